"""Keyed aggregates: batch group-sum (A1), rolling aggregates (R1-R8) and
the final value per key (A2).

"Rolling" = one output row per input row, holding the aggregate of the key
so far in ``order``.  Non-aggregated fields come from the key's *first* row
(sum/min/max/reduce), or from the extreme row itself (min_by/max_by, ties go
to the lowest ``order``).  All of them go through ``prefix.running``, so a
hot key is split over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.operators.prefix import _order_number, running


def group_sum(df: DataFrame, key, value=None, name: str = "n") -> DataFrame:
    """A1: ``groupBy(key).sum(value)`` (count when ``value`` is None).
    Partial aggregation runs before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    agg = F.count(F.lit(1)) if value is None else F.sum(value)
    return df.groupBy(*keys).agg(agg.alias(name))


def _firsts(carry) -> dict:
    return {f"first_{c}": ("first", F.col(c)) for c in (carry or [])}


def rolling_count(df, key, order, name="n", **kw) -> DataFrame:
    """Running count per key."""
    return running(df, key, order, {name: ("count", F.lit(1))}, **kw)


def rolling_sum(df, key, order, value, carry=(), name=None, **kw) -> DataFrame:
    """R2: running sum; ``carry`` fields come from the key's first row."""
    return running(df, key, order, {name or f"sum_{value}": ("sum", F.col(value)), **_firsts(carry)}, **kw)


def rolling_min(df, key, order, value, carry=(), name=None, **kw) -> DataFrame:
    """Running minimum, other fields from the first row."""
    return running(df, key, order, {name or f"min_{value}": ("min", F.col(value)), **_firsts(carry)}, **kw)


def rolling_max(df, key, order, value, carry=(), name=None, **kw) -> DataFrame:
    """Running maximum, other fields from the first row."""
    return running(df, key, order, {name or f"max_{value}": ("max", F.col(value)), **_firsts(carry)}, **kw)


def _arg_extreme(df, key, order, value, cols, prefix, largest, **kw) -> DataFrame:
    # Structs compare field by field: (value, tie-breaker, payload...).
    # A row without a value never holds the extreme.
    tie = (-_order_number(df, order)) if largest else F.col(order)
    packed = F.when(F.col(value).isNotNull(), F.struct(
        F.col(value).alias("v"), tie.alias("t"), F.col(order).alias("o"), *[F.col(c).alias(c) for c in cols]))
    out = running(df, key, order, {"_fl_arg": ("max" if largest else "min", packed)}, **kw)
    fields = [F.col("_fl_arg.v").alias(f"{prefix}_{value}"), F.col("_fl_arg.o").alias(f"{prefix}_{order}")]
    fields += [F.col(f"_fl_arg.{c}").alias(f"{prefix}_{c}") for c in cols]
    return out.select(*[F.col(c) for c in df.columns], *fields)


def rolling_min_by(df, key, order, value, cols=(), prefix="argmin", **kw) -> DataFrame:
    """The whole row holding the running minimum; first row wins ties."""
    return _arg_extreme(df, key, order, value, list(cols), prefix, largest=False, **kw)


def rolling_max_by(df, key, order, value, cols=(), prefix="argmax", **kw) -> DataFrame:
    """The whole row holding the running maximum; first row wins ties."""
    return _arg_extreme(df, key, order, value, list(cols), prefix, largest=True, **kw)


def rolling_reduce(df, key, order, reduced: dict[str, str | tuple[str, str]], carry=(), **kw) -> DataFrame:
    """Pairwise reduce with associative combiners, other fields from the
    first row.  ``reduced`` maps an output name to a column, which is summed,
    or to ``(kind, column)`` with one of ``prefix.KINDS`` (sum, count, min,
    max, first; min and max take structs too)."""
    aggs = {out: (("sum", F.col(c)) if isinstance(c, str) else (c[0], F.col(c[1]))) for out, c in reduced.items()}
    return running(df, key, order, {**aggs, **_firsts(carry)}, **kw)


def rolling_avg(df, key, order, value, name="avg", carry=(), **kw) -> DataFrame:
    """Running ``sum(value) / count`` as a double (R7 then a ratio)."""
    d = df.withColumn("_fl_one", F.lit(1))
    out = running(d, key, order, {"_fl_s": ("sum", F.col(value)), "_fl_n": ("sum", F.col("_fl_one")),
                                  **_firsts(carry)}, **kw)
    return out.withColumn(name, F.col("_fl_s").cast("double") / F.col("_fl_n")) \
        .drop("_fl_s", "_fl_n", "_fl_one")


def final_aggregates(df: DataFrame, key, order: str, value: str, cols=()) -> DataFrame:
    """A2: what each rolling operator ends at on a bounded input, per key:
    count, sum, min, max, arg-min/arg-max rows (ties to the lowest ``order``),
    average, and the first row's fields.  One hash aggregate with partial
    aggregation; no per-key serial scan."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(cols)
    v, o = F.col(value), F.col(order)
    valued = v.isNotNull()
    lo = F.min(F.when(valued, F.struct(v.alias("v"), o.alias("t"), *[F.col(c) for c in cols])))
    hi = F.max(F.when(valued, F.struct(v.alias("v"), (-_order_number(df, order)).alias("t"), o.alias("o"),
                                       *[F.col(c) for c in cols])))
    first = F.min(F.struct(o.alias("t"), *[F.col(c) for c in cols]))
    agg = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(v).alias(f"sum_{value}"),
        F.min(v).alias(f"min_{value}"), F.max(v).alias(f"max_{value}"),
        lo.alias("_lo"), hi.alias("_hi"), first.alias("_first"))
    out = [*keys, "n", f"sum_{value}", f"min_{value}", f"max_{value}",
           F.col("_lo.t").alias(f"argmin_{order}"), F.col("_hi.o").alias(f"argmax_{order}"),
           (F.col(f"sum_{value}").cast("double") / F.col("n")).alias(f"avg_{value}")]
    out += [F.col(f"_lo.{c}").alias(f"argmin_{c}") for c in cols]
    out += [F.col(f"_hi.{c}").alias(f"argmax_{c}") for c in cols]
    out += [F.col(f"_first.{c}").alias(f"first_{c}") for c in cols]
    return agg.select(*out)
