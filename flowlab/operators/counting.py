"""Count-based operators on a bounded table.

* ``count_window`` (K1/K3/K4): per key, the sum of every ``size``
  consecutive values; a group is emitted once full and state is cleared,
  so a trailing partial group is never emitted.
* ``count_window_list`` (K2): the same, also emitting the values as
  ``" v1 v2 ... vN"`` (leading blank).
* ``count_trigger`` (W8): global window per key firing on every
  ``every``-th row *without* purging: running totals at rows every, 2*every...
* ``batched`` / ``batched_rows`` (S10 batch forms): rows buffered per shard
  and flushed in batches of ``threshold`` - one summary row per flushed
  batch, or the flushed rows themselves; the remainder stays buffered (no
  final flush).

Positions come from the skew-split prefix count (``prefix.running``), so
no key is scanned by one task; groups are then ordinary hash aggregates
with at most ``size`` rows each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowlab.operators.prefix import running


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _grouped(df, keys, order, size, **kw):
    d = running(df, keys, order, {"_fl_rn": ("count", F.lit(1))}, **kw)
    return d.withColumn("_fl_g", F.floor((F.col("_fl_rn") - 1) / F.lit(size)).cast("bigint"))


def count_window(df: DataFrame, keys, order: str, value: str, size: int = 10,
                 name: str = "total", index: str = "window_no", **kw) -> DataFrame:
    keys = _keys(keys)
    g = _grouped(df, keys, order, size, **kw)
    out = g.groupBy(*keys, F.col("_fl_g").alias(index)).agg(
        F.count(F.lit(1)).alias("_fl_n"), F.sum(value).alias(name))
    return out.filter(F.col("_fl_n") == size).drop("_fl_n")


def count_window_list(df: DataFrame, keys, order: str, value: str, size: int = 10,
                      name: str = "total", values: str = "values", index: str = "window_no",
                      **kw) -> DataFrame:
    keys = _keys(keys)
    g = _grouped(df, keys, order, size, **kw)
    out = g.groupBy(*keys, F.col("_fl_g").alias(index)).agg(
        F.count(F.lit(1)).alias("_fl_n"), F.sum(value).alias(name),
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))).alias("_fl_l"))
    text = F.concat(F.lit(" "), F.concat_ws(" ", F.transform("_fl_l", lambda x: x["v"].cast("string"))))
    return out.filter(F.col("_fl_n") == size).select(*keys, index, text.alias(values), name)


def count_trigger(df: DataFrame, keys, order: str, value: str, every: int = 5, carry=(),
                  name: str = "total", **kw) -> DataFrame:
    keys = _keys(keys)
    aggs = {"n": ("count", F.lit(1)), name: ("sum", F.col(value))}
    aggs.update({f"first_{c}": ("first", F.col(c)) for c in carry})
    d = running(df, keys, order, aggs, **kw)
    return d.filter(F.col("n") % every == 0).select(*keys, order, "n", name, *[f"first_{c}" for c in carry])


def batched(df: DataFrame, shard, order: str, threshold: int, value: str | None = None,
            **kw) -> DataFrame:
    """One row per emitted batch: ``shard, batch_no, rows, first/last order``
    (and ``total`` of ``value``).  Only full batches are emitted."""
    keys = _keys(shard)
    g = _grouped(df, keys, order, threshold, **kw)
    aggs = [F.count(F.lit(1)).alias("rows"), F.min(order).alias(f"first_{order}"),
            F.max(order).alias(f"last_{order}")]
    if value:
        aggs.append(F.sum(value).alias("total"))
    out = g.groupBy(*keys, F.col("_fl_g").alias("batch_no")).agg(*aggs)
    return out.filter(F.col("rows") == threshold)


def batched_rows(df: DataFrame, shard, order: str, threshold: int, **kw) -> DataFrame:
    """S10 sink content: every row that a threshold-buffered sink has flushed,
    tagged with ``batch_no``; rows of a shard's trailing partial batch are
    still buffered and are not returned.

    A batch is full when it holds ``threshold`` rows.  They are counted over
    ``(shard, batch_no)``, at most ``threshold`` rows at a time, so the input
    is read once and a hot shard is not serialised."""
    keys = _keys(shard)
    g = _grouped(df, keys, order, threshold, **kw)
    full = F.count(F.lit(1)).over(W.partitionBy(*keys, "_fl_g")) == threshold
    g = g.withColumn("_fl_full", full)
    return g.filter("_fl_full").select(*[F.col(c) for c in df.columns], F.col("_fl_g").alias("batch_no"))
