"""Running (prefix) aggregates that do not serialise a hot key.

``Window.partitionBy(key).orderBy(o)`` puts every row of a key into one task;
if one key holds a third of the data, one task scans a third of the data.
``running`` cuts each hot key's rows into chunks by order and works in two levels:

1. inside each ``(key, chunk)``: the ordinary window scan, partitioned by
   ``(key, chunk)``, so a hot key is spread over many tasks;
2. per ``(key, chunk)``: one total row (partial + final hash aggregate);
   a window over these totals gives the *carry-in* of every chunk, i.e. the
   aggregate of all earlier chunks of the key.  That table has at most
   ``chunks per key`` rows per key, independent of how many rows the key has;
3. join the carry-in back on ``(key, chunk)`` and combine.

By default ``plan_chunks`` measures the data first (one small job, a bounded
sketch of frequent keys).  When no key is hot the plain window is cheaper
(one shuffle, no join) and is used.  Otherwise only the hot keys, which meet
the rows as a small broadcast table, are cut into chunks and aggregated into
chunk totals; every other key stays one chunk and just probes the small
carry table.  Key-less scans always split.

Valid for the associative, order-insensitive combiners ``sum``, ``count``,
``min``, ``max`` (also on structs, which gives arg-min/arg-max) and ``first``
(the value at the lowest order).  ``order`` is an integral, timestamp or
date column that is a total order within each key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

KINDS = ("sum", "count", "min", "max", "first")
AUTO = "auto"
_CHUNK = "_fl_chunk"
_KEY = "_fl_key"
_HOT = "_fl_hot"
_POINTS = "_fl_points"
SKETCH_ITEMS, SKETCH_MOST = 10_000, 1_000_000
_NO_CHUNK = -(2 ** 62)


def _as_list(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def _order_number(df: DataFrame, order: str) -> Column:
    """A monotone integral view of the order column for chunking:
    timestamps as microseconds, dates as days since the epoch."""
    kind = dict(df.dtypes)[order]
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(order).cast("timestamp"))
    if kind == "date":
        return F.unix_date(F.col(order))
    return F.col(order)


def _partitions(spark) -> int:
    try:
        return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    except Exception:  # noqa: BLE001
        return max(1, spark.sparkContext.defaultParallelism)


@dataclass(frozen=True)
class ScanPlan:
    """How ``running`` scans.  All fields ``None``: the plain window.

    ``width``: chunks of that width of the order column, for every key.
    ``points``: chunks between measured points of the order column; one tuple
    of points per key of ``hot``, or a single one without keys."""
    width: int | None
    hot: tuple | None = None
    points: tuple | None = None

    @property
    def split(self) -> bool:
        return self.width is not None or self.points is not None


def _quantiles(o: Column, chunks: int) -> Column:
    """The ``chunks - 1`` inner quantiles of ``o``; an error in rank of a tenth of a chunk."""
    return F.percentile_approx(o, [i / chunks for i in range(1, chunks)], max(10000, 10 * chunks))


def plan_chunks(df: DataFrame, keys, order: str, skew_factor: float = 2.0,
                oversplit: int = 2) -> ScanPlan:
    """Measure the data and decide how to scan.

    One job reads the keys into a sketch of frequent items over their 64-bit
    hashes, of bounded size and without a shuffle of keys; a single row comes
    back.  A key is hot when the sketch gives it more than ``skew_factor``
    times the rows of an average shuffle partition.  The sketch never gives a
    key too few rows, and at most half an average partition too many, so no
    hot key is missed and fewer than ``partitions`` are found.  No hot key:
    plain window.  Otherwise a second job reads the rows of the hot keys only
    and cuts each at quantiles of its own order values, so that its chunks
    hold about half an average partition each however its rows lie in the
    order range.  Fewer than ``oversplit * partitions`` points together (and
    one more a key) are fetched.  Cold keys stay in one chunk and skip the
    chunk totals.  Without keys the whole table is one hot group.  Rows that
    repeat one order value are not cut apart.
    """
    keys = _as_list(keys)
    o = _order_number(df, order)
    parts = _partitions(df.sparkSession)
    if not keys:
        row = df.agg(_quantiles(o, max(2, oversplit * parts)).alias("points")).first()
        if row is None or row["points"] is None:
            return ScanPlan(None)            # empty, or no order value at all
        return ScanPlan(None, None, (tuple(sorted(set(row["points"]))),))
    # an error of at most 3.5 / items of all rows, which is under half an average partition
    items = min(SKETCH_MOST, max(SKETCH_ITEMS, 1 << (8 * parts - 1).bit_length()))
    hashed = df.select(F.xxhash64(*keys).alias("h"))
    row = hashed.agg(F.count(F.lit(1)).alias("total"), F.expr(f"approx_top_k(h, {min(parts, items // 8)}, {items})").alias("top")).first()
    if row is None or not row["total"]:
        return ScanPlan(None)
    per_part = max(1.0, row["total"] / parts)
    threshold = skew_factor * per_part
    hot = {r["item"]: r["count"] for r in row["top"] if r["count"] > threshold}
    if not hot:
        return ScanPlan(None)
    # skewed: a second job cuts the hot keys.  Quantiles for the hottest one,
    # thinned for the others before they are fetched.
    finest = max(2, oversplit * math.ceil(max(hot.values()) / per_part))
    own = F.least(F.lit(finest), F.greatest(F.lit(2), F.lit(oversplit) * F.ceil(F.col("_n") / F.lit(per_part)))).cast("int")
    found = F.broadcast(df.sparkSession.createDataFrame([(h,) for h in hot], f"{_HOT} bigint"))   # under ``partitions`` rows
    cut = (df.join(found, F.xxhash64(*keys) == F.col(_HOT), "left_semi").groupBy(*keys)
           .agg(F.count(F.lit(1)).alias("_n"), _quantiles(o, finest).alias("_q"))
           .filter((F.col("_n") > threshold) & F.col("_q").isNotNull())
           .select(*keys, F.transform(F.sequence(F.lit(1), own - 1), lambda j: F.element_at(
               "_q", F.greatest(F.lit(1), F.floor(j * F.lit(finest) / own).cast("int")))).alias("_q")).collect())
    if not cut:
        return ScanPlan(None)
    return ScanPlan(None, tuple(tuple(r[k] for k in keys) for r in cut), tuple(tuple(sorted(set(r["_q"]))) for r in cut))


def _points_passed(o: Column, points: Column, most: int) -> Column:
    """How many of the sorted ``points``, ``most`` at most, are at most ``o``:
    a binary search, so wide plans cost a row only its logarithm."""
    steps = [1 << i for i in reversed(range(max(1, most.bit_length())))]

    def step(at: Column, by: Column) -> Column:
        past = at + by
        return F.when((past <= F.size(points)) & (F.get(points, past - 1) <= o), past).otherwise(at)
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step).cast("bigint")


def _with_chunks(df: DataFrame, keys: list[str], order: str, plan: ScanPlan) -> DataFrame:
    """``df`` with the chunk of each row and whether its key is split.  Cold
    keys and null orders (which sort first anyway) have ``_NO_CHUNK``, so the
    chunk is never null.  The hot keys and their points meet the rows as a
    broadcast table; ``plan_chunks`` bounds it."""
    o = _order_number(df, order)
    some = bool(keys) and plan.hot is not None
    if some:
        points = plan.points or ((),) * len(plan.hot)
        fields = [StructField(f"{_HOT}_{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
        table = df.sparkSession.createDataFrame([(*h, list(p)) for h, p in zip(plan.hot, points)],
                                                StructType([*fields, StructField(_POINTS, ArrayType(LongType()))]))
        same = F.lit(True)
        for f, k in zip(fields, keys):
            same = same & F.col(k).eqNullSafe(F.col(f.name))
        d = df.join(F.broadcast(table), same, "left")
    elif plan.points is not None:
        d = df.withColumn(_POINTS, F.lit(list(plan.points[0])).cast("array<bigint>"))
    else:
        d = df.withColumn(_POINTS, F.array().cast("array<bigint>"))
    if plan.points is None:
        chunk = F.floor(o / F.lit(plan.width)).cast("bigint")
    else:
        chunk = _points_passed(o, F.col(_POINTS), max(map(len, plan.points)))
    hot = F.col(_POINTS).isNotNull()
    return d.select(*df.columns, F.coalesce(F.when(o.isNotNull() & hot, chunk), F.lit(_NO_CHUNK)).alias(_CHUNK), hot.alias(_HOT))


def _window_agg(kind: str, e: Column, w) -> Column:
    if kind == "sum":
        return F.sum(e).over(w)
    if kind == "count":
        return F.count(e).over(w)
    if kind == "min":
        return F.min(e).over(w)
    if kind == "max":
        return F.max(e).over(w)
    if kind == "first":
        return F.first(e).over(w)
    raise ValueError(f"unsupported running aggregate {kind!r}; use one of {KINDS}")


def _chunk_total(kind: str, e: Column, order: str) -> Column:
    if kind == "sum":
        return F.sum(e)
    if kind == "count":
        return F.count(e)
    if kind == "min":
        return F.min(e)
    if kind == "max":
        return F.max(e)
    if kind == "first":
        return F.min_by(e, F.col(order))
    raise ValueError(kind)


def _carry(kind: str, t: Column, w) -> Column:
    # combine chunk totals of all earlier chunks
    if kind in ("sum", "count"):
        return F.sum(t).over(w)
    if kind == "min":
        return F.min(t).over(w)
    if kind == "max":
        return F.max(t).over(w)
    if kind == "first":
        return F.first(t).over(w)
    raise ValueError(kind)


def _combine(kind: str, carry: Column, inner: Column, n_before: Column) -> Column:
    if kind == "sum":
        return F.when(carry.isNull(), inner).when(inner.isNull(), carry).otherwise(carry + inner)
    if kind == "count":
        return F.coalesce(carry, F.lit(0)) + inner
    if kind == "min":
        return F.least(carry, inner)
    if kind == "max":
        return F.greatest(carry, inner)
    if kind == "first":
        return F.when(n_before > 0, carry).otherwise(inner)
    raise ValueError(kind)


def running(df: DataFrame, keys, order: str, aggs: dict[str, tuple[str, Column]],
            include_current: bool = True, chunk_width: int | str | ScanPlan | None = AUTO) -> DataFrame:
    """Add one column per entry of ``aggs`` (``name -> (kind, expr)``) holding
    the aggregate over the rows of the same key up to this row in ``order``
    (``include_current=False``: strictly before it).

    ``chunk_width``: ``"auto"`` (default) measures the data with
    ``plan_chunks``; ``None`` forces the plain single-level window (one task
    per key); an integer forces the two-level scan of every key with that
    chunk width; a ``ScanPlan`` is used as given.
    """
    keys = _as_list(keys)
    frame_end = Window.currentRow if include_current else -1
    if chunk_width == AUTO:
        plan = plan_chunks(df, keys, order)
    elif isinstance(chunk_width, ScanPlan):
        plan = chunk_width
    else:
        plan = ScanPlan(chunk_width)
    if not plan.split:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, frame_end)
        return df.select("*", *[_window_agg(k, e, w).alias(n) for n, (k, e) in aggs.items()])

    # One struct key: never null itself (null fields compare equal), so rows
    # with a null key are kept by the join below, and the join reuses the
    # window's partitioning on (key, chunk) instead of shuffling again.
    key = F.struct(*keys) if keys else F.lit(0)
    some = bool(keys) and plan.hot is not None
    chunked = _with_chunks(df, keys, order, plan).withColumn(_KEY, key)
    d = chunked.drop(_HOT)

    w_in = Window.partitionBy(_KEY, _CHUNK).orderBy(order) \
        .rowsBetween(Window.unboundedPreceding, frame_end)
    inner = d.select("*", *[_window_agg(k, e, w_in).alias(f"_fl_in_{n}") for n, (k, e) in aggs.items()])

    # chunk totals of the split keys only (cold keys have no earlier chunk)
    totals = (chunked.filter(_HOT) if some else d).groupBy(_KEY, _CHUNK).agg(
        *[_chunk_total(k, e, order).alias(f"_fl_t_{n}") for n, (k, e) in aggs.items()])
    w_c = Window.partitionBy(_KEY).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        _KEY, _CHUNK,
        F.count(F.lit(1)).over(w_c).alias("_fl_nb"),
        *[_carry(k, F.col(f"_fl_t_{n}"), w_c).alias(f"_fl_c_{n}") for n, (k, _e) in aggs.items()])

    if some and plan.points is not None:   # a row for each point and hot key, which ``plan_chunks`` bounds
        carry = F.broadcast(carry)
    joined = inner.join(carry, on=[_KEY, _CHUNK], how="left" if some else "inner")
    nb = F.coalesce(F.col("_fl_nb"), F.lit(0))
    out_cols = [F.col(c) for c in df.columns]
    for n, (k, _e) in aggs.items():
        out_cols.append(_combine(k, F.col(f"_fl_c_{n}"), F.col(f"_fl_in_{n}"), nb).alias(n))
    return joined.select(*out_cols)


def row_number(df: DataFrame, keys, order: str, name: str = "rn", **kw) -> DataFrame:
    """1-based position of each row within its key, skew-split like ``running``."""
    return running(df, keys, order, {name: ("count", F.lit(1))}, **kw)


__all__: Sequence[str] = ("running", "row_number", "plan_chunks", "ScanPlan", "KINDS", "AUTO")
