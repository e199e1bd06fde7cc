"""Time windows on a bounded table: tumbling (W1/W2), sliding (W3/W4),
session (W5-W7), and the count-triggered global window (W8, in
``counting``).

Windows are ``[start, end)`` aligned to the epoch.  The time column may be
``timestamp`` or ``timestamp_ntz``; the bounds come back in the same type.

Tumbling and sliding windows are hash aggregates with partial aggregation,
so neither a global (un-keyed) window nor a hot key lands in one task.  A
sliding window of many slides goes by panes: rows are aggregated once, not
copied into every window they lie in.

Sessions use a lossless pre-collapse: two events in the same gap-wide
bucket ``floor(t / gap)`` are less than a gap apart, so they are always in
one session.  Buckets are reduced in parallel; the gaps-and-islands step
then runs on bucket rows only, at most ``time span / gap`` per key, as the
two-level prefix scan, so neither a global session window nor a hot key is
serialised.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.operators.prefix import AUTO, plan_chunks, running

PANE_COPIES = 16       # from so many slides a window on, by panes
_UNIT_US = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
            "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}
_COMBINE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def _agg_exprs(aggs: dict[str, tuple[str, Column]]):
    out = []
    for name, (kind, e) in aggs.items():
        fn = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[kind]
        out.append(fn(e).alias(name))
    return out


def tumbling(df: DataFrame, time_col: str, size: str, aggs: dict[str, tuple[str, Column]],
             keys=None) -> DataFrame:
    """Tumbling windows of ``size`` (e.g. ``"1 hour"``)."""
    return sliding(df, time_col, size, None, aggs, keys)


def interval_us(text: str) -> int:
    """Microseconds of an interval such as ``"1 hour 30 minutes"``."""
    parts = re.findall(r"(\d+)\s+([a-z]+?)s?(?=\s|$)", text.lower())
    if not parts or any(u not in _UNIT_US for _, u in parts):
        raise ValueError(f"not an interval of fixed length: {text!r}")
    return sum(int(n) * _UNIT_US[u] for n, u in parts)


def sliding(df: DataFrame, time_col: str, size: str, slide: str | None,
            aggs: dict[str, tuple[str, Column]], keys=None) -> DataFrame:
    """Sliding windows (``slide=None``: tumbling).  From
    ``PANE_COPIES`` slides a window on, ``sliding_panes`` gives the rows."""
    if slide and interval_us(size) >= PANE_COPIES * interval_us(slide):
        return sliding_panes(df, time_col, size, slide, aggs, keys)
    keys = _keys(keys)
    win = F.window(time_col, size, slide) if slide else F.window(time_col, size)
    g = df.groupBy(*keys, win.alias("w")).agg(*_agg_exprs(aggs))
    return g.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *aggs.keys())


def sliding_panes(df: DataFrame, time_col: str, size: str, slide: str,
                  aggs: dict[str, tuple[str, Column]], keys=None) -> DataFrame:
    """W3/W4 by panes, for ``sum``/``count``/``min``/``max``.

    A pane is the greatest common part of size and slide; rows are aggregated
    per pane once.  Panes are grouped into blocks as long as a window, so a
    window is the end of one block and the beginning of the next: its value
    combines a suffix of the one with a prefix of the other, both running
    aggregates inside a block.  No step holds more than a block's panes of a
    key, and after the first aggregate there are at most two rows a window.
    A window without rows is not returned; rows without a time lie in none."""
    keys = _keys(keys)
    size_us, slide_us = interval_us(size), interval_us(slide)
    pane_us = math.gcd(size_us, slide_us)
    k, every = size_us // pane_us, slide_us // pane_us
    ntz = dict(df.dtypes)[time_col] == "timestamp_ntz"
    p, b = F.col("_fl_p"), F.col("_fl_b")

    def down(c: Column, by: int) -> Column:
        return c - F.pmod(c, F.lit(by))
    panes = (df.withColumn("_fl_t", F.unix_micros(F.col(time_col).cast("timestamp"))).filter("_fl_t IS NOT NULL")
             .withColumn("_fl_p", F.expr(f"(_fl_t - pmod(_fl_t, {pane_us})) div {pane_us}"))
             .groupBy(*keys, "_fl_p").agg(*_agg_exprs(aggs)).withColumn("_fl_b", down(p, k)))   # a block's first pane
    w = Window.partitionBy(*keys, "_fl_b").orderBy("_fl_p")
    ends = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    begins = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def side(frame, lo: Column, hi: Column) -> Column:
        # windows are known by their first pane, a multiple of ``every``
        return F.struct((-down(-lo, every)).alias("_fl_lo"), hi.alias("_fl_hi"),
                        *[_COMBINE[kind](F.col(n)).over(frame).alias(n) for n, (kind, _e) in aggs.items()])
    suffix = side(ends, F.coalesce(F.lag(p).over(w) + 1, b), p)
    # the windows whose last pane is ``p`` or a later one before the next
    # pane with rows; the one that is the whole block is a suffix already
    prefix = side(begins, p - k + 1, F.coalesce(F.lead(p).over(w) - 1, b + k - 2) - k + 1)
    sides = panes.select(*keys, F.array(suffix, prefix).alias("_fl_sides")).select(*keys, F.inline("_fl_sides"))
    each = sides.filter("_fl_lo <= _fl_hi").withColumn("_fl_w", F.explode(F.sequence("_fl_lo", "_fl_hi", F.lit(every).cast("bigint"))))
    g = each.groupBy(*keys, "_fl_w").agg(*[_COMBINE[kind](F.col(n)).alias(n) for n, (kind, _e) in aggs.items()])
    start = F.timestamp_micros(F.col("_fl_w") * F.lit(pane_us))
    end = F.timestamp_micros(F.col("_fl_w") * F.lit(pane_us) + F.lit(size_us))
    if ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    return g.select(*keys, start.alias("window_start"), end.alias("window_end"), *aggs.keys())


def sessions_native(df: DataFrame, time_col: str, gap: str, aggs: dict[str, tuple[str, Column]],
                    keys=None) -> DataFrame:
    """Sessions with Spark's ``session_window`` (one task per key)."""
    keys = _keys(keys)
    g = df.groupBy(*keys, F.session_window(time_col, gap).alias("w")).agg(*_agg_exprs(aggs))
    return g.select(*keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"),
                    *aggs.keys())


def merge_intervals(parts: DataFrame, keys: list[str], gap_us: int, combine: dict[str, Column],
                    once: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Intervals ``_fl_s, _fl_e`` (microseconds) that lie at most ``gap_us``
    apart become one, per key, their other columns by ``combine``.  Intervals
    may overlap; the scan over them is the two-level one.  ``once`` may keep
    a table that is read several times."""
    d = once(parts.groupBy(*keys, "_fl_s").agg(F.max("_fl_e").alias("_fl_e"), *combine.values()))   # one row per place in the order
    plan = plan_chunks(d, keys, "_fl_s")
    d = running(d, keys, "_fl_s", {"_fl_prev": ("max", F.col("_fl_e"))}, include_current=False, chunk_width=plan)
    d = once(d.withColumn("_fl_new", (F.col("_fl_prev").isNull() | (F.col("_fl_s") - F.col("_fl_prev") > gap_us)).cast("int")))
    d = running(d, keys, "_fl_s", {"_fl_sid": ("sum", F.col("_fl_new"))}, chunk_width=plan)
    return d.groupBy(*keys, "_fl_sid").agg(F.min("_fl_s").alias("_fl_s"), F.max("_fl_e").alias("_fl_e"), *combine.values()).drop("_fl_sid")


def sessions(df: DataFrame, time_col: str, gap_us: int, aggs: dict[str, tuple[str, Column]],
             keys=None, chunk_width=AUTO) -> DataFrame:
    """Session windows with gap ``gap_us`` microseconds.

    A row joins the current session when it is at most ``gap`` after the
    session's last row; a session is ``[first, last + gap)``.  Aggregates
    must be ``sum``/``count``/``min``/``max``.
    """
    keys = _keys(keys)
    ntz = dict(df.dtypes)[time_col] == "timestamp_ntz"
    t = F.unix_micros(F.col(time_col).cast("timestamp"))
    d = df.withColumn("_fl_t", t).withColumn("_fl_b", F.floor(F.col("_fl_t") / F.lit(gap_us)).cast("bigint"))
    if chunk_width == AUTO:
        # measured on the raw rows: a key's bucket count is at most its row count
        chunk_width = plan_chunks(d, keys, "_fl_b")
    # 1. lossless collapse into gap-wide buckets (parallel, partial agg)
    b = d.groupBy(*keys, "_fl_b").agg(
        F.min("_fl_t").alias("_fl_s"), F.max("_fl_t").alias("_fl_e"), *_agg_exprs(aggs))
    # 2. a bucket opens a session when it starts more than a gap after the
    #    last row of all earlier buckets of the key
    b = running(b, keys, "_fl_b", {"_fl_prev": ("max", F.col("_fl_e"))}, include_current=False,
                chunk_width=chunk_width)
    b = b.withColumn("_fl_new", (F.col("_fl_prev").isNull() | (F.col("_fl_s") - F.col("_fl_prev") > gap_us))
                     .cast("int"))
    b = running(b, keys, "_fl_b", {"_fl_sid": ("sum", F.col("_fl_new"))}, chunk_width=chunk_width)
    # 3. one row per session
    s = b.groupBy(*keys, "_fl_sid").agg(
        F.min("_fl_s").alias("_fl_s"), F.max("_fl_e").alias("_fl_e"),
        *[_COMBINE[k](F.col(n)).alias(n) for n, (k, _e) in aggs.items()])
    start = F.timestamp_micros(F.col("_fl_s"))
    end = F.timestamp_micros(F.col("_fl_e") + F.lit(gap_us))
    if ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    return s.select(*keys, start.alias("session_start"), end.alias("session_end"), *aggs.keys())
