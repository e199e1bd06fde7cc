"""Event time (T1), and the late-row report (T5): the batch oracle of a
bounded-lateness watermark (T3/T4).

The watermark seen by a row is ``max(event time of the rows that arrived
before it) - delay``; a row is late when the session it would open,
``[t, t + gap)``, already ends at or before that watermark (Spark's test
for session windows).  The prefix maximum over the whole arrival order is
computed in two levels (``prefix.running`` without a key), never as one
global ``Window.orderBy`` in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.functions.exprs import event_time, millis_to_time

from flowlab.operators.prefix import AUTO, running


def with_event_time(df: DataFrame, col: str, name: str = "event_time", millis: bool = False) -> DataFrame:
    """Event-time column; ``millis=True`` reads epoch milliseconds."""
    c = millis_to_time(col) if millis else event_time(col)
    return df.withColumn(name, c)


def delayed_arrival(order: str, every: int, places: int) -> Column:
    """An arrival order where every ``every``-th row (``order % every == 0``)
    arrives ``places`` later: its position key becomes ``order + places``,
    and on a tie the row with the lower ``order`` arrives first.  Returned
    as one integral column (``2 * key + tie``) so it can be chunked."""
    o = F.col(order)
    delayed = (o % every) == 0
    key = F.when(delayed, o + places).otherwise(o)
    return key * 2 + F.when(delayed, F.lit(0)).otherwise(F.lit(1))


def late_report(df: DataFrame, time_col: str, arrival: str, gap_us: int, delay_us: int,
                chunk_width: int | str | None = AUTO) -> DataFrame:
    """All rows with the watermark they met on arrival and a ``late`` flag."""
    t = F.unix_micros(F.col(time_col).cast("timestamp"))
    d = df.withColumn("_fl_t", t)
    d = running(d, [], arrival, {"_fl_max": ("max", F.col("_fl_t"))}, include_current=False,
                chunk_width=chunk_width)
    wm = F.col("_fl_max") - F.lit(delay_us)
    ntz = dict(df.dtypes)[time_col] == "timestamp_ntz"
    wm_ts = F.timestamp_micros(wm)
    if ntz:
        wm_ts = wm_ts.cast("timestamp_ntz")
    late = F.coalesce(F.col("_fl_t") + F.lit(gap_us) <= wm, F.lit(False))
    return d.withColumn("watermark", wm_ts).withColumn("late", late).drop("_fl_t", "_fl_max")
