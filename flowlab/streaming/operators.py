"""Streaming forms of the operators.  Each has a batch twin in
``flowlab.operators``; tests check that both give the same rows for any
cut of the input into micro-batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.functions.exprs import event_time, millis_to_time
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType, StringType, StructField, StructType

from pyspark.sql.streaming.state import GroupStateTimeout

from flowlab.streaming.stateful import (CountTriggerProcessor, CountWindowProcessor, RollingProcessor,
                                        count_trigger_fn, count_trigger_state_schema, count_window_fn,
                                        count_window_state_schema, rolling_fn, rolling_state_schema)

PANDAS_STATE = "applyInPandasWithState"
TRANSFORM_WITH_STATE = "transformWithStateInPandas"


def _stateful(grouped, engine: str, fn, processor, out_schema: StructType, state_schema: str) -> DataFrame:
    if engine == PANDAS_STATE:
        return grouped.applyInPandasWithState(fn, out_schema, state_schema, "append", GroupStateTimeout.NoTimeout)
    if engine == TRANSFORM_WITH_STATE:
        return grouped.transformWithStateInPandas(processor, out_schema, "Append", "None")
    raise ValueError(f"unknown state engine {engine!r}")


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def _whole(df: DataFrame, value: str):
    """The value as bigint.  The state steps count in whole numbers: a
    fractional column is refused, never cut (pass cents or micros)."""
    kind = df.schema[value].dataType
    if not isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        raise TypeError(f"{value} is {kind.simpleString()}; the streaming state steps take whole numbers")
    return F.col(value).cast("bigint").alias(value)


def _key_fields(df: DataFrame, keys: list[str]) -> list[StructField]:
    return [df.schema[k] for k in keys]


def with_event_time(df: DataFrame, col: str, name: str = "event_time", delay: str = "0 seconds",
                    millis: bool = False) -> DataFrame:
    """Event time from a column plus a bounded-lateness watermark
    (``delay`` = allowed out-of-orderness; ``"0 seconds"`` is the monotone
    case).  ``timestamp_ntz`` is reinterpreted in the session zone (UTC)."""
    c = millis_to_time(col) if millis else event_time(col)
    return df.withColumn(name, c).withWatermark(name, delay)


def processing_time(df: DataFrame, name: str = "proc_time") -> DataFrame:
    """Processing-time clock (constant within a micro-batch)."""
    return df.withColumn(name, F.current_timestamp())


def window_agg_stream(df: DataFrame, time_col: str, size: str, slide: str | None,
                      aggs: dict[str, Column], keys=None) -> DataFrame:
    """W1-W4 on a stream (aggregates given as finished Column expressions)."""
    keys = _keys(keys)
    win = F.window(time_col, size, slide) if slide else F.window(time_col, size)
    g = df.groupBy(*keys, win.alias("w")).agg(*[e.alias(n) for n, e in aggs.items()])
    return g.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *aggs.keys())


def session_agg_stream(df: DataFrame, time_col: str, gap: str, aggs: dict[str, Column],
                       keys=None) -> DataFrame:
    """W5-W7 on a stream.  A streaming session window needs a grouping key;
    an un-keyed (global) session uses a constant key, with sessions merged
    inside each partition before the shuffle (``SESSION_CONF``)."""
    keys = _keys(keys)
    if not keys:
        df = df.withColumn("_fl_all", F.lit(0))
    group = keys or ["_fl_all"]
    g = df.groupBy(*group, F.session_window(time_col, gap).alias("w")).agg(
        *[e.alias(n) for n, e in aggs.items()])
    return g.select(*keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"),
                    *aggs.keys())


def exclude_stream(df: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """J5 on a stream: stream-static anti-join; the static list is read when
    each micro-batch is planned ("complete as of the start of the batch")."""
    return df.join(excluded.select(key).distinct(), on=key, how="left_anti")


def exclude_per_batch(load_excluded, key: str, write):
    """J5 with an exclusion list that changes while the stream runs: a
    ``foreachBatch`` function that re-reads the list (``load_excluded()``)
    at the start of every micro-batch, anti-joins, and hands the kept rows
    to ``write(df, batch_id)`` (use an idempotent writer)."""
    from flowlab.operators.joins import exclude

    def run(batch: DataFrame, batch_id: int) -> None:
        write(exclude(batch, load_excluded(), key), batch_id)
    return run


def count_window_stream(df: DataFrame, keys, order: str | None, value: str, size: int = 10,
                        with_values: bool = False, engine: str = PANDAS_STATE) -> DataFrame:
    """K1-K4 on a stream (``order=None``: the order rows are delivered in)."""
    keys = _keys(keys)
    fields = _key_fields(df, keys) + [StructField("window_no", LongType()), StructField("rows", LongType()),
                                      StructField("total", LongType())]
    if order:
        fields += [StructField(f"first_{order}", LongType()), StructField(f"last_{order}", LongType())]
    if with_values:
        fields.append(StructField("values", StringType()))
    cols = [*keys, *([order] if order else []), _whole(df, value)]
    return _stateful(df.select(*cols).groupBy(*keys), engine,
                     count_window_fn(keys, order, value, size, with_values),
                     CountWindowProcessor(keys, order, value, size, with_values) if engine == TRANSFORM_WITH_STATE
                     else None, StructType(fields), count_window_state_schema(with_values))


def batched_sink_stream(df: DataFrame, shard, order: str, value: str, threshold: int,
                        engine: str = PANDAS_STATE) -> DataFrame:
    """S10/K9 on a stream: per-shard buffer flushed at ``threshold`` rows;
    write the result with ``foreachBatch`` (idempotent on the batch id)."""
    out = count_window_stream(df, shard, order, value, threshold, engine=engine)
    return out.withColumnRenamed("window_no", "batch_no")


def count_trigger_stream(df: DataFrame, keys, order: str | None, value: str, every: int,
                         carry: str, engine: str = PANDAS_STATE) -> DataFrame:
    """W8 on a stream (``order=None``: the order rows are delivered in)."""
    keys = _keys(keys)
    fields = _key_fields(df, keys) + ([df.schema[order]] if order else []) + [
        StructField("n", LongType()), StructField("total", LongType()), StructField(f"first_{carry}", StringType())]
    cols = [*keys, *([order] if order else []), _whole(df, value), carry]
    return _stateful(df.select(*cols).groupBy(*keys), engine, count_trigger_fn(keys, order, value, every, carry),
                     CountTriggerProcessor(keys, order, value, every, carry) if engine == TRANSFORM_WITH_STATE
                     else None, StructType(fields), count_trigger_state_schema(carry))


def rolling_stream(df: DataFrame, keys, order: str | None, value: str, carry, emit: str = "row",
                   engine: str = PANDAS_STATE) -> DataFrame:
    """R1-R8 on a stream.

    ``emit="row"``: one row per input row (exact rolling semantics, state
    processor) with running ``n, sum, min, max``, the first row's ``carry``
    fields and the arg-min / arg-max rows' ``carry`` fields.
    ``emit="batch"``: built-in aggregation in update mode, one row per key
    per micro-batch (partial aggregation before the shuffle)."""
    keys = _keys(keys)
    carry = [carry] if isinstance(carry, str) else list(carry)
    if emit == "batch":
        return df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.sum(value).alias("sum"), F.min(value).alias("min"),
            F.max(value).alias("max"))
    fields = _key_fields(df, keys) + ([df.schema[order]] if order else []) + [
        StructField(value, LongType()), StructField("n", LongType()), StructField("sum", LongType()),
        StructField("min", LongType()), StructField("max", LongType())]
    for p in ("first", "argmin", "argmax"):
        fields += [StructField(f"{p}_{c}", StringType()) for c in carry]
    cols = [*keys, *([order] if order else []), _whole(df, value), *carry]
    return _stateful(df.select(*cols).groupBy(*keys), engine, rolling_fn(keys, order, value, carry),
                     RollingProcessor(keys, order, value, carry) if engine == TRANSFORM_WITH_STATE else None,
                     StructType(fields), rolling_state_schema(carry))


def read_state(spark, checkpoint: str, state_var: str | None = None, operator_id: int | None = None) -> DataFrame:
    """K5: read keyed state of a stream from its checkpoint (consistent as of
    the last committed micro-batch) as ``key`` and ``value`` structs.
    ``state_var`` names a ``transformWithState`` variable; without it the
    ``applyInPandasWithState`` state is read."""
    r = spark.read.format("statestore").option("path", checkpoint)
    if state_var:
        r = r.option("stateVarName", state_var)
    if operator_id is not None:
        r = r.option("operatorId", operator_id)
    df = r.load()
    if state_var:
        return df.select("key", "value")
    return df.select("key", F.col("value.groupState").alias("value"))
