"""Streams on carried tables: equal to the batch forms for any cut of the
input, over replays, restarts, late rows and a hot key."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from flowlab.operators import count_trigger, count_window_list, rolling_avg, rolling_max_by, rolling_min_by
from flowlab.operators.counting import batched_rows
from flowlab.operators.windows import sessions
from flowlab.sources.tables import directory_stream
from flowlab.streaming.carry import CarryRun, rolling_carry, session_carry, sessions_to_end, sink_carry, window_carry
from flowlab.streaming.runner import path_exists

SCHEMA = "seq bigint, key bigint, value bigint, name string"


def _rows(n=160, hot=True):
    rng = random.Random(n)
    # null keys and null values; a third of the rows has one key
    return [(i, None if i % 11 == 0 else (1 if hot and i % 3 == 0 else rng.randint(1, 6)), None if i % 13 == 0 else rng.randint(-9, 9), f"r{i}")
            for i in range(n)]


def _land(df, folder, parts, column="seq"):
    """One file per part, in the order of ``column``, read one at a time."""
    rows = df.orderBy(column).collect()
    size = -(-len(rows) // parts)
    for i in range(parts):
        spark = df.sparkSession
        spark.createDataFrame(rows[i * size:(i + 1) * size], df.schema).coalesce(1).write.mode("append").parquet(str(folder))
    return directory_stream(df.sparkSession, str(folder), df.schema, max_files_per_trigger=1)


def _same(got, want):
    columns = sorted(want.columns)
    assert set(columns) <= set(got.columns)
    key = lambda r: str(tuple(r))
    assert sorted(got.select(columns).collect(), key=key) == sorted(want.select(columns).collect(), key=key)



@pytest.mark.parametrize("parts", [4])
def test_rolling_equals_batch(spark, tmp_path, parts):
    df = spark.createDataFrame(_rows(), SCHEMA)
    run = CarryRun(spark, "roll")
    run.run(_land(df, tmp_path / "in", parts), rolling_carry("key", "seq", "value", "name"))
    got = run.result("rows", SCHEMA)
    _same(got, rolling_min_by(df, "key", "seq", "value", cols=["name"]).drop("name", "argmin_value"))
    _same(got, rolling_max_by(df, "key", "seq", "value", cols=["name"]).drop("name", "argmax_value"))
    _same(got.withColumn("avg", F.col("sum").cast("double") / F.col("n")).select("seq", "avg"),
          rolling_avg(df, "key", "seq", "value").select("seq", "avg"))
    trigger = CarryRun(spark, "trigger")
    trigger.run(directory_stream(spark, str(tmp_path / "in"), df.schema, 1), rolling_carry("key", "seq", "value", "name", every=5))
    _same(trigger.result("rows", SCHEMA).withColumnRenamed("sum", "total"), count_trigger(df, "key", "seq", "value", 5, carry=["name"]))


@pytest.mark.parametrize("parts", [5])
def test_windows_and_state_equal_batch(spark, tmp_path, parts):
    df = spark.createDataFrame(_rows(), SCHEMA).filter("value is not null")
    run = CarryRun(spark, "win")
    run.run(_land(df, tmp_path / "in", parts), window_carry("key", "seq", "value", 10, with_values=True))
    _same(run.result("windows", SCHEMA), count_window_list(df, "key", "seq", "value", 10))
    left = df.groupBy("key").agg((F.count("*") % 10).alias("rows"))
    _same(run.carried("windows").select("key", "rows"), left)
    assert run.versions("windows") == list(range(max(0, parts - 2), parts))      # two versions stay


@pytest.mark.parametrize("kind", ["double", "decimal(9,3)"])
def test_fractions_and_time_orders_are_kept(spark, tmp_path, kind):
    start = datetime(2020, 1, 1)
    df = spark.createDataFrame([(start + timedelta(milliseconds=i), i % 2, i / 8) for i in range(40)], "at timestamp_ntz, key bigint, x double")
    df = df.withColumn("value", F.col("x").cast(kind)).drop("x")
    run = CarryRun(spark, "frac")
    run.run(_land(df, tmp_path / "in", 3, "at"), window_carry("key", "at", "value", 10))
    got = sorted((r.key, r.window_no, float(r.total), r.first_at) for r in run.result("windows", SCHEMA).collect())
    assert got == [(k, w, sum((20 * w + k + 2 * j) / 8 for j in range(10)), start + timedelta(milliseconds=20 * w + k)) for k in (0, 1) for w in (0, 1)]
    rolled = CarryRun(spark, "frac")
    rolled.run(directory_stream(spark, str(tmp_path / "in"), df.schema, 1), rolling_carry("key", "at", "value"))
    last = max(rolled.result("rows", SCHEMA).filter("key = 1").collect(), key=lambda r: r.n)
    assert float(last["sum"]) == sum((1 + 2 * j) / 8 for j in range(20)) and isinstance(last["min"], Decimal if "dec" in kind else float)


@pytest.mark.parametrize("parts", [4])
def test_sink_flushes_rows_and_keeps_the_rest(spark, tmp_path, parts):
    df = spark.createDataFrame(_rows(), SCHEMA).withColumn("shard", F.col("seq") % 3)
    run = CarryRun(spark, "sink")
    run.run(_land(df, tmp_path / "in", parts), sink_carry("shard", "seq", 7))
    want = batched_rows(df, "shard", "seq", 7)
    got = run.result("flushed", SCHEMA)
    _same(got, want)
    held = run.carried("held")
    assert held.count() == df.count() - want.count() and held.join(got, "seq").isEmpty()
    assert held.groupBy("shard").count().filter("count >= 7").isEmpty()


def test_a_failed_batch_is_replayed_once(spark, tmp_path):
    df = spark.createDataFrame(_rows(90), SCHEMA)
    src = _land(df, tmp_path / "in", 3)
    run, step, fail = CarryRun(spark, "again"), window_carry("key", "seq", "value", 10), [True]

    def failing(batch, carried, batch_id):
        outputs, state = step(batch, carried, batch_id)
        if batch_id == 1 and fail:      # after the state of the batch was written, before the stream commits it
            fail.clear()
            for name, table in state.items():
                table.write.mode("overwrite").parquet(f"{run.state}/{name}/batch={batch_id}")
            raise RuntimeError("lost")
        return outputs, state
    with pytest.raises(Exception, match="lost"):
        run.run(src, failing)
    run.run(directory_stream(spark, str(tmp_path / "in"), df.schema, 1), failing)
    _same(run.result("windows", SCHEMA).select("key", "window_no", "total"),
          count_window_list(df, "key", "seq", "value", 10).select("key", "window_no", "total"))


def test_a_hot_key_is_split_and_nothing_runs_in_python(spark, tmp_path):
    df = spark.createDataFrame([(i, 1 if i % 3 else i, 1, "x") for i in range(4000)], SCHEMA)
    plans = []

    def spying(step):
        def run(batch, carried, batch_id):
            outputs, state = step(batch, carried, batch_id)
            plans.extend(t._jdf.queryExecution().toString() for t in [*outputs.values(), *state.values()])
            return outputs, state
        return run
    src = _land(df, tmp_path / "in", 2)
    run = CarryRun(spark, "hot")
    run.run(src, spying(rolling_carry("key", "seq", "value", "name")))
    run.run(directory_stream(spark, str(tmp_path / "in"), df.schema, 1), spying(window_carry("key", "seq", "value", 10)))
    assert any("_fl_chunk" in p for p in plans) and not any("Python" in p or "Pandas" in p or "InArrow" in p for p in plans)
    assert run.result("rows", SCHEMA).agg(F.max("n")).first()[0] == df.filter("key = 1").count()


T0 = datetime(2021, 5, 1)
GAP = 10_000_000


def _events(seconds):
    return [(i, None if s is None else T0 + timedelta(seconds=s), i % 2) for i, s in enumerate(seconds)]


def _aggs():
    return {"n": ("count", F.lit(1)), "top": ("max", F.col("seq"))}


@pytest.mark.parametrize("keys", [None, "key"])
@pytest.mark.parametrize("parts", [4])
def test_all_sessions_of_a_bounded_input(spark, tmp_path, keys, parts):
    rng, t, times = random.Random(3), 0, []
    for _ in range(60):
        t += rng.choice([0, 1, 4, 9, 10, 11, 30])
        times.append(t)
    df = spark.createDataFrame(_events(times), "seq bigint, ts timestamp_ntz, key int")
    src = _land(df, tmp_path / "in", parts)
    run = CarryRun(spark, "sess")
    got = sessions_to_end(run, src, "ts", GAP, _aggs(), keys, delay_us=3_500_000)
    _same(got, sessions(df, "ts", GAP, _aggs(), keys))
    assert not run.carried("open").isEmpty()
    # nothing new: the flush is not repeated
    _same(sessions_to_end(run, directory_stream(spark, str(tmp_path / "in"), df.schema, 1), "ts", GAP, _aggs(), keys, 3_500_000),
          sessions(df, "ts", GAP, _aggs(), keys))


def test_late_rows_are_reported_and_left_out(spark, tmp_path):
    df = spark.createDataFrame(_events([1, 2, 30, None, 3, 40]), "seq bigint, ts timestamp_ntz, key int")
    src = _land(df, tmp_path / "in", 3)                 # [1 2] [30 null] [3 40]: 3 is 23.5 s behind the watermark
    run = CarryRun(spark, "late")
    got = sessions_to_end(run, src, "ts", GAP, _aggs(), delay_us=3_500_000)
    assert sorted((r.session_start.second, r.n) for r in got.collect()) == [(1, 2), (30, 2)]
    assert [r.seq for r in run.result("late", SCHEMA).collect()] == [4]


@pytest.mark.parametrize("late, start, n", [("row", 10, 2), ("merged", 9, 3)])
def test_merge_before_the_lateness_test(spark, tmp_path, late, start, n):
    # open session 10-25 s, watermark 20 s, then a row at 9 s of the same key
    rows = [(0, T0 + timedelta(seconds=10), 1), (1, T0 + timedelta(seconds=15), 1), (2, T0 + timedelta(seconds=20), 2),
            (3, T0 + timedelta(seconds=9), 1), (4, T0 + timedelta(seconds=9), 3)]
    df = spark.createDataFrame(rows, "seq bigint, ts timestamp_ntz, key int")
    src = _land(df.filter("seq < 3"), tmp_path / "in", 1)
    _land(df.filter("seq >= 3"), tmp_path / "in", 1)
    run = CarryRun(spark, "merge")
    got = sessions_to_end(run, src, "ts", GAP, _aggs(), "key", late=late)
    assert {(r.key, r.session_start.second, r.session_end.second, r.n) for r in got.collect()} == {(1, start, 25, n), (2, 20, 30, 1)}
    assert run.result("late", SCHEMA).count() == (2 if late == "row" else 1)


def test_empty_input_and_unknown_rule(spark, tmp_path):
    df = spark.createDataFrame([], "seq bigint, ts timestamp_ntz, key int")
    df.write.parquet(str(tmp_path / "in"))
    run = CarryRun(spark, "none")
    got = sessions_to_end(run, directory_stream(spark, str(tmp_path / "in"), df.schema, 1), "ts", GAP, _aggs(), "key")
    assert got.collect() == [] and got.columns == ["key", "session_start", "session_end", "n", "top"]
    assert not path_exists(spark, run.out + "/nothing")
    with pytest.raises(ValueError):
        session_carry("ts", GAP, _aggs(), late="never")
