"""Edge cases of the batch operators, and the skew-split prefix scan
checked against a brute-force pandas computation."""

from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowlab.functions.parse import parse_fields
from flowlab.operators import (batched, count_window, equi_join, exclude, late_report, parity_split,
                               rolling_max_by, rolling_min_by, running, sessions, sessions_native)
from flowlab.operators.iterate import IterationLimitExceeded, iterate
from flowlab.operators.prefix import ScanPlan
from flowlab.sources.sinks import write_delimited, write_tuples


def test_parse_failfast_and_quarantine(spark):
    lines = spark.createDataFrame([("1,John",), ("x,Bad",), ("3",)], "value string")
    with pytest.raises(Exception):
        parse_fields(lines, "person").collect()
    good, bad = parse_fields(lines, "person", mode="quarantine")
    assert [tuple(r) for r in good.collect()] == [(1, "John")]
    assert sorted(r.value for r in bad.collect()) == ["3", "x,Bad"]


def test_parse_pins_split_and_cast_details(spark):
    # Spark keeps trailing empty fields (extra ones are ignored by the
    # declared layout) and its casts accept surrounding blanks
    lines = spark.createDataFrame([("1,John,",), (" 2 ,Ann",), ("3,,",)], "value string")
    assert [tuple(r) for r in parse_fields(lines, "person").collect()] == [(1, "John"), (2, "Ann"), (3, "")]
    good, bad = parse_fields(spark.createDataFrame([("4",)], "value string"), "person", mode="quarantine")
    assert good.count() == 0 and bad.count() == 1        # a missing field is a bad line


def test_outer_join_fills_only_missing_side(spark):
    left = spark.createDataFrame([(1, None), (2, "b")], "id int, name string")
    right = spark.createDataFrame([(1, "X"), (3, "Z")], "id int, state string")
    rows = sorted(tuple(r) for r in equi_join(left, right, "id", "full").collect())
    # the null name of the matched id 1 stays null; only missing sides read "NULL"
    assert rows == [(1, None, "X"), (2, "b", "NULL"), (3, "NULL", "Z")]
    dup = spark.createDataFrame([(1, "Y")], "id int, state string")
    assert equi_join(left, right.unionByName(dup), "id", "inner").count() == 2  # duplicates multiply


def test_exclude_repeated_ids(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    ex = spark.range(0, 100, 3).withColumnRenamed("id", "k")
    a = sorted(r.k for r in exclude(df, ex, "k").collect())
    b = sorted(r.k for r in exclude(df, ex.union(ex), "k").collect())
    assert a == b == [k for k in range(100) if k % 3]


def test_checked_broadcast_hints_only_within_bound(spark):
    from flowlab.operators import checked_broadcast
    big = spark.range(1000).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # only the explicit hint may broadcast
    try:
        hinted = big.join(checked_broadcast(small, 100), "k")._jdf.queryExecution().executedPlan().toString()
        plain = big.join(checked_broadcast(small, 5), "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert "BroadcastHashJoin" in hinted and "BroadcastHashJoin" not in plain


def test_arg_extremes_first_row_wins_ties(spark):
    df = spark.createDataFrame([(1, "k", 5, "a"), (2, "k", 3, "b"), (3, "k", 3, "c"), (4, "k", 9, "d"),
                                (5, "k", 9, "e")], "o long, k string, v long, tag string")
    mn = {r.o: r.argmin_tag for r in rolling_min_by(df, "k", "o", "v", ["tag"], chunk_width=2).collect()}
    mx = {r.o: r.argmax_tag for r in rolling_max_by(df, "k", "o", "v", ["tag"], chunk_width=2).collect()}
    assert mn == {1: "a", 2: "b", 3: "b", 4: "b", 5: "b"}
    assert mx == {1: "a", 2: "a", 3: "a", 4: "d", 5: "d"}


def test_parity_split_negative_odd(spark):
    parts = parity_split(spark.createDataFrame([(-3,), (-4,), (0,), (7,)], "n int"), "n")
    assert sorted(int(r.n) for r in parts["even"].collect()) == [-4, 0]
    assert sorted(r.n for r in parts["odd"].collect()) == [-3, 7]


def test_tag_branches_one_pass(spark):
    from flowlab.operators import tag_branches
    df = spark.createDataFrame([(-3,), (-4,), (0,), (7,)], "n int")
    got = sorted((r.branch, r.n) for r in tag_branches(df, {"even": F.col("n") % 2 == 0,
                                                            "odd": F.col("n") % 2 != 0}).collect())
    assert got == sorted([("main", -3), ("main", -4), ("main", 0), ("main", 7),
                          ("even", -4), ("even", 0), ("odd", -3), ("odd", 7)])


def test_session_gap_edge(spark):
    df = spark.createDataFrame([(0,), (1000,), (2001,)], "ms long").withColumn("ts", F.timestamp_millis("ms"))
    aggs = {"n": ("count", F.lit(1))}
    ours = sorted((r.session_start, r.session_end, r.n) for r in sessions(df, "ts", 1_000_000, aggs).collect())
    native = sorted((r.session_start, r.session_end, r.n)
                    for r in sessions_native(df.withColumn("k", F.lit(1)), "ts", "1 second", aggs, "k").collect())
    epoch = dt.datetime(1970, 1, 1)
    expect = [(epoch, epoch + dt.timedelta(seconds=2), 2),
              (epoch + dt.timedelta(milliseconds=2001), epoch + dt.timedelta(milliseconds=3001), 1)]
    assert ours == native == expect


def test_count_window_edges(spark):
    rows = [(k, i, i) for k, n in ((1, 9), (2, 10), (3, 11), (4, 20)) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, o long, v long")
    got = sorted((r.k, r.window_no, r.total) for r in count_window(df, "k", "o", "v", 10, chunk_width=3).collect())
    assert got == [(2, 0, 45), (3, 0, 45), (4, 0, 45), (4, 1, 145)]
    assert count_window(df.limit(0), "k", "o", "v", 10).count() == 0  # empty input


def test_batched_keeps_remainder(spark):
    df = spark.range(25).select(F.col("id").alias("o"), (F.col("id") % 2).alias("shard"))
    got = sorted((r.shard, r.batch_no, r.rows) for r in batched(df, "shard", "o", 5).collect())
    assert got == [(0, 0, 5), (0, 1, 5), (1, 0, 5), (1, 1, 5)]  # 13 and 12 rows: remainders stay buffered


def test_batched_rows_hold_back_the_partial_batch(spark):
    from flowlab.operators import batched_rows
    df = spark.range(25).select(F.col("id").alias("o"), (F.col("id") % 2).alias("shard"))
    got = sorted((r.shard, r.batch_no, r.o) for r in batched_rows(df, "shard", "o", 5).collect())
    # shard 0 has 13 rows, shard 1 has 12: 10 rows each are flushed in two batches
    assert [g[2] for g in got if g[0] == 0] == [0, 2, 4, 6, 8, 10, 12, 14, 16, 18]
    assert [g[1] for g in got if g[0] == 1] == [0] * 5 + [1] * 5


def test_iterate_fused_rounds_equal_single_rounds(spark):
    df = spark.range(0, 40).select((F.col("id") % 11).alias("n"), F.lit(0).alias("m"))

    def step(d):
        done = F.col("n") == 10
        return d.select(F.when(done, F.col("n")).otherwise(F.col("n") + 1).alias("n"),
                        F.when(done, F.col("m")).otherwise(F.col("m") + 1).alias("m"))

    one = sorted(map(tuple, iterate(df, step, lambda: F.col("n") == 10, max_iter=20).collect()))
    fused = sorted(map(tuple, iterate(df, step, lambda: F.col("n") == 10, max_iter=20, fuse=3).collect()))
    assert one == fused and len(one) == 40


def test_iterate_limit(spark):
    df = spark.createDataFrame([(11,)], "n long")
    with pytest.raises(IterationLimitExceeded):
        iterate(df, lambda d: d.select((F.col("n") + 1).alias("n")), lambda: F.col("n") == 10, max_iter=3)


def test_late_report_marks_rows(spark):
    # arrival order 0,1,3,2: row 2 arrives after 3 (t=100 s); gap 10 s, delay 5 s
    df = spark.createDataFrame([(0, 0, 0), (1, 1, 10), (2, 3, 20), (3, 2, 100)], "id long, arr long, sec long") \
        .withColumn("ts", F.timestamp_seconds("sec"))
    late = {r.id: r.late for r in late_report(df, "ts", "arr", 10_000_000, 5_000_000, chunk_width=2).collect()}
    assert late == {0: False, 1: False, 2: True, 3: False}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b", 2.5)], "id int, s string, x double")
    write_delimited(df, str(tmp_path / "d"))
    write_tuples(df, str(tmp_path / "t"))
    assert [r.value for r in spark.read.text(str(tmp_path / "d")).collect()] == ["1 a b 2.5"]
    assert [r.value for r in spark.read.text(str(tmp_path / "t")).collect()] == ["(1,a b,2.5)"]
    with pytest.raises(Exception):
        write_tuples(df, str(tmp_path / "t"))  # fail if present
    write_tuples(df, str(tmp_path / "t"), mode="overwrite")


# ---------------------------------------------------------------- brute force

def _brute(pdf: pd.DataFrame, include_current: bool) -> dict:
    """SQL semantics: sum/min/max skip nulls, count(1) counts rows, first is
    the first row's value even when null."""
    out = {}
    for _k, g in pdf.sort_values("o").groupby("k", dropna=False):
        vals = []
        for o, v in zip(g["o"], g["v"]):
            v = None if pd.isna(v) else int(v)
            seen = vals + [v] if include_current else list(vals)
            nn = [x for x in seen if x is not None]
            out[o] = (sum(nn) if nn else None, min(nn) if nn else None, max(nn) if nn else None,
                      len(seen), seen[0] if seen else None)
            vals.append(v)
    return out


@settings(max_examples=24, deadline=None)
@given(data=st.lists(st.tuples(st.sampled_from([None, 0, 1, 2]), st.one_of(st.none(), st.integers(-50, 50))),
                     min_size=1, max_size=40),
       width=st.integers(1, 9), include_current=st.booleans(),
       hot=st.sampled_from([None, ((0,),), ((0,), (None,)), ((2,), (1,))]))
def test_running_matches_brute_force(spark, data, width, include_current, hot):
    # a hot key (0 holds most rows) and a null key are both in the draw
    pdf = pd.DataFrame({"o": range(len(data)), "k": [d[0] for d in data], "v": [d[1] for d in data]})
    df = spark.createDataFrame(pdf.astype({"k": "Int64", "v": "Int64"}), "o long, k long, v long")
    aggs = {"s": ("sum", F.col("v")), "mn": ("min", F.col("v")), "mx": ("max", F.col("v")),
            "n": ("count", F.lit(1)), "f": ("first", F.col("v"))}
    got = {r.o: (r.s, r.mn, r.mx, r.n, r.f) for r in
           running(df, "k", "o", aggs, include_current=include_current,
                   chunk_width=width if hot is None else ScanPlan(width, hot)).collect()}
    assert got == _brute(pdf, include_current)


@pytest.mark.parametrize("keys,gap_s,width", [(None, 300, 7), (["user_id"], 6 * 3600, 3), (["user_id"], 300, 50)])
def test_sessions_split_path_equals_native(spark, keys, gap_s, width):
    """The forced two-level path (used when the time span holds many buckets)
    against Spark's own session_window on the sf0.01 events."""
    from conftest import SF_ORACLE
    ev = spark.read.parquet(f"{SF_ORACLE}/events.parquet").select(
        "ts", "user_id", F.round(F.col("value") * 100).cast("bigint").alias("c"))
    aggs = {"n": ("count", F.lit(1)), "s": ("sum", F.col("c"))}
    ours = sessions(ev, "ts", gap_s * 1_000_000, aggs, keys=keys, chunk_width=width)
    native = sessions_native(ev if keys else ev.withColumn("k", F.lit(0)), "ts", f"{gap_s} seconds", aggs,
                             keys or ["k"])
    cols = [*(keys or []), "session_start", "session_end", "n", "s"]
    assert sorted(map(tuple, ours.select(*cols).collect())) == sorted(map(tuple, native.select(*cols).collect()))


def test_running_orders_by_timestamp(spark):
    df = spark.createDataFrame([(k, s, v) for k, s, v in [(1, 5, 1), (1, 1, 2), (1, 9, 4), (2, 3, 8), (1, 7, 16)]],
                               "k long, sec long, v long").withColumn("t", F.timestamp_seconds("sec"))
    got = {r.sec: r.s for r in running(df, "k", "t", {"s": ("sum", F.col("v"))}, chunk_width=2_000_000).collect()}
    assert got == {1: 2, 5: 3, 7: 19, 9: 23, 3: 8}


def test_running_with_only_null_orders(spark):
    df = spark.createDataFrame([(1, None, 3), (1, None, 4)], "k long, o long, v long")
    assert running(df, "k", "o", {"n": ("count", F.lit(1))}).count() == 2
    assert running(df, [], "o", {"n": ("count", F.lit(1))}).count() == 2


@settings(max_examples=10, deadline=None)
@given(data=st.lists(st.tuples(st.sampled_from([1, 2, 3]), st.integers(0, 100_000)), min_size=1, max_size=60,
                     unique_by=lambda t: t[1]),
       gap_ms=st.integers(1, 20_000), width=st.one_of(st.none(), st.integers(1, 7)), keyed=st.booleans())
def test_sessions_match_session_window(spark, data, gap_ms, width, keyed):
    """Random timestamps, keys and gaps: the collapsed sessions (plain or
    forced split) equal Spark's own session_window."""
    pdf = pd.DataFrame({"k": [d[0] for d in data], "ms": [d[1] for d in data]})
    df = spark.createDataFrame(pdf, "k long, ms long").withColumn("ts", F.timestamp_millis("ms"))
    aggs = {"n": ("count", F.lit(1))}
    keys = ["k"] if keyed else None
    ours = sessions(df, "ts", gap_ms * 1000, aggs, keys=keys, chunk_width=width if width else "auto")
    nat = sessions_native(df if keyed else df.withColumn("k", F.lit(0)), "ts", f"{gap_ms} milliseconds", aggs, ["k"])
    cols = (["k"] if keyed else []) + ["session_start", "session_end", "n"]
    assert sorted(map(tuple, ours.select(*cols).collect())) == sorted(map(tuple, nat.select(*cols).collect()))


def test_null_values_never_hold_an_extreme(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("a", 3, 4)], "k string, o int, v int")
    from flowlab.operators.rolling import final_aggregates, rolling_min_by
    rows = sorted(rolling_min_by(df, "k", "o", "v").collect(), key=lambda r: r.o)
    assert [r.argmin_v for r in rows] == [5, 5, 4]
    r = final_aggregates(df, "k", "o", "v").first()
    assert (r.min_v, r.argmin_o, r.argmax_o) == (4, 3, 1)


def test_arg_max_with_a_time_order(spark):
    from flowlab.operators.rolling import final_aggregates, rolling_max_by
    df = spark.sql("SELECT 'a' k, timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id) t, id % 3 v FROM range(6)")
    rows = sorted(rolling_max_by(df, "k", "t", "v").collect(), key=lambda r: r.t)
    assert [r.argmax_t.second for r in rows] == [0, 1, 2, 2, 2, 2]
    assert final_aggregates(df, "k", "t", "v").first().argmax_t.second == 2


def test_null_lines_are_quarantined(spark):
    from flowlab.functions import parse_fields
    df = spark.createDataFrame([("1",), ("x",), (None,)], "value string")
    good, bad = parse_fields(df, [("n", "int")], mode="quarantine")
    assert (good.count(), bad.count()) == (1, 2)


def test_null_fields_keep_their_place_in_text(spark):
    from flowlab.functions.exprs import tuple_text
    df = spark.createDataFrame([(1, None, "c")], "a int, b string, c string")
    assert df.select(tuple_text("a", "b", "c").alias("t")).first().t == "(1,null,c)"


def test_tag_field_takes_the_separator_literally(spark):
    from flowlab.operators.transforms import tag_field
    df = spark.createDataFrame([("a|b|c",)], "line string")
    assert tag_field(df, "line", 1, "f", sep="|").first().f == "b"


def test_iterate_limit_is_exact_with_fused_rounds(spark):
    import pytest
    from pyspark.sql import functions as F
    from flowlab.operators.iterate import IterationLimitExceeded, iterate
    df = spark.createDataFrame([(0,)], "n int")

    def step(d):
        return d.withColumn("n", F.when(F.col("n") < 4, F.col("n") + 1).otherwise(F.col("n")))
    with pytest.raises(IterationLimitExceeded):
        iterate(df, step, lambda: F.col("n") >= 4, max_iter=3, fuse=4)
    assert iterate(df, step, lambda: F.col("n") >= 4, max_iter=5, fuse=4).first().n == 4


def test_streaming_steps_refuse_fractions(spark):
    import pytest
    from flowlab.streaming.operators import rolling_stream
    df = spark.createDataFrame([("a", 1, 1.75)], "k string, o int, v double")
    with pytest.raises(TypeError):
        rolling_stream(df, "k", "o", "v", [])


def _chunk_sizes(df, keys, plan):
    from flowlab.operators.prefix import _CHUNK, _with_chunks
    return sorted(r["count"] for r in _with_chunks(df, keys, "o", plan).groupBy(*keys, _CHUNK).count().collect())


def test_chunks_are_cut_by_rows_not_by_order_range(spark):
    """A hot key inside 1 % of the order range, and one outlying order value,
    both leave chunks of similar size; the running sums agree with a window."""
    from flowlab.operators.prefix import plan_chunks
    cold = spark.range(20_000).select((F.col("id") % 1000 + 1).alias("k"), (F.col("id") * 50).alias("o"))
    hot = spark.range(10_000).select(F.lit(0).cast("bigint").alias("k"), (F.col("id") + 500_000).alias("o"))
    df = cold.unionByName(hot)
    plan = plan_chunks(df, "k", "o")
    assert plan.hot == ((0,),)
    sizes = _chunk_sizes(df.filter("k = 0"), ["k"], plan)
    assert len(sizes) > 2 and max(sizes) < 2 * sum(sizes) / len(sizes)
    aggs = {"s": ("sum", F.col("o"))}
    ours = running(df, "k", "o", aggs, chunk_width=plan)
    plain = running(df, "k", "o", aggs, chunk_width=None)
    assert ours.exceptAll(plain).isEmpty() and plain.exceptAll(ours).isEmpty()

    far = spark.range(10_000).select(F.col("id").alias("o")).unionByName(spark.range(1).select(F.lit(10 ** 12).alias("o")))
    plan = plan_chunks(far, None, "o")
    sizes = _chunk_sizes(far, [], plan)
    assert max(sizes) < 2 * sum(sizes) / len(sizes)
    last = running(far, None, "o", {"n": ("count", F.lit(1))}, chunk_width=plan).agg(F.max("n"), F.countDistinct("n")).first()
    assert tuple(last) == (10_001, 10_001)


def test_plan_of_null_keys_and_null_orders(spark):
    from flowlab.operators.prefix import plan_chunks
    df = spark.range(2_000).select(F.when(F.col("id") % 2 == 0, F.col("id") + 1).alias("k"),
                                   F.when(F.col("id") != 7, F.col("id")).alias("o"))
    plan = plan_chunks(df, "k", "o")
    assert plan.hot == ((None,),)
    aggs = {"n": ("count", F.lit(1))}
    ours, plain = running(df, "k", "o", aggs, chunk_width=plan), running(df, "k", "o", aggs, chunk_width=None)
    assert ours.exceptAll(plain).isEmpty()
    assert not plan_chunks(df.limit(0), "k", "o").split
    assert not plan_chunks(df.limit(0), None, "o").split


def test_five_hundred_hot_keys_are_planned_quickly(spark):
    """Their number costs the plan nothing to speak of, and the rows are right."""
    import time
    from flowlab.operators.prefix import plan_chunks
    from flowlab.streaming.runner import scoped_conf
    hot = spark.range(200_000).select(F.when(F.col("id") % 500 == 7, None).otherwise(F.col("id") % 500).alias("k"), F.col("id").alias("o"))
    df = hot.unionByName(spark.range(50_000).select((F.col("id") + 1_000).alias("k"), F.col("id").alias("o")))
    with scoped_conf(spark, {"spark.sql.shuffle.partitions": "2000"}):
        plan_chunks(df, "k", "o")           # code generated and compiled before the clock starts
        begun = time.time()
        plan = plan_chunks(df, "k", "o")
        ours = running(df, "k", "o", {"n": ("count", F.lit(1)), "s": ("sum", F.col("o"))}, chunk_width=plan)
        ours._jdf.queryExecution().executedPlan()
        assert time.time() - begun < 5
    assert len(plan.hot) == 500 and (None,) in plan.hot
    with scoped_conf(spark, {"spark.sql.shuffle.partitions": "8"}):
        plain = running(df, "k", "o", {"n": ("count", F.lit(1)), "s": ("sum", F.col("o"))}, chunk_width=None)
        assert ours.exceptAll(plain).isEmpty() and plain.exceptAll(ours).isEmpty()


@pytest.mark.parametrize("keys", [["a", "b"], ["b"]])
def test_hot_keys_of_several_columns_and_signed_zeros(spark, keys):
    """Keys with null parts and a floating zero of either sign stay whole."""
    from flowlab.operators.prefix import plan_chunks
    df = spark.range(6_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("x")).alias("a"),
        F.when(F.col("id") % 4 == 1, F.lit(-0.0)).when(F.col("id") % 4 == 2, F.lit(0.0))
        .when(F.col("id") % 4 == 3, F.lit(float("nan"))).alias("b"), F.col("id").alias("o"))
    plan = plan_chunks(df, keys, "o", skew_factor=0.5)
    assert plan.split
    ours = running(df, keys, "o", {"n": ("count", F.lit(1))}, chunk_width=plan).select("o", "n")
    plain = running(df, keys, "o", {"n": ("count", F.lit(1))}, chunk_width=None).select("o", "n")
    assert ours.exceptAll(plain).isEmpty() and plain.exceptAll(ours).isEmpty()


@pytest.mark.parametrize("size,slide,keys", [
    ("24 hours", "1 hour", ["k"]), ("24 hours", "1 hour", []), ("7 seconds", "3 seconds", ["k"]), ("10 seconds", "4 seconds", []),
    ("2 minutes", "2 minutes", ["k"]), ("3 seconds", "10 seconds", ["k"]), ("1 hour 30 minutes", "1 minute", ["k"])])
@pytest.mark.parametrize("ntz", [False, True])
def test_panes_equal_copied_rows(spark, size, slide, keys, ntz):
    """Windows by panes have the rows of Spark's own windows: sparse and dense
    times, times before 1970, nulls in key, time and value, an empty table."""
    import random
    from flowlab.operators.windows import sliding_panes
    rng = random.Random(5)
    times = [rng.choice([rng.randrange(-200, 200), rng.randrange(0, 300_000), rng.randrange(-10 ** 6, 10 ** 6)]) for _ in range(250)]
    rows = [(rng.choice(["a", "b", None]), None if i % 50 == 0 else t + rng.choice([0.0, 0.25]), None if rng.random() < 0.3 else rng.randrange(-9, 9))
            for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "k string, t double, v long").withColumn("ts", F.timestamp_micros((F.col("t") * 1_000_000).cast("long")))
    if ntz:
        df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    aggs = {"n": ("count", F.lit(1)), "nv": ("count", F.col("v")), "s": ("sum", F.col("v")), "lo": ("min", F.col("v")), "hi": ("max", F.col("v"))}
    ours = sliding_panes(df, "ts", size, slide, aggs, keys)
    by_rows = df.groupBy(*keys, F.window("ts", size, slide).alias("w")) if slide != "10 seconds" else None
    if by_rows is None:      # Spark's own windows may not slide by more than their size
        t = F.unix_micros(F.col("ts").cast("timestamp"))
        start = t - F.pmod(t, F.lit(10_000_000))
        by_rows = df.filter(t - start < 3_000_000).withColumn("w", F.struct(
            F.timestamp_micros(start).cast(df.schema["ts"].dataType).alias("start"),
            F.timestamp_micros(start + 3_000_000).cast(df.schema["ts"].dataType).alias("end"))).groupBy(*keys, "w")
    copied = by_rows.agg(F.count("*").alias("n"), F.count("v").alias("nv"), F.sum("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi")) \
        .select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "nv", "s", "lo", "hi")
    assert ours.schema["window_start"].dataType == df.schema["ts"].dataType
    assert sorted(map(tuple, ours.collect()), key=str) == sorted(map(tuple, copied.collect()), key=str)
    assert sliding_panes(df.limit(0), "ts", size, slide, aggs, keys).isEmpty()


def test_intervals_of_no_fixed_length_are_refused():
    from flowlab.operators.windows import interval_us
    assert interval_us("1 day 2 seconds") == 86_402_000_000
    with pytest.raises(ValueError):
        interval_us("1 month")


def test_reduce_takes_every_kind(spark):
    from flowlab.operators import rolling_reduce
    df = spark.createDataFrame([("a", 1, 5, "p"), ("a", 2, None, "q"), ("a", 3, 2, "r"), ("b", 4, 7, None)], "k string, o int, v int, w string")
    out = rolling_reduce(df, "k", "o", {"s": "v", "lo": ("min", "v"), "hi": ("max", "v"), "n": ("count", "v"), "f": ("first", "w")})
    assert sorted((r.o, r.s, r.lo, r.hi, r.n, r.f) for r in out.collect()) == [
        (1, 5, 5, 5, 1, "p"), (2, 5, 5, 5, 1, "p"), (3, 7, 2, 5, 2, "p"), (4, 7, 7, 7, 1, None)]
