"""Query catalogue: every operator bound to the driver's tables, with an
independent DuckDB oracle for each query that SQL can express.

Conventions shared by both sides:
* money is compared as integer cents, ``c = cast(round(value * 100) as bigint)``,
  so sums do not depend on summation order;
* ratios are one IEEE division of exact operands, identical in both engines;
* the arrival order of ``events`` is ``event_id``;
* window and session bounds are ``timestamp_ntz`` (DuckDB ``timestamp``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.functions.exprs import cents
from flowlab.functions.parse import parse_fields
from flowlab.operators import (count_trigger, count_window, count_window_list, delayed_arrival, equi_join,
                               exclude, final_aggregates, group_sum, iterate, late_report,
                               prefix_filter, ratio, rolling_avg, rolling_count, rolling_max,
                               rolling_max_by, rolling_min, rolling_min_by, rolling_reduce, rolling_sum,
                               sessions, sliding, tag_branches, tag_field, tumbling, batched, batched_rows)
from flowlab.operators.prefix import plan_chunks
from flowlab.sources.tables import load_table

HOUR_US = 3_600_000_000
MINUTE_US = 60_000_000

# Fixed query parameters (the catalogue's contract with its oracles).
SESSION_GAP_USER_US = 6 * HOUR_US
SESSION_GAP_GLOBAL_US = 5 * MINUTE_US
LATE_DELAY_US = 3_500_000
LATE_EVERY, LATE_PLACES = 7, 2
EXCLUDE_ABOVE = 250
RAW_ORDER_ABOVE, RAW_QUANTITY_ABOVE = 100_000, 25
COUNT_WINDOW, COUNT_TRIGGER, SINK_THRESHOLD, SINK_SHARDS = 10, 5, 100, 4


def _events(spark: SparkSession, sf: str) -> DataFrame:
    e = load_table(spark, sf, "events")
    return e.select("event_id", "ts", "user_id", "event_type", cents("value").alias("c"))


# ---------------------------------------------------------------- stateless

def q_filter_project(spark, sf):
    part = load_table(spark, sf, "part")
    return prefix_filter(part, "p_name", "s").select(
        "p_partkey", "p_name", ratio("p_retailprice", "p_size", "price_per_size"))


def q_parse_lines(spark, sf):
    o = load_table(spark, sf, "orders")
    lines = o.select(F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                 "o_orderpriority").alias("value"))
    tagged = tag_field(lines, "value", 2, "status_tag")
    return parse_fields(tagged, [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                                 ("o_totalprice", "double"), ("o_orderpriority", "string")],
                        keep=["status_tag"])


def q_group_sum(spark, sf):
    ev = load_table(spark, sf, "events").select("event_type")
    return group_sum(prefix_filter(ev, "event_type", ["c", "p"]), "event_type", name="n")


def q_split_even_odd(spark, sf):
    # all side outputs as one tagged result, one scan (``split_by`` gives
    # the same branches as separate, separately typed DataFrames)
    ev = load_table(spark, sf, "events").select("event_id")
    n = F.col("event_id")
    return tag_branches(ev, {"even": n % 2 == 0, "odd": n % 2 != 0}).select("branch", "event_id")


# ---------------------------------------------------------------- joins

def _cust_by_nation(spark, sf):
    c = load_table(spark, sf, "customer")
    return (c.filter((F.col("c_acctbal") > 0) & (F.col("c_nationkey") < 15))
            .groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("cust_n")))


def _supp_by_nation(spark, sf):
    s = load_table(spark, sf, "supplier")
    return (s.filter(F.col("s_nationkey") >= 5)
            .groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("supp_n")))


def q_join_inner(spark, sf):
    c = load_table(spark, sf, "customer").filter(F.col("c_nationkey") < 15) \
        .select(F.col("c_nationkey").alias("nationkey"), "c_custkey", "c_name")
    n = load_table(spark, sf, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    return equi_join(c, n, "nationkey", "inner")


def _outer(how):
    def q(spark, sf):
        return equi_join(_cust_by_nation(spark, sf), _supp_by_nation(spark, sf), "nationkey", how, fill="NULL")
    return q


def _raw_outer(how):
    """J2-J4 on two raw tables, both filtered so that both sides miss keys."""
    def q(spark, sf):
        o = load_table(spark, sf, "orders").filter(F.col("o_totalprice") > RAW_ORDER_ABOVE) \
            .select(F.col("o_orderkey").alias("orderkey"), "o_custkey")
        li = load_table(spark, sf, "lineitem").filter(F.col("l_quantity") > RAW_QUANTITY_ABOVE) \
            .select(F.col("l_orderkey").alias("orderkey"), "l_linenumber")
        return equi_join(o, li, "orderkey", how, fill="NULL")
    return q


def q_anti_broadcast_count(spark, sf):
    ev = load_table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    # skew measured before the exclusion: an upper bound per key, without
    # evaluating the anti-join twice
    plan = plan_chunks(ev, "event_type", "event_id")
    kept = exclude(ev, ev.filter(F.col("value") > EXCLUDE_ABOVE).select("user_id"), "user_id")
    return rolling_count(kept.drop("value"), "event_type", "event_id", name="n", chunk_width=plan)


# ---------------------------------------------------------------- rolling

def q_rolling_sum(spark, sf):
    return rolling_sum(_events(spark, sf).drop("ts"), "user_id", "event_id", "c", carry=["event_type"],
                       name="sum_c").drop("event_type")


def q_rolling_min(spark, sf):
    return rolling_min(_events(spark, sf).drop("ts"), "user_id", "event_id", "c", carry=["event_type"],
                       name="min_c").drop("event_type")


def q_rolling_max(spark, sf):
    return rolling_max(_events(spark, sf).drop("ts"), "user_id", "event_id", "c", carry=["event_type"],
                       name="max_c").drop("event_type")


def q_rolling_argmin(spark, sf):
    return rolling_min_by(_events(spark, sf).drop("ts"), "user_id", "event_id", "c", cols=["event_type"],
                          prefix="argmin").drop("event_type")


def q_rolling_argmax(spark, sf):
    return rolling_max_by(_events(spark, sf).drop("ts"), "user_id", "event_id", "c", cols=["event_type"],
                          prefix="argmax").drop("event_type")


def q_rolling_reduce(spark, sf):
    ev = _events(spark, sf).drop("ts").withColumn("one", F.lit(1).cast("bigint"))
    return rolling_reduce(ev, "user_id", "event_id", {"sum_c": "c", "cnt": "one"},
                          carry=["event_type"]).drop("event_type", "one")


def q_rolling_reduce_kinds(spark, sf):
    """Running minimum, maximum, count and first value by one reduce."""
    return rolling_reduce(_events(spark, sf).drop("ts"), "user_id", "event_id", {
        "min_c": ("min", "c"), "max_c": ("max", "c"), "cnt": ("count", "c"), "first_c": ("first", "c")}).drop("event_type")


def q_rolling_avg(spark, sf):
    return rolling_avg(_events(spark, sf).drop("ts", "event_type"), "user_id", "event_id", "c", name="avg_c")


def q_final_aggregates(spark, sf):
    return final_aggregates(_events(spark, sf).drop("ts"), "event_type", "event_id", "c", cols=["user_id"])


# ---------------------------------------------------------------- windows

def _wagg():
    return {"n": ("count", F.lit(1)), "sum_c": ("sum", F.col("c"))}


def q_tumbling(spark, sf):
    return tumbling(_events(spark, sf), "ts", "1 hour", _wagg(), keys=["event_type"])


def q_sliding_keyed(spark, sf):
    return sliding(_events(spark, sf), "ts", "2 hours", "1 hour", _wagg(), keys=["event_type"])


def q_sliding_global(spark, sf):
    return sliding(_events(spark, sf), "ts", "4 hours", "2 hours", _wagg())


def q_sliding_day_by_minute(spark, sf):
    """Windows of a day that slide by a minute, by panes."""
    return sliding(_events(spark, sf), "ts", "24 hours", "1 minute", {
        **_wagg(), "min_c": ("min", F.col("c")), "max_c": ("max", F.col("c"))}, keys=["event_type"])


def q_session_keyed(spark, sf):
    return sessions(_events(spark, sf), "ts", SESSION_GAP_USER_US, _wagg(), keys=["user_id"])


def q_session_global(spark, sf):
    return sessions(_events(spark, sf), "ts", SESSION_GAP_GLOBAL_US, _wagg())


def q_late_report(spark, sf):
    ev = _events(spark, sf).select("event_id", "ts")
    ev = ev.withColumn("arrival", delayed_arrival("event_id", LATE_EVERY, LATE_PLACES))
    return late_report(ev, "ts", "arrival", SESSION_GAP_GLOBAL_US, LATE_DELAY_US).drop("arrival")


# ---------------------------------------------------------------- count based

def q_count_trigger_5(spark, sf):
    return count_trigger(_events(spark, sf).drop("ts"), "user_id", "event_id", "c", every=COUNT_TRIGGER,
                         carry=["event_type"])


def q_count_window_10(spark, sf):
    return count_window(_events(spark, sf), "user_id", "event_id", "c", size=COUNT_WINDOW)


def q_count_window_10_list(spark, sf):
    return count_window_list(_events(spark, sf), "user_id", "event_id", "c", size=COUNT_WINDOW)


def q_batched_sink(spark, sf):
    ev = _events(spark, sf).withColumn("shard", F.col("event_id") % SINK_SHARDS)
    return batched(ev, "shard", "event_id", SINK_THRESHOLD, value="c")


def q_batched_sink_rows(spark, sf):
    """The rows the threshold sink has flushed, with their batch number."""
    ev = _events(spark, sf).select("event_id", "c", (F.col("event_id") % SINK_SHARDS).alias("shard"))
    return batched_rows(ev, "shard", "event_id", SINK_THRESHOLD)


def q_iterate_until(spark, sf):
    li = load_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_linenumber").alias("n"), F.lit(0).alias("steps"))

    def step(df):
        done = F.col("n") == 10
        return df.select("l_orderkey", "l_linenumber",
                         F.when(done, F.col("n")).otherwise(F.col("n") + 1).alias("n"),
                         F.when(done, F.col("steps")).otherwise(F.col("steps") + 1).alias("steps"))

    # the body leaves finished rows unchanged, so four rounds run per job
    return iterate(li, step, lambda: F.col("n") == 10, max_iter=64, fuse=4)


# ---------------------------------------------------------------- hot key
# One key holding a third of all rows: every user with user_id % 3 = 0 is
# folded into key 0.  Same operators; the skew-split scan spreads key 0
# over many tasks.

def _hot(df: DataFrame) -> DataFrame:
    return df.withColumn("hot_user", F.when(F.col("user_id") % 3 == 0, F.lit(0).cast("bigint"))
                         .otherwise(F.col("user_id"))).drop("user_id")


def q_rolling_sum_hot_key(spark, sf):
    return rolling_sum(_hot(_events(spark, sf).drop("ts")), "hot_user", "event_id", "c", carry=["event_type"],
                       name="sum_c").drop("event_type")


def q_count_window_10_hot_key(spark, sf):
    return count_window(_hot(_events(spark, sf)), "hot_user", "event_id", "c", size=COUNT_WINDOW)


def q_rolling_argmax_hot_key(spark, sf):
    return rolling_max_by(_hot(_events(spark, sf).drop("ts")), "hot_user", "event_id", "c", cols=["event_type"],
                          prefix="argmax").drop("event_type")


def q_session_keyed_hot_key(spark, sf):
    return sessions(_hot(_events(spark, sf)), "ts", SESSION_GAP_USER_US, _wagg(), keys=["hot_user"])


def q_rolling_max_hot_key_by_time(spark, sf):
    """R5 for a hot key, ordered by event time (a timestamp order column)."""
    return rolling_max(_hot(_events(spark, sf)), "hot_user", "ts", "c", carry=["event_type"],
                       name="max_c").drop("event_type")


BATCH_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "filter_project": q_filter_project,
    "parse_lines": q_parse_lines,
    "group_sum": q_group_sum,
    "split_even_odd": q_split_even_odd,
    "join_inner": q_join_inner,
    "join_left_fill": _outer("left"),
    "join_right_fill": _outer("right"),
    "join_full_fill": _outer("full"),
    "join_left_raw": _raw_outer("left"),
    "join_right_raw": _raw_outer("right"),
    "join_full_raw": _raw_outer("full"),
    "anti_broadcast_count": q_anti_broadcast_count,
    "rolling_sum": q_rolling_sum,
    "rolling_min": q_rolling_min,
    "rolling_max": q_rolling_max,
    "rolling_argmin": q_rolling_argmin,
    "rolling_argmax": q_rolling_argmax,
    "rolling_reduce": q_rolling_reduce,
    "rolling_reduce_kinds": q_rolling_reduce_kinds,
    "rolling_avg": q_rolling_avg,
    "final_aggregates": q_final_aggregates,
    "tumbling": q_tumbling,
    "sliding_keyed": q_sliding_keyed,
    "sliding_global": q_sliding_global,
    "sliding_day_by_minute": q_sliding_day_by_minute,
    "session_keyed": q_session_keyed,
    "session_global": q_session_global,
    "late_report": q_late_report,
    "count_trigger_5": q_count_trigger_5,
    "count_window_10": q_count_window_10,
    "count_window_10_list": q_count_window_10_list,
    "batched_sink": q_batched_sink,
    "batched_sink_rows": q_batched_sink_rows,
    "iterate_until": q_iterate_until,
    "rolling_sum_hot_key": q_rolling_sum_hot_key,
    "count_window_10_hot_key": q_count_window_10_hot_key,
    "rolling_argmax_hot_key": q_rolling_argmax_hot_key,
    "session_keyed_hot_key": q_session_keyed_hot_key,
    "rolling_max_hot_key_by_time": q_rolling_max_hot_key_by_time,
}

