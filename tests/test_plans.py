"""Scale properties of the physical plans (what ``explain`` shows)."""

from __future__ import annotations

import __spark_entry__ as contract

from conftest import SF_ORACLE

Q = contract.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_filter_and_projection_reach_the_scan(spark):
    p = plan(Q["filter_project"](spark, SF_ORACLE))
    assert "StringStartsWith(p_name,s)" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_size:int,p_retailprice:double>" in \
        formatted(Q["filter_project"](spark, SF_ORACLE))


def test_group_sum_pre_aggregates_before_the_shuffle(spark):
    p = plan(Q["group_sum"](spark, SF_ORACLE))
    assert "partial_count" in p and p.count("Exchange hashpartitioning") == 1


def test_rolling_without_hot_key_is_one_shuffle(spark):
    p = plan(Q["rolling_sum"](spark, SF_ORACLE))
    assert p.count("Exchange") == 1 and "Window" in p


def test_hot_key_split_shuffles_the_big_side_once(spark):
    p = plan(Q["rolling_sum_hot_key"](spark, SF_ORACLE))
    # big side: scan -> one exchange on (key, chunk) -> window -> probe.  The two
    # other exchanges carry the hot keys' chunk totals, after map-side partial
    # aggregation; the carry-in reaches the big side without reshuffling it.
    assert p.count("Exchange hashpartitioning") == 3
    assert "partial_sum" in p and "BroadcastHashJoin" in p


def test_exclusion_list_is_broadcast_after_its_size_check(spark):
    p = plan(Q["anti_broadcast_count"](spark, SF_ORACLE))
    assert "BroadcastHashJoin" in p and "LeftAnti" in p
