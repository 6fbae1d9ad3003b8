"""Physical plans: what must and what must not be in them."""

import re

import pytest

from millrace import plans

QUERIES = plans.QUERIES


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_slow_operators(spark, sf, name):
    plan = plan_of(QUERIES[name](spark, sf))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "NestedLoopJoin", "Window"):
        assert bad not in plan, bad


def test_filters_are_pushed(spark, sf):
    assert "EqualTo(o_orderstatus,F)" in plan_of(QUERIES["filter_match"](spark, sf))
    assert "In(event_type, [click,view])" in plan_of(QUERIES["log_subscribe"](spark, sf))
    assert "GreaterThanOrEqual(ts" in plan_of(QUERIES["load_job_status"](spark, sf))


def test_columns_are_pruned(spark, sf):
    plan = plan_of(QUERIES["offset_ledger"](spark, sf))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in plan


def test_aggregates_reduce_before_the_shuffle(spark, sf):
    for name in ("min_pair_match", "agg_spec_grouped", "offset_ledger", "join_inner"):
        assert "partial_" in plan_of(QUERIES[name](spark, sf)), name


def test_shuffled_match_spreads_hot_groups(spark, sf):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["join_multi_key"](spark, sf))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # The rows are shuffled by key and both values, not by the key alone.
    assert re.search(r"hashpartitioning\(o_custkey#\w+, o_orderdate#\w+, .*o_totalprice#", plan)
