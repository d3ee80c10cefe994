"""Plan guards over every registered query: no Python UDF on the hot path,
no cartesian product, no nested-loop join."""

import re

import pytest

import __spark_entry__ as E
from reelscope.plans.registry import QUERIES
from tests.conftest import SF_SMALL

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
             "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_forbidden_operators(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [op for op in FORBIDDEN if op in plan]
    assert not found, f"{name}: {found}"


def test_channel_filter_reaches_scan(spark):
    df = E.queries()["channel_mentions"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[In\(source", plan)


def test_bucketed_join_needs_no_shuffle(spark):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()["comments_per_show_bucketed"](spark, SF_SMALL)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
