"""What the plans of the registered queries must and must not hold."""

import os

import pytest

from starloom.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not present")


def plan_of(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_no_window_no_python(spark, name):
    plan = plan_of(spark, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow"):
        assert node not in plan, node
    if name != "surrogate_key_dense":  # a running total over one row per partition
        assert "Window" not in plan


@pytest.mark.parametrize("name", ["star_plays_by_user", "songplays_strict_join", "songplays_hour_grain", "arrivals_fact"])
def test_small_dimensions_move_no_fact_rows(spark, name):
    plan = plan_of(spark, name)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("filter_action", "EqualTo(event_type,purchase)"),
        ("songplays_strict_join", "EqualTo(event_type,purchase)"),
        ("lookup_by_compound_key", "EqualTo(l_orderkey,12)"),
        ("like_prefix_filter", "StringStartsWith(p_name,blue)"),
        ("filter_equal", "EqualTo(p_name,blue ring)"),
        ("stage_run_month", "GreaterThanOrEqual(o_orderdate"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan_of(spark, name)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("scan_project", "struct<c_custkey:bigint,c_name:string,c_mktsegment:string>"),
        ("max_value", "struct<l_extendedprice:double,l_shipdate:timestamp_ntz>"),
        ("dq_orphan_rows", "struct<l_suppkey:bigint>"),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    assert f"ReadSchema: {columns}" in plan_of(spark, name)
