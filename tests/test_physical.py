"""Plans stay distributed: equality joins, group limits before shuffles, pruned and pushed-down scans."""

import pytest
from conftest import SF

import __spark_entry__ as entry

NATIVE = [
    "latest_version", "policy_rollup", "interval_join", "lookback_join", "asof_exposure", "overlap_join", "fallback_lookup", "merge_outer", "spread_max", "sessionize",
    "pivot_counts", "eav_pivot", "journey_features", "rollup_labels", "daily_actives", "audience_slot", "first_by_priority", "share_of",
]


def plan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NATIVE)
def test_no_pairwise_join_and_no_python(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert bad not in text


@pytest.mark.parametrize("name", ["latest_version", "keep_last_nulls_win", "first_by_priority", "fallback_lookup"])
def test_top_row_is_limited_before_the_shuffle(spark, name):
    assert "Partial" in plan(spark, name) and "WindowGroupLimit" in plan(spark, name)


def test_scan_is_pruned_and_filtered(spark):
    text = plan(spark, "row_filters")
    assert "GreaterThanOrEqual(o_orderdate" in text and "o_custkey" not in text.split("ReadSchema")[1]


def test_pivot_is_one_aggregate(spark):
    text = plan(spark, "pivot_counts")
    assert text.count("Exchange hashpartitioning") == 1
