"""Plan properties that keep the models scale-safe (checked on sf0.001)."""
import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/orders.parquet"), reason="test tables not present")


def _plan(spark, key):
    from __spark_entry__ import queries
    from tools.plan_audit import final_plan
    return final_plan(queries()[key](spark, SF))


@pytest.mark.parametrize("key", ["fct_kolada_y", "fct_capacity_yearly", "fct_overcrowding_monthly",
                                 "mart_resources_yearly", "mart_regional_explorer_monthly_long",
                                 "declared_checks_reference"])
def test_no_nested_loop_or_sort_merge_joins(spark, key):
    plan = _plan(spark, key)
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "SortMergeJoin" not in plan
    assert "BroadcastHashJoin" in plan
    assert "EvalPython" not in plan and "InPandas" not in plan


def test_row_number_picks_are_limited_before_the_shuffle(spark):
    plan = _plan(spark, "best_match")
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("key", ["fct_kolada_y", "dedupe_grain", "dedupe_registry"])
def test_one_row_per_key_is_a_hash_aggregate_without_a_sort(spark, key):
    plan = _plan(spark, key)
    assert "ObjectHashAggregate" in plan and "partial_min(struct" in plan
    assert "Sort" not in plan.replace("SortMergeJoin", "") and "Window" not in plan


def test_scans_are_pruned_and_filtered(spark):
    from __spark_entry__ import queries
    df = queries()["load_table"](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in text
    assert "o_orderpriority" not in text.split("ReadSchema:")[1]
