"""Properties of the physical plans that matter at scale."""

import re

import pytest

from starmart.catalog import queries as catalog

LAZY = sorted(set(catalog.QUERIES) - {"table_row_counts", "json_reject_stats"})


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    return {name: plan_of(catalog.QUERIES[name](spark, sf_dir)) for name in LAZY}


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_products(plans, name):
    for operator in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups",
                     "CartesianProduct", "BroadcastNestedLoopJoin", "collect_list", "collect_set"):
        assert operator not in plans[name]


@pytest.mark.parametrize("name", ["top_states", "top_categories", "top_subcategories"])
def test_top_k_is_not_a_full_sort(plans, name):
    assert "TakeOrderedAndProject" in plans[name]


def test_scans_read_only_needed_columns(plans):
    scan = re.search(r"FileScan parquet \[([^\]]*)\].*lineitem", plans["monthly_reviews"]).group(1)
    assert set(re.sub(r"#\d+L?", "", scan).split(",")) == {
        "l_orderkey", "l_partkey", "l_shipdate"}
    assert "EqualTo(l_returnflag,R)" in plans["tip_counts"]


def test_monthly_fact_shuffles_once_per_key(plans):
    # events by business and month, then the months of a business; nothing else
    assert plans["monthly_fact"].count("Exchange hashpartitioning") == 2


def test_unpartitioned_windows_only_over_bounded_rows(plans):
    """A window in a single task is allowed over bucket sizes and finished results only."""
    bounded = {"dim_location_keys", "dim_category", "dim_category_keys", "dim_business_location", "category_bridge",
               "category_bridge_keys", "daily_fact", "dashboard_payload", "registered_business_keys", "user_bucket_share"}
    single_task = re.compile(r"Window \[.*\n.*Sort \[.*\n.*Exchange SinglePartition|Window \[.*\n.*Exchange SinglePartition")
    assert {name for name, plan in plans.items() if single_task.search(plan)} <= bounded


def test_number_rows_reuses_its_shuffle(spark, sf_dir):
    frame = catalog.QUERIES["dim_location_keys"](spark, sf_dir)
    frame.collect()
    assert "ReusedExchange" in plan_of(frame)


def test_dashboard_joins_see_aggregated_rows(plans):
    for name in ("weekly_performance", "performance_by_day"):
        top = plans[name].index("BroadcastHashJoin")
        assert "HashAggregate" in plans[name][top:]
