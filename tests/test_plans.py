"""Plan-shape guards for the scale properties documented in the README."""

import pytest

from visitlens.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
PLAN_KEYS = [k for k in sorted(QUERIES) if not k.startswith(("sink_", "daily_"))]


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")   # untruncated PushedFilters
    return {k: physical(QUERIES[k](spark, SF)) for k in PLAN_KEYS}


def test_no_python_udfs_or_pair_joins(plans):
    for key, plan in plans.items():
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                    "BroadcastNestedLoopJoin", "ObjectHashAggregate"):
            assert bad not in plan, (key, bad)


def test_first_touch_is_an_aggregate_and_stored(plans):
    assert "Window" not in plans["first_touch"] and "Window" not in plans["visit_mart"]
    assert "/first-touch-" in plans["visit_mart"]    # first touch read from its table
    assert "Window" not in plans["latest_cart"]


def test_window_filters_reach_the_scans(plans):
    # the stand-in log view is stored with the column named datetime_est
    assert "GreaterThanOrEqual(datetime_est,2024-01-17T00:00)" in plans["visit_mart"]
    assert "GreaterThanOrEqual(datetime_est,2024-01-15T00:00)" in plans["sku_mart"]


def test_dimensions_broadcast_in_sku_mart(plans):
    assert plans["sku_mart"].count("BroadcastHashJoin") >= 4


def test_page_facts_joins_aggregates(plans):
    # hits per (visit, URL) and order totals per visit are both aggregated
    # before they meet; the join never sees raw actions x raw orders
    plan = plans["page_facts"]
    join_at = plan.find("Join")
    assert join_at > 0 and "HashAggregate" in plan[join_at:]


def scans(plan: str, view: str) -> int:
    """Scans of a stored stand-in table in the initial plan."""
    return sum(f"/standin-{view}-" in line for line in plan.splitlines() if "FileScan" in line)


def test_each_fact_is_scanned_once_beside_dimensions_too_large_to_broadcast(plans):
    plan = plans["sku_mart_shuffled"]
    assert "BroadcastHashJoin" not in plan
    assert [scans(plan, v) for v in ("ads_hourly", "pla_hourly", "visit_actions")] == [1, 1, 1]
    # beside those of sku_mart, one for each side of the eight joins (41 with a branch for NULL keys)
    assert plan.count("Exchange hashpartitioning") <= plans["sku_mart"].count("Exchange hashpartitioning") + 16
    assert scans(plans["visit_sales"], "visit_orders") == 1
    assert scans(plans["category_catalog_ids"], "web") == 1
    for key in ("sku_mart_shuffled", "visit_sales", "category_catalog_ids"):
        assert "Union" not in plans["visit_sales"] and "_no_key" in plans[key]


def test_the_visit_master_is_exchanged_once(plans):
    for key, by in (("visit_mart", "hashpartitioning(_av_visit_id"),
                    ("visit_mart_salted", "hashpartitioning(_av_visit_id")):
        assert plans[key].count(f"Exchange {by}") == 1, key
    bucketed = plans["visit_mart_bucketed"]
    assert "Exchange hashpartitioning(_av_visit_id" not in bucketed
    assert "Bucketed: true" in bucketed


def test_goal_visits_filter_the_first_touches_where_they_are_read(plans):
    plan = plans["attribution_repair"]
    semi = [line for line in plan.splitlines() if "LeftSemi" in line]
    assert semi and all("BroadcastHashJoin" in line for line in semi)
