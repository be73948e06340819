"""Plan properties the scale design relies on (checked on the physical plans)."""

import re

import pytest

import __spark_entry__ as E
from helpers import SF_SMALL
from streamlytics.plans.queries import QUERIES

BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


def _plan(spark, name):
    return E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_batch_plans_stay_in_the_jvm_and_never_funnel(spark, name):
    plan = _plan(spark, name)
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas", plan)
    # the un-keyed running total orders one row for each 16 window sizes in one task
    if not name.startswith("marketing_total"):
        assert "SinglePartition" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["hot_items_topn", "hot_urls_topn", "click_cap_pass", "click_cap_warn",
                                  "click_cap_by_region"])
def test_limits_are_applied_before_the_shuffle(spark, name):
    plan = _plan(spark, name)
    assert re.search(r"WindowGroupLimit .*Partial", plan)
    assert re.search(r"WindowGroupLimit .*Final", plan)


@pytest.mark.parametrize("name", ["hot_items_topn", "page_views_hourly", "uv_exact_hourly", "ad_clicks_by_region",
                                  "tx_interval_join", "order_pay_outcomes"])
def test_event_type_filters_reach_the_scan(spark, name):
    assert re.search(r"PushedFilters: \[[^\]]*(EqualTo|In)\(event_type", _plan(spark, name))


def test_window_after_join_reshuffles_by_all_keys(spark):
    plan = _plan(spark, "click_cap_by_region")
    # the cap's window is on (user, day): it must not reuse the join's partitioning by user
    assert re.search(r"Exchange hashpartitioning\(user_id#\d+L, _w0#\d+L", plan)


def test_patterns_run_in_one_shuffle(spark):
    for name in ("login_fail_strict", "order_pay_timeout"):
        plan = _plan(spark, name)
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1, name


def test_each_source_is_scanned_as_often_as_needed(spark):
    scans = lambda name: len(re.findall(r"FileScan parquet", _plan(spark, name)))
    assert scans("login_fail_strict") == scans("order_pay_timeout") == 1
    assert scans("tx_reconcile") == 4


def test_running_distinct_shares_its_markers(spark):
    df = E.queries()["uv_running"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    reused = len(re.findall(r"ReusedExchange", plan))
    assert len(re.findall(r"Scan parquet", plan)) <= 3 and reused >= 1
