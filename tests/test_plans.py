"""Physical plan shapes the operators rely on (initial adaptive plan, no execution)."""

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def plan(spark, name):
    return E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["hot_items_topn", "hot_items_topn_sql", "click_cap", "hot_pages_topn"])
def test_topn_uses_partial_window_group_limit(spark, name):
    p = plan(spark, name)
    assert "WindowGroupLimit" in p and "Partial" in p


@pytest.mark.parametrize("name", ["channel_behavior_count", "marketing_total", "page_view_count"])
def test_runs_plan_has_no_expand_and_two_shuffles(spark, name):
    p = plan(spark, name)
    assert "Expand" not in p
    assert p.count("Exchange hashpartitioning") == 2


def test_interval_join_keys_include_time_bucket(spark, no_broadcast):
    p = plan(spark, "tx_interval_join")
    assert "SortMergeJoin [tx_id" in p and "_jb" in p.split("SortMergeJoin", 1)[1].split("\n", 1)[0]


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(spark, "filter_pv")
    assert "PushedFilters" in p
    p = plan(spark, "tx_interval_join")
    scan = [l for l in p.split("\n") if "FileScan parquet" in l and "EqualTo(event_type,click)" in l][0]
    assert "EqualTo(event_type,click)" in scan and "value" not in scan.split("ReadSchema:")[1]


@pytest.mark.parametrize("name", ["login_fail_pairs", "cep_fail_next", "cep_fail_times3"])
def test_login_patterns_take_one_scan_and_one_shuffle(spark, name):
    p = plan(spark, name)
    assert p.count("FileScan parquet") == 1 and p.count("Exchange hashpartitioning") == 1


def test_changelog_takes_one_scan(spark):
    p = plan(spark, "topn_changelog")
    assert p.count("FileScan parquet") == 1 and "Join" not in p and "Union" not in p


def test_order_classify_takes_one_join(spark, no_broadcast):
    p = plan(spark, "order_pay_classify")
    assert p.count("Join ") == 1 and "FullOuter" not in p


def test_full_match_has_no_full_outer_join(spark, no_broadcast):
    p = plan(spark, "tx_full_match")
    assert "FullOuter" not in p and "Window" not in p and p.count("SortMergeJoin") == 3


@pytest.mark.parametrize("name, pushed", [
    ("pv_total_simple", "EqualTo(event_type,view)"), ("hot_items_topn", "EqualTo(event_type,view)"),
    ("uv_bitmap", "EqualTo(event_type,view)"), ("channel_behavior_count", "Not(EqualTo(event_type,signup))"),
    ("hot_pages_topn", "Not(EqualTo(event_type,signup))"), ("click_cap", "EqualTo(event_type,click)")])
def test_behaviour_filters_reach_the_scan(spark, name, pushed):
    scans = [l for l in plan(spark, name).split("\n") if "FileScan parquet" in l and "event_type" in l]
    assert scans and all(pushed in l for l in scans)


def test_login_pairs_window_is_split_by_time_bucket(spark):
    p = plan(spark, "login_fail_pairs")
    wins = [l for l in p.split("\n") if "Window [lag(" in l]
    assert wins and all("_b" in l.split("windowspecdefinition(", 1)[1] for l in wins)
