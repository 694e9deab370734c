"""Plan shape: the properties the scale design relies on, checked on the
physical plans (with broadcasts and AQE off, i.e. the shape a large input
gets)."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from tabsmith.operators import customers as C
from tabsmith.plans import tabs
from tabsmith.plans.catalog import QUERIES, _cust


@pytest.fixture(scope="module")
def big_shape(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)

    def plan(key: str) -> str:
        return QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    yield plan
    for k, v in old.items():
        spark.conf.set(k, v)


def test_latest_unit_limits_before_shuffle(big_shape):
    p = big_shape("latest_unit")
    assert "WindowGroupLimit" in p and ", Partial" in p  # one row per item and map task is shuffled


def test_entry_tier_reuses_join_partitioning(big_shape):
    p = big_shape("vendor_item_price")
    window = p.index("Window [row_number()")
    below = p[window:]
    # the first operator below the window is the limit, not a new exchange
    assert below.index("WindowGroupLimit") < below.index("Exchange")


def test_customer_industry_has_no_window_or_fanout(big_shape):
    p = big_shape("customer_master")
    assert "Window" not in p
    # the opportunities meet their fields once
    assert p.count("partial_min(industry") == 1 and p.count("partial_count(industry") == 1


def test_bill_to_usage_never_joins_the_universe(spark, big_shape):
    """The usage totals come without a join; ranking them joins the written totals with one row per range and customer."""
    p = big_shape("default_address_rank")
    assert p.count("Join") == 1 and "order_count" in p and p.count("FileScan") == 2
    view = _cust(spark, SF_SMALL)
    sources = [s for s, _ in tabs._usage_sources(view, "bill_to_id", True)]
    totals = C.address_totals(C.address_counts(sources, "bill_to_id"), "bill_to_id")
    assert "Join" not in totals._jdf.queryExecution().executedPlan().toString()


def test_usage_and_shipped_lines_are_read_once(big_shape):
    """The totals behind the default flag and the shipped items are written once and read by both sides of their joins."""
    assert "partial_count(id" not in big_shape("tab_bill_to")
    assert big_shape("unit_weight").count("FileScan") == 4  # packages, shipments, and the written rows twice


def test_bom_selection_uses_aggregate_not_window(big_shape):
    p = big_shape("select_bom")
    assert "Window" not in p
    assert "partial_count(bom_id" in p


def test_scans_are_pruned(big_shape):
    p = big_shape("clean_phone")
    # only the key and the join column are read; the phone text is derived
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in p
    assert "ReadSchema: struct<n_nationkey:int>" in p


@pytest.mark.parametrize("key", ["item_class", "tab_purchase_inventory", "tab_assembly_inventory", "customer_master"])
def test_building_a_query_runs_no_job(spark, key):
    tracker = spark.sparkContext.statusTracker()
    QUERIES["item_class"](spark, SF_SMALL)  # table listings are cached from here on
    spark.sparkContext.setJobGroup(f"build-{key}", "build only")
    df = QUERIES[key](spark, SF_SMALL)
    df._jdf.queryExecution().executedPlan()
    jobs = tracker.getJobIdsForGroup(f"build-{key}")
    spark.sparkContext.setJobGroup("", "")
    reading_schema_only = 2  # parquet footers of tables not seen before
    assert len(jobs) <= reading_schema_only


@pytest.mark.parametrize("key", ["tab_bill_to", "tab_ship_to"])
def test_default_address_needs_no_window(big_shape, key):
    assert "Window" not in big_shape(key)


def test_exclusions_read_the_log_once(spark):
    from tabsmith.operators import items as I

    log = spark.createDataFrame([], "id long, arinvt_id long, standard_id long, trans_type string, trans_date timestamp")
    item = spark.createDataFrame([], "id long, itemno string, descrip string, pk_hide string, standard_id long, onhand double")
    bom = spark.createDataFrame([], "id long, mfgno string")
    for df in (I.inactive_items(log, item), I.stale_items(log, item, bom), I.stale_item_ids(log, item, bom)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("trans_type") and plan.count("LocalRelation") <= 3


def test_weights_join_the_lines_once(big_shape):
    p = big_shape("unit_weight")
    assert "ReusedExchange" in p or p.count("partial_sum(__q") <= 2
