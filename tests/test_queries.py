"""Registered queries: the driver contract, oracle agreement, invariants."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE, SF_SMALL
from oracle_compare import compare, duck

import __spark_entry__ as entry_mod
from tabsmith.plans import tabs
from tabsmith.plans.catalog import ITEMS, QUERIES, Views

ORACLE_KEYS = sorted(entry_mod.oracle_sql())


def test_contract_shapes():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 45


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["external_id", "item_name_number", "quan", "vendor_external_id", "vendor_code",
                          "vendor_price", "preferred"]


@pytest.fixture(scope="module")
def con_small():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", ORACLE_KEYS)
def test_oracle_sf0001(spark, con_small, key):
    r = compare(spark, SF_SMALL, key, entry_mod.queries()[key], entry_mod.oracle_sql()[key], con_small)
    assert r["columns_match"], r
    assert r["values_match"], r


HEAVY = ["customer_master", "address_usage", "vendor_reconcile", "vendor_item_price", "tab_assembly_inventory",
         "bom_components", "routing_steps", "unit_weight", "stale_items"]


@pytest.mark.skipif(not os.path.exists(SF_ORACLE), reason="sf0.01 data missing")
@pytest.mark.parametrize("key", HEAVY)
def test_oracle_sf001(spark, key):
    r = compare(spark, SF_ORACLE, key, entry_mod.queries()[key], entry_mod.oracle_sql()[key])
    assert r["columns_match"] and r["values_match"], r


def test_one_row_per_key(spark):
    root = SF_ORACLE
    assert QUERIES["latest_unit"](spark, root).groupBy("arinvt_id").count().filter("count > 1").count() == 0
    vip = QUERIES["vendor_item_price"](spark, root)
    assert vip.groupBy("external_id", "vendor_external_id").count().filter("count > 1").count() == 0
    cm = QUERIES["customer_master"](spark, root)
    assert cm.groupBy("external_id").count().filter("count > 1").count() == 0
    bill = QUERIES["tab_bill_to"](spark, root)
    per_cust = bill.groupBy("customer_external_id").agg(
        F.sum(F.when(F.col("address_1_default_billing") == "TRUE", 1).otherwise(0)).alias("d"))
    assert per_cust.filter("d != 1").count() == 0


def test_kept_and_excluded_partition_items(spark):
    root = SF_ORACLE
    t = Views(spark, root, ITEMS)
    purchased = t["dim_inventory"].filter(tabs.purchased_predicate((3, 14, 159, 265, 358)))
    active = QUERIES["active_items"](spark, root).select("inventory_id")
    inactive = QUERIES["inactive_items"](spark, root).select(F.col("arinvt_id").alias("inventory_id"))
    excluded = purchased.select("inventory_id").join(inactive, "inventory_id", "left_semi")
    assert active.join(excluded, "inventory_id").count() == 0
    assert active.count() + excluded.count() == purchased.count()


def test_sorted_export_order(spark):
    df = QUERIES["multi_key_sort"](spark, SF_SMALL)
    got = [(r["item_name_number"], r["vendor_external_id"]) for r in df.collect()]
    expect = sorted(got, key=lambda x: x[1])
    expect = sorted(expect, key=lambda x: x[0], reverse=True)
    assert got == expect


def test_csv_job_missing_columns(spark, tmp_path):
    from tabsmith.plans import address_job
    p = str(tmp_path / "in")
    spark.createDataFrame([("  5 main st ", " 01234 ")], "address string, zip string").write.option(
        "header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(p)
    out = str(tmp_path / "out")
    address_job.run(spark, p, out)
    back = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(out)
    assert back.columns == ["address", "zip", "cleaned_address", "cleaned_zip"]
    r = back.collect()[0]
    assert (r["cleaned_address"], r["cleaned_zip"]) == ("5 Main Street", "01234")
