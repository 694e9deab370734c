"""Export orders with nulls, template values, and title case of odd letters."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tabsmith.functions import fixed
from tabsmith.functions.text import py_title
from tabsmith.plans import export, tabs
from tabsmith.plans.catalog import ITEMS, QUERIES, STALE_BEFORE, Views


def key_of(value, descending):
    """Nulls are the largest value."""
    return (value is None, value) if value is not None else (True, "")


@pytest.mark.parametrize("kind", sorted(tabs.SINK_ORDER))
def test_every_order_puts_nulls_last_ascending_and_first_descending(spark, kind):
    names = [c for c, _ in tabs.SINK_ORDER[kind]]
    values = ["b", None, "a", "c"]
    rows = [(x, y)[: len(names)] for x in values for y in (values if len(names) > 1 else ["-"])]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names))
    got = [tuple(r) for r in tabs.sorted_for_export(df, kind).collect()]
    want = rows
    for i in reversed(range(len(names))):
        want = sorted(want, key=lambda r: key_of(r[i], False), reverse=tabs.SINK_ORDER[kind][i][1])
    assert got == want


def test_orders_on_columns_outside_the_tab(spark):
    t = Views(spark, SF_SMALL, ITEMS)
    items = tabs.assembly_items_kept(t, STALE_BEFORE)
    numbers = {r["inventory_id"]: r["item_number"] for r in items.collect()}
    got = [numbers[r["external_id"]] for r in tabs.assembly_locations_tab(t, ordered=True, items=items).collect()]
    assert len(got) > 3 and got == sorted(got, key=lambda v: key_of(v, True), reverse=True)
    main = spark.createDataFrame([("b-BOM", "b"), ("c-BOM", None), ("a-BOM", "a")], "external_id string, name string")
    assert [r["bill_of_materials_external_id"] for r in tabs.routing_header_tab(main, ordered=True).collect()] == ["c-BOM", "b-BOM", "a-BOM"]


def test_location_templates_keep_their_unnamed_columns(spark):
    for key in ("tab_purchase_locations", "tab_assembly_locations"):
        columns = QUERIES[key](spark, SF_SMALL).columns
        at = columns.index("min_order_qty")
        assert tuple(columns[at + 1:at + 6]) == fixed.UNNAMED_LOCATION_COLUMNS and columns[at + 6] == "location_1_count_interval"


def test_template_values_are_parameters(spark):
    df = QUERIES["tab_purchase_inventory"](spark, SF_SMALL)
    new = tabs.with_template_values(df, {"subsidiary": "Other Ltd", "asset_account": "1", "cogs_account": "2"})
    assert new.columns == df.columns and new.count() == df.count() > 0
    assert [tuple(r) for r in new.select("subsidiary", "asset_account", "cogs_account", "income_account").distinct().collect()] == [
        ("Other Ltd", "1", "2", fixed.INCOME_ACCOUNT)]
    with pytest.raises(ValueError):
        tabs.with_template_values(df, {"no_such_value": "x"})


def test_command_line_options():
    args = export.arguments(["in", "out", "--format", "parquet", "--stale-before", "2020-02-03", "--exclude-item", "5", "--exclude-item", "6",
                             "--set", "subsidiary=A=B", "--true-usage-totals"])
    options = export.options_of(args)
    assert options["assembly"] == {"stale_before": dt.date(2020, 2, 3)} and options["purchased"] == {"excluded_ids": (5, 6)}
    assert options["values"] == {"subsidiary": "A=B"} and options["fmt"] == "parquet" and options["address"]["union_all_sources"]


def test_export_reads_tables_and_removes_stages(spark, tmp_path):
    import os

    from tabsmith.session import shared_dir

    for name, df in _one_erp(spark).items():
        df.limit(300).write.parquet(str(tmp_path / "erp" / name))
    read = export.read_tables(spark, str(tmp_path / "erp"))
    assert set(read) == set(tabs.TABLES)
    stages = f"{shared_dir(spark)}/stages"
    before = set(os.listdir(stages)) if os.path.isdir(stages) else set()
    paths = export.export_all(read, str(tmp_path / "out"), "parquet")
    assert len(paths) == 17 and set(os.listdir(stages)) == before


def _one_erp(spark):
    """All tables under one name each, from the customer, vendor and item views."""
    from tabsmith.plans.catalog import CUSTOMERS, VENDORS

    both = {}
    for mapping in (ITEMS, VENDORS, CUSTOMERS):
        view = Views(spark, SF_SMALL, mapping)
        for name in mapping:
            df = view[name]
            if name in both:
                extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in both[name].schema if f.name not in df.columns]
                df = df.select("*", *extra)
            both[name] = df
    return both


@pytest.mark.parametrize("mark", ["", "\u0001"])
def test_title_case_of_odd_letters(spark, mark):
    texts = [t + mark for t in ["aªb", "xºy z", "ﬁx it", "o'brien 5th", "ǆur ǅ", "éa ÉA", "straße", "2ª via", "ⓐb"]]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", py_title(F.col("t")).alias("title")).collect():
        assert r["title"] == r["t"].title(), repr(r["t"])
