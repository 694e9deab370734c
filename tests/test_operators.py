"""Relational operators on small literal frames: every decision branch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tabsmith.operators import boms as B
from tabsmith.operators import customers as C
from tabsmith.operators import items as I
from tabsmith.operators.relational import distinct_union, rank_within
from tabsmith.sources.files import collected_stages


def test_latest_unit_null_dates(spark):
    units = spark.createDataFrame([(dt.date(2020, 1, 1), 1, "EACH"), (None, 1, "BOX"), (dt.date(2019, 1, 1), 2, "FT"),
                                   (dt.date(2019, 1, 1), 2, "EA")], "po_date date, arinvt_id int, unit string")
    got = sorted(rows(I.latest_unit(units), "arinvt_id", "unit"))
    assert got == [(1, "EACH"), (2, "EA")]
    got = sorted(rows(I.latest_unit(units, nulls_first=True), "arinvt_id", "unit"))
    assert got == [(1, "BOX"), (2, "EA")]


def test_usage_union_distinct_vs_all(spark):
    """Customer 1, address 7: 2 uses in source A and 2 in source B."""
    a = spark.createDataFrame([(1, 7, 10), (1, 7, 11)], "arcusto_id long, bill_to_id long, id long")
    b = spark.createDataFrame([(1, 7, 20), (1, 7, 21)], "arcusto_id long, bill_to_id long, id long")
    u = spark.createDataFrame([(1,), (2,), (None,)], "arcusto_id long")
    usage = C.address_usage(u, [(a, True), (b, True)], "bill_to_id")
    assert sorted(rows(usage), key=repr) == sorted([(1, 7, 2), (2, None, 0)], key=repr)
    ranked = C.rank_addresses(usage, "bill_to_id")
    assert rows(ranked, "external_id", "order_count", "rn") == [(1, 2, 1)]
    usage_all = C.address_usage(u, [(a, True), (b, True)], "bill_to_id", union_all_sources=True)
    ranked_all = C.rank_addresses(usage_all, "bill_to_id")
    assert rows(ranked_all, "external_id", "order_count") == [(1, 4)]
    assert sorted(rows(usage_all), key=repr).count((2, None, 0)) == 2


def test_one_default_per_customer(spark):
    usage = spark.createDataFrame([(1, 7, 3), (1, 8, 3), (1, 9, 1), (2, 5, 1)],
                                  "external_id long, bill_to_id long, total long")
    r = C.rank_addresses(usage, "bill_to_id")
    tops = sorted(rows(r.filter("rn = 1"), "external_id", "bill_to_id"))
    assert tops == [(1, 7), (2, 5)]  # tie on 3 uses -> smaller address id


def test_ranks_of_a_hot_key_come_from_many_tasks(spark):
    """Half of the rows and all nulls share a key; ranks equal those of one window, no task sorts a whole key."""
    data = [(1 if i % 2 else (None if i % 6 == 0 else i % 40), (i * 7919) % 1000, i) for i in range(3000)]
    df = spark.createDataFrame(data, "k long, v long, id long")
    order = [F.desc("v"), F.asc("id")]
    got = {(r["id"], r["rn"]) for r in rank_within(df, ["k"], order).collect()}
    window = Window.partitionBy("k").orderBy(*order)
    assert got == {(r["id"], r["rn"]) for r in df.withColumn("rn", F.row_number().over(window)).collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # ranges as a large input has them
    try:
        with collected_stages() as paths:
            ranked = rank_within(df, ["k"], order).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {(r["id"], r["rn"]) for r in ranked} == got
    per_task = spark.read.parquet(paths[0]).where("k = 1").groupBy(F.shiftright("__row", 33)).count().collect()
    assert len(per_task) >= 3 and max(r["count"] for r in per_task) < 1000


def test_ranks_without_rows(spark):
    assert rank_within(spark.createDataFrame([], "k long, v long"), ["k"], [F.asc("v")]).collect() == []


def test_industry_gate_and_pick(spark):
    u = spark.createDataFrame([(1,), (2,), (3,)], "arcusto_id long")
    opp = spark.createDataFrame([(10, "ARCUSTO", 1), (11, "ARCUSTO", 1), (12, "ARCUSTO", 1), (20, "ARCUSTO", 2),
                                 (21, "ARCUSTO", 2), (30, "OTHER", 3)],
                                "id long, principle_source string, principle_source_id long")
    udf = spark.createDataFrame([(10, "B"), (11, "B"), (12, "A"), (20, "C"), (21, "C"), (30, "Z")],
                                "parent_id long, industry string")
    single = rows(C.single_occurrence_category(u, opp, udf), "arcusto_id", "industry")
    assert single == [(1, "A")]
    # gated customer 1 gets the smallest industry of all its opportunities
    assert rows(C.industry_pick(u, opp, udf)) == [(1, "A")]


def test_inactive_rules(spark):
    tl = spark.createDataFrame([
        (1, 1, dt.datetime(2019, 1, 1), "NEW ITEM"),                     # created early, 1 tx -> out
        (2, 2, dt.datetime(2019, 1, 1), "NEW ITEM"), (3, 2, dt.datetime(2024, 5, 1), "X"),  # 2 tx, recent
        (4, 3, dt.datetime(2018, 1, 1), "X"),                           # old, nothing on hand -> out
        (5, 4, dt.datetime(2018, 1, 1), "X"),                           # old but stock on hand
        (6, 99, dt.datetime(2018, 1, 1), "X"),                          # unknown item -> null group
    ], "id long, arinvt_id long, trans_date timestamp_ntz, trans_type string")
    items = spark.createDataFrame([(1, 5.0), (2, 0.0), (3, None), (4, 2.0)], "id long, onhand double")
    got = sorted(rows(I.inactive_items(tl, items), "arinvt_id", "transaction_count"), key=repr)
    assert got == sorted([(1, 1), (3, 1), (None, 1)], key=repr)


def test_unit_weight_conserves_package_weight(spark):
    sp = spark.createDataFrame([(1, 100, 100.0), (2, 200, 30.0)], "id long, shipments_id long, actual_weight double")
    s = spark.createDataFrame([(100,), (200,)], "id long")
    sd = spark.createDataFrame([(100, 1, 2.0), (100, 2, 3.0), (200, 3, 3.0)],
                               "shipments_id long, order_dtl_id long, cumm_shipped double")
    od = spark.createDataFrame([(1, 7, 2.0), (2, 8, 3.0), (3, 7, 3.0)], "id long, arinvt_id long, cumm_shipped double")
    w = dict(rows(I.unit_weight(sp, s, sd, od)))
    # item 7: 40 lb over 2 units + 30 lb over 3 units = 70 / 5
    assert abs(w[7] - 14.0) < 1e-9 and abs(w[8] - 20.0) < 1e-9
    assert abs(w[7] * 5 + w[8] * 3 - 130.0) < 1e-9  # all package weight is spread


def test_unit_weight_several_packages_per_shipment(spark):
    """Every package of a shipment gets all its lines (pairs semantics),
    checked against a brute-force pairs computation."""
    sp = spark.createDataFrame([(1, 100, 10.0), (2, 100, 30.0), (3, 200, None), (4, 200, 8.0), (5, 300, 5.0)],
                               "id long, shipments_id long, actual_weight double")
    s = spark.createDataFrame([(100,), (200,), (300,)], "id long")
    sd = spark.createDataFrame([(100, 1, 2.0), (100, 2, 6.0), (200, 3, 4.0), (200, 4, None), (300, 5, 0.0)],
                               "shipments_id long, order_dtl_id long, cumm_shipped double")
    od = spark.createDataFrame([(1, 7, 1.0), (2, 8, 3.0), (3, 7, 2.0), (4, 8, 5.0), (5, 7, 4.0)],
                               "id long, arinvt_id long, cumm_shipped double")
    got = dict(rows(I.unit_weight(sp, s, sd, od)))
    packages = [(1, 100, 10.0), (2, 100, 30.0), (3, 200, None), (4, 200, 8.0), (5, 300, 5.0)]
    lines = {100: [(2.0, 7, 1.0), (6.0, 8, 3.0)], 200: [(4.0, 7, 2.0), (None, 8, 5.0)], 300: [(0.0, 7, 4.0)]}
    tw, tq = {}, {}
    for _, ship, w in packages:
        total = sum(x[0] for x in lines[ship] if x[0] is not None)
        for _, item, q in lines[ship]:
            if w is not None and total:
                tw[item] = tw.get(item, 0.0) + w * (q / total)
            tq[item] = tq.get(item, 0.0) + q
    for item in (7, 8):
        assert abs(got[item] - tw[item] / tq[item]) < 1e-9


def test_bom_selection(spark):
    c = spark.createDataFrame([
        (1, "A1", 10, None), (2, "A2", 20, "Default"), (2, "A2", 21, None), (3, "A3", 30, None), (3, "A3", 31, None),
    ], "assembly_id long, assembly_item_num string, bom_id long, is_bom_default string")
    got = sorted(rows(B.select_boms(c), "assembly_id", "bom_id"))
    assert got == [(1, 10), (2, 20)]


def test_candidate_boms_marks_and_defaults(spark):
    asm = spark.createDataFrame([(1, "ITEM-1", "d")], "external_id long, `Item Name/Number` string, description string")
    partno = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (1, 13)], "arinvt_id long, standard_id long")
    arinvt = spark.createDataFrame([(1, 11)], "id long, standard_id long")
    std = spark.createDataFrame([(10, "M-sub", "x"), (11, "M-1", "x"), (12, None, "x"), (13, "m-Rework", "x")],
                                "id long, mfgno string, descrip string")
    tl = spark.createDataFrame([(11, dt.datetime(2020, 1, 1), "PACKING SLIP"), (11, dt.datetime(2021, 1, 1), "X")],
                               "standard_id long, trans_date timestamp_ntz, trans_type string")
    got = rows(B.candidate_boms(asm, partno, arinvt, std, tl), "bom_id", "is_bom_default", "last_transaction_date")
    assert got == [(11, "Default", dt.datetime(2020, 1, 1))]


def test_union(spark):
    a = spark.createDataFrame([(1,), (2,)], "x int")
    b = spark.createDataFrame([(2,), (3,)], "x int")
    assert sorted(rows(distinct_union([a, b]))) == [(1,), (2,), (3,)]


def test_config_items_semi_joins(spark):
    od = spark.createDataFrame([(5, 100), (6, 101)], "arinvt_id long, orders_id long")
    hod = spark.createDataFrame([(7, 102)], "arinvt_id long, orders_id long")
    orders = spark.createDataFrame([(100, 1), (101, 2), (102, 1)], "id long, crm_quote_id long")
    quote = spark.createDataFrame([(1,), (2,)], "id long")
    qd = spark.createDataFrame([(1, 1, "SALES_CONFIG"), (2, 1, "SALES_CONFIG"), (3, 2, "MANUAL")],
                               "id long, crm_quote_id long, source string")
    assert sorted(rows(I.config_items(od, orders, hod, orders, quote, qd))) == [(5,), (7,)]


def test_package_lines_total_packages_before_lines_join(spark, monkeypatch):
    """Totals are joined back to packages, not to lines; repeated and null ids count as often as their rows."""
    from collections import Counter

    from tabsmith.operators import items

    totalled, group_total = [], items.with_group_total
    monkeypatch.setattr(items, "with_group_total", lambda df, *args: (totalled.append(df.columns), group_total(df, *args))[1])
    packages = [(1, 10, 2.0), (1, 11, 3.0), (1, 10, 2.0), (None, 10, 1.0), (None, 11, None), (3, 12, 4.0), (4, None, 5.0), (5, 13, 6.0)]
    shipments, lines = [10, 10, 11, 13, None, 14], [(10, 100, 4), (10, 101, None), (11, 100, 6), (12, 100, 7), (13, 102, 0), (None, 100, 9)]
    orders = [(100, 7, 8), (100, 8, 9), (101, 7, None), (102, 9, 3), (None, 1, 1)]
    rows = [(p, w, a, iq, q) for p, ps, w in packages for s in shipments for ls, o, q in lines for i, a, iq in orders
            if ps is not None and ps == s == ls and o == i]
    total = {p: sum(q or 0 for k, *_, q in rows if k == p) for p, *_ in rows}
    want = Counter((p, w, a, iq, total[p], w * (iq / total[p]) if None not in (w, iq) and total[p] else None) for p, w, a, iq, _ in rows)
    got = items.package_lines(spark.createDataFrame(packages, "id long, shipments_id long, actual_weight double"),
                              spark.createDataFrame([(s,) for s in shipments], "id long"),
                              spark.createDataFrame(lines, "shipments_id long, order_dtl_id long, cumm_shipped long"),
                              spark.createDataFrame(orders, "id long, arinvt_id long, cumm_shipped long"))
    assert Counter(tuple(r) for r in got.collect()) == want and len(want) > 5
    assert all("arinvt_id" not in columns for columns in totalled) and totalled
