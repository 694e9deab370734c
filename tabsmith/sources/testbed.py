"""ERP-shaped views of the driver's test tables.

The ERP source tables (customers, bill-to/ship-to addresses, vendors, purchase
orders, items, transaction log, price breaks, BOMs, routings...) do not exist
in the test data, so each one is derived from the TPC-H-like tables by a small
SQL expression per column. Every view reads whole tables, so the work of every
query grows with the data.

Each view is declared once and rendered two ways:
  * to a Spark DataFrame (``spark_view``), used by the registered queries;
  * to a DuckDB common table expression (``duckdb_ctes``), used by the oracle.
Both renderings share the column expressions, so both engines see identical
inputs; the operators under test are implemented independently on each side.
The expressions stay inside the dialect subset both engines agree on
(CASE, ||, CAST, %, lpad, substr, nullif, date + int).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.functions import fixed
from tabsmith.sources.tables import DRIVER_TABLES, read_table


@dataclass(frozen=True)
class View:
    name: str
    base: str
    select: tuple  # ((alias, sql expression), ...)
    joins: tuple = ()  # ((table, left column, right column, how), ...)
    where: str | None = None
    distinct: bool = False
    group_by: tuple = ()  # ((alias, sql expression), ...) keys of an aggregate view
    values: tuple = field(default=())  # literal rows for a fixed lookup


def _s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _phone(k: str) -> str:
    """Phone text in eight shapes chosen by the key."""
    tail = f"lpad({_s(f'{k} % 10000')}, 4, '0')"
    return (
        f"CASE {k} % 8 "
        f"WHEN 0 THEN '+44 20 7946 ' || {tail} "
        f"WHEN 1 THEN '1 (404) 555-' || {tail} "
        f"WHEN 2 THEN '(404) 555-' || {tail} || ' x' || {_s(f'{k} % 97')} "
        f"WHEN 3 THEN '1-770-555-' || {tail} || ' ext ' || {_s(f'{k} % 13')} "
        f"WHEN 4 THEN '555-' || {tail} "
        f"WHEN 5 THEN '0049 30 ' || {_s(k)} "
        f"WHEN 6 THEN 'n/a' "
        f"ELSE NULL END"
    )


def _email(k: str) -> str:
    key = _s(k)
    return (
        f"CASE {k} % 7 "
        f"WHEN 0 THEN 'Buyer ' || {key} || ' <Buyer' || {key} || '@Example.COM>' "
        f"WHEN 1 THEN 'Contact' || {key} || '@Mail.com' "
        f"WHEN 2 THEN 'www.site' || {key} || '.com' "
        f"WHEN 3 THEN 'www.x' || {key} || '@site.com' "
        f"WHEN 4 THEN 'none' "
        f"WHEN 5 THEN NULL "
        f"ELSE '>a' || {key} || '@b.com<' END"
    )


def _country(k: str, name: str) -> str:
    return (
        f"CASE {k} % 10 "
        f"WHEN 0 THEN 'UNITED STATES OF AMERICA' "
        f"WHEN 1 THEN '282' "
        f"WHEN 2 THEN NULL "
        f"WHEN 3 THEN 'united states' "
        f"WHEN 4 THEN lower({name}) || ' republic' "
        f"ELSE {name} END"
    )


def _unit(k: str) -> str:
    return (
        f"CASE {k} % 9 WHEN 0 THEN 'EACH' WHEN 1 THEN 'YARD' WHEN 2 THEN 'PAIR' WHEN 3 THEN 'GAL' "
        f"WHEN 4 THEN 'FT' WHEN 5 THEN 'ROLL' WHEN 6 THEN 'IN' WHEN 7 THEN 'BOX' ELSE NULL END"
    )


def _po_unit(k: str) -> str:
    return (
        f"CASE {k} % 8 WHEN 0 THEN 'EACH' WHEN 1 THEN 'UNIT' WHEN 2 THEN 'ROLL' WHEN 3 THEN 'YARD' "
        f"WHEN 4 THEN 'BOX' WHEN 5 THEN 'GAL' WHEN 6 THEN 'PAIR' ELSE NULL END"
    )


# Test values derived from the fixed rule tables so every rule fires: product
# types map onto the purchased product groups (plus one group outside them);
# brands map onto the first model of every class rule, the second model of
# some (the model listed under two classes and the "no class" models among
# them) and one model outside all rules.
_TYPES = ("STANDARD", "PROMO", "ECONOMY", "MEDIUM", "SMALL", "LARGE")
_GROUP_BY_TYPE = tuple(zip(_TYPES, fixed.PURCHASED_GROUPS[:5] + ("Service Kits",)))
_RULE_MODELS = [models for models, _ in fixed.MODEL_CLASS_RULES]
_MODEL_BY_BRAND = tuple([m[0] for m in _RULE_MODELS] + [_RULE_MODELS[i][1] for i in (0, 1, 2, 3, 6, 7, 14)]
                        + ["Custom Build"])
_CENTER_TYPES = tuple(t for types, _ in fixed.WORK_CENTERS for t in types) + ("OTHER",)
# Class-name -> target class id lookup (hand-maintained in the ERP).
CLASS_IDS = tuple((name, str(101 + i)) for i, name in enumerate(
    dict.fromkeys([fixed.PARTS_CLASS] + [c for _, c in fixed.MODEL_CLASS_RULES if c])))


def _case_map(col: str, pairs) -> str:
    whens = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in pairs)
    return f"CASE {col} {whens} ELSE NULL END"


def _brand_model() -> str:
    whens = " ".join(f"WHEN 'Brand#{i + 1}' THEN '{m}'" for i, m in enumerate(_MODEL_BY_BRAND))
    return f"CASE p_brand {whens} ELSE NULL END"


def _center_type(k: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(_CENTER_TYPES))
    return f"CASE {k} % 21 {whens} ELSE NULL END"


# Purchase/shipment split of the line log.
_CUT = "DATE '1999-01-01'"
_LINE_ID = "l_orderkey * 8 + l_linenumber"
_PAIR_ID = "l_partkey * 1000000 + l_suppkey"

VIEWS: dict[str, View] = {}


def _add(v: View) -> None:
    VIEWS[v.name] = v


# ------------------------------------------------------------- customers
_order_cols = (
    ("id", "o_orderkey"),
    ("arcusto_id", "o_custkey"),
    ("bill_to_id", "o_custkey * 10 + o_orderkey % 4"),
    ("ship_to_id", "o_custkey * 10 + 4 + o_orderkey % 3"),
)
_add(View("c_orders", "orders", _order_cols, where="o_orderstatus = 'O'"))
_add(View("c_hist_orders", "orders", _order_cols, where="o_orderstatus = 'F'"))
_add(View("c_arinvoice", "orders", _order_cols[:3], where="o_orderstatus = 'P'"))
_add(View("c_rma", "lineitem", (("arcusto_id", "o_custkey"),),
          joins=(("orders", "l_orderkey", "o_orderkey", "inner"),), where="l_returnflag = 'R'"))
_add(View("crm_activity", "events", (
    ("id", "event_id"),
    ("principle_source", "CASE WHEN event_type = 'error' THEN 'VENDOR' ELSE 'ARCUSTO' END"),
    ("principle_source_id", "nullif(user_id, 0)"),
    ("type", "CASE WHEN event_type IN ('signup', 'purchase') THEN '4' ELSE '2' END"),
    ("bill_to_id", "user_id * 10 + event_id % 4"),
    ("ship_to_id", "user_id * 10 + 4 + event_id % 3"),
)))
_add(View("crm_opportunity", "orders", (
    ("id", "o_orderkey"),
    ("principle_source", "CASE WHEN o_orderstatus = 'P' THEN 'PROSPECT' ELSE 'ARCUSTO' END"),
    ("principle_source_id", "o_custkey"),
)))
_add(View("v_ud_crm_opportunity", "orders", (
    ("parent_id", "o_orderkey"),
    ("industry", "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE substr(o_orderpriority, 3) END"),
)))
_add(View("arcusto", "customer", (
    ("id", "c_custkey"),
    ("custno", f"'C' || lpad({_s('c_custkey')}, 7, '0')"),
    ("company", "CASE c_custkey % 3 WHEN 0 THEN upper(c_mktsegment) || ' SUPPLY CO' "
                "WHEN 1 THEN lower(c_name) || ' inc' ELSE c_name END"),
    ("cust_since", "DATE '1990-01-01' + CAST(c_custkey % 7000 AS INT)"),
    ("prime_contact_email", _email("c_custkey")),
    ("phone_number", _phone("c_custkey")),
    ("terms_id", "c_nationkey % 5"),
    ("credit_limit", "c_acctbal"),
    ("status_id", "CASE WHEN c_acctbal < 0 THEN 'Cr Hold' ELSE 'Active' END"),
    ("status_date", "DATE '2020-01-01' + CAST(c_custkey % 1000 AS INT)"),
    ("cuser1", "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'DEALER' ELSE c_mktsegment END"),
    ("tax_exempt_num", f"CASE WHEN c_custkey % 4 = 0 THEN 'EX' || {_s('c_custkey')} END"),
    ("addr1", f"{_s('c_custkey')} || ' Market St'"),
    ("addr2", f"CASE WHEN c_custkey % 2 = 0 THEN 'Suite ' || {_s('c_custkey % 100')} END"),
    ("city", "'City of ' || n_name"),
    ("state", f"CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 'S' || {_s('c_nationkey')} END"),
    ("zip", f"lpad({_s('c_custkey % 100000')}, 5, '0')"),
    ("country", _country("c_custkey", "n_name")),
), joins=(("nation", "c_nationkey", "n_nationkey", "inner"),)))
_add(View("terms", "region", (("id", "r_regionkey"), ("description", "r_name"))))


def _address_dim(name: str, ids: str, street: str) -> None:
    _add(View(name, ids, (
        ("id", "id"),
        ("attn", f"CASE WHEN id % 10 = 1 THEN NULL ELSE 'Attn ' || {_s('id')} END"),
        ("phone_number", _phone("id")),
        ("addr1", f"{_s('id')} || ' {street}'"),
        ("addr2", f"CASE WHEN id % 3 = 0 THEN 'Floor ' || {_s('id % 9')} END"),
        ("city", f"'city ' || {_s('id % 37')}"),
        ("state", f"CASE WHEN id % 17 = 0 THEN NULL ELSE 'S' || {_s('id % 25')} END"),
        ("zip", f"lpad({_s('id % 100000')}, 5, '0')"),
        ("country", _country("id", f"'COUNTRY ' || {_s('id % 7')}")),
    )))


_add(View("bill_to_ids", "orders", (("id", "o_custkey * 10 + o_orderkey % 4"),), distinct=True))
_add(View("ship_to_ids", "orders", (("id", "o_custkey * 10 + 4 + o_orderkey % 3"),), distinct=True))
_address_dim("bill_to", "bill_to_ids", "Commerce Blvd")
_address_dim("ship_to", "ship_to_ids", "Dock Rd")

# ---------------------------------------------------------------- vendors
_add(View("vendor", "supplier", (
    ("id", "s_suppkey"),
    ("vendorno", f"CASE s_suppkey % 4 WHEN 0 THEN '5' || {_s('s_suppkey')} WHEN 1 THEN 'v' || {_s('s_suppkey')} "
                 f"WHEN 2 THEN {_s('s_suppkey + 123456789012')} ELSE {_s('s_suppkey')} END"),
    ("company", "s_name"),
    ("cuser2", "CASE s_suppkey % 3 WHEN 0 THEN 'Strategic Buyer' WHEN 1 THEN 'Tactical Buyer' ELSE 'Other Buyer' END"),
    ("e_mail_addr", f"'Sales' || {_s('s_suppkey')} || '@Supplier.com'"),
    ("phone_number", _phone("s_suppkey")),
    ("web_site_url", f"'www.supplier' || {_s('s_suppkey')} || '.com'"),
    ("fax_number", _phone("s_suppkey + 3")),
    ("addr1", f"{_s('s_suppkey')} || ' INDUSTRIAL pkwy'"),
    ("city", "'CITY OF ' || n_name"),
    ("state", f"'S' || {_s('s_nationkey')}"),
    ("zip", f"lpad({_s('s_suppkey % 100000')}, 5, '0')"),
    ("country", _country("s_suppkey", "n_name")),
    ("terms_id", "s_nationkey % 5"),
    ("fed_tax_id", f"'TX-' || {_s('s_suppkey')}"),
    ("include_in_1099", "CASE s_suppkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END"),
    ("glacct_id_exp", "s_nationkey"),
), joins=(("nation", "s_nationkey", "n_nationkey", "inner"),)))
_add(View("states", "nation", (("state_code", f"'S' || {_s('n_nationkey')}"), ("name", "upper(n_name) || ' STATE'"))))
_add(View("glacct", "nation", (("id", "n_nationkey"), ("acct", f"'6' || lpad({_s('n_nationkey')}, 3, '0') || ' Expense'"))))
_add(View("dim_employees", "customer", (
    ("employee_full_name", f"'Supplier#' || lpad({_s('c_custkey * 3')}, 9, '0')"),)))
_add(View("v_po", "lineitem", (
    ("id", "l_orderkey"),
    ("pono", f"'PO' || {_s('l_orderkey')}"),
    ("ship_to_id", "l_orderkey % 3"),
    ("vendor_id", "l_suppkey"),
    ("remit_to_id", "CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_suppkey * 10 + l_orderkey % 5 END"),
)))
_add(View("remit_ids", "lineitem", (("id", "l_suppkey * 10 + l_orderkey % 5"),), distinct=True))
_add(View("remit_to", "remit_ids", (
    ("id", "id"),
    ("attn", f"CASE WHEN id % 10 = 1 THEN NULL ELSE 'accounts payable ' || {_s('id')} END"),
    ("phone_number", _phone("id")),
    ("addr1", f"{_s('id')} || ' remit rd'"),
    ("addr2", f"'PO BOX ' || {_s('id % 1000')}"),
    ("addr3", f"CASE WHEN id % 2 = 0 THEN 'DEPT ' || {_s('id % 7')} END"),
    ("city", f"'remit city ' || {_s('id % 11')}"),
    ("state", f"'S' || {_s('id % 30')}"),
    ("zip", f"lpad({_s('id % 100000')}, 5, '0')"),
    ("country", _country("id", "'CANADA'")),
)))
_add(View("vendors_cleaned", "supplier", (
    ("external_id", "CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey ELSE s_suppkey + 1000000000 END"),
    ("email", f"'ap' || {_s('s_suppkey')} || '@vendor.example'"),
    ("web_address", f"'https://vendor' || {_s('s_suppkey')} || '.example'"),
    ("fax", f"'404555' || lpad({_s('s_suppkey % 10000')}, 4, '0')"),
    ("address_1_external_id", f"'VA1-' || {_s('s_suppkey')}"),
    ("address_1_city", "'Curated City'"),
    ("address_1_state", "'Georgia'"),
    ("address_1_zip", f"lpad({_s('s_suppkey % 100000')}, 5, '0')"),
    ("address_1_country", "'United States'"),
    ("address_2_external_id", f"'VA2-' || {_s('s_suppkey')}"),
    ("address_2_address_1", f"{_s('s_suppkey')} || ' Remit Road'"),
    ("address_2_address_2", "CAST(NULL AS STRING)"),
    ("address_2_city", "'Remit City'"),
    ("address_2_state", "'Florida'"),
    ("address_2_zip", f"lpad({_s('s_suppkey % 99999')}, 5, '0')"),
    ("address_2_country", "'United States'"),
)))

# ------------------------------------------------------------------ items
# Distinct (part, supplier) pairs of the line log: one vendor item, one BOM
# and one part row each (deduplicated on two longs before any text is built).
_add(View("part_supplier_pairs", "lineitem", (("l_partkey", "l_partkey"), ("l_suppkey", "l_suppkey")),
          distinct=True))
_add(View("dim_inventory", "part", (
    ("inventory_id", "p_partkey"),
    ("item_number", f"'ITEM-' || {_s('p_partkey')}"),
    ("item_description", "upper(p_name) || CASE WHEN p_partkey % 17 = 0 THEN ' TEST RIG' ELSE '' END"),
    ("product_group", _case_map("p_type", _GROUP_BY_TYPE)),
    ("product_model", _brand_model()),
    ("unit_of_measure", _unit("p_partkey")),
    ("default_bom_number", f"CASE WHEN p_size > 25 THEN 'BOM-' || {_s('p_partkey')} END"),
    ("lead_days", "p_size % 5"),
    ("min_order_qty", "CAST(p_size * 2 AS DOUBLE)"),
    ("standard_cost", "p_retailprice"),
)))
_add(View("part_default_bom", "lineitem", (("d_suppkey", "min(l_suppkey)"),),
          group_by=(("d_partkey", "l_partkey"),)))
_add(View("arinvt", "part", (
    ("id", "p_partkey"),
    ("itemno", f"CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE 'ITEM-' || {_s('p_partkey')} END"),
    ("descrip", "p_name"),
    ("unit", _unit("p_partkey")),
    ("class", "CASE WHEN p_size % 10 = 0 THEN 'FG-' || p_type ELSE p_type END"),
    ("pk_hide", "CASE WHEN p_size % 7 = 0 THEN 'Y' END"),
    ("onhand", "CAST(p_size % 3 AS DOUBLE)"),
    ("safety_stock", "CAST(p_size % 4 AS DOUBLE)"),
    ("standard_id", "d_partkey * 1000000 + d_suppkey"),
), joins=(("part_default_bom", "p_partkey", "d_partkey", "left"),)))
_add(View("po", "orders", (
    ("id", "o_orderkey"),
    ("po_date", "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END"),
)))
# Historic headers are dated apart, so that a line joined to the wrong header shows.
_add(View("po_hist", "orders", (
    ("id", "o_orderkey"),
    ("po_date", "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderdate - INTERVAL '400' DAY AS DATE) END"),
)))
_po_detail_cols = (("po_id", "l_orderkey"), ("arinvt_id", "l_partkey"), ("unit", _po_unit("l_orderkey + l_linenumber")))
_add(View("po_detail", "lineitem", _po_detail_cols, where=f"l_shipdate >= {_CUT}"))
_add(View("po_detail_hist", "lineitem", _po_detail_cols, where=f"l_shipdate < {_CUT}"))
_add(View("translog", "lineitem", (
    ("id", _LINE_ID),
    ("arinvt_id", "l_partkey"),
    ("standard_id", _PAIR_ID),
    ("trans_date", "l_shipdate"),
    ("trans_type", "CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'NEW ITEM' "
                   "WHEN l_returnflag = 'A' THEN 'PROCESS WIP' "
                   "WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'PACKING SLIP' ELSE 'RECEIVING' END"),
)))
_add(View("arinvt_vendors", "part_supplier_pairs", (
    ("id", _PAIR_ID),
    ("arinvt_id", "l_partkey"),
    ("vendor_id", "l_suppkey % 5"),  # several vendor items for one item and vendor
    ("vend_itemno", f"'V' || {_s('l_suppkey')} || '-' || {_s('l_partkey')}"),
    ("is_default", "CASE (l_partkey + l_suppkey) % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END"),
)))
_add(View("arinvt_vendors_breaks", "lineitem", (
    ("id", _LINE_ID),
    ("arinvt_vendors_id", _PAIR_ID),
    ("quan", "CASE l_linenumber WHEN 7 THEN CAST(0 AS DOUBLE) WHEN 6 THEN NULL ELSE l_quantity END"),
    ("qprice", "l_extendedprice"),
    ("deactive_date", "CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END"),
)))
_add(View("ord_detail", "lineitem", (
    ("id", _LINE_ID), ("arinvt_id", "l_partkey"), ("orders_id", "l_orderkey"), ("cumm_shipped", "l_quantity"),
), where=f"l_shipdate >= {_CUT}"))
_add(View("hist_ord_detail", "lineitem", (("arinvt_id", "l_partkey"), ("orders_id", "l_orderkey")),
          where=f"l_shipdate < {_CUT}"))
_add(View("i_orders", "orders", (
    ("id", "o_orderkey"),
    ("crm_quote_id", "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_custkey END"),
)))
_add(View("i_hist_orders", "orders", (
    ("id", "o_orderkey"),
    ("crm_quote_id", "CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_custkey END"),
)))
_add(View("crm_quote", "customer", (("id", "c_custkey"),)))
_add(View("crm_quote_detail", "events", (
    ("id", "event_id"),
    ("crm_quote_id", "user_id"),
    ("source", "CASE WHEN event_type = 'purchase' THEN 'SALES_CONFIG' ELSE 'MANUAL' END"),
)))
# Several packages per shipment.
_add(View("shipment_packages", "part_supplier_pairs", (
    ("id", _PAIR_ID), ("shipments_id", "l_partkey"), ("actual_weight", "(l_partkey + l_suppkey) * 0.5"))))
_add(View("shipments", "orders", (("id", "o_orderkey"),)))
_add(View("shipment_dtl", "lineitem", (
    ("shipments_id", "l_orderkey"), ("order_dtl_id", _LINE_ID), ("cumm_shipped", "l_quantity"))))
_add(View("item_class_ids", "", (("product_group", None), ("class_id", None)), values=CLASS_IDS))

# ------------------------------------------------------ BOMs and routings
_add(View("standard", "part_supplier_pairs", (
    ("id", _PAIR_ID),
    ("mfgno", f"'MFG-' || {_s('l_partkey')} || '-' || {_s('l_suppkey')} || "
              "CASE (l_partkey + l_suppkey) % 12 WHEN 0 THEN '-sub' WHEN 1 THEN '-Test' WHEN 2 THEN '-ECO' "
              "WHEN 3 THEN '-rework' WHEN 4 THEN '-eco' ELSE '' END"),
    ("descrip", f"'Bill for part ' || {_s('l_partkey')}"),
)))
_add(View("partno", "part_supplier_pairs", (("id", _PAIR_ID), ("arinvt_id", "l_partkey"), ("standard_id", _PAIR_ID))))
_add(View("ptoper", "lineitem", (
    ("partno_id", _PAIR_ID), ("sndop_id", "l_orderkey"),
    ("opseq", "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END"))))
_add(View("sndop", "orders", (
    ("id", "o_orderkey"),
    ("opdesc", "'OP ' || substr(o_orderpriority, 3)"),
    ("cntr_type", _center_type("o_orderkey")),
    ("cycletm", "o_totalprice / 1000"),
)))
_add(View("opmat", "lineitem", (
    ("sndop_id", "l_orderkey"),
    ("arinvt_id", "CASE WHEN l_linenumber = 5 THEN l_partkey + 1000000000 ELSE l_partkey END"),
    ("ptsper", "l_quantity / 10"),
)))
_assembly_cols = (
    ("external_id", "p_partkey"),
    ("Item Name/Number", f"'ITEM-' || {_s('p_partkey')}"),
    ("description", "p_name"),
)
_add(View("serialized_assembly_items", "part", _assembly_cols, where="p_size <= 30"))
_add(View("non_serialized_assembly_items", "part", _assembly_cols, where="p_size > 20"))

# -------------------------------------------------------- address job input
_add(View("raw_addresses", "customer", (
    ("customer_id", "c_custkey"),
    ("address", f"{_s('c_custkey')} || CASE c_custkey % 9 WHEN 0 THEN '  main st. ' WHEN 1 THEN ' oak RD' "
                "WHEN 2 THEN ' 5th ave' WHEN 3 THEN ' o''brien blvd.' WHEN 4 THEN '   sunset   dr ' "
                "WHEN 5 THEN ' memory ln.' WHEN 6 THEN ' st. louis pkwy' WHEN 7 THEN ' stone street' "
                "ELSE ' hwy 1 rdx' END"),
    ("city", "CASE c_custkey % 5 WHEN 0 THEN '  ' || lower(n_name) || ' city ' WHEN 1 THEN upper(n_name) "
             "WHEN 2 THEN NULL ELSE 'new ' || lower(n_name) END"),
    ("state", f"CASE c_custkey % 8 WHEN 0 THEN ' GA' WHEN 1 THEN 'fl ' WHEN 2 THEN 'Al' WHEN 3 THEN 'tn' "
              f"WHEN 4 THEN 'ny' WHEN 5 THEN NULL WHEN 6 THEN ' new york ' ELSE 'S' || {_s('c_nationkey')} END"),
    ("zip", f"CASE c_custkey % 7 WHEN 0 THEN lpad({_s('c_custkey % 100000')}, 5, '0') "
            f"WHEN 1 THEN lpad({_s('c_custkey % 100000')}, 5, '0') || '-1234' "
            f"WHEN 2 THEN {_s('c_custkey % 9')} || '-23456' WHEN 3 THEN {_s('c_custkey % 10000')} "
            f"WHEN 4 THEN lpad({_s('c_custkey')}, 6, '9') WHEN 5 THEN NULL "
            f"ELSE ' ' || lpad({_s('c_custkey % 100000')}, 5, '0') || ' ' END"),
), joins=(("nation", "c_nationkey", "n_nationkey", "inner"),)))


# --------------------------------------------------------------- rendering
_BUILT: dict = {}


def spark_view(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The view as a lazy DataFrame over the parquet tables under ``root``.

    Views are immutable plans, so each (session, folder, view) is built once
    and reused: the file listing, footer read and analysis happen once
    instead of once per query that uses the view."""
    key = (id(spark), root, name)
    if key not in _BUILT or _BUILT[key].sparkSession is not spark:
        _BUILT[key] = _build_view(spark, root, name)
    return _BUILT[key]


def _build_view(spark: SparkSession, root: str, name: str) -> DataFrame:
    if name in DRIVER_TABLES:
        return read_table(spark, root, name)
    v = VIEWS[name]
    if v.values:
        cols = [a for a, _ in v.select]
        return spark.createDataFrame(list(v.values), ", ".join(f"`{c}` string" for c in cols))
    df = spark_view(spark, root, v.base)
    for table, left, right, how in v.joins:
        df = df.join(spark_view(spark, root, table), F.col(left) == F.col(right), how)
    if v.where:
        df = df.filter(F.expr(v.where))
    if v.group_by:
        df = df.groupBy(*[F.expr(e).alias(a) for a, e in v.group_by]).agg(
            *[F.expr(e).alias(a) for a, e in v.select])
    else:
        df = df.select(*[F.expr(e).alias(a) for a, e in v.select])
    if v.distinct:
        df = df.distinct()
    return df


def spark_views(spark: SparkSession, root: str, names) -> dict[str, DataFrame]:
    return {n: spark_view(spark, root, n) for n in names}


def _deps(name: str, out: list) -> None:
    if name in DRIVER_TABLES or name in out:
        return
    v = VIEWS[name]
    if v.base:
        _deps(v.base, out)
    for table, *_ in v.joins:
        _deps(table, out)
    out.append(name)


def _duck_select(v: View) -> str:
    if v.values:
        rows = ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in v.values)
        cols = ", ".join(a for a, _ in v.select)
        return f"SELECT * FROM (VALUES {rows}) AS t({cols})"
    items = list(v.group_by) + list(v.select)
    cols = ", ".join(f'{e} AS "{a}"' for a, e in items)
    sql = f"SELECT {'DISTINCT ' if v.distinct else ''}{cols} FROM {v.base}"
    for table, left, right, how in v.joins:
        sql += f" {'LEFT ' if how == 'left' else ''}JOIN {table} ON {left} = {right}"
    if v.where:
        sql += f" WHERE {v.where}"
    if v.group_by:
        sql += " GROUP BY " + ", ".join(e for _, e in v.group_by)
    return sql


def duckdb_ctes(names) -> str:
    """``name AS (SELECT ...), ...`` for the views and everything they read."""
    order: list = []
    for n in names:
        _deps(n, order)
    return ",\n".join(f"{n} AS ({_duck_select(VIEWS[n])})" for n in order)
