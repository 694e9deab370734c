"""The import tabs (T1-T17). Each takes a mapping of ERP table name to
DataFrame and returns the tab as a lazy DataFrame (sort only at the sink,
see ``sorted_for_export``).

The mapping holds the tables of ``TABLES``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith import functions as T
from tabsmith.functions import fixed
from tabsmith.operators import boms as B
from tabsmith.operators import customers as C
from tabsmith.operators import items as I
from tabsmith.operators import vendors as V

Tables = Mapping[str, DataFrame]

#: ERP tables that the tabs read.
TABLES = (
    "orders", "hist_orders", "arinvoice", "rma", "crm_activity", "crm_opportunity", "v_ud_crm_opportunity", "arcusto",
    "terms", "bill_to", "ship_to", "vendor", "po", "remit_to", "states", "dim_employees", "glacct", "vendors_cleaned",
    "dim_inventory", "arinvt", "po_detail", "po_detail_hist", "po_hist", "translog", "arinvt_vendors",
    "arinvt_vendors_breaks", "item_class_ids", "ord_detail", "hist_ord_detail", "crm_quote", "crm_quote_detail",
    "shipment_packages", "shipments", "shipment_dtl", "standard", "partno", "ptoper", "sndop", "opmat",
    "serialized_assembly_items", "non_serialized_assembly_items",
)


def _null(name: str) -> Column:
    return F.lit(None).cast("string").alias(name)


def _lit(value: str, name: str) -> Column:
    return F.lit(value).alias(name)


# ---------------------------------------------------------------- customers
def customer_universe(t: Tables) -> DataFrame:
    return C.customer_universe(t["orders"], t["hist_orders"], t["arinvoice"], t["rma"], t["crm_activity"])


def customer_tab(t: Tables, universe: DataFrame | None = None) -> DataFrame:
    """One row per known (non-null) customer."""
    u = universe if universe is not None else customer_universe(t)
    ids = u.filter(F.col("arcusto_id").isNotNull())
    a = t["arcusto"]
    terms = t["terms"].select(F.col("id").alias("__terms"), F.col("description").alias("__terms_text"))
    pick = C.industry_pick(u, t["crm_opportunity"], t["v_ud_crm_opportunity"])
    rows = (ids.join(a, ids["arcusto_id"] == a["id"], "left")
            .join(terms, F.col("terms_id") == F.col("__terms"), "left")
            .join(pick.withColumnRenamed("arcusto_id", "__pick"), F.col("arcusto_id") == F.col("__pick"), "left"))
    digits = T.phone_digits(F.col("phone_number"))
    mail = T.email(F.col("prime_contact_email"))
    return rows.select(
        F.col("arcusto_id").alias("external_id"),
        F.col("custno").alias("id"),
        T.initcap_lower(F.col("company")).alias("company_name"),
        _lit(fixed.SUBSIDIARY, "subsidiary_external_id"),
        _null("parent_company_external_id"), _null("category"),
        F.col("cust_since").alias("customer_since"),
        _null("sales_rep"),
        mail.alias("email"),
        T.phone(F.col("phone_number"), digits).alias("phone"),
        T.phone_extension(F.col("phone_number"), digits).alias("extension"),
        _lit(fixed.CURRENCY, "primary_currency"),
        _null("price_level"),
        F.col("__terms_text").alias("terms"),
        F.col("credit_limit"),
        T.credit_hold(F.col("status_id")).alias("hold"),
        T.on_hold_since(F.col("status_id"), F.col("status_date")).alias("on_hold_since"),
        _null("tag_reg_number"),
        T.market_industry(F.col("cuser1"), F.col("industry")).alias("market_industry"),
        F.col("cuser1").alias("channel_segment"),
        mail.alias("customer_sales_order_emails"),
        mail.alias("customer_invoice_emails"),
        T.taxable(F.col("tax_exempt_num")).alias("taxable"),
    )


def _usage_sources(t: Tables, address_col: str, with_invoices: bool):
    keep = [c for c in ("arcusto_id", address_col, "id")]
    crm = C.crm_customer_activity(t["crm_activity"]).select(
        F.col("principle_source_id").alias("arcusto_id"), address_col, "id")
    sources = [(t["orders"].select(*keep), True), (t["hist_orders"].select(*keep), True), (crm, False)]
    if with_invoices:
        sources.append((t["arinvoice"].select(*keep), True))
    return sources


def address_usage(t: Tables, kind: str = "bill_to", universe: DataFrame | None = None,
                  union_all_sources: bool = False) -> DataFrame:
    """Usage rows per (customer, address) for bill-to (4 sources) or ship-to
    (3 sources), including the ``(customer, null, 0)`` rows."""
    col = f"{kind}_id"
    u = universe if universe is not None else customer_universe(t)
    # The usage sources are branches of the universe, so no semi join is needed.
    return C.address_usage(u, _usage_sources(t, col, kind == "bill_to"), col, union_all_sources,
                           sources_within_universe=universe is None)


def ranked_addresses(t: Tables, kind: str = "bill_to", union_all_sources: bool = False) -> DataFrame:
    col = f"{kind}_id"
    srcs = [s for s, _ in _usage_sources(t, col, kind == "bill_to")]
    return C.rank_addresses(C.address_counts(srcs, col, union_all_sources), col)


def most_used_addresses(t: Tables, kind: str = "bill_to", union_all_sources: bool = False) -> DataFrame:
    """The rows of :func:`ranked_addresses` with ``is_most_used`` in place of the rank."""
    col = f"{kind}_id"
    srcs = [s for s, _ in _usage_sources(t, col, kind == "bill_to")]
    return C.mark_most_used(C.address_counts(srcs, col, union_all_sources), col)


def _address_columns(prefix: str, key: Column, attention: Column, default_billing: Column,
                     default_shipping: Column) -> list:
    digits = T.phone_digits(F.col("phone_number"))
    country = T.country(F.col("country"))
    return [
        T.prefixed_id(prefix, key).alias("address_external_id"),
        T.address_label(F.col("addr1"), F.col("city"), F.col("state"), country).alias("address_label"),
        attention.alias("address_1_attention"),
        T.phone(F.col("phone_number"), digits).alias("address_1_phone"),
        T.phone_extension(F.col("phone_number"), digits).alias("address_1_phone_extension"),
        F.col("addr1").alias("address_1_address_1"),
        F.col("addr2").alias("address_1_address_2"),
        F.col("city").alias("address_1_city"),
        F.col("state").alias("address_1_state"),
        F.col("zip").alias("address_1_zip"),
        country.alias("address_1_country"),
        default_billing.alias("address_1_default_billing"),
        default_shipping.alias("address_1_default_shipping"),
    ]


def customer_address_tab(t: Tables, kind: str = "bill_to", fix_ship_to_defaults: bool = False,
                         union_all_sources: bool = False) -> DataFrame:
    """T2 (bill-to) / T3 (ship-to): each used address of each customer; the
    most used one is the default. As in the source template the ship-to tab
    marks it as default *billing*; ``fix_ship_to_defaults`` marks default
    shipping instead."""
    col = f"{kind}_id"
    used = most_used_addresses(t, kind, union_all_sources)
    dim = t[kind]
    rows = used.join(dim, used[col] == dim["id"], "left")
    top = T.flag_text(F.col("is_most_used"))
    false = F.lit("FALSE")
    billing, shipping = (false, top) if (kind == "ship_to" and fix_ship_to_defaults) else (top, false)
    return rows.select(F.col("external_id").alias("customer_external_id"),
                       *_address_columns("B" if kind == "bill_to" else "S", F.col(col), F.col("attn"),
                                         billing, shipping))


def customer_own_address_tab(t: Tables, universe: DataFrame | None = None) -> DataFrame:
    """T4: the customer master's own address, for every universe key
    (the null key included)."""
    u = universe if universe is not None else customer_universe(t)
    a = t["arcusto"]
    rows = u.join(a, u["arcusto_id"] == a["id"], "left")
    return rows.select(F.col("arcusto_id").alias("customer_external_id"),
                       *_address_columns("C", F.col("arcusto_id"), F.col("company"), F.lit("FALSE"),
                                         F.lit("FALSE")))


# ------------------------------------------------------------------ vendors
def vendor_grid(t: Tables, with_po_only: bool = False, vendor_ids=None) -> DataFrame:
    rows = V.vendor_rows(t["vendor"], t["po"], t["remit_to"], t["terms"], t["states"], t["dim_employees"],
                         t["glacct"], with_po_only, vendor_ids)
    return V.format_vendor_rows(rows)


def vendor_tab(t: Tables, with_po_only: bool = False, vendor_ids=None) -> DataFrame:
    """T5: curated vendors with their computed rows side by side."""
    listed = t["vendors_cleaned"].select(F.col("external_id").alias("id"))
    curated = {**t, "vendor": t["vendor"].join(listed, "id", "left_semi")}
    return V.reconcile(t["vendors_cleaned"], vendor_grid(curated, with_po_only, vendor_ids))


# -------------------------------------------------------------------- items
def _unit_columns(dim_unit: Column, item_unit: Column, po_unit: Column) -> list:
    return [
        T.units_type(dim_unit).alias("units_type"),
        T.stock_unit(item_unit).alias("primary_stock_unit"),
        T.purchase_unit(po_unit, item_unit).alias("primary_purchase_unit"),
        T.purchase_unit(po_unit, item_unit).alias("primary_sale_unit"),
        T.stock_unit(item_unit).alias("primary_consumption_unit"),
    ]


def latest_units(t: Tables) -> DataFrame:
    return I.latest_unit(I.purchase_units(t["po_detail"], t["po"], t["po_detail_hist"], t["po_hist"],
                                          distinct=False))


def purchased_predicate(excluded_ids=fixed.EXCLUDED_ITEM_IDS) -> Column:
    """Purchased items: listed product group, no default BOM, not one of the
    excluded ids (a null id is dropped, as ``NOT IN`` does)."""
    return (F.col("product_group").isin(*fixed.PURCHASED_GROUPS) & F.col("default_bom_number").isNull()
            & ~F.col("inventory_id").isin(*excluded_ids))


def active_purchased_items(t: Tables, excluded_ids=fixed.EXCLUDED_ITEM_IDS, **inactive_args) -> DataFrame:
    """dim_inventory rows of purchased items that are not inactive."""
    inactive = I.inactive_items(t["translog"], t["arinvt"], **inactive_args).select(
        F.col("arinvt_id").alias("inventory_id"))
    return t["dim_inventory"].filter(purchased_predicate(excluded_ids)).join(inactive, "inventory_id", "left_anti")


def _with_item(dim: DataFrame, t: Tables, cols) -> DataFrame:
    a = t["arinvt"].select(F.col("id").alias("__item"), *cols)
    return dim.join(a, dim["inventory_id"] == a["__item"], "left")


def _with_class(rows: DataFrame, t: Tables) -> DataFrame:
    cls = t["item_class_ids"].select(F.col("product_group").alias("__class"), "class_id")
    named = rows.withColumn("__class_name", T.item_class(F.col("product_group"), F.col("product_model")))
    return named.join(cls, F.col("__class_name") == F.col("__class"), "left")


def _with_latest_unit(rows: DataFrame, units: DataFrame) -> DataFrame:
    u = units.select(F.col("arinvt_id").alias("__po_item"), F.col("unit").alias("__po_unit"))
    return rows.join(u, F.col("inventory_id") == F.col("__po_item"), "left")


def purchase_inventory_tab(t: Tables, items: DataFrame | None = None, units: DataFrame | None = None, **kw) -> DataFrame:
    """Purchased items with units, class and accounts. ``items`` and
    ``units`` take results of :func:`active_purchased_items` and
    :func:`latest_units` that are already at hand."""
    rows = _with_item(active_purchased_items(t, **kw) if items is None else items, t, ["unit"])
    rows = _with_latest_unit(_with_class(rows, t), latest_units(t) if units is None else units)
    return rows.select(
        F.col("inventory_id").alias("external_id"),
        F.col("item_number").alias("item_name_number"),
        F.col("item_description").alias("display_name"),
        F.col("item_description").alias("purchase_description"),
        F.col("item_description").alias("sales_description"),
        _lit(fixed.SUBSIDIARY, "subsidiary"), _lit("FALSE", "include_children"),
        *_unit_columns(F.col("unit_of_measure"), F.col("unit"), F.col("__po_unit")),
        F.col("class_id").alias("class"),
        _lit(fixed.PURCHASED_COST_CATEGORY, "cost_category"), _null("planning_item_category"), _lit("TRUE", "use_bins"),
        _lit(fixed.REPLENISHMENT, "replenishment_method"), _lit("TRUE", "match_bill_to_receipt"),
        _lit(fixed.ASSET_ACCOUNT, "asset_account"), _lit(fixed.INCOME_ACCOUNT, "income_account"),
        _lit(fixed.COGS_ACCOUNT, "cogs_account"), _lit(fixed.TAX_SCHEDULE, "tax_schedule"),
    )


def _location_columns(supply_type: str) -> list:
    return [
        _lit(fixed.SUBSIDIARY, "subsidiary"), _lit(fixed.LOCATION, "location_1_location"),
        _null("location_1_reorder_point"), _lit(supply_type, "location_1_supply_type"),
        _null("location_1_preferred_stock_level"),
        T.zero_to_null(F.col("lead_days")).alias("location_1_purchase_lead_time"),
        T.zero_to_null(F.col("safety_stock")).alias("location_1_safety_stock_level"),
        T.lot_sizing(F.col("unit_of_measure")).alias("location_1_lot_sizing_method"),
        F.col("min_order_qty"),
        *[_null(name) for name in fixed.UNNAMED_LOCATION_COLUMNS],
        _lit(fixed.COUNT_INTERVAL, "location_1_count_interval"),
        F.col("standard_cost").alias("location_1_default_cost"),
    ]


def purchase_locations_tab(t: Tables, items: DataFrame | None = None, **kw) -> DataFrame:
    """Location settings of the purchased items."""
    rows = _with_item(active_purchased_items(t, **kw) if items is None else items, t, ["safety_stock"])
    return rows.select(F.col("inventory_id").alias("external_id"), *_location_columns(fixed.PURCHASED_SUPPLY_TYPE),
                       _null("location_1_classification"))


def _vendor_price_columns(item_col: str, number_col: str, yes: str, no: str) -> list:
    return [
        F.col(item_col).alias("external_id"), F.col(number_col).alias("item_name_number"),
        F.col("quan"), F.col("vendor_id").alias("vendor_external_id"), F.col("vend_itemno").alias("vendor_code"),
        F.col("vendor_price"), T.preferred_flag(F.col("is_default"), yes, no).alias("preferred"),
    ]


def purchase_item_vendors_tab(t: Tables, items: DataFrame | None = None, **kw) -> DataFrame:
    """Per purchased item and vendor, the entry price tier."""
    items = (active_purchased_items(t, **kw) if items is None else items).select("inventory_id", "item_number")
    priced = I.priced_breaks(t["arinvt_vendors_breaks"], t["arinvt_vendors"])
    rows = priced.join(items, priced["arinvt_id"] == items["inventory_id"], "inner")
    return I.entry_tier(rows, "inventory_id").select(*_vendor_price_columns("inventory_id", "item_number",
                                                                             "TRUE", "FALSE"))


def assembly_items_kept(t: Tables, stale_before: dt.date = fixed.STALE_BEFORE) -> DataFrame:
    """dim_inventory rows of the assemblies to export: default BOM present,
    description without TEST, class without FG, and neither stale nor a
    configurator item. (Item ids are the masters' primary keys.)"""
    stale = I.stale_item_ids(t["translog"], t["arinvt"], t["standard"], stale_before).select(
        F.col("arinvt_id").alias("inventory_id"))
    config = I.config_items(t["ord_detail"], t["orders"], t["hist_ord_detail"], t["hist_orders"], t["crm_quote"],
                            t["crm_quote_detail"]).select(F.col("arinvt_id").alias("inventory_id"))
    dim = (t["dim_inventory"].filter(F.col("default_bom_number").isNotNull()
                                     & ~F.upper(F.col("item_description")).like(fixed.TEST_MARK))
           .join(stale, "inventory_id", "left_anti").join(config, "inventory_id", "left_anti"))
    cls = t["arinvt"].select(F.col("id").alias("inventory_id"), "class").filter(
        ~F.col("class").like(fixed.FINISHED_GOOD_MARK))
    return dim.join(cls.select("inventory_id"), "inventory_id", "left_semi")


def assembly_results(t: Tables, stale_before: dt.date = fixed.STALE_BEFORE, items: DataFrame | None = None,
                     units: DataFrame | None = None) -> DataFrame:
    """T9 rows before formatting: kept assemblies with item unit, class id,
    latest purchase unit and weight per unit."""
    rows = _with_item(assembly_items_kept(t, stale_before) if items is None else items, t, ["unit"])
    rows = _with_latest_unit(_with_class(rows, t), latest_units(t) if units is None else units)
    w = I.unit_weight(t["shipment_packages"], t["shipments"], t["shipment_dtl"], t["ord_detail"]).select(
        F.col("arinvt_id").alias("__w_item"), "weight_per_unit")
    return rows.join(w, F.col("inventory_id") == F.col("__w_item"), "left")


def assembly_inventory_tab(t: Tables, **kw) -> DataFrame:
    """Assemblies with units, class, weight and accounts."""
    rows = assembly_results(t, **kw)
    return rows.select(
        F.col("inventory_id").alias("external_id"),
        F.col("item_number").alias("item_name_number"),
        F.col("item_description").alias("display_name"),
        F.col("item_description").alias("description"),
        _lit(fixed.SUBSIDIARY, "subsidiary"), _lit("FALSE", "include_children"),
        *_unit_columns(F.col("unit_of_measure"), F.col("unit"), F.col("__po_unit")),
        F.col("class_id").alias("class"),
        _null("preferred_location"), _lit(fixed.ASSEMBLY_COST_CATEGORY, "cost_category"), _null("round_up_quantity"),
        _null("planning_item_category"), _lit("TRUE", "use_bins"),
        _lit(fixed.REPLENISHMENT, "replenishment_method"), _lit("TRUE", "match_bill_to_receipt"),
        _null("phantom"), _lit("FALSE", "special_work_order_item"), _lit("TRUE", "offer_support"),
        F.col("weight_per_unit").alias("weight"), _lit(fixed.WEIGHT_UOM, "weight_uom"),
        _lit(fixed.ASSET_ACCOUNT, "asset_account"), _lit(fixed.INCOME_ACCOUNT, "income_account"),
        _lit(fixed.COGS_ACCOUNT, "cogs_account"), _lit(fixed.TAX_SCHEDULE, "tax_schedule"),
    ).distinct()


def assembly_locations_tab(t: Tables, ordered: bool = False, items: DataFrame | None = None, **kw) -> DataFrame:
    """Location settings of the assemblies of T9 ('Build' supply).
    ``ordered`` sorts by the item number, which is not a column of the tab.
    Built from the kept assembly rows; the T9 enrichment (units, class,
    weight) does not change which items are exported, so it is not rerun."""
    rows = _with_item(assembly_items_kept(t, **kw) if items is None else items, t, ["safety_stock"])
    if ordered:
        rows = rows.orderBy(F.desc_nulls_first("item_number"))
    return rows.select(F.col("inventory_id").alias("external_id"), *_location_columns(fixed.ASSEMBLY_SUPPLY_TYPE))


def assembly_item_vendors_tab(t: Tables, items: DataFrame | None = None, **kw) -> DataFrame:
    """Per assembly of T9 and vendor, the entry price tier (Yes/No)."""
    res = (assembly_items_kept(t, **kw) if items is None else items).select("inventory_id", "item_number")
    priced = I.priced_breaks(t["arinvt_vendors_breaks"], t["arinvt_vendors"])
    rows = priced.join(res, priced["arinvt_id"] == res["inventory_id"], "inner")
    return I.entry_tier(rows, "inventory_id").select(*_vendor_price_columns("inventory_id", "item_number",
                                                                             "Yes", "No"))


# -------------------------------------------------------------- BOMs/routing
def selected_boms(t: Tables) -> DataFrame:
    asm = B.assembly_items(t["serialized_assembly_items"], t["non_serialized_assembly_items"])
    cands = B.candidate_boms(asm, t["partno"], t["arinvt"], t["standard"], t["translog"])
    return B.select_boms(cands)


def bom_tab(selected: DataFrame) -> DataFrame:
    """One BOM per selected assembly BOM."""
    ext = T.bom_external_id(F.col("assembly_item_num"))
    return selected.select(
        ext.alias("external_id"), F.col("bom_id").alias("internal_id"), ext.alias("name"),
        _lit("FALSE", "use_component_yield"), _lit("FALSE", "available_for_all_assemblies"),
        F.col("assembly_id").alias("restrict_to_assemblies_external_id"),
        _lit("TRUE", "available_for_all_locations"), _null("restrict_to_locations"),
        _lit(fixed.SUBSIDIARY, "subsidiary"), _lit("FALSE", "include_children"),
    )


def bom_revision_tab(selected: DataFrame) -> DataFrame:
    """One revision per assembly number."""
    rev = T.revision_external_id(F.col("assembly_item_num"))
    return selected.select(
        rev.alias("external_id"), rev.alias("name"),
        T.bom_external_id(F.col("assembly_item_num")).alias("bill_of_materials_external_id"),
        _lit(fixed.REVISION_START, "effective_start_date"),
    ).distinct()


def bom_revision_components_tab(t: Tables, selected: DataFrame) -> DataFrame:
    """The components of each selected BOM revision (one level)."""
    comp = B.bom_components(selected, t["partno"], t["ptoper"], t["sndop"], t["opmat"], t["arinvt"])
    return comp.select(
        T.revision_external_id(F.col("assembly_item_num")).alias("external_id"),
        F.col("item_id").alias("item_external_id"),
        _lit(fixed.COMPONENT_YIELD, "component_yield"),
        F.col("ptsper").alias("bom_quantity"),
        _lit(fixed.ITEM_SOURCE, "item_source"),
    )


def assembly_bom_link_tab(selected: DataFrame) -> DataFrame:
    """Each assembly points at its BOM as the master default."""
    return selected.select(
        F.col("assembly_id").alias("assembly_item_external_id"),
        T.bom_external_id(F.col("assembly_item_num")).alias("bill_of_material_external_id"),
        _lit("TRUE", "master_default"),
    )


def routing_header_tab(bom_main: DataFrame, ordered: bool = False) -> DataFrame:
    """One default routing per BOM of the BOM main table. ``ordered``
    sorts by the BOM's name, which is not a column of the tab."""
    b = bom_main.filter(F.col("external_id").isNotNull())
    if ordered:
        b = b.orderBy(F.desc_nulls_first("name"))
    rid = T.routing_external_id(F.col("external_id"))
    return b.select(
        rid.alias("external_id"), rid.alias("name"), _lit(fixed.SUBSIDIARY, "subsidiary"),
        F.col("external_id").alias("bill_of_materials_external_id"), _lit(fixed.LOCATION, "location_external_id"),
        _lit("TRUE", "is_default"), _lit("FALSE", "auto_calculate_lag_time"),
    )


def routing_steps_tab(t: Tables, bom_main: DataFrame) -> DataFrame:
    """The routing steps of every BOM of the BOM main table."""
    return B.routing_steps(bom_main, t["partno"], t["ptoper"], t["sndop"])


# --------------------------------------------------------------------- sink
def with_legacy_names(df: DataFrame) -> DataFrame:
    """Rename corrected template columns back to the target template's
    legacy spellings (``fixed.LEGACY_COLUMN_NAMES``)."""
    for new, old in fixed.LEGACY_COLUMN_NAMES.items():
        if new in df.columns:
            df = df.withColumnRenamed(new, old)
    return df


# Export order per tab: (column, descending?). Nulls sort as the largest value:
# last when ascending, first when descending. The orders of the assembly
# locations and routing headers are on columns that the tabs don't have, see
# their ``ordered`` arguments.
SINK_ORDER = {
    "customer": [("id", False)],
    "customer_address": [("customer_external_id", False)],
    "vendor": [("external_id", False)],
    "purchase_inventory": [("external_id", False)],
    "purchase_item_vendors": [("external_id", False), ("vendor_external_id", False)],
    "assembly_item_vendors": [("item_name_number", True), ("vendor_external_id", False)],
    "assembly_inventory": [("item_name_number", True)],
    "bom_header": [("external_id", False)],
    "bom_components": [("external_id", True), ("item_external_id", False)],
    "bom_link": [("bill_of_material_external_id", True)],
    "routing_steps": [("external_id", False), ("operation_sequence", False)],
}


def sorted_for_export(df: DataFrame, kind: str) -> DataFrame:
    """Apply the tab's export order (a global sort; only at the sink)."""
    return df.orderBy(*[F.desc_nulls_first(c) if desc else F.asc_nulls_last(c) for c, desc in SINK_ORDER[kind]])


# Template constants by the columns that carry them.
TEMPLATE_COLUMNS = {
    "subsidiary": ("subsidiary", "subsidiary_external_id"),
    "location": ("location_1_location", "location_external_id"),
    "currency": ("primary_currency", "currency"),
    "asset_account": ("asset_account",),
    "income_account": ("income_account",),
    "cogs_account": ("cogs_account",),
    "tax_schedule": ("tax_schedule",),
    "replenishment_method": ("replenishment_method",),
    "cost_category": ("cost_category",),
}


def with_template_values(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """A tab with other template constants, e.g. ``{"subsidiary": "Other Ltd"}``
    (names: ``TEMPLATE_COLUMNS``); the defaults are the fixed values."""
    unknown = sorted(set(values) - set(TEMPLATE_COLUMNS))
    if unknown:
        raise ValueError(f"no template value is named {', '.join(unknown)}")
    new = {c: F.lit(v) for name, v in values.items() for c in TEMPLATE_COLUMNS[name] if c in df.columns}
    return df.withColumns(new) if new else df
