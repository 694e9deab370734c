"""Item operators: latest purchase unit, price breaks, exclusion sets,
weight per unit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.functions import fixed
from tabsmith.functions.items import unit_price
from tabsmith.operators.relational import default_like, distinct_union, first_per_key, union_all, with_group_total
from tabsmith.sources.files import staged


# --------------------------------------------------------- purchase units
def purchase_units(po_detail: DataFrame, po: DataFrame, po_detail_hist: DataFrame, po_hist: DataFrame,
                   distinct: bool = True) -> DataFrame:
    """(po_date, arinvt_id, unit) over current and historic PO lines, the date
    from the PO header (null when the header is missing); distinct unless
    ``distinct=False`` (a top-1 per item does not need it: duplicates are
    identical rows, so dropping them first only costs a shuffle)."""
    def dated(detail: DataFrame, header: DataFrame) -> DataFrame:
        h = header.select(F.col("id").alias("__po"), "po_date")
        return (detail.join(h, detail["po_id"] == h["__po"], "left")
                .select("po_date", "arinvt_id", "unit"))
    parts = [dated(po_detail, po), dated(po_detail_hist, po_hist)]
    return distinct_union(parts) if distinct else union_all(parts)


def latest_unit(units: DataFrame, nulls_first: bool = False) -> DataFrame:
    """Per item the unit of its most recent PO line. A dated line beats an
    undated one unless ``nulls_first``; equal dates take the smaller unit."""
    date_order = F.desc_nulls_first("po_date") if nulls_first else F.desc_nulls_last("po_date")
    return first_per_key(units, ["arinvt_id"], [date_order, F.asc_nulls_last("unit")]).select(
        "po_date", "arinvt_id", "unit")


# ------------------------------------------------------------ price breaks
def live_price_breaks(breaks: DataFrame) -> DataFrame:
    """Among breaks that are not deactivated, the highest break id per
    (vendor item, quantity, price): the current version of each tier."""
    return (breaks.filter(F.col("deactive_date").isNull())
            .groupBy("arinvt_vendors_id", "quan", "qprice")
            .agg(F.max("id").alias("vendor_price_break_id"))
            .select("vendor_price_break_id", "arinvt_vendors_id", "quan", "qprice"))


def priced_breaks(breaks: DataFrame, arinvt_vendors: DataFrame, representatives_only: bool = False) -> DataFrame:
    """Live breaks joined to their vendor item, with the unit price.

    The source keeps only each tier's representative (highest id per vendor
    item, quantity and price). For the entry tier that filter cannot change
    the result: every output column is a function of (vendor item, quantity,
    price), and the id tie-break picks the highest id, which is always a
    representative. So by default the filter (an aggregate plus a join of
    two large inputs) is skipped; ``representatives_only=True`` applies it as
    the source does, a join on the break id (with unique break ids this is a
    semi join; with repeated ids every matching tier repeats the row)."""
    live = breaks.filter(F.col("deactive_date").isNull())
    if representatives_only:
        reps = live_price_breaks(breaks).select(F.col("vendor_price_break_id").alias("id"))
        live = live.join(reps, "id", "inner")
    av = arinvt_vendors.select(F.col("id").alias("__av"), "arinvt_id", "vendor_id", "vend_itemno", "is_default")
    return (live.join(av, F.col("arinvt_vendors_id") == F.col("__av"), "inner")
            .select("id", "arinvt_id", "vendor_id", "vend_itemno", "is_default", "quan", "qprice",
                    unit_price(F.col("quan"), F.col("qprice")).alias("vendor_price")))


def entry_tier(priced: DataFrame, item_col: str = "arinvt_id") -> DataFrame:
    """Per (item, vendor) the lowest-quantity break (unknown quantities last;
    ties: lower unit price, then higher break id)."""
    return first_per_key(priced, [item_col, "vendor_id"],
                         [F.asc_nulls_last("quan"), F.asc_nulls_last("vendor_price"), F.desc("id")])


# ---------------------------------------------------------- exclusion sets
def inactive_items(translog: DataFrame, arinvt: DataFrame, created_before: dt.date = fixed.CREATED_BEFORE,
                   max_transactions: int = fixed.MAX_TRANSACTIONS,
                   last_moved_before: dt.date = fixed.LAST_MOVED_BEFORE) -> DataFrame:
    """Purchased items to leave out: created before ``created_before`` with at
    most ``max_transactions`` transactions, or last moved before
    ``last_moved_before`` with nothing (or nothing known) on hand.

    Statistics are grouped by (item, on hand) over the transaction log joined
    to the item master. The log is aggregated per item first (map-side
    combine; a hot item costs nothing extra), then joined to the master and
    grouped by what the master says. Log rows whose item is missing from the
    master fall into one group with a null item, as the outer join makes
    them."""
    per_item = translog.groupBy("arinvt_id").agg(
        F.count("id").alias("__n"),
        F.max("trans_date").alias("__last"),
        F.min(F.when(F.col("trans_type") == fixed.NEW_ITEM, F.col("trans_date"))).alias("__created"),
    )
    master = arinvt.select(F.col("id").alias("__id"), "onhand")
    stats = (per_item.join(master, per_item["arinvt_id"] == master["__id"], "left")
             .groupBy(F.col("__id").alias("arinvt_id"), "onhand")
             .agg(F.sum("__n").alias("transaction_count"), F.max("__last").alias("last_transaction_date"),
                  F.min("__created").alias("creation_date"))
             .select("arinvt_id", "transaction_count", "last_transaction_date", "creation_date", "onhand"))
    rule = (((F.col("creation_date") < F.lit(created_before)) & (F.col("transaction_count") <= max_transactions))
            | ((F.col("last_transaction_date") < F.lit(last_moved_before))
               & (F.coalesce(F.col("onhand"), F.lit(0)) == 0)))
    return stats.filter(rule)


def creation_dates(translog: DataFrame) -> DataFrame:
    """Every ``NEW ITEM`` row's date per item (not the minimum)."""
    return (translog.filter((F.col("trans_type") == fixed.NEW_ITEM) & F.col("arinvt_id").isNotNull())
            .select("arinvt_id", F.col("trans_date").alias("item_creation_date")))


def last_use(translog: DataFrame) -> DataFrame:
    """Latest use (work in process or packing slip) per item."""
    return (translog.filter(F.col("trans_type").isin(*fixed.USE_TRANSACTIONS) & F.col("arinvt_id").isNotNull())
            .groupBy("arinvt_id").agg(F.max("trans_date").alias("recent_trans_date")))


def _log_history(translog: DataFrame, *more) -> DataFrame:
    """One row per known log item, in one pass of the log: its last use, and ``more``."""
    used = F.max(F.when(F.col("trans_type").isin(*fixed.USE_TRANSACTIONS), F.col("trans_date"))).alias("recent_trans_date")
    return translog.filter(F.col("arinvt_id").isNotNull()).groupBy("arinvt_id").agg(used, *more)


def _created() -> Column:
    return F.when(F.col("trans_type") == fixed.NEW_ITEM, F.col("trans_date"))


def _with_masters(history: DataFrame, arinvt: DataFrame, standard: DataFrame) -> tuple[DataFrame, Column]:
    a = arinvt.select(F.col("id").alias("arinvt_id"), "itemno", "descrip", "pk_hide", "standard_id")
    std = standard.select(F.col("id").alias("__std"), "mfgno")
    rows = history.join(a, "arinvt_id", "left").join(std, F.col("standard_id") == F.col("__std"), "left")
    return rows, F.coalesce(F.col("recent_trans_date"), default_like(history, "recent_trans_date", fixed.NEVER_USED))


def stale_items(translog: DataFrame, arinvt: DataFrame, standard: DataFrame,
                stale_before: dt.date = fixed.STALE_BEFORE) -> DataFrame:
    """Assemblies to leave out: known items created and last used before
    ``stale_before`` (never used counts as 1900-01-01), or whose default BOM
    number contains ``ECO`` (case-sensitive). One row per creation date.

    The log is read and shuffled once, reduced to one row per item (last use
    and distinct creation dates, both combined map-side) before any join; an
    item with a third of all log rows adds one row, not a third of the log."""
    history = _log_history(translog, F.collect_set(_created()).alias("__created"))
    rows, recent = _with_masters(history, arinvt, standard)
    rows = rows.withColumn("item_creation_date", F.explode_outer("__created"))
    old = (F.col("itemno").isNotNull() & (F.col("item_creation_date") < F.lit(stale_before))
           & (recent < F.lit(stale_before)))
    return rows.filter(old | F.col("mfgno").like(fixed.ECO_MARK)).select(
        "arinvt_id", "itemno", "descrip",
        F.coalesce(F.col("pk_hide"), F.lit("N")).alias("is_item_inactive"),
        "item_creation_date", recent.alias("recent_trans_date"),
    )


def stale_item_ids(translog: DataFrame, arinvt: DataFrame, standard: DataFrame,
                   stale_before: dt.date = fixed.STALE_BEFORE) -> DataFrame:
    """The ids of :func:`stale_items`, once each. Some creation date is before
    the cut-off exactly if the first one is, so one row per item is enough."""
    history = _log_history(translog, F.min(_created()).alias("__first"))
    rows, recent = _with_masters(history, arinvt, standard)
    old = F.col("itemno").isNotNull() & (F.col("__first") < F.lit(stale_before)) & (recent < F.lit(stale_before))
    return rows.filter(old | F.col("mfgno").like(fixed.ECO_MARK)).select("arinvt_id").distinct()


def config_items(ord_detail: DataFrame, orders: DataFrame, hist_ord_detail: DataFrame, hist_orders: DataFrame,
                 crm_quote: DataFrame, crm_quote_detail: DataFrame) -> DataFrame:
    """Items on current or historic orders whose quote has a sales-configurator
    line. Written as semi joins (quote -> order -> order line), so a quote
    with many lines never multiplies the order lines."""
    cfg_lines = crm_quote_detail.filter(F.col("id").isNotNull() & (F.col("source") == fixed.SALES_CONFIG))
    quotes = crm_quote.select("id").join(
        cfg_lines.select(F.col("crm_quote_id").alias("id")), "id", "left_semi")

    def branch(detail: DataFrame, headers: DataFrame) -> DataFrame:
        cfg_orders = headers.join(quotes.select(F.col("id").alias("crm_quote_id")), "crm_quote_id", "left_semi")
        return (detail.join(cfg_orders.select(F.col("id").alias("orders_id")), "orders_id", "left_semi")
                .select("arinvt_id"))

    return distinct_union([branch(ord_detail, orders), branch(hist_ord_detail, hist_orders)])


# ------------------------------------------------------------------ weight
def package_lines(shipment_packages: DataFrame, shipments: DataFrame, shipment_dtl: DataFrame,
                  ord_detail: DataFrame) -> DataFrame:
    """One row per (package, shipment line, order line) with the package
    weight, the order-line quantity and the package's total shipped quantity.

    Lines meet packages last, in a join that nothing is shuffled after: the
    lines of shipments with a package are written once, their quantity is
    added up per shipment, and a package's total is the sum over its
    shipments, an aggregate of packages joined back to packages."""
    sp = shipment_packages.select(F.col("id").alias("package_id"), F.col("shipments_id").alias("__sid"),
                                  F.col("actual_weight").alias("total_package_weight"))
    s = shipments.select(F.col("id").alias("__sid"))
    sd = shipment_dtl.select(F.col("shipments_id").alias("__sid"), F.col("order_dtl_id").alias("__od"),
                             F.col("cumm_shipped").alias("shipped_quantity"))
    od = ord_detail.select(F.col("id").alias("__od"), "arinvt_id", F.col("cumm_shipped").alias("item_quantity"))
    lines = staged(sd.join(sp.select("__sid"), "__sid", "left_semi").join(od, "__od").drop("__od"), "package-lines")
    loads = lines.groupBy("__sid").agg(F.sum("shipped_quantity").alias("__load"))
    packages = with_group_total(sp.join(s, "__sid").join(loads, "__sid"), ["package_id"], "__load", "__total")
    total = F.col("__total").cast(loads.schema["__load"].dataType)
    return packages.withColumn("total_package_quantity", total).join(lines, "__sid").select(
        "package_id", "total_package_weight", "arinvt_id", "item_quantity", "total_package_quantity",
        (F.col("total_package_weight")
         * (F.col("item_quantity") / F.nullif(F.col("total_package_quantity"), F.lit(0)))).alias("distributed_weight"))


def unit_weight(shipment_packages: DataFrame, shipments: DataFrame, shipment_dtl: DataFrame,
                ord_detail: DataFrame) -> DataFrame:
    """Weight per unit from shipments: each package's weight is spread over
    the order lines shipped with it in proportion to the line quantity over
    the package's total shipped quantity; then per item
    sum(weight) / sum(quantity). The numerator uses the order-line quantity,
    the denominator the shipment-line quantity, and every package of a
    shipment gets all of the shipment's lines.

    The package x line pairs of a shipment are never built: with W the sum
    of the shipment's package weights, n its package count and Q its total
    shipped quantity (the same for each of its packages),
      sum over pairs of w * (q / Q) = (W / Q) * sum(q)  and
      sum over pairs of q           = n * sum(q),
    so the lines are joined and aggregated once per (shipment, item), written,
    and a shipment's total is added up from those rows: time linear in packages
    + lines, however many packages a hot shipment has. (Package and shipment
    ids are keys.)"""
    pk = (shipment_packages.join(shipments.select(F.col("id").alias("shipments_id")), "shipments_id")
          .groupBy("shipments_id").agg(F.sum("actual_weight").alias("__w"), F.count(F.lit(1)).alias("__n")))
    od = ord_detail.select(F.col("id").alias("order_dtl_id"), "arinvt_id", F.col("cumm_shipped").alias("__q"))
    lines = shipment_dtl.select("shipments_id", "order_dtl_id", F.col("cumm_shipped").alias("__sq")).join(
        od, "order_dtl_id")
    per_item = staged(lines.groupBy("shipments_id", "arinvt_id").agg(F.sum("__q").alias("__qi"), F.sum("__sq").alias("__sqi")),
                      "shipped-items")
    shipped = per_item.groupBy("shipments_id").agg(F.sum("__sqi").alias("__Q"))
    parts = per_item.join(pk, "shipments_id").join(shipped, "shipments_id").select(
        "arinvt_id",
        (F.col("__w") * (F.col("__qi") / F.nullif(F.col("__Q"), F.lit(0)))).alias("__tw"),
        (F.col("__n") * F.col("__qi")).alias("__tq"))
    totals = parts.groupBy("arinvt_id").agg(F.sum("__tw").alias("total_weight"),
                                            F.sum("__tq").alias("total_quantity"))
    return totals.select(
        "arinvt_id", (F.col("total_weight") / F.nullif(F.col("total_quantity"), F.lit(0))).alias("weight_per_unit"))
