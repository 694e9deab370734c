"""Customer operators: key universe, industry gate and pick, address usage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.functions import fixed
from tabsmith.operators.relational import distinct_union, rank_within, union_all
from tabsmith.sources.files import staged


def crm_customer_activity(crm_activity: DataFrame) -> DataFrame:
    """CRM activity rows that describe a customer (source and type fixed)."""
    return crm_activity.filter(
        (F.col("principle_source") == fixed.CRM_CUSTOMER_SOURCE)
        & (F.col("type") == fixed.CRM_CUSTOMER_ACTIVITY_TYPE))


def customer_universe(orders: DataFrame, hist_orders: DataFrame, arinvoice: DataFrame, rma: DataFrame,
                      crm_activity: DataFrame) -> DataFrame:
    """Distinct customer keys seen on current or historic orders, invoices,
    returns or customer CRM activity. May contain one null key."""
    branches = [
        orders.select("arcusto_id"),
        hist_orders.select("arcusto_id"),
        arinvoice.select("arcusto_id"),
        rma.select("arcusto_id"),
        crm_customer_activity(crm_activity).select(F.col("principle_source_id").alias("arcusto_id")),
    ]
    return distinct_union(branches)


def customer_opportunity_industries(crm_opportunity: DataFrame, opportunity_udf: DataFrame) -> DataFrame:
    """(arcusto_id, industry) for every customer opportunity with an industry."""
    opp = crm_opportunity.filter(F.col("principle_source") == fixed.CRM_CUSTOMER_SOURCE)
    return (opp.join(opportunity_udf, opp["id"] == opportunity_udf["parent_id"], "inner")
            .filter(F.col("industry").isNotNull())
            .select(F.col("principle_source_id").alias("arcusto_id"), "industry"))


def single_occurrence_category(universe: DataFrame, crm_opportunity: DataFrame,
                               opportunity_udf: DataFrame) -> DataFrame:
    """(customer, industry) pairs seen exactly once among the customer's
    opportunities. Counted per pair first, then restricted to the universe
    (a semi join, so the universe never multiplies rows)."""
    counts = (customer_opportunity_industries(crm_opportunity, opportunity_udf)
              .groupBy("arcusto_id", "industry").agg(F.count("industry").alias("industry_count"))
              .filter(F.col("industry_count") == 1))
    return counts.join(universe.select("arcusto_id"), "arcusto_id", "left_semi")


def industry_pick(universe: DataFrame, crm_opportunity: DataFrame, opportunity_udf: DataFrame) -> DataFrame:
    """One industry per customer that has a single-occurrence industry: the
    smallest name among all industries of its opportunities. The
    single-occurrence pairs only gate which customers get one.

    From one count per (customer, industry): per customer the smallest name,
    and whether any count is 1. The opportunities are joined to their fields
    once, both aggregates combine map-side, and customers outside the universe
    are dropped last, from one row each."""
    counts = (customer_opportunity_industries(crm_opportunity, opportunity_udf)
              .groupBy("arcusto_id", "industry").agg(F.count("industry").alias("__n")))
    picks = counts.groupBy("arcusto_id").agg(F.min("industry").alias("industry"), F.min("__n").alias("__rarest"))
    return (picks.filter(F.col("__rarest") == 1).join(universe.select("arcusto_id"), "arcusto_id", "left_semi")
            .select("arcusto_id", "industry"))


def address_usage(universe: DataFrame, sources: list[tuple[DataFrame, bool]], address_col: str,
                  union_all_sources: bool = False, sources_within_universe: bool = False) -> DataFrame:
    """Rows (external_id, address, total) as the distinct union over sources
    of ``count(source.id)`` per (customer, address) for the customers of the
    universe. ``sources`` pairs a frame (arcusto_id, <address_col>, id) with
    whether customers absent from it still get a ``(customer, null, 0)`` row
    (an outer join without a later filter does that).

    Each source is aggregated by (customer, address) before meeting the
    universe. With ``sources_within_universe`` (every source is itself a
    branch of the universe, as in the customer tabs) that meeting only drops
    null customers and no join is planned. Absent customers are found with
    one aggregate: the set of sources each universe customer appears in
    (at most one entry per source, so bounded per customer). Equal
    (customer, address, total) rows from two sources merge, as a distinct
    union does; ``union_all_sources=True`` keeps them."""
    ids = universe.filter(F.col("arcusto_id").isNotNull()).select(F.col("arcusto_id").alias("external_id"))
    addr_type = sources[0][0].schema[address_col].dataType
    parts = []
    for src, _ in sources:
        agg = (src.filter(F.col("arcusto_id").isNotNull())
               .groupBy(F.col("arcusto_id").alias("external_id"), F.col(address_col))
               .agg(F.count("id").alias("total")))
        parts.append(agg if sources_within_universe else agg.join(ids, "external_id", "left_semi"))
    tags = [i for i, (_, keep_absent) in enumerate(sources) if keep_absent]
    if tags:
        seen = union_all([ids.select("external_id", F.lit(-1).alias("__src"))] + [
            sources[i][0].select(F.col("arcusto_id").alias("external_id"), F.lit(i).alias("__src")) for i in tags])
        present = (seen.filter(F.col("external_id").isNotNull()).groupBy("external_id")
                   .agg(F.collect_set("__src").alias("__seen")))
        wanted = F.array(*[F.lit(i) for i in tags])
        absent = (present.filter(F.array_contains("__seen", -1))
                  .select("external_id", F.explode(F.array_except(wanted, F.col("__seen"))).alias("__src")))
        zero = absent.select("external_id", F.lit(None).cast(addr_type).alias(address_col),
                             F.lit(0).cast("long").alias("total"))
        parts.append(zero)
    return union_all(parts) if union_all_sources else distinct_union(parts)


def address_counts(sources: list[DataFrame], address_col: str, union_all_sources: bool = False) -> DataFrame:
    """The non-null-address part of ``address_usage`` when every source is
    itself a branch of the customer universe (true for the bill-to and
    ship-to tabs): restricting to the universe then only drops null
    customers, so no join is needed at all."""
    parts = [
        src.filter(F.col("arcusto_id").isNotNull() & F.col(address_col).isNotNull())
        .groupBy(F.col("arcusto_id").alias("external_id"), F.col(address_col))
        .agg(F.count("id").alias("total"))
        for src in sources
    ]
    return union_all(parts) if union_all_sources else distinct_union(parts)


def address_totals(usage: DataFrame, address_col: str) -> DataFrame:
    """Total usage per (address, customer)."""
    return (usage.filter(F.col(address_col).isNotNull())
            .groupBy(address_col, "external_id")
            .agg(F.sum("total").cast("long").alias("order_count")))


def mark_most_used(usage: DataFrame, address_col: str) -> DataFrame:
    """Total usage per (address, customer), with ``is_most_used`` true for the
    address that :func:`rank_addresses` ranks first. The first address is a
    grouped minimum joined back, so no task orders all addresses of a hot
    customer. The totals are written once and read by both sides."""
    totals = staged(address_totals(usage, address_col), "address-totals")
    first = totals.groupBy(F.col("external_id").alias("__customer")).agg(
        F.min(F.struct((-F.col("order_count")).alias("n"), F.col(address_col).alias("a"))).alias("__first"))
    return totals.join(first, F.col("external_id") == F.col("__customer")).select(
        address_col, "external_id", "order_count", (F.col(address_col) == F.col("__first.a")).alias("is_most_used"))


def rank_addresses(usage: DataFrame, address_col: str) -> DataFrame:
    """Total usage per (address, customer); ``rn = 1`` marks the customer's
    most used address (ties: smaller address id). All rows are kept."""
    totals = address_totals(usage, address_col)
    return rank_within(totals, ["external_id"], [F.desc("order_count"), F.asc(address_col)])
