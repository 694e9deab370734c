"""Bill-of-materials and routing operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.functions import fixed
from tabsmith.functions.mfg import operation_sequence, routing_external_id, work_center
from tabsmith.operators.relational import default_like, distinct_union

ITEM_NUMBER_COLUMN = "Item Name/Number"


def assembly_items(serialized: DataFrame, non_serialized: DataFrame) -> DataFrame:
    """Both assembly lists as one distinct set (columns matched by name)."""
    return distinct_union([serialized, non_serialized.select(*serialized.columns)])


def bom_last_use(translog: DataFrame) -> DataFrame:
    """Latest use (work in process, packing slip) per BOM, from the log."""
    return (translog.filter(F.col("trans_type").isin(*fixed.USE_TRANSACTIONS) & F.col("standard_id").isNotNull())
            .groupBy("standard_id").agg(F.max("trans_date").alias("__last_use")))


def candidate_boms(assemblies: DataFrame, partno: DataFrame, arinvt: DataFrame, standard: DataFrame,
                   translog: DataFrame) -> DataFrame:
    """Every BOM of every listed assembly, minus BOM numbers containing SUB,
    TEST, ECO or REWORK in any case (a BOM without a number is dropped), with
    the default flag (the item's own BOM) and the BOM's last use
    (1900-01-01 when never used).

    The last use is aggregated per BOM before the join, so the log is never
    multiplied by the part rows of a BOM. Repeated part rows are reduced to
    distinct (item, BOM) pairs before any text is attached; item and BOM ids
    are keys of their masters, so no row repeats after that."""
    parts = partno.select("arinvt_id", "standard_id").distinct()
    asm = assemblies.select(F.col("external_id").alias("assembly_id"),
                            F.col(ITEM_NUMBER_COLUMN).alias("assembly_item_num"),
                            F.col("description").alias("assembly_item_descrip"))
    items = arinvt.select(F.col("id").alias("__item"), F.col("standard_id").alias("__item_bom"))
    boms = standard.select(F.col("id").alias("bom_id"), F.col("mfgno").alias("bom_mfg_num"),
                           F.col("descrip").alias("bom_descrip"))
    keep = None
    for mark in fixed.BOM_EXCLUDED_MARKS:
        cond = ~F.upper(F.col("bom_mfg_num")).like(mark)
        keep = cond if keep is None else keep & cond
    uses = bom_last_use(translog)
    rows = (parts.join(asm, F.col("arinvt_id") == F.col("assembly_id"), "inner")
            .join(items, F.col("assembly_id") == F.col("__item"), "left")
            .join(boms.filter(keep), F.col("standard_id") == F.col("bom_id"), "inner")
            .join(uses.withColumnRenamed("standard_id", "__bom"), F.col("bom_id") == F.col("__bom"), "left"))
    never = default_like(uses, "__last_use", fixed.NEVER_USED)
    return rows.select(
        "assembly_id", "assembly_item_num", "assembly_item_descrip", "bom_id",
        F.when(F.col("__item_bom") == F.col("bom_id"), F.lit(fixed.BOM_DEFAULT)).alias("is_bom_default"),
        "bom_mfg_num", "bom_descrip",
        F.coalesce(F.col("__last_use"), never).alias("last_transaction_date"),
    )


def bom_counts(candidates: DataFrame) -> DataFrame:
    """Per assembly: number of candidate BOMs and of default ones."""
    return candidates.groupBy("assembly_id").agg(
        F.count("bom_id").alias("total_bom_count"),
        F.sum(F.when(F.col("is_bom_default") == fixed.BOM_DEFAULT, 1).otherwise(0)).cast("long")
        .alias("default_bom_count"))


def select_boms(candidates: DataFrame) -> DataFrame:
    """Keep an assembly's only BOM and every default one; several without a
    default keep nothing. Counts per assembly are an aggregate joined back
    (combines map-side; AQE splits a hot assembly)."""
    j = candidates.join(bom_counts(candidates), "assembly_id", "inner")
    keep = (F.col("total_bom_count") == 1) | (F.col("is_bom_default") == fixed.BOM_DEFAULT)
    return j.filter(keep).select(*candidates.columns)


def bom_components(selected: DataFrame, partno: DataFrame, ptoper: DataFrame,
                   sndop: DataFrame, opmat: DataFrame, arinvt: DataFrame) -> DataFrame:
    """One level of expansion: BOM -> part rows -> operations -> operation
    definitions -> materials -> item. Rows without an item are dropped, so
    every hop is an inner join. (A selected BOM exists in the BOM master:
    its number was read there.)"""
    pn = partno.select(F.col("id").alias("__pn"), F.col("standard_id").alias("bom_id"))
    po = ptoper.select(F.col("partno_id").alias("__pn"), F.col("sndop_id").alias("__op"))
    op = sndop.select(F.col("id").alias("__op"))
    mat = opmat.select(F.col("sndop_id").alias("__op"), F.col("arinvt_id").alias("__item"), "ptsper")
    item = arinvt.select(F.col("id").alias("__item"))
    return (selected.select("assembly_item_num", "bom_id")
            .join(pn, "bom_id").join(po, "__pn").join(op, "__op")
            .join(mat, "__op").join(item, "__item")
            .select("assembly_item_num", F.col("__item").alias("item_id"), "ptsper"))


def routing_steps(bom_main: DataFrame, partno: DataFrame, ptoper: DataFrame, sndop: DataFrame) -> DataFrame:
    """Routing steps of each BOM: its part rows' operations with the
    operation definition; sequence x 10; rows without a sequence dropped."""
    boms = bom_main.filter(F.col("external_id").isNotNull()).select(
        F.col("external_id").alias("__bom_ext"), F.col("internal_id").alias("__bom"))
    pn = partno.select(F.col("id").alias("__pn"), F.col("standard_id").alias("__bom"))
    po = ptoper.select(F.col("partno_id").alias("__pn"), F.col("sndop_id").alias("__op"), "opseq")
    op = sndop.select(F.col("id").alias("__op"), "opdesc", "cntr_type", "cycletm")
    rows = (boms.join(pn, "__bom").join(po, "__pn")
            .filter(F.col("opseq").isNotNull())
            .join(op, "__op", "left"))
    center = work_center(F.col("cntr_type"))
    return rows.select(
        routing_external_id(F.col("__bom_ext")).alias("external_id"),
        operation_sequence(F.col("opseq")).alias("operation_sequence"),
        F.col("opdesc").alias("operation_name"),
        center.alias("manufacturing_work_center"),
        center.alias("manufacturing_cost_template_external_id"),
        F.lit(None).cast("string").alias("setup_time"),
        F.col("cycletm").alias("run_rate"),
    )
