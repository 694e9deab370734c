"""Mix sources to target weights.

Sizes are word counts. The total of all sizes is shared among the sources by
weight; a source's target stops at ``MAX_REPEATS`` times its size, and the
excess goes to the others by weight until none is above. ``target / size`` is
the source's repetition rate: every document is taken ``floor(rate)`` times,
plus once more if a hash-seeded uniform draw is below the fraction.

Draws come from ``md5(doc_id|size|number)``, so reruns and recomputed tasks
agree. Each source uses the one of ``SEEDS`` numbered draws whose taken words
come nearest its target. All sums combine before the shuffle, and only
per-source rows (one per source) are ever ordered or joined.

Cases: null text has size 0; a null source is a source of its own, last in
order; a source without words has target 0 and takes nothing; repeated rows
are decided alike and each counts; an empty table gives an empty result.
Weights that are missing for a source count as 0. Extra input columns are not
read by :func:`mix_sizes` and are passed on by :func:`mix_documents`.

Native: DataFrame functions only. Two concessions: the per-source table, one
small row per source, is ordered in one window, and it is joined by its size
(Spark's own threshold decides on a broadcast).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import staged, word_count

MAX_REPEATS = 3
SEEDS = 32           # draws tried per source; DRAWS_PER_HASH of them come from one md5
DRAWS_PER_HASH = 4   # of 8 hex digits each


def cycled_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """(source, weight): sources in code-point order, null last, weigh 1..cycle, repeating."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    return sources.select("source", (1 + F.pmod(F.row_number().over(order) - 1, F.lit(cycle))).cast("double").alias("weight"))


def targets(totals: DataFrame, weights: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target) from (source, source_size) and (source, weight).

    Sources whose cap is reached come first when ordered by cap per weight;
    the rest share what is left in proportion.
    """
    named = weights.select(F.col("source").alias("_source"), "weight")
    rows = (totals.join(named, F.col("source").eqNullSafe(F.col("_source")), "left")
            .select("source", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight")))
    everything = Window.partitionBy()
    by_cap = Window.orderBy(F.col("_ratio"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    cap = F.col("source_size") * max_repeats
    rows = rows.withColumns({"_cap": cap.cast("double"), "_total": F.sum("source_size").over(everything).cast("double")})
    rows = rows.withColumn("_ratio", F.when(F.col("weight") > 0, F.col("_cap") / F.col("weight")).otherwise(F.lit(float("inf"))))
    rows = rows.withColumns({"_caps_before": F.coalesce(F.sum("_cap").over(before), F.lit(0.0)),
                             "_weight_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))})
    capped = (F.col("weight") > 0) & (F.col("_ratio") * F.col("_weight_left") <= F.col("_total") - F.col("_caps_before"))
    rows = rows.withColumn("_capped", capped)
    spare = F.col("_total") - F.sum(F.when(F.col("_capped"), F.col("_cap")).otherwise(0.0)).over(everything)
    weight = F.sum(F.when(F.col("_capped"), 0.0).otherwise(F.col("weight"))).over(everything)
    rows = rows.withColumns({"_spare": spare, "_open": weight})
    share = F.when(F.col("_open") > 0, F.col("_spare") * F.col("weight") / F.col("_open")).otherwise(0.0)
    return rows.select("source", "source_size", F.when(F.col("_capped"), F.col("_cap")).otherwise(share).alias("target"))


def _draw(number: Column) -> Column:
    """Uniform number in [0, 1) for a row's doc_id and size, by the draw's number."""
    key = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("size").cast("string"),
                      F.floor(number / DRAWS_PER_HASH).cast("string"))
    digits = F.md5(key).substr(F.pmod(number, F.lit(DRAWS_PER_HASH)) * 8 + 1, F.lit(8))
    return F.conv(digits, 16, 10).cast("double") / 4294967296.0


def rates(sized: DataFrame, weights: DataFrame | None = None, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target, whole, fraction, draw) from rows (doc_id, source, size)."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    totals = staged(totals, "mix-totals")
    goal = targets(totals, weights if weights is not None else cycled_weights(totals), max_repeats)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(max_repeats)))).otherwise(0.0)
    goal = goal.withColumn("_rate", rate).select(
        "source", "source_size", "target", F.floor("_rate").alias("whole"), (F.col("_rate") - F.floor("_rate")).alias("fraction"))
    goal = staged(goal, "mix-targets")
    drawn = (with_rates(sized, goal.select("source", "fraction"))
             .where(F.col("fraction") > 0)
             .withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(SEEDS - 1))))
             .groupBy("source", "draw").agg(F.sum(F.when(_draw(F.col("draw")) < F.col("fraction"), F.col("size")).otherwise(0)).alias("extra")))
    off = F.abs(F.col("whole") * F.col("source_size") + F.col("extra") - F.col("target"))
    best = with_rates(drawn, goal).groupBy("source").agg(F.min(F.struct(off.alias("off"), "draw")).alias("best"))
    best = best.select("source", F.col("best.draw").alias("draw"))
    return staged(with_rates(goal, best, "left").withColumn("draw", F.coalesce("draw", F.lit(0))), "mix-rates")


def with_rates(rows: DataFrame, per_source: DataFrame, how: str = "inner") -> DataFrame:
    """Join on source, null with null."""
    named = per_source.withColumnRenamed("source", "_source")
    return rows.join(named, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def copies() -> Column:
    """Times a row (doc_id, size, whole, fraction, draw) is taken."""
    return F.col("whole") + F.when(_draw(F.col("draw")) < F.col("fraction"), 1).otherwise(0)


def mix_sizes(docs: DataFrame, weights: DataFrame | None = None, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, copies and taken words."""
    sized = staged(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    mixed = with_rates(sized, rates(sized, weights, max_repeats)).withColumn("copies", copies())
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies",
                        (F.col("size") * F.col("copies")).alias("taken"))


def mix_documents(docs: DataFrame, weights: DataFrame | None = None, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as it is taken, same columns."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    per_source = rates(staged(sized, "mix-sizes"), weights, max_repeats)
    packed = docs.select("doc_id", "source", F.struct(*docs.columns).alias("_row"), word_count(F.col("text")).alias("size"))
    taken = with_rates(packed, per_source).withColumn("_copies", copies()).where("_copies > 0")
    return taken.select("_row", F.explode(F.expr("sequence(1L, _copies)"))).select("_row.*")
