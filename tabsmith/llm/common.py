"""Helpers that the training-data operators share."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabsmith.sources.files import staged as staged  # written below the shared folder and read back

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: A word is a run of characters other than the six ASCII white-space ones.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


TEXTS_PER_BATCH = 512
COUNTED_GROUPS = 1000
PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def let_workers_import(spark: SparkSession) -> None:
    """Put the folder that holds the package on the Python path of this session's workers.

    On a cluster the package comes with ``--py-files``; the extra entry is then idle.
    Rows that hold whole texts go to the workers in batches of ``TEXTS_PER_BATCH``,
    so that a worker's memory is a few batches whatever the table's size.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXTS_PER_BATCH)
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, PACKAGE_ROOT])


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One table of the data folder, through Spark's reader only, cut to the named columns."""
    let_workers_import(spark)
    table = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return table.select(*columns) if columns else table


def sampled(rows: DataFrame, key: Column, most: int, group: str | None = None) -> DataFrame:
    """At most ``most`` of ``rows``, those of the least hashes of ``key``, dealt evenly over the values of ``group``.

    A bottom-k sketch by threshold: from the rows counted per group follows a
    hash below which a few more than ``most`` of the group lie, and only these
    are shuffled and ordered, however many rows a group has. (Only the largest
    ``COUNTED_GROUPS`` groups get a threshold; it spares work and decides nothing.)
    """
    hashed = rows.withColumn("_key", F.xxhash64(key))
    by = F.col(group) if group else F.lit("")
    counts = rows.groupBy(by.alias("g")).agg(F.count("*").alias("n")).where(F.col("n") > most)
    shares = {r["g"]: (most + 6 * most ** 0.5 + 10) / r["n"] for r in counts.orderBy(F.desc("n")).limit(COUNTED_GROUPS).collect()}
    if shares:
        share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[by]
        hashed = hashed.where(F.shiftrightunsigned("_key", 11) / float(1 << 53) < F.coalesce(share, F.lit(1.0)))
    if group:
        turn = F.row_number().over(Window.partitionBy(group).orderBy("_key", *rows.columns))
        hashed = hashed.withColumn("_turn", turn).where(F.col("_turn") <= most)
        return hashed.orderBy("_turn", "_key", *rows.columns).limit(most).drop("_turn", "_key")
    return hashed.orderBy("_key", *rows.columns).limit(most).drop("_key")


def fitted_in_task(rows: DataFrame, fit) -> bytes:
    """``fit`` of all ``rows`` (bounded, in order) as one pandas frame, or of None, run in one executor task; returns its bytes."""

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        yield pd.DataFrame({"model": [fit(pd.concat(parts, ignore_index=True) if parts else None)]})

    made = rows.mapInPandas(learn, "model binary").first()
    return bytes(made["model"]) if made else fit(None)  # no rows may be no tasks


def word_count(text: Column) -> Column:
    """Number of words of a text as long; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
