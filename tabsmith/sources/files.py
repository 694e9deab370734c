"""File sources and sinks: header CSV with string columns, written stages."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tabsmith.session import stage_path
from tabsmith.sources import csv_ranges


#: RFC 4180: a quote inside a quoted field is doubled; blanks belong to the field.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_text_csv(spark: SparkSession, path: str, columns: list[str] | None = None, multi_line: bool = True) -> DataFrame:
    """Header CSV read with every column as a string. No type inference: a
    ZIP such as ``01234`` stays ``01234``. Files with the same columns in
    different orders are aligned by name; other columns fail, and so does a
    malformed row.

    ``multi_line`` allows line breaks inside quoted fields; files of any size
    are still read by many tasks (:mod:`tabsmith.sources.csv_ranges`), at the
    cost of a first pass that counts quotes. With ``multi_line=False``, where
    no field holds a line break, there is one pass, and every file must have
    the same header."""
    if multi_line:
        return csv_ranges.read(spark, path, CSV_OPTIONS, columns, staged=lambda df: staged(df, "csv-ranges"))
    reader = spark.read.options(**CSV_OPTIONS).option("mode", "FAILFAST").option("enforceSchema", False)
    if columns is not None:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    else:
        reader = reader.option("inferSchema", False)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV, one folder of part files (no index column)."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


#: Paths of the stages written in this thread of work, where someone collects them.
_owner: ContextVar[list | None] = ContextVar("stage owner", default=None)


@contextmanager
def collected_stages() -> Iterator[list[str]]:
    """Collects the paths of the stages written inside the block, for their owner to remove."""
    paths: list[str] = []
    token = _owner.set(paths)
    try:
        yield paths
    finally:
        _owner.reset(token)


def write_stage(df: DataFrame, name: str) -> str:
    """Write a stage as parquet below the cluster's shared folder and return
    its path; reading it back cuts the lineage (an executor lost later
    re-reads the files instead of recomputing the upstream plan)."""
    path = stage_path(df.sparkSession, name)
    if (paths := _owner.get()) is not None:
        paths.append(path)
    df.write.mode("overwrite").parquet(path)
    return path


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a stage and read it back; no pass over the files for the schema."""
    return df.sparkSession.read.schema(df.schema).parquet(write_stage(df, name))
