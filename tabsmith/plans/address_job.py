"""Address cleaning job.

Reads a header CSV (all columns as text), adds ``cleaned_address``,
``cleaned_city``, ``cleaned_state`` and ``cleaned_zip`` for the input
columns that exist, keeps every input column, and writes a header CSV.
All cleaning is column expressions in one projection (one scan, one write,
no Python worker).
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.functions.address import clean_address, clean_city, clean_state, clean_zip
from tabsmith.sources.files import read_text_csv, write_csv

CLEANERS = (
    ("address", "cleaned_address", clean_address),
    ("city", "cleaned_city", clean_city),
    ("state", "cleaned_state", clean_state),
    ("zip", "cleaned_zip", clean_zip),
)


def clean_addresses(df: DataFrame) -> DataFrame:
    """Add a cleaned copy of each address column present (missing columns
    are skipped, as the schema is known on the driver without a job)."""
    present = set(df.columns)
    added = [fn(F.col(src)).alias(dst) for src, dst, fn in CLEANERS if src in present]
    return df.select("*", *added)


def missing_columns(df: DataFrame) -> list[str]:
    return [src for src, _, _ in CLEANERS if src not in set(df.columns)]


def run(spark: SparkSession, input_path: str, output_path: str, multi_line: bool = True) -> DataFrame:
    """Read, clean, write; returns the cleaned DataFrame (lazy re-read-able)."""
    df = clean_addresses(read_text_csv(spark, input_path, multi_line=multi_line))
    write_csv(df, output_path)
    return df


def main(argv: list[str]) -> None:
    """``python -m tabsmith.plans.address_job <input csv> <output folder> [--single-line]``"""
    from tabsmith.session import build_session

    run(build_session(master=None), argv[0], argv[1], multi_line="--single-line" not in argv[2:])


if __name__ == "__main__":
    main(sys.argv[1:])
