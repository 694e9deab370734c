"""Reading the base tables.

Tables are read lazily; Catalyst prunes the columns a plan does not use and
pushes filters into the parquet scan, so no explicit column list is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``<root>/<name>.parquet`` (a file or a folder of part files)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
