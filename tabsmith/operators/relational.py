"""Generic relational building blocks used by the domain operators.

All are plain DataFrame compositions. Notes on how they scale:
  * ``distinct_union`` unions without a shuffle and removes duplicates with one
    aggregate that combines map-side first.
  * ``first_per_key`` is ``row_number() = 1``; Spark plans it with a partial
    ``WindowGroupLimit`` before the exchange, so at most one row per key and
    map partition is shuffled, however skewed the key.
  * ``rank_within`` numbers all rows of a key over a range sort and prefix
    sums, so a hot key is spread over many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.sources.files import staged


def distinct_union(frames: list[DataFrame]) -> DataFrame:
    """SQL ``UNION``: rows from all inputs, duplicates removed (by name)."""
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], rn: str | None = None) -> DataFrame:
    """One row per key: the first by ``order`` (give a total order)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    col = rn or "__rn"
    out = df.withColumn(col, F.row_number().over(w)).filter(F.col(col) == 1)
    return out if rn else out.drop(col)


def rank_within(df: DataFrame, keys: list[str], order: list[Column], name: str = "rn") -> DataFrame:
    """``row_number()`` over each key, all rows kept (give a total order).

    No task holds a key: the rows are dealt to ranges of (keys, order), so a
    hot key fills many ranges in a row, and are written once with their place
    in their range. A row's rank is its place plus the rows of its key in
    earlier ranges, a prefix sum over one count per (range, key)."""
    columns = [F.col(k) for k in keys]
    ordered = df.repartitionByRange(*columns, *order).sortWithinPartitions(*columns, *order)
    written = staged(ordered.withColumn("__row", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__row", 33)
    counts = written.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], part.alias("__part")).agg(
        F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = (Window.partitionBy(*[f"__k{i}" for i in range(len(keys))]).orderBy("__part")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1))
    shifts = counts.withColumn("__shift", F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first") + 1)
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    return written.join(shifts, [*same, part == F.col("__part")]).select(
        *df.columns, (F.col("__row") + F.col("__shift")).cast("int").alias(name))


def with_group_total(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``sum(value) over (partition by keys)`` on every row, computed as an
    aggregate joined back (null keys form a group, as in a window). The
    aggregate combines map-side and AQE splits the join when one key is hot,
    so no task has to hold a whole group."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias(name))
    t = totals.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], name)
    cond = [df[k].eqNullSafe(t[f"__k{i}"]) for i, k in enumerate(keys)]
    return df.join(t, cond, "inner").drop(*[f"__k{i}" for i in range(len(keys))])


def default_like(df: DataFrame, col: str, literal: str) -> Column:
    """A literal cast to the type of ``df[col]`` (for ``nvl(col, literal)``)."""
    return F.lit(literal).cast(df.schema[col].dataType)
