"""Exact top-k search by inner product with a vector-approximation file.

Components are integers. The approximation file holds, for each vector, the
number of the cell that each component falls in (one byte, ``CELL_BITS`` bits
used, cells of equal width between a component's smallest and largest value).

1. Scan: blocks of queries meet blocks of cells. Cell edges give a lower and an
   upper bound of every score; a block passes on the candidates whose upper
   bound reaches its k-th best lower bound.
2. Over all blocks of a query the k-th best lower bound rises, and more
   candidates fall out.
3. Read: the candidates that lead in bound order are joined with the exact
   vectors first; their k-th exact score then decides which of the rest can
   still matter, and only those are read. What is left out is certainly worse.

Equal vectors are searched once: of each group of equal vectors only the first
k + 1 by id can enter any result, so the rest leave the candidates beforehand
(not the queries), and equal queries share one search.

Bounded memory: a task holds one block of queries and one of cells. Nothing
but per-component ranges and row counts comes to the driver.

Wide vectors, with a component beyond ``LARGEST``, would overflow the integer
scores. They are kept as they are and scored in integers of any size, block by
block: wide queries with all vectors, the others with the wide ones. The best
of both ways are merged. Where there are none, nothing of this runs.

Cases: vectors that are null, or hold a null or non-finite component, take no
part; a score beyond a long is given as the nearest long, and ranked by its
true value; a shorter vector counts as ending in zeros,
so an empty one scores 0 with all; ties go to the smaller id; repeated rows
with one id are one candidate, the one that comes first by value (wide ones first); rows without
an id take no part; fewer candidates than k give all; an empty table gives no
rows. Extra input columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import staged

CELL_BITS = 5
VECTORS_PER_BLOCK = 16384
QUERIES_PER_BLOCK = 2048
QUERIES_AT_ONCE = 128       # rows of the bound matrix that a task holds
LARGEST = float(1 << 24)    # largest component whose scores surely fit in a long
SCALE = 256
WIDE_BLOCK = 1024           # vectors in one task of the search among wide ones
LONGS = (-(1 << 63), (1 << 63) - 1)


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, wide): components as floor(SCALE * x), or a wide vector's own; rows that can't take part left out."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = F.col("vec_id").isNotNull() & x.isNotNull() & F.coalesce(finite, F.lit(False))
    large = F.exists(x, lambda c: F.abs(c) > LARGEST)
    small = F.transform(x, lambda c: F.when(F.abs(c) <= LARGEST, F.floor(c.cast("double") * SCALE)).otherwise(F.lit(0)).cast("long"))
    return vectors.select("vec_id", "embedding").where(usable).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.when(~large, small).alias("v"), F.when(large, x.cast("array<double>")).alias("wide"))


def _first_of_equal(vectors: DataFrame, k: int) -> DataFrame:
    """One row per id, and of equal vectors the first ``k + 1`` by id.

    Both windows stop at a fixed rank, which Spark applies before the shuffle.
    """
    by_id = Window.partitionBy("vec_id").orderBy("v")
    unique = vectors.withColumn("_n", F.row_number().over(by_id)).where("_n = 1").drop("_n")
    equal = Window.partitionBy(F.xxhash64("v"), "v").orderBy("vec_id")
    return unique.withColumn("copy", F.row_number().over(equal)).where(F.col("copy") <= k + 1)


def cell_ranges(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Smallest and largest value of each component (a row per component), and the number of vectors."""
    values = vectors.select(F.posexplode("v").alias("d", "x"))
    rows = values.groupBy("d").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
    size = max((r["d"] for r in rows), default=-1) + 1
    lo, hi = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    for r in rows:  # shorter vectors end in zeros, so 0 is within every range
        lo[r["d"]], hi[r["d"]] = min(r["lo"], 0), max(r["hi"], 0)
    return lo, hi, vectors.count()


def _matrix(rows: pd.Series, size: int) -> np.ndarray:
    out = np.zeros((len(rows), size), dtype=np.int64)
    for i, v in enumerate(rows):
        out[i, :len(v)] = v
    return out


def approximation(vectors: DataFrame, lo: np.ndarray, hi: np.ndarray, bits: int = CELL_BITS) -> DataFrame:
    """The approximation file: (vec_id, cells), one byte per component."""
    size, width = len(lo), cell_width(lo, hi, bits)

    def cells_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells = ((_matrix(batch["v"], size) - lo) // width).astype(np.uint8)
            yield pd.DataFrame({"vec_id": batch["vec_id"], "cells": [c.tobytes() for c in cells]})

    return vectors.mapInPandas(cells_of, "vec_id long, cells binary")


def cell_width(lo: np.ndarray, hi: np.ndarray, bits: int) -> np.ndarray:
    return (hi - lo) // (1 << bits) + 1


def _candidates(lo: np.ndarray, hi: np.ndarray, bits: int, k: int):
    """Function of a block of queries and a block of cells: candidates with their bounds."""
    size, width = len(lo), cell_width(lo, hi, bits)
    columns = ["query", "vec_id", "low", "high"]

    def scan(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or block.empty:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in columns})
        cells = np.frombuffer(b"".join(block["cells"]), dtype=np.uint8).reshape(len(block), size).astype(np.int64)
        below = lo + cells * width
        above = np.minimum(below + width - 1, hi)
        middle, radius = ((below + above) / 2.0).T, ((above - below) / 2.0).T
        ids = block["vec_id"].to_numpy()
        q = _matrix(queries["v"], size).astype(np.float64)
        query_ids, out = queries["query"].to_numpy(), []
        for start in range(0, len(q), QUERIES_AT_ONCE):
            part = q[start:start + QUERIES_AT_ONCE]
            centre, spread = part @ middle, np.abs(part) @ radius
            slack = 1.0 + 1e-12 * (np.abs(part) @ np.maximum(np.abs(lo), np.abs(hi)))[:, None]
            low, high = np.floor(centre - spread - slack), np.ceil(centre + spread + slack)
            kth = np.partition(low, -k, axis=1)[:, -k] if len(ids) > k else low.min(axis=1)
            rows, at = np.nonzero(high >= kth[:, None])
            out.append(pd.DataFrame({"query": query_ids[start + rows], "vec_id": ids[at],
                                     "low": low[rows, at].astype(np.int64), "high": high[rows, at].astype(np.int64)}, columns=columns))
        return pd.concat(out, ignore_index=True)

    return scan


def _score(a: str, b: str) -> Column:
    """Inner product of two long arrays; the shorter ends in zeros."""
    products = F.zip_with(F.col(a), F.col(b), lambda x, y: F.coalesce(x * y, F.lit(0).cast("long")))
    return F.aggregate(products, F.lit(0).cast("long"), lambda s, x: s + x)


def _read(pairs: DataFrame, searched: DataFrame, vectors: DataFrame) -> DataFrame:
    """(query, vec_id, score): exact scores of the pairs."""
    queries = searched.select("query", F.col("v").alias("q"))
    return (pairs.join(vectors.select("vec_id", "v"), "vec_id").join(queries, "query")
            .select("query", "vec_id", _score("q", "v").alias("score")))


def _integers(v, wide) -> list[int]:
    """Components of a row of :func:`quantised` as integers of any size."""
    if v is not None:
        return [int(c) for c in v]
    return [int(c) * SCALE if abs(c) >= 1 << 53 else math.floor(c * SCALE) for c in wide]


def _search_wide(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """(query_id, vec_id, exact): the k best of each query's pairs with a wide side; ``exact`` is the score as text."""
    candidates = staged(vectors.groupBy("vec_id").agg(F.min(F.struct("v", "wide")).alias("s")).select("vec_id", "s.*"), "wide-vectors")
    queries = candidates.where(is_query)
    sizes = candidates.agg(F.count("*").alias("n"), F.count("wide").alias("wide"), F.sum(is_query.cast("long")).alias("q")).first()
    columns, rows = (max(1, -(-(n or 0) // WIDE_BLOCK)) for n in (sizes["n"], sizes["q"]))

    def best(asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found = []
        others = [(i, _integers(v, w), w is not None) for i, v, w in zip(block["vec_id"], block["v"], block["wide"], strict=True)]
        for i, v, w in zip(asked["vec_id"], asked["v"], asked["wide"], strict=True):
            own = _integers(v, w)
            scores = ((sum(a * b for a, b in zip(own, other, strict=False)), -j) for j, other, wide in others if j != i and (wide or w is not None))
            found += [(i, -j, str(score)) for score, j in heapq.nlargest(k, scores)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "exact"])

    asked = queries.select("*", F.pmod(F.xxhash64("vec_id"), F.lit(rows)).alias("row"), F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("column"))
    block = candidates.select("*", F.pmod(F.xxhash64("vec_id"), F.lit(columns)).cast("int").alias("column"),
                              F.explode(F.sequence(F.lit(0).cast("long"), F.lit(rows - 1).cast("long"))).alias("row"))
    return asked.groupBy("row", "column").cogroup(block.groupBy("row", "column")).applyInPandas(best, "query_id long, vec_id long, exact string")


def search(vectors: DataFrame, is_query: Column, k: int = 5, bits: int = CELL_BITS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k best rows but itself.

    ``vectors`` has (vec_id, v, wide) as :func:`quantised` gives it; ``is_query``
    is a condition on its id.
    """
    wide_ids = vectors.where("wide is not null").select("vec_id")
    if wide_ids.isEmpty():
        return search_cells(vectors.select("vec_id", "v"), is_query, k, bits)
    near = search_cells(vectors.select("vec_id", "v").join(wide_ids, "vec_id", "left_anti"), is_query, k, bits)
    found = near.select("query_id", "vec_id", F.col("score").cast("string").alias("exact")).unionByName(_search_wide(vectors, is_query, k))

    def ranked(rows: pd.DataFrame) -> pd.DataFrame:
        best = heapq.nlargest(k, ((int(s), -int(j)) for j, s in zip(rows["vec_id"], rows["exact"], strict=True)))
        return pd.DataFrame([(int(rows["query_id"].iloc[0]), n, -j, min(max(s, LONGS[0]), LONGS[1])) for n, (s, j) in enumerate(best, 1)],
                            columns=["query_id", "rank", "vec_id", "score"])

    return found.groupBy("query_id").applyInPandas(ranked, "query_id long, rank int, vec_id long, score long")


def search_cells(vectors: DataFrame, is_query: Column, k: int = 5, bits: int = CELL_BITS) -> DataFrame:
    """:func:`search` over (vec_id, v) without wide vectors. One more than k is searched, as a query finds itself."""
    exact = staged(_first_of_equal(vectors, k), "vectors")
    asked = vectors.where(is_query).select(F.col("vec_id").alias("query_id"), "v")
    asked = asked.withColumn("_n", F.row_number().over(Window.partitionBy("query_id").orderBy("v"))).where("_n = 1").drop("_n")
    # Equal queries share a search, named after the first copy among the candidates.
    first = exact.where("copy = 1").select(F.col("vec_id").alias("query"), F.col("v").alias("_v"))
    asked = staged(asked.join(first, (F.xxhash64("v") == F.xxhash64("_v")) & (F.col("v") == F.col("_v"))).select("query_id", "query", "v"), "queries")
    searched = staged(asked.groupBy("query").agg(F.first("v").alias("v")), "searches")
    lo, hi, n_vectors = cell_ranges(exact)
    schema = "query long, vec_id long, low long, high long"
    n_columns = max(1, -(-n_vectors // VECTORS_PER_BLOCK))
    n_rows = max(1, -(-searched.count() // QUERIES_PER_BLOCK))
    file = staged(approximation(exact.select("vec_id", "v"), lo, hi, bits), "vector-cells")
    blocks = file.select("*", F.pmod(F.xxhash64("vec_id"), F.lit(n_columns)).alias("column"),
                         F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))).alias("row"))
    asking = searched.select("*", F.pmod(F.xxhash64("query"), F.lit(n_rows)).cast("int").alias("row"),
                             F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_columns - 1).cast("long"))).alias("column"))
    keep = k + 1
    found = asking.groupBy("row", "column").cogroup(blocks.groupBy("row", "column")).applyInPandas(_candidates(lo, hi, bits, keep), schema)
    found = staged(found, "vector-candidates")

    def kth(frame: DataFrame, column: str) -> DataFrame:
        best = Window.partitionBy("query").orderBy(F.col(column).desc())
        ranked = frame.select("query", column, F.row_number().over(best).alias("_n")).where(F.col("_n") <= keep)
        return ranked.groupBy("query").agg(F.when(F.count("*") == keep, F.min(column)).alias("least"))

    reached = F.col("least").isNull() | (F.col("high") >= F.col("least"))
    certain = found.join(kth(found, "low"), "query").where(reached).drop("least")
    lead = Window.partitionBy("query").orderBy(F.col("high").desc(), "vec_id")
    certain = staged(certain.withColumn("place", F.row_number().over(lead)), "vector-bounds")
    first_read = staged(_read(certain.where(F.col("place") <= keep), searched, exact), "vector-first")
    rest = certain.where(F.col("place") > keep).join(kth(first_read, "score"), "query").where(reached)
    scored = first_read.unionByName(_read(rest, searched, exact))
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    scored = scored.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= keep).drop("_n")
    answers = (asked.select("query_id", "query").join(scored, "query").where("vec_id <> query_id")
               .withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))))
    return answers.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
