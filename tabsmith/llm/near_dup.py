"""Near-duplicate groups with SetSketch registers.

A register is the exponentially spaced, truncated minimum of the elements'
hashes: ``min(max(floor(1 - log_b(h)), 0), q + 1)`` with h exponential of rate
a. Registers of a union are the larger ones of both, so sketches merge; two
sets agree on a register with a probability close to their Jaccard similarity.
Bands of registers propose pairs, the joint likelihood of greater, equal and
less registers given both set sizes estimates the similarity, and the full sets
decide (see :mod:`tabsmith.llm.links`).

Cases: a null or empty text, or one without words, has an empty set and is
linked with nothing; fewer words than a shingle are one shingle; rows with
equal sets are linked, repeated rows among them; a null id stands for itself
unless a linked document has one; a component's kept document is the one with
the least id. An empty table gives no rows. Extra input columns are not read
(:func:`deduplicated` passes them on).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import staged
from tabsmith.llm.links import NearRule, grouped, rooted_rows, sketched_rows, universal_minima


@dataclass(frozen=True)
class SetSketch:
    """SetSketch with base ``b``, rate ``a`` and largest value ``q + 1``."""

    bands: int = 24
    rows: int = 4
    dtype: str = "<u2"
    b: float = 1.001
    a: float = 20.0
    q: int = (1 << 16) - 2
    seed: int = 11

    def registers(self, shingles: np.ndarray) -> np.ndarray:
        least = universal_minima(shingles, self.bands * self.rows, self.seed)
        h = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0 ** 64) / self.a
        return np.clip(np.floor(1.0 - np.log(np.maximum(h, 1e-300)) / np.log(self.b)), 0, self.q + 1)

    def merge(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Registers of the union."""
        return np.maximum(one, other)

    def _above(self, x: np.ndarray) -> np.ndarray:
        """Probability that one register exceeds the other, from the share x that only its set has."""
        return -np.log(1.0 - np.clip(x, 1e-12, 1.0) * (self.b - 1.0) / self.b) / np.log(self.b)

    def estimate(self, equal: np.ndarray, greater: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
        """Similarity of greatest joint likelihood, by golden-section search."""
        u = n_a / np.maximum(n_a + n_b, 1)
        v = 1.0 - u

        def likelihood(j: np.ndarray) -> np.ndarray:
            up, down = self._above(u - v * j), self._above(v - u * j)
            return equal * np.log(np.maximum(1.0 - up - down, 1e-12)) + greater * np.log(np.maximum(up, 1e-12)) + less * np.log(np.maximum(down, 1e-12))

        low, high = np.zeros(len(equal)), np.minimum(u / np.maximum(v, 1e-12), v / np.maximum(u, 1e-12))
        ratio = (np.sqrt(5.0) - 1) / 2
        for _ in range(24):
            first, second = high - ratio * (high - low), low + ratio * (high - low)
            left = likelihood(first) > likelihood(second)
            high, low = np.where(left, second, high), np.where(left, low, first)
        return (low + high) / 2


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return grouped(docs.select("doc_id", "text"), NearRule(SetSketch(), words, percent))


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each near-duplicate group, same columns as ``docs``: the least by (doc_id, nulls last; text).

    Rows without words are in no group and all stay. Every row is judged by its
    own text, also where rows share their id or have none. Rows with an id of
    their own, as a rule all, are decided by ids alone, without a second
    pass over the texts in Python or a shuffle of them.
    """
    rule = NearRule(SetSketch(), words, percent)
    rooted = rooted_rows(docs.select("doc_id", "text"), rule)
    least = rooted.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("least"))
    counts = rooted.groupBy("doc_id").agg(F.count("*").alias("rows"))
    shared = staged(counts.where("doc_id is null or rows > 1").select("doc_id"), "near-shared-ids")
    dropped = staged(rooted.join(least, "root").where("doc_id <> least").select("doc_id").distinct(), "near-dropped")
    if shared.isEmpty():
        return docs.join(dropped, "doc_id", "left_anti")
    same_id = docs["doc_id"].eqNullSafe(shared["doc_id"])
    own_id = docs.join(shared, same_id, "left_anti").join(dropped, "doc_id", "left_anti")
    # The others are sketched again, for the component of each row's own text.
    row = F.struct(*docs.columns).alias("row")
    odd = docs.join(shared, same_id, "left_semi").select(F.col("doc_id"), "text", row)
    roots = rooted.where(F.col("node").isNotNull()).select("node", "root").distinct()
    judged = sketched_rows(odd, rule, "row").join(roots, "node", "left").join(least, "root", "left")
    wordless = judged.where("root is null").select("row.*")
    first = F.min_by("row", F.struct("row.text", F.xxhash64(F.to_json("row"))))
    chosen = judged.where("root is not null").where(F.col("doc_id").eqNullSafe(F.col("least"))).groupBy("root").agg(first.alias("row"))
    return own_id.unionByName(wordless).unionByName(chosen.select("row.*"))
