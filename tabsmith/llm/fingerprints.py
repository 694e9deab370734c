"""MinHash fingerprints of whole texts, and near duplicates by their bands.

A signature holds the minima of universal hash functions over a text's word
shingles, computed in numpy. Its fingerprint keeps one byte of each minimum, as
hex; the share of equal bytes, less what chance makes equal, is the likeness of
two fingerprints. :func:`near_groups` joins signature bands in Spark and
verifies the Jaccard similarity on full sets (see :mod:`tabsmith.llm.links`).

:func:`edited_fingerprints` also fingerprints each document's edited text, for
which it needs the next document by id. One range shuffle puts the documents in
order; a task works through its range with one document of look-ahead, and the
two edge documents of each range (bounded by the number of tasks) are matched
afterwards.

Cases: a null text is empty; an empty text, or one without words, has the
fingerprint of zeros, alike only to another such; fewer words than a shingle
are one shingle; documents without an id come last in order, rows of one id are
ordered by text; a single document is its own next one; an empty table gives no
rows. Extra input columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tabsmith.llm.common import staged
from tabsmith.llm.links import NearRule, grouped, shingles, universal_minima

PERMUTATIONS = 128
SHINGLE_WORDS = 5
SEED = 29
ROWS_PER_BATCH = 1024
KIND_ROW, KIND_FIRST, KIND_LAST = 0, 1, 2


@dataclass(frozen=True)
class MinHash:
    """Signature of minima under universal hash functions, 32 bits of each."""

    bands: int = 32
    rows: int = 4
    dtype: str = "<u4"

    def registers(self, values: np.ndarray) -> np.ndarray:
        return universal_minima(values, self.bands * self.rows, SEED) >> np.uint64(32)

    def estimate(self, equal: np.ndarray, greater: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
        return equal / (self.bands * self.rows)


def signature(text: str | None) -> np.ndarray:
    """One byte of each minimum; zeros for a text without words."""
    found = shingles(text, SHINGLE_WORDS)
    if not len(found):
        return np.zeros(PERMUTATIONS, dtype=np.uint8)
    return (universal_minima(found, PERMUTATIONS, SEED) >> np.uint64(20)).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated similarity of two signatures, 0 to 1."""
    if not a.any() or not b.any():
        return float(not a.any() and not b.any())
    equal = float((a == b).mean())
    return max(0.0, (equal - 1 / 256) / (1 - 1 / 256))


def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by as much of the beginning of the following one."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def _result(doc_id, text: str, own: np.ndarray, following: str, next_signature: np.ndarray) -> tuple:
    changed = edited(text, following)
    edited_signature = signature(changed)
    return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(), own.tobytes().hex(),
            edited_signature.tobytes().hex(), likeness(own, edited_signature), likeness(own, next_signature))


RESULT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
RESULT_TYPES = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
RESULT_NAMES = tuple(part.split()[0] for part in RESULT.split(", "))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    id_field = rows.schema["doc_id"]
    id_type = to_arrow_type(id_field.dataType)
    names = ("kind", "part", "text", "doc_id", *RESULT_NAMES)
    arrow = pa.schema(list(zip(names, (pa.int32(), pa.int32(), pa.string(), id_type, *RESULT_TYPES), strict=True)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        empty = (None,) * len(RESULT_NAMES)
        out: list[tuple] = []
        before = None
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = signature(text)
                if before is None:
                    out.append((KIND_FIRST, part, text, doc_id, *empty))
                else:
                    out.append((KIND_ROW, part, None, *_result(*before, text, own)))
                before = (doc_id, text, own)
                if len(out) >= ROWS_PER_BATCH:
                    yield _batch(out, arrow)
                    out = []
        if before is not None:
            out.append((KIND_LAST, part, before[1], before[0], *empty))
        if out:
            yield _batch(out, arrow)

    order = (F.col("doc_id").asc_nulls_last(), F.col("text"))
    ranges = rows.repartitionByRange(order[0]).sortWithinPartitions(*order)
    schema = f"kind int, part int, text string, doc_id {id_field.dataType.simpleString()}, {RESULT}"
    done = staged(ranges.mapInArrow(work, schema), "fingerprints")
    firsts = done.where(F.col("kind") == KIND_FIRST).select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    parts = done.where(F.col("kind") == KIND_FIRST).select("part")
    ring = Window.orderBy("part")  # one row per task
    parts = parts.select("part", F.coalesce(F.lead("part").over(ring), F.min("part").over(Window.partitionBy())).alias("next_part"))
    lasts = done.where(F.col("kind") == KIND_LAST).select("part", "doc_id", "text").join(parts, "part").join(firsts, "next_part")

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edge_schema = pa.schema(list(zip(("doc_id", *RESULT_NAMES), (id_type, *RESULT_TYPES), strict=True)))
        for batch in batches:
            found = [_result(i, t, signature(t), f, signature(f)) for i, t, f in
                     zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")), strict=True)]
            yield _batch(found, edge_schema)

    at_edges = lasts.select("doc_id", "text", "following").mapInArrow(edges, f"doc_id {id_field.dataType.simpleString()}, {RESULT}")
    return done.where(F.col("kind") == KIND_ROW).select("doc_id", *RESULT_NAMES).unionByName(at_edges)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def near_groups(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept; bands joined, similarity verified."""
    return grouped(docs.select("doc_id", "text"), NearRule(MinHash(), words, percent))
