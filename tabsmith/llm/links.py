"""Near-duplicate links between documents from banded sketches, and their components.

Shared by the near-duplicate operators; each brings its own sketch of a
shingle set and its own similarity estimate from two sketches.

Documents with equal shingle sets form a class, and classes are what is linked.
Classes that agree on all registers of a band share a bucket:

1. In every bucket the members are paired with its ``CENTRES`` densest members
   (those in the fullest buckets), in a small bucket with all. Pairs whose
   estimate reaches the threshold less a margin of ``SIGMAS`` standard errors
   are verified on full sets. This is linear in the bucket.
2. What is linked so far forms components. Where a bucket still holds several,
   its members outside its main component are compared with all of that
   component and with each other, in blocks: the estimate of every pair first,
   then the full sets in the order of the estimates, until a document is
   linked. So no pair that shares a bucket goes unseen, while links within one
   component, which could not change it, are not enumerated.

Large buckets are split over tasks by block; a task holds two blocks. Nothing
per document comes to the driver. Components come from alternating star
contraction, whose rounds grow with the logarithm of the graph, written to the
shared folder round by round.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import staged
from tabsmith.session import remove_stage
from tabsmith.sources.files import collected_stages

CENTRES = 4            # densest members that everyone in a bucket is paired with
SMALL_BUCKET = 8       # up to this size all pairs are formed
SIGMAS = 4.0           # margin of the estimate below the threshold, in standard errors
AGREEMENT_SLACK = 0.1  # of equal registers below the least estimate, for the estimate to be computed at all
OPEN_BLOCK = 512       # documents outside the main component, in one task
ALL_BLOCK = 2048       # documents they are compared with, in one task
WORD_CACHE = 200_000   # word hashes kept by a worker process
BROADCAST_IDS = 1_000_000  # ids of documents whose sets are wanted are broadcast up to this number (some 30 MB), else joined


class Sketch(Protocol):
    """A fixed number of registers per shingle set, in bands."""

    bands: int
    rows: int
    dtype: str

    def registers(self, shingles: np.ndarray) -> np.ndarray: ...

    def estimate(self, equal: np.ndarray, greater: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray: ...


@dataclass(frozen=True)
class NearRule:
    """Documents are linked from ``percent`` % Jaccard similarity of their ``words``-word shingles."""

    sketch: Sketch
    words: int = 5
    percent: int = 80

    @property
    def least_estimate(self) -> float:
        level = self.percent / 100
        return level - SIGMAS * float(np.sqrt(level * (1 - level) / (self.sketch.bands * self.sketch.rows)))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > WORD_CACHE:
            self.clear()
        self[word] = number = xxhash.xxh3_64_intdigest(word)
        return number


_hashes = _WordHashes()


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; fewer words are one shingle, none an empty set."""
    words = words_of(text)
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
    number = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    n = len(words) - k + 1
    mixed = number[:n].copy()
    for j in range(1, k):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + number[j:n + j]
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return np.unique(mixed ^ (mixed >> np.uint64(31)))


def universal_minima(values: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Minima of ``values`` under ``count`` universal hash functions, in slices of bounded size."""
    random = np.random.default_rng(seed)
    factor = random.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = random.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2)
    least = np.full(count, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(values), 2048):
        block = factor[:, None] * values[None, start:start + 2048] + shift[:, None]
        np.minimum(least, block.min(axis=1), out=least)
    return least


def sketched_rows(docs: DataFrame, rule: NearRule, *also: str) -> DataFrame:
    """(doc_id, n, node, registers) and the columns ``also``: ``node`` names the shingle set, null for an empty one."""
    sketch, words = rule.sketch, rule.words

    @F.pandas_udf("n long, node binary, registers binary")
    def summary(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            found = shingles(text, words)
            if len(found):
                out.append((len(found), xxhash.xxh3_128_digest(found.tobytes()), sketch.registers(found).astype(sketch.dtype).tobytes()))
            else:
                out.append((0, None, None))
        return pd.DataFrame(out, columns=["n", "node", "registers"])

    return docs.select("doc_id", *also, summary("text").alias("s")).select("doc_id", *also, "s.*")


def _estimated(pairs: DataFrame, rule: NearRule) -> DataFrame:
    """Pairs (a, b, n_a, n_b, r_a, r_b) that may reach the threshold."""
    sketch = rule.sketch

    @F.pandas_udf("double")
    def estimate(r_a: pd.Series, r_b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
        if not len(r_a):
            return pd.Series(dtype="float64")
        a, b = _registers(r_a, sketch), _registers(r_b, sketch)
        return pd.Series(sketch.estimate((a == b).sum(axis=1), (a > b).sum(axis=1), (a < b).sum(axis=1), n_a.to_numpy(), n_b.to_numpy()))

    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * rule.percent
    return pairs.where(sizes).where(estimate("r_a", "r_b", "n_a", "n_b") >= rule.least_estimate).select("a", "b")


def _registers(column: pd.Series, sketch: Sketch) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=sketch.dtype).reshape(len(column), -1)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""
    side = lambda name: sets.select(F.col("node").alias(name), F.col("set").alias(f"set_{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.select("a", "b", F.size("set_a").alias("n_a"), F.size("set_b").alias("n_b"),
                       F.size(F.array_intersect("set_a", "set_b")).alias("common"))
    return both.where(F.col("common").cast("long") * 100 >= percent * (F.col("n_a") + F.col("n_b") - F.col("common")).cast("long")).select("a", "b")


def _compare(rule: NearRule):
    """Function of two blocks of rows (node, root, registers, set): links between different roots."""
    sketch, percent, least = rule.sketch, rule.percent, rule.least_estimate

    def links(key: tuple, open_rows: pd.DataFrame, all_rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[bytes, bytes]] = []
        if len(open_rows) and len(all_rows):
            a, b = _registers(open_rows["registers"], sketch), _registers(all_rows["registers"], sketch)
            sets_a, sets_b = [np.asarray(s) for s in open_rows["set"]], [np.asarray(s) for s in all_rows["set"]]
            n_b = np.array([len(s) for s in sets_b])
            nodes_a, nodes_b = open_rows["node"].tolist(), all_rows["node"].tolist()
            roots_b = all_rows["root"].tolist()
            leader: dict = {}
            for i, (node, root) in enumerate(zip(nodes_a, open_rows["root"], strict=True)):
                equal = (b == a[i]).sum(axis=1)
                n_a = len(sets_a[i])
                may = equal >= (least - AGREEMENT_SLACK) * b.shape[1]
                rows = np.nonzero(may & (np.minimum(n_a, n_b) * 100 >= np.maximum(n_a, n_b) * percent))[0]
                near = sketch.estimate(equal[rows], (a[i] > b[rows]).sum(axis=1), (a[i] < b[rows]).sum(axis=1), np.full(len(rows), n_a), n_b[rows])
                for j in rows[np.argsort(-near, kind="stable")][: int((near >= least).sum())]:
                    x, y = _lead(leader, root), _lead(leader, roots_b[j])
                    if x != y:
                        common = len(np.intersect1d(sets_a[i], sets_b[j], assume_unique=True))
                        if common * 100 >= percent * (n_a + len(sets_b[j]) - common):
                            leader[max(x, y)] = min(x, y)
                            out.append((node, nodes_b[j]))
        return pd.DataFrame(out, columns=["a", "b"])

    return links


def _lead(leader: dict, root: bytes) -> bytes:
    while root in leader:
        root = leader[root]
    return root


def near_links(docs: DataFrame, rule: NearRule) -> tuple[DataFrame, DataFrame]:
    """(sketches per document, links between classes): (doc_id, n, node, registers) and (a, b)."""
    sketch = rule.sketch
    sketched = staged(sketched_rows(docs, rule), "near-sketches")
    classes = staged(sketched.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
                                                                F.first("registers").alias("registers")), "near-classes")
    width = sketch.rows * np.dtype(sketch.dtype).itemsize
    key = F.transform(F.sequence(F.lit(0), F.lit(sketch.bands - 1)), lambda i: F.xxhash64(i, F.substring("registers", i * width + 1, F.lit(width))))
    bands = classes.select("node", F.explode(F.array_distinct(key)).alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = staged(bands.join(shared, "key"), "near-members")
    density = members.groupBy("node").agg(F.sum("size").alias("density"))
    by_density = Window.partitionBy("key").orderBy(F.col("density").desc(), "node")
    centres = (members.join(density, "node").withColumn("place", F.row_number().over(by_density)).where(F.col("place") <= SMALL_BUCKET)
               .where((F.col("place") <= CENTRES) | (F.col("size") <= SMALL_BUCKET)).select("key", F.col("node").alias("centre")))
    pairs = (members.select("key", "node").join(centres, "key").where("node <> centre")
             .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct())
    side = lambda x: classes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}"))
    pairs = staged(_estimated(pairs.join(side("a"), "a").join(side("b"), "b"), rule), "near-pairs")
    compared = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(members.where(F.col("size") > SMALL_BUCKET).select("node"))
    sets = staged(_full_sets(docs, classes.join(compared.distinct(), "node", "left_semi"), rule), "near-sets")
    links = staged(_verified(pairs, sets, rule.percent), "near-links")
    rest = staged(_rest_links(members, classes, sets, components(links), rule), "near-rest")
    return sketched, links.unionByName(rest)


def _full_sets(docs: DataFrame, classes: DataFrame, rule: NearRule) -> DataFrame:
    """(node, set) of the classes, from the text of one document of each."""
    words = rule.words

    @F.pandas_udf("node binary, set array<long>")
    def full(texts: pd.Series) -> pd.DataFrame:
        found = [shingles(t, words) for t in texts]
        return pd.DataFrame({"node": [xxhash.xxh3_128_digest(s.tobytes()) for s in found], "set": [s.view(np.int64) for s in found]})

    # Filters on a function that counts as deterministic would be pushed below the join, and it would run on all documents.
    full = full.asNondeterministic()
    wanted = staged(classes.select(F.col("doc_id").alias("_id"), F.col("node").alias("_node")), "near-wanted")
    ids = wanted.select("_id").distinct()
    if wanted.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    found = texts.select(full("text").alias("f")).select("f.*").join(wanted.select(F.col("_node").alias("node")), "node")
    return found.groupBy("node").agg(F.first("set").alias("set"))


def _rest_links(members: DataFrame, classes: DataFrame, sets: DataFrame, found: DataFrame, rule: NearRule) -> DataFrame:
    """Links between the components that still share a bucket in which not all pairs were formed."""
    nodes = members.select("node").distinct().join(found, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    nodes = staged(nodes, "near-roots")
    rooted = members.where(F.col("size") > SMALL_BUCKET).select("key", "node").join(nodes, "node")
    counts = rooted.groupBy("key", "root").agg(F.count("*").alias("n"))
    home = counts.groupBy("key").agg(F.max(F.struct("n", "root")).alias("main"), F.count("*").alias("roots")).where("roots > 1")
    open_rows = (rooted.join(home.select("key", F.col("main.root").alias("home")), "key").where("root <> home")
                 .select("home", "node", "root").distinct())
    open_rows = staged(open_rows, "near-open")
    homes = open_rows.groupBy("home").agg(F.countDistinct("node").alias("n_open"))
    main_rows = nodes.join(homes.select("home"), F.col("root") == F.col("home")).select("home", "node", "root")
    all_rows = main_rows.unionByName(open_rows)
    counted = all_rows.groupBy("home").agg(F.count("*").alias("n_all")).join(homes, "home")
    blocks = counted.select("home", F.ceil(F.col("n_open") / OPEN_BLOCK).alias("n_i"), F.ceil(F.col("n_all") / ALL_BLOCK).alias("n_j"))
    payload = classes.select("node", "registers").join(sets, "node")

    def dealt(rows: DataFrame, own: str, n_own: str, other: str, n_other: str) -> DataFrame:
        rows = rows.join(blocks, "home").join(payload, "node")
        rows = rows.select("home", "node", "root", "registers", "set", F.pmod(F.xxhash64("node"), F.col(n_own)).alias(own),
                           F.explode(F.expr(f"sequence(0L, {n_other} - 1L)")).alias(other))
        return rows.toDF(*rows.columns)  # columns of its own, as both sides come from the same tables

    left = dealt(open_rows, "i", "n_i", "j", "n_j").groupBy("home", "i", "j")
    right = dealt(all_rows, "j", "n_j", "i", "n_i").groupBy("home", "i", "j")
    return left.cogroup(right).applyInPandas(_compare(rule), "a binary, b binary").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b); the root is the least node that it is connected to."""
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = staged(_star(_star(edges, large=True), large=False), "edges")
        after = _state(edges)
        if after == state:
            break
        state = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u > v) reconnected to the least neighbour: of the larger neighbours, or of the smaller ones."""
    around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    pulled = around.join(least, "u")
    if large:
        new = pulled.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        new = pulled.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return new.where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a sum of their hashes: equal only if nothing moved."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def rooted_rows(docs: DataFrame, rule: NearRule) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, node (null for an empty set) and root, written; what led to them is removed."""
    with collected_stages() as paths:
        sketched, links = near_links(docs, rule)
        roots = components(links)
        rows = sketched.join(roots, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), "node", F.coalesce("root", "node").alias("root"))
        rows = staged(rows, "near-rooted")
    for path in paths[:-1]:
        remove_stage(docs.sparkSession, path)
    return rows


def grouped(docs: DataFrame, rule: NearRule) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (least doc_id reachable) and kept."""
    rooted = rooted_rows(docs, rule)
    least = rooted.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("least"))
    out = rooted.join(least, "root", "left")
    component = F.coalesce("least", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
