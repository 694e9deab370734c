"""Merkle manifest of a table: leaves, subroots by group, one root, a proof for every row.

A leaf is H (sha256, lowercase hex) of a row's fields, each as its UTF-8 byte
count, ``:`` and its value, or ``-`` where it is null. Per group (``lang``) the
leaves ascend by id; while several nodes remain, every ``FAN`` consecutive ones
become H of their texts, the last run as it is, even with one node. The
subroots, ordered by group, give the root likewise.

Cogrouped subtree exchange. A superblock is ``FAN ** DEPTH`` consecutive nodes
of a group, so a bounded group of rows.

1. Leaves are hashed in the scan; only digests are written and shuffled. Places
   come from a range sort by (group, id), the counts of each range and their
   prefix sums, so no task holds a hot group.
2. Going up, each superblock is reduced to one node, and the nodes are the next
   tier's leaves: four levels a tier, until every group has one node. The
   subroots are one more group of that kind.
3. Going down, a tier's nodes are cogrouped by superblock with the outer nodes
   that this superblock needs (its siblings level by level up to the root, the
   same for all its members), in one ``applyInPandas``: it finishes the local
   reduction, joins local and outer siblings to the proof and folds a leaf with
   them to the root.

Tampering (:func:`manifest`) replaces rows that a rule picks by rows with
changed fields: their leaf is recomputed and folded with the siblings of the
untouched tree.

Cases: null fields and null ids are ``-`` (null ids come first); a null group is
a group, before all others; groups are ordered bytewise; rows that share an id
are ordered by their leaf, equal rows keep as many leaves; a group of one row has its leaf
as subroot, a table of one row as root, and an empty proof (H of nothing);
texts of any length are hashed whole; an empty table gives no rows. Input
columns that are not fields are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import staged

FAN = 8
DEPTH = 4


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def framed(column: Column) -> Column:
    """One field as leaf input: byte count, colon, value; ``-`` for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[framed(f) for f in fields]), 256)


def _group_key(column: Column) -> Column:
    """A group as text whose bytewise order puts null first."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("-"))


def levels_of(n: int) -> int:
    """Levels of the tree over n nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def run_parents(nodes: list[str]) -> list[str]:
    return [digest("".join(nodes[i:i + FAN])) for i in range(0, len(nodes), FAN)]


def local_levels(nodes: list[str], depth: int) -> list[list[str]]:
    """The nodes of a superblock and ``depth`` levels above them."""
    out = [nodes]
    for _ in range(depth):
        out.append(run_parents(out[-1]))
    return out


def siblings(levels: list[list[str]], place: int, depth: int) -> list[tuple[str, str]]:
    """(nodes before, nodes after) in the run of the node at ``place``, level by level."""
    found = []
    for level in range(depth):
        start = place - place % FAN
        run = levels[level][start:start + FAN]
        found.append(("".join(run[:place - start]), "".join(run[place - start + 1:])))
        place //= FAN
    return found


def fold(node: str, path: Sequence[tuple[str, str]]) -> str:
    """The root that a node gives with its siblings."""
    return reduce(lambda x, around: digest(around[0] + x + around[1]), path, node)


def proof_digest(path: Sequence[tuple[str, str]]) -> str:
    return digest("".join(before + after for before, after in path))


def _placed(nodes: DataFrame, order: list[str], name: str) -> DataFrame:
    """``nodes`` with ``place``, the 0-based rank within ``tree`` by ``order``, and ``size``, the tree's node count.

    One range sort; the row numbers of a range count from the number of nodes
    of the tree in earlier ranges. Only one row per (range, tree) is ordered
    in a window.
    """
    ranged = staged(nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
                    .withColumn("row", F.monotonically_increasing_id()), name)
    part = F.shiftright("row", 33)
    counts = ranged.groupBy("tree", part.alias("part")).agg(F.min("row").alias("first"), F.count("*").alias("n"))
    # A tree's ranges are consecutive, and in one range its rows are: the window sorts ranges, not rows.
    by_tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(by_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col("tree").alias("t"), F.col("part").alias("p"), (before - F.col("first")).alias("shift"),
                           F.sum("n").over(by_tree).alias("size"))
    return ranged.join(starts, (F.col("tree") == F.col("t")) & (part == F.col("p"))).select(
        "tree", *[c for c in nodes.columns if c != "tree"], (F.col("row") + F.col("shift")).alias("place"), "size")


PATH = "array<struct<before:string,after:string>>"
OUTER = f"tree string, block long, path {PATH}, subroot string, root string"


@dataclass(frozen=True)
class Exchange:
    """Trees cut into superblocks of ``FAN ** depth`` nodes."""

    depth: int = DEPTH

    @property
    def superblock(self) -> int:
        return FAN ** self.depth

    def block(self) -> Column:
        return F.expr(f"place div {self.superblock}")

    def reduced(self, nodes: DataFrame) -> DataFrame:
        """One node per superblock of (tree, place, size, node)."""

        def up(rows: pd.DataFrame) -> pd.DataFrame:
            size = int(rows["size"].iloc[0])
            (top,) = local_levels(rows.sort_values("place")["node"].tolist(), min(self.depth, levels_of(size)))[-1]
            return pd.DataFrame({"tree": [rows["tree"].iloc[0]], "node": [top], "place": [int(rows["place"].iloc[0]) // self.superblock],
                                 "size": [-(-size // self.superblock)]})

        blocks = nodes.select("tree", "place", "size", "node", self.block().alias("block")).groupBy("tree", "block")
        return blocks.applyInPandas(up, "tree string, node string, place long, size long")

    def tiers(self, nodes: DataFrame, name: str) -> list[DataFrame]:
        """``nodes`` and what each reduction by superblocks leaves, until every tree has one node.

        The number of reductions follows from the largest tree's size, the only
        value that the driver reads.
        """
        tiers = [staged(nodes, name)]
        largest = tiers[0].agg(F.max("size")).first()[0] or 0
        while largest > 1:
            tiers.append(staged(self.reduced(tiers[-1]), f"{name}-tier"))
            largest = -(-largest // self.superblock)
        return tiers

    def paths(self, rows: pd.DataFrame, outer: pd.DataFrame) -> tuple[pd.DataFrame, list[list[tuple[str, str]]]]:
        """A superblock's rows by place and the siblings of each, local ones first, then those of the superblock."""
        rows = rows.sort_values("place")
        depth = min(self.depth, levels_of(int(rows["size"].iloc[0])))
        levels = local_levels(rows["node"].tolist(), depth)
        above = [(p["before"], p["after"]) for p in outer["path"].iloc[0]]
        return rows, [siblings(levels, int(place) % self.superblock, depth) + above for place in rows["place"]]

    def handed_down(self, nodes: DataFrame, outer: DataFrame) -> DataFrame:
        """What the superblocks below a tier's nodes need: each node's siblings up to the root.

        A node stands for block ``down_block`` of the tree ``down``; where that
        is another tree than its own, the node is that tree's subroot.
        """

        def down(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
            rows, paths = self.paths(rows, outer)
            subroot = outer["subroot"].iloc[0]
            return pd.DataFrame({
                "tree": rows["down"].tolist(), "block": rows["down_block"].tolist(),
                "path": [[{"before": a, "after": b} for a, b in path] for path in paths],
                "subroot": [node if tree != below else subroot
                            for node, tree, below in zip(rows["node"], rows["tree"], rows["down"], strict=True)],
                "root": outer["root"].iloc[0]})

        return self.cogrouped(nodes, outer).applyInPandas(down, OUTER)

    def proved(self, leaves: DataFrame, outer: DataFrame) -> DataFrame:
        """The manifest rows: local reduction, proof joining and folding of a superblock in one pass."""

        def prove(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
            rows, paths = self.paths(rows, outer)
            root = outer["root"].iloc[0]
            folded = [fold(node if own is None else own, path)
                      for node, own, path in zip(rows["node"], rows["tampered"], paths, strict=True)]
            return pd.DataFrame({
                "doc_id": rows["doc_id"].to_numpy(), "leaf": rows["node"].tolist(), "subroot": outer["subroot"].iloc[0], "root": root,
                "proof_sha256": [proof_digest(p) for p in paths], "folded_root": folded, "verified": [f == root for f in folded]})

        id_type = leaves.schema["doc_id"].dataType.simpleString()
        return self.cogrouped(leaves, outer).applyInPandas(
            prove, f"doc_id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")

    def cogrouped(self, nodes: DataFrame, outer: DataFrame):
        """Nodes and outer nodes by superblock."""
        return nodes.withColumn("block", self.block()).groupBy("tree", "block").cogroup(outer.groupBy("tree", "block"))


def prove(leaves: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Manifest rows of (tree, doc_id, node, tampered): ``tampered`` is the leaf to fold, null for the node itself.

    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.
    """
    exchange = Exchange(depth)
    tiers = exchange.tiers(_placed(leaves, ["doc_id", "node"], "merkle-places"), "merkle-leaves")
    subroots = tiers[-1].select(F.lit("").alias("tree"), "node", F.col("tree").alias("down"), F.lit(0).cast("long").alias("down_block"))
    # The subroots are the leaves of one more tree; its name is no group's key.
    tops = exchange.tiers(_placed(subroots, ["down"], "merkle-subroots"), "merkle-top")
    outer = staged(tops[-1].select("tree", F.lit(0).cast("long").alias("block"), F.array().cast(PATH).alias("path"),
                                   F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root")), "merkle-root")
    for tier in [*reversed(tops[1:-1]), tops[0], *reversed(tiers[1:-1])]:
        if "down" not in tier.columns:
            tier = tier.withColumns({"down": F.col("tree"), "down_block": F.col("place")})
        outer = staged(exchange.handed_down(tier, outer), "merkle-outer")
    return exchange.proved(tiers[0], outer)


def manifest(docs: DataFrame, fields: Sequence[str], group: str, tampered: Column, changes: dict[str, Column]) -> DataFrame:
    """Manifest of ``docs`` over ``fields``, grouped by ``group``.

    Rows where ``tampered`` holds are folded with the leaf that they have after
    ``changes`` (field -> changed value); the others with their own.
    """
    own = leaf_hash([F.col(f) for f in fields])
    changed = leaf_hash([changes.get(f, F.col(f)) for f in fields])
    leaves = docs.select(_group_key(F.col(group)).alias("tree"), "doc_id", own.alias("node"), F.when(tampered, changed).alias("tampered"))
    return prove(staged(leaves, "merkle-hashes"))
