"""Vector search, mixing and packing against brute force, with every odd row."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsmith.llm import mixing, packing, token_rollup, tokens, vector_search
from tabsmith.llm.queries import PACK_TOKENIZER, tokenizer_path

from .conftest import CLASHING, docs_of

VECTORS = "vec_id long, embedding array<float>, label int, rank int, score long"


def brute_force(rows, every, k):
    usable = {}
    for vec_id, e in rows:
        if vec_id is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            usable.setdefault(vec_id, [math.floor(256 * float(np.float32(x))) for x in e])
    out = set()
    for q in usable:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q)
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("n, dims", [(0, 4), (1, 4), (3, 4), (180, 6)])
def test_search_equals_brute_force(spark, n, dims):
    random = np.random.default_rng(n)
    rows = [(i, [float(x) for x in random.normal(0, 0.4, dims)]) for i in range(n)]
    if n > 100:
        rows[30:75] = [(i, rows[20][1]) for i in range(30, 75)]      # a group of equal vectors, ties throughout
        rows += [(200, None), (201, [1.0, None]), (202, [float("nan")] * dims), (203, [float("inf")] * dims), (204, []),
                 (205, [0.5]), (None, rows[0][1]), rows[7]]
    df = spark.createDataFrame([(i, e, 0, 1, 2) for i, e in rows], VECTORS)
    found = vector_search.search(vector_search.quantised(df), F.col("vec_id") % 5 == 0, 5)
    assert {tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()} == brute_force(rows, 5, 5)


def test_wide_components_take_part(spark, monkeypatch):
    """Components whose scores pass a long: ranked by their true values, given as the nearest long."""
    monkeypatch.setattr(vector_search, "WIDE_BLOCK", 16)
    random = np.random.default_rng(1)
    rows = [(i, [float(x) for x in random.normal(0, 0.4, 3)]) for i in range(60)]
    rows[10:18] = [(10, [3e7, 1.0, 0.0]), (11, [1e20, 0.25, -1e20]), (12, [1e20, 0.25, -1e20]), (13, [-3e7]), (14, [1e38, 1e38, 1e38]),
                   (15, [1e38, 1e38, 1e38]), (16, [float("inf"), 0.0, 0.0]), (17, [16777217.0, 0.1, 0.2])]
    df = spark.createDataFrame([(i, e, 0, 1, 2) for i, e in rows], VECTORS)
    found = vector_search.search(vector_search.quantised(df), F.col("vec_id") % 5 == 0, 5).select("query_id", "rank", "vec_id", "score").collect()
    low, high = vector_search.LONGS
    assert {tuple(r) for r in found} == {(q, n, i, min(max(s, low), high)) for q, n, i, s in brute_force(rows, 5, 5)}
    assert {(0, 1), (5, 1)} <= {(r["query_id"], r["rank"]) for r in found} and any(r["score"] == high for r in found)


def test_bounds_hold(spark):
    random = np.random.default_rng(3)
    v = random.integers(-200, 200, (300, 8))
    lo, hi = v.min(axis=0), v.max(axis=0)
    import pandas as pd

    width = vector_search.cell_width(lo, hi, 4)
    block = pd.DataFrame({"vec_id": range(300), "cells": [c.tobytes() for c in ((v - lo) // width).astype(np.uint8)]})
    queries = pd.DataFrame({"query": range(20), "v": list(v[:20])})
    out = vector_search._candidates(lo, hi, 4, 6)(queries, block)
    exact = v[:20] @ v.T
    for row in out.itertuples():
        assert row.low <= exact[row.query, row.vec_id] <= row.high
    for q in range(20):  # the true best are among the candidates
        assert set(np.argsort(-exact[q], kind="stable")[:6]) <= set(out[out["query"] == q]["vec_id"])


def reshared(sizes, weights, most):
    """Targets by resharing the excess again and again."""
    target, capped = {}, {s for s in sizes if not sizes[s]}
    target.update(dict.fromkeys(capped, 0.0))
    while True:
        spare = sum(sizes.values()) - sum(target[s] for s in capped)
        left = sum(weights[s] for s in sizes if s not in capped)
        for s in sizes:
            if s not in capped:
                target[s] = spare * weights[s] / left
        over = {s for s in sizes if s not in capped and target[s] > most * sizes[s]}
        if not over:
            return target
        for s in over:
            target[s] = float(most * sizes[s])
        capped |= over


def test_mix_targets_and_copies(spark):
    texts = [("w " * (1 + 7 * i % 40)).strip() for i in range(600)] + [None, "", "  ", "a\u00a0b \x0b c"]
    df = docs_of(spark, texts, CLASHING)
    df = df.withColumn("source", F.when(F.col("doc_id") < 300, "hot").when(F.col("doc_id") < 306, "tiny")
                       .when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("s"), F.col("doc_id") % 5)))
    rows = mixing.mix_sizes(df.unionByName(df.where("doc_id = 10"))).collect()
    assert len(rows) == 605
    assert {r["doc_id"]: r["size"] for r in rows}[603] == 2
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = reshared(sizes, {s: 1 + i % 3 for i, s in enumerate(order)}, 3)
    for s in order:
        own = [r for r in rows if r["source"] == s]
        assert own[0]["source_size"] == sizes[s] and own[0]["target"] == pytest.approx(want[s])
        assert all(r["taken"] <= 3 * r["size"] for r in own)
        rate = want[s] / sizes[s] if sizes[s] else 0
        assert all(r["copies"] in (math.floor(rate), math.ceil(rate)) for r in own)
        assert abs(sum(r["taken"] for r in own) - want[s]) <= max(40, 0.02 * want[s])
    again = mixing.mix_sizes(df.unionByName(df.where("doc_id = 10"))).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_mixed_documents_keep_their_columns(spark):
    df = docs_of(spark, ["a b c", "d e", None, "f", "a b c"], CLASHING)
    mixed = mixing.mix_documents(df)
    assert mixed.columns == df.columns
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix_sizes(df).collect()}
    got = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in taken.items() if v}
    assert mixing.mix_sizes(df.limit(0)).count() == 0 and mixing.mix_documents(df.limit(0)).count() == 0


def test_ids_equal_the_tokenizers_library(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["", " ", "  a  b", "x\n \ny\t", "<|endoftext|> a <|endoftext|>", "don't 's 'S", "\u4e2d\u6587 \U0001f600e\u0301", "\u00a0\u2003z", "a" * 3000]
    for text in texts:
        assert tokens.encode(path, text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_packing_round_trip(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    texts = ["one two three", "one two three", None, "", "word " * 5000, "x " * 2047, " ".join(map(str, range(1500))), "y" * 40] + [f"t{i} " * (i % 90) for i in range(300)]
    df = docs_of(spark, texts, CLASHING)
    out = packing.pack(df.unionByName(df.where("doc_id = 0")), path, with_ids=True).collect()
    ids = {i: tokens.encode(path, t).tolist() + [0] for i, t in enumerate(texts)}
    by_doc, by_sequence = {}, {}
    for r in out:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) and r["length"] == len(r["ids"])
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, want in ids.items():
        rows = sorted(by_doc[i], key=lambda r: r["piece"])
        for copy in range(2 if i == 0 else 1):
            own = rows[copy::2] if i == 0 else rows
            assert [x for r in own for x in r["ids"]] == want
            assert [r["start"] for r in own] == [0, *np.cumsum([len(r["ids"]) for r in own])[:-1].tolist()]
            assert all(r["length"] == 2048 for r in own[1:]) and (len(want) > 2048 or len(own) == 1)
    for rows in by_sequence.values():
        end = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == end
            end += r["length"]
        assert end <= 2048
    total = sum(r["length"] for r in out)
    assert len(by_sequence) <= -(-total // 2048) + 1
    assert packing.pack(df.limit(0), path).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_every_piece_once(seed):
    random = np.random.default_rng(seed)
    counts = np.zeros(257, dtype=np.int64)
    for length in random.integers(1, 257, 80 + 400 * seed):
        counts[length] += random.integers(1, 2 + 30 * seed)
    plan = packing.plan_sequences(counts, 256)
    used = np.zeros_like(counts)
    for lengths, number in plan:
        assert sum(lengths) <= 256 and number > 0
        for length in lengths:
            used[length] += number
    assert (used == counts).all()
    simple = sum(n for _, n in packing.best_fit(counts, 256))
    assert -(-int(counts @ np.arange(257)) // 256) <= sum(n for _, n in plan) <= simple


def test_knapsack_is_optimal():
    lengths, prices = np.array([3, 5, 7]), np.array([3.1, 5.3, 7.2])
    best, used, pick = packing.knapsack(lengths, prices, 23)
    for room in range(24):
        brute = max(a * 3.1 + b * 5.3 + c * 7.2 for a in range(8) for b in range(5) for c in range(4) if 3 * a + 5 * b + 7 * c <= room)
        assert best[room] == pytest.approx(brute)
    held = [[] for _ in lengths]
    for owner, i in packing.configurations(lengths, used, pick, 23):
        for o, k in zip(owner, i, strict=True):
            held[o].append(k)
    for k, h in enumerate(held):  # the best configuration with each length in it
        assert k in h and lengths[h].sum() <= 23 and prices[h].sum() == pytest.approx(prices[k] + best[23 - lengths[k]])


def fewest(lengths, room):
    """The least number of sequences, by trying all placements."""
    best = len(lengths)

    def put(i, free):
        nonlocal best
        if len(free) >= best:
            return
        if i == len(lengths):
            best = len(free)
            return
        for k in {f: k for k, f in enumerate(free) if f >= lengths[i]}.values():
            put(i + 1, [*free[:k], free[k] - lengths[i], *free[k + 1:]])
        put(i + 1, [*free, room - lengths[i]])

    put(0, [])
    return best


@pytest.mark.parametrize("seed", range(5))
def test_bound_and_plan_around_the_optimum(seed):
    lengths = sorted(np.random.default_rng(seed).integers(8, 60, 9).tolist(), reverse=True)
    counts = np.bincount(lengths, minlength=101)
    least = fewest(lengths, 100)
    assert packing.sequence_bound(counts, 100, rounds=80) <= least <= packing.sequences_of(packing.plan_sequences(counts, 100))


def test_configuration_program_on_lengths_that_best_fit_packs_badly():
    """Lengths around a third of a sequence: the plan stays near the program's bound, best fit doesn't."""
    lengths = np.clip(np.random.default_rng(0).normal(700, 60, 100_000).round().astype(int), 1, 2048)
    counts = np.bincount(lengths, minlength=2049)
    needed, simple = packing.sequences_of(packing.plan_sequences(counts)), packing.sequences_of(packing.best_fit(counts.copy(), 2048))
    assert needed <= 36_334 < simple - 1000
    bound = packing.sequence_bound(counts)
    assert packing.volume_bound(counts, 2048) < bound <= needed <= 1.03 * bound


def test_full_pieces_do_not_change_the_plan_of_the_others():
    """Best fit is held against the bound of the pieces that it packs, however many full ones there are."""
    lengths = np.clip(np.random.default_rng(0).normal(88, 8, 3000).round().astype(int), 1, 255)
    counts = np.bincount(lengths, minlength=257)
    alone = packing.plan_sequences(counts, 256)
    assert packing.sequences_of(alone) < packing.sequences_of(packing.best_fit(counts.copy(), 256))
    counts[256] = 5000
    assert packing.plan_sequences(counts, 256) == [((256,), 5000), *alone]


def test_very_long_white_space(spark):
    """More white space in a row than the pattern engine takes: ids equal those of the tokenizers library."""
    import tokenizers

    path = tokenizer_path(PACK_TOKENIZER)
    library = tokenizers.Tokenizer.from_file(path)
    n = 1_100_000
    for text in (" " * n, "a" + "\n" * n + "b", "x" + " \n\t" * (n // 3) + " y  z"):
        assert tokens.encode(path, text).tolist() == library.encode(text, add_special_tokens=False).ids
    df = docs_of(spark, [" " * n, "short"])
    rows = packing.pack(df, path).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 0) == len(tokens.encode(path, " " * n)) + 1
    assert token_rollup.counted(df, {"bpe": path}).where("doc_id = 0").first()["tokens"] == len(tokens.encode(path, " " * n))
