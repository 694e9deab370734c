"""Near duplicates and fingerprints against brute force."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from tabsmith.llm import fingerprints, links, near_dup
from tabsmith.llm.queries import LLM_QUERIES

from .conftest import CLASHING, DOCS, SF, SF_SMALL, docs_of


def shingle_set(text, k):
    words = (text or "").encode().lower().split()
    if len(words) < k:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def brute_groups(rows, k, percent):
    """{doc_id: (set size, least connected id)} by comparing all pairs of distinct sets."""
    sets = {i: shingle_set(t, k) for i, t in rows}
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    root = {i: (first[s] if s else i) for i, s in sets.items()}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    kinds = [(s, i) for s, i in first.items() if s]
    for n, (s, i) in enumerate(kinds):
        for t, j in kinds[:n]:
            if min(len(s), len(t)) * 100 >= percent * max(len(s), len(t)):
                common = len(s & t)
                if 100 * common >= percent * (len(s) + len(t) - common):
                    a, b = find(i), find(j)
                    parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(root[i])) for i in sets}


def copies(random, n_groups, per_group, words=120):
    """Groups of copies of copies with few or many changed words."""
    texts = []
    for g in range(n_groups):
        base = [f"w{random.integers(0, 5000)}" for _ in range(words)]
        family = [base]
        for _ in range(per_group - 1):
            copy = list(family[random.integers(0, len(family))])
            for _ in range(random.integers(0, 4)):
                copy[random.integers(0, words)] = f"z{random.integers(0, 10 ** 6)}"
            family.append(copy)
        texts += [" ".join(f) for f in family]
    return texts


@pytest.mark.parametrize("operator, k, percent", [(near_dup, 3, 85), (fingerprints, 5, 80)])
def test_groups_equal_brute_force(spark, operator, k, percent):
    random = np.random.default_rng(k)
    texts = copies(random, 3, 40) + copies(random, 1, 110, 60)
    texts += [None, "", " \n ", "one two", "ONE  two", "one", "one", "the end of it " * 300, "the end of it " * 300 + "x", "Éa éa b", "éa éa b"]
    df = docs_of(spark, texts, CLASHING)
    df = df.unionByName(df.where("doc_id in (0, 5)"))  # repeated rows
    got = operator.near_groups(df, words=k, percent=percent).collect()
    assert len(got) == len(texts) + 2
    want = brute_groups(list(enumerate(texts)), k, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert operator.near_groups(df.limit(0)).count() == 0


def test_registered_groups_equal_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = LLM_QUERIES["op6_near_duplicates"](spark, SF_SMALL).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_groups(rows, 3, 85)


def test_rest_is_compared_beyond_the_centres(spark, monkeypatch):
    """With one centre per bucket most links must come from the comparison of the rest, in several blocks."""
    monkeypatch.setattr(links, "CENTRES", 1)
    monkeypatch.setattr(links, "SMALL_BUCKET", 2)
    monkeypatch.setattr(links, "OPEN_BLOCK", 7)
    monkeypatch.setattr(links, "ALL_BLOCK", 11)
    texts = copies(np.random.default_rng(8), 2, 70, 60)
    got = near_dup.near_groups(docs_of(spark, texts), words=3, percent=85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_groups(list(enumerate(texts)), 3, 85)


def test_deduplicated_keeps_one_of_each(spark):
    texts = ["a b c d e f g", "a b c d e f g", "other words here now and then", None, None]
    df = docs_of(spark, texts, CLASHING)
    out = near_dup.deduplicated(df.unionByName(df.where("doc_id = 2")))
    assert out.columns == df.columns and sorted(r["doc_id"] for r in out.collect()) == [0, 2, 3, 4]


def test_deduplicated_judges_rows_and_not_ids(spark):
    """Rows that share an id, or have none, are kept and dropped by their own text; each group keeps one row."""
    a, b, c = "alpha beta gamma delta epsilon zeta", "one two three four five six seven", "a text that only rows without an id have here"
    rows = [(1, a), (1, b), (0, a), (None, a), (None, c), (None, c), (None, c + " "), (2, b), (2, b), (5, None), (5, None), (None, ""), (7, "alone")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    kept = sorted(((r["doc_id"], (r["text"] or "").strip()) for r in near_dup.deduplicated(docs).collect()), key=repr)
    assert kept == sorted([(0, a), (1, b), (None, c), (5, ""), (5, ""), (None, ""), (7, "alone")], key=repr)
    only = spark.createDataFrame([(None, a, "en", "s", 1)] * 5, DOCS)
    assert near_dup.deduplicated(only).count() == 1
    assert near_dup.deduplicated(only.limit(0)).count() == 0


def test_full_sets_are_built_for_the_wanted_documents_alone(spark):
    """No filter on the sets is pushed below the join that picks their documents."""
    docs = docs_of(spark, copies(np.random.default_rng(2), 3, 4))
    rule = links.NearRule(near_dup.SetSketch(), 5, 80)
    classes = links.sketched_rows(docs, rule).where("doc_id < 2").select("node", "doc_id")
    plan = links._full_sets(docs.repartition(2), classes, rule)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.index("ArrowEvalPython") < plan.index("LeftSemi")


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(bytes([0, i]), bytes([0, i + 1])) for i in range(60)] + [(b"\x01a", b"\x01b")], "a binary, b binary")
    got = {bytes(r["node"]): bytes(r["root"]) for r in links.components(edges).collect()}
    assert got == {**{bytes([0, i]): b"\x00\x00" for i in range(61)}, b"\x01a": b"\x01a", b"\x01b": b"\x01a"}
    assert links.components(edges.limit(0)).count() == 0


def test_setsketch_estimates_and_merges():
    random = np.random.default_rng(4)
    sketch = near_dup.SetSketch(bands=64, rows=8)
    for share in (0.3, 0.6, 0.85):
        a = random.integers(0, 1 << 63, 900, dtype=np.uint64)
        b = np.concatenate([a[: int(len(a) * share)], random.integers(0, 1 << 63, 300, dtype=np.uint64)])
        ra, rb = sketch.registers(a), sketch.registers(b)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        one = lambda x: np.array([x])
        got = sketch.estimate(one((ra == rb).sum()), one((ra > rb).sum()), one((ra < rb).sum()), one(len(a)), one(len(b)))[0]
        assert abs(got - true) < 0.08
        assert (sketch.merge(ra, rb) == sketch.registers(np.union1d(a, b))).all()


def test_fingerprints_of_the_table(spark):
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = {r["doc_id"]: r for r in LLM_QUERIES["op8_fingerprints"](spark, SF).collect()}
    assert len(got) == len(rows)
    by_text = {}
    error = []
    for n, (i, text) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        quarter = len(text) // 4
        changed = text[:len(text) - quarter] + following[:quarter]
        r = got[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert by_text.setdefault(changed, r["edited_fingerprint"]) == r["edited_fingerprint"]
        for near, other in (("near_edited", changed), ("near_next", following)):
            a, b = shingle_set(text, 5), shingle_set(other, 5)
            assert 0 <= r[near] <= 1
            error.append(abs(r[near] - (len(a & b) / len(a | b) if a | b else 1.0)))
    assert np.mean(error) < 0.03 and max(error) < 0.25


def test_fingerprints_of_odd_rows(spark):
    texts = ["abcd efgh", None, "", "word " * 30000, "x", "x"]
    df = docs_of(spark, texts, CLASHING)
    df = df.unionByName(df.where("doc_id = 4")).unionByName(spark.createDataFrame([(None, "last", None, None, 4)], "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", *CLASHING))
    rows = fingerprints.edited_fingerprints(df).collect()
    assert len(rows) == 8
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[None]["edited_sha256"] == hashlib.sha256(b"lasa").hexdigest()      # the first document follows the last
    assert by_id[0]["edited_sha256"] == hashlib.sha256(b"abcd ef").hexdigest()      # an empty one follows: nothing to add
    assert by_id[1]["near_next"] == 1.0 and by_id[1]["fingerprint"] == by_id[2]["fingerprint"]
    assert by_id[4]["fingerprint"] == by_id[5]["fingerprint"] and by_id[3]["near_edited"] > 0
    assert fingerprints.edited_fingerprints(df.limit(0)).count() == 0
    assert fingerprints.edited_fingerprints(df.where("doc_id = 0")).collect()[0]["near_next"] == 1.0
