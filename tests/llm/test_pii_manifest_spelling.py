"""Personal data, Merkle manifest and spelling variants against brute force."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter
from random import Random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tabsmith.llm import merkle, pii, spelling, tagger
from tabsmith.llm.queries import LLM_ORACLE, LLM_QUERIES, MANIFEST_FIELDS

from .conftest import CLASHING, SF, SF_SMALL, docs_of

# --- personal data -------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def plain_base(text):
    """The patterns as they are written, by the plain regex engine."""
    found = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            fits = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                    "card": 12 <= len(digits) <= 19 and plain_luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if fits:
                found.append((m.start(), k, m.end()))
    return sorted(found)


def digest_of(spans):
    return hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


def test_base_spans_equal_the_plain_patterns():
    random = np.random.default_rng(3)
    pieces = ["a", "b.c", "@", "@x.de", ".", "-", "+", " ", "12", "3.4", "255", "256", "0.0.0.0", "(", ")", "4111111111111111", "é", "+1 (132) 555-1352",
              "4012 8888 8888 1881", "%", "_", "@h", "00001", "1-2"]
    for _ in range(3000):
        text = "".join(pieces[i] for i in random.integers(0, len(pieces), random.integers(0, 14)))
        assert pii.base_spans(text) == plain_base(text), text


def test_spans_of_very_long_texts_take_linear_time():
    n = 300_000
    for text in ("a" * n, "1" * n, "1." * n, "a@" * n, "@" + "a" * n, "+1 " * n, "a.b@c" * n):
        pii.base_spans(text)
    assert pii.base_spans("x" * n + "@h.de")[0] == (0, pii.EMAIL, n + 5)


def test_tagger_gradient_and_best_tags():
    model = tagger.new_tagger(1, 4, 1)
    model.weights = {k: v.astype(float) for k, v in model.weights.items()}
    random = np.random.default_rng(0)
    classes = random.integers(1, 20, (7, 3))
    tags = np.array([[0, 1, 2, 0, 1, 1, 2], [0] * 7, [1, 2, 2, 2, 0, 0, 1]]).T
    _, gradient = model.loss_and_gradient(classes, tags)
    for name, g in gradient.items():
        w = model.weights[name]
        place = np.unravel_index(np.abs(g).argmax(), w.shape)
        w[place] += 1e-5
        more = model.loss_and_gradient(classes, tags)[0]
        w[place] -= 2e-5
        less = model.loss_and_gradient(classes, tags)[0]
        w[place] += 1e-5
        assert abs((more - less) / 2e-5 - g[place]) < 1e-4 * max(1, abs(g[place])), name
    rows = [classes[:n, b] for b, n in enumerate((7, 1, 5))]
    scores = model.emissions(rows)
    for row, alone in zip(rows, scores, strict=True):  # batching changes nothing
        assert np.allclose(model.emissions([row])[0], alone, atol=1e-5)
    moves = model.weights["moves"]

    def path_score(s, path):
        return moves[0, path[0]] + moves[path[-1], 0] + sum(s[t, k] for t, k in enumerate(path)) + sum(moves[a, b] for a, b in itertools.pairwise(path))

    for s, best in zip(scores, model.best_tags(scores), strict=True):
        brute = max(itertools.product(range(3), repeat=len(s)), key=lambda p: path_score(s, p))
        assert abs(path_score(s, brute) - path_score(s, best)) < 1e-3


@pytest.fixture(scope="module")
def passages():
    texts = pq.read_table(f"{SF_SMALL}/documents.parquet")["text"].to_pylist()
    return [t[:pii.PASSAGE_CHARS] for t in texts if t]


@pytest.fixture(scope="module")
def model(passages):
    return pii.fitted(passages[::2])


def test_tagger_finds_held_out_spans(model, passages):
    random = Random(99)
    rows = [pii.training_row(random, passages[1::2]) for _ in range(600)]
    found = [set(pii.tagged_runs(t)) for t in model.best_tags(model.emissions([c for c, _ in rows]))]
    true = [set(pii.tagged_runs(t)) for _, t in rows]
    hit, wanted, given = (sum(map(len, x)) for x in ((a & b for a, b in zip(true, found, strict=True)), true, found))
    assert hit / wanted > 0.85 and hit / given > 0.85


def test_added_spans(model):
    texts = ["Call me at (132) 555-1352 or write to jane.doe (at) example (dot) com today",
             "paid with 4111.1111.1111.1111 from 10[.]0[.]0[.]7 yesterday",
             "ring +1 (826) 555-4081 4387393285946913 now", "", "no data at all", "on 2021-03-04 we sold 12,500 of v1.2.3",
             "token 0641917ea4e9feb9cda83477b57ac265 and order 123456789012"]
    spans = pii.spans_of(model, texts)
    text_of = lambda i: [(pii.KINDS[k], texts[i][a:b]) for a, k, b in spans[i][1]]
    assert ("phone", "+1 (826) 555-4081") in text_of(2) and ("card", "4387393285946913") in text_of(2)
    assert [len(all_) for _, all_ in spans][3:] == [0, 0, 0, 0]
    assert all(set(base) <= set(all_) for base, all_ in spans)
    found = {x for i in (0, 1) for x in text_of(i)}
    assert len(found & {("phone", "(132) 555-1352"), ("email", "jane.doe (at) example (dot) com"), ("card", "4111.1111.1111.1111"),
                        ("ip", "10[.]0[.]0[.]7")}) >= 3


def test_windows_are_reconciled(model):
    """A stretch of many windows gives the spans of its parts, also where a window ends inside a span."""
    value = "4111 1111 1111 1111 x "  # found by pattern as well, so only the tagger's rows are compared
    text = value * 60
    (tags,) = model.best_tags(pii.stretch_scores(model, [tagger.classes_of(text)]))
    (whole,) = model.best_tags(model.emissions([tagger.classes_of(text)]))
    same = len(set(pii.tagged_runs(tags)) & set(pii.tagged_runs(whole)))
    assert same >= 0.95 * len(pii.tagged_runs(whole)) > 0
    assert pii.windows(10) == [(0, 10)] and pii.windows(257)[-1] == (192, 257)
    covered = np.zeros(1000, int)
    for a, b in pii.windows(1000):
        covered[a:b] += 1
    assert covered.min() == 1


def test_pii_query_against_plain_patterns(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    rows = LLM_QUERIES["op11_pii"](spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        text, base = texts[r["doc_id"]], plain_base(texts[r["doc_id"]])
        assert r["base_sha256"] == digest_of(base)
        spans = [(int(a), pii.KINDS.index(k), int(b)) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)]
        assert spans == sorted(spans) and set(base) <= set(spans)
        assert Counter(k for _, k, _ in spans) == +Counter({i: r[f"n_{kind}"] for i, kind in enumerate(pii.KINDS)})
        for a, k, b in set(spans) - set(base):
            assert pii.acceptable(k, text, a, b)


def test_pii_odd_rows(spark):
    text = "mail a@b.de, " + "x" * 200_000 + " 10.0.0.1 " + "1" * 5000
    docs = docs_of(spark, [None, "", " ", text, "a@b.de", "a@b.de"], extra=[*CLASHING, "'z' as spans", "1 as n_ip"]).unionByName(
        docs_of(spark, ["a@b.de"]).withColumn("doc_id", F.lit(None).cast("long")), allowMissingColumns=True)
    rows = {(r["doc_id"], r["n_email"], r["n_ip"]): r["spans"] for r in pii.find_spans(docs).collect()}
    assert len(rows) == 7 and rows[(0, 0, 0)] == rows[(1, 0, 0)] == ""
    assert rows[(4, 1, 0)] == rows[(5, 1, 0)] == rows[(None, 1, 0)] == "email:0:6"
    assert rows[(3, 1, 1)].startswith("email:5:11,ip:")
    assert pii.find_spans(docs.where("false")).collect() == []


def test_counts_are_of_base_spans(spark, model, monkeypatch):
    """What the tagger adds shows among the spans and is not counted."""
    monkeypatch.setattr(pii, "fit", lambda docs: pii.packed(model))
    text = "ring +1 (826) 555-4081 4387393285946913 now, mail a@b.de"
    (row,) = pii.find_spans(docs_of(spark, [text])).collect()
    base = plain_base(text)
    assert len(row["spans"].split(",")) > len(base) and row["base_sha256"] == digest_of(base)
    assert [row[f"n_{kind}"] for kind in pii.KINDS] == [sum(k == i for _, k, _ in base) for i in range(len(pii.KINDS))]


# --- manifest --------------------------------------------------------------------

def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_manifest(rows):
    """{(doc_id, leaf): (subroot, root, proof, folded, verified)} by building every level whole."""
    framed = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: h("".join(framed(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
        return out

    by_lang = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted(by_lang[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[lang] = (own, levels([leaf(r, r["text"]) for r in own]))
    top = levels([trees[lang][1][-1][0] for lang in langs])
    found = {}
    for place, lang in enumerate(langs):
        own, tree = trees[lang]
        for i, r in enumerate(own):
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            lowered = r["text"] and r["text"].translate({c: c + 32 for c in range(65, 91)})
            node, proof = leaf(r, lowered if tampered else r["text"]), ""
            for at, up in ((i, tree), (place, top)):
                for level in up[:-1]:
                    start = at - at % 8
                    before, after = "".join(level[start:at]), "".join(level[at + 1:start + 8])
                    node, proof, at = h(before + node + after), proof + before + after, at // 8
            found[(r["doc_id"], tree[0][i])] = (tree[-1][0], top[-1][0], h(proof), node, node == top[-1][0])
    return found


def manifest_of(docs, depth):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    own = merkle.leaf_hash([F.col(f) for f in MANIFEST_FIELDS])
    other = merkle.leaf_hash([lower if f == "text" else F.col(f) for f in MANIFEST_FIELDS])
    leaves = docs.select(F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("tree"), "doc_id", own.alias("node"),
                         F.when(tampered, other).alias("tampered"))
    return {(r["doc_id"], r["leaf"]): tuple(r)[2:] for r in merkle.prove(leaves, depth).collect()}


@pytest.mark.parametrize("depth", [1, 2])
def test_manifest_of_many_tiers(spark, depth):
    """Superblocks of 8 and 64 rows: several tiers, a lone last block, groups of one row, more groups than a run."""
    rows = [(i, f"Text {i} É", "en", "a", i) for i in range(577)] + [(1000 + i, "X", f"l{i:02}", None, None) for i in range(19)]
    rows += [(2000 + i, None if i % 2 else "B", None, "s", 3) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert manifest_of(docs, depth) == plain_manifest([r.asDict() for r in docs.collect()])


def test_manifest_odd_rows(spark):
    docs = docs_of(spark, [None, "", "A" * 100_000, "é", "é"], extra=CLASHING)
    odd = docs.unionByName(docs.limit(2)).unionByName(docs.withColumn("doc_id", F.lit(None).cast("long")))
    got = merkle.manifest(odd, MANIFEST_FIELDS, "lang", F.lit(False), {}).collect()
    want = plain_manifest([r.asDict() for r in odd.collect()])
    assert len(got) == odd.count() and {(r["doc_id"], r["leaf"]) for r in got} == set(want)
    assert all(r["verified"] and r["root"] == r["folded_root"] for r in got)
    one = merkle.manifest(docs.where("doc_id = 2"), MANIFEST_FIELDS, "lang", F.lit(False), {}).collect()[0]
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == h("")
    assert merkle.manifest(docs.where("false"), MANIFEST_FIELDS, "lang", F.lit(False), {}).collect() == []


# --- spelling ----------------------------------------------------------------------

def one_edit(a, b):
    """Whether one inserted, deleted or replaced letter turns a into b, by trying all."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def variants(random, n):
    """Words with their misspellings, of few letters so that many are near."""
    words = set()
    while len(words) < n:
        word = "".join("abcé"[c] for c in random.integers(0, 4, random.integers(5, 10)))
        words.add(word)
        for _ in range(3):
            i = random.integers(0, len(word))
            words.add([word[:i] + word[i + 1:], word[:i] + "x" + word[i:], word[:i] + "d" + word[i + 1:]][random.integers(0, 3)])
    return sorted(w for w in words if len(w) >= 5)


def test_index_search_finds_every_near_word():
    words = variants(np.random.default_rng(5), 400)
    index = spelling.WordIndex(words)
    queries = [*words, "zzzzz", "abcdefghij" * 30]
    pairs = set()
    for side in (spelling.BY_START, spelling.BY_END):
        query, number = spelling.near_in_index(index, queries, side)
        found = {(queries[q], words[w]) for q, w in zip(query, number, strict=True)}
        assert all(one_edit(a, b) for a, b in found)
        pairs |= found
    assert pairs == {(a, b) for a in queries for b in words if one_edit(a, b)}


def test_suffix_array_and_intervals():
    text = np.array([1, 2, 3, 2, 3, 1, 2, 1, 0])
    suffixes = sorted(range(len(text)), key=lambda i: list(text[i:]))
    assert list(spelling.suffix_array(text)) == suffixes
    index = spelling.WordIndex(["ababa", "abab"])
    found = index.whole(1)
    for letter, left in ((2, True), (3, False), (2, False), (3, True)):  # a, ab, aba, baba
        found = index.by_letter(found, np.array([letter]), left)
    assert found.size[0] == 1 and index.by_letter(found, np.array([3]), True).size[0] == 0


def brute_variants(counts):
    words = sorted(counts)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    best = {w: min(near[w], key=lambda v: (-counts[v], v)) if near[w] else None for w in words}
    form = {w: b if b and counts[b] >= 2 * counts[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in words}


@pytest.mark.parametrize("block_chars,per_task", [(1 << 16, 1 << 14), (40, 7), (1, 1 << 14)])
def test_groups_equal_brute_force_over_blocks(spark, monkeypatch, block_chars, per_task):
    monkeypatch.setattr(spelling, "QUERIES_PER_TASK", per_task)
    random = np.random.default_rng(11)
    counts = {w: int(2 ** random.integers(2, 9)) for w in variants(random, 90)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    pairs = {(r["word"], r["near"], r["near_n"]) for r in spelling.near_words(words, block_chars).collect()}
    assert pairs == {(a, b, counts[b]) for a in counts for b in counts if one_edit(a, b)}
    if block_chars > 1:
        got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.variant_groups(words).collect()}
        assert got == brute_variants(counts)


def plain_counts(rows, damaged_every):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            code = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if code % damaged_every == 0:
                run = run[:code % len(run)] + run[code % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def test_spelling_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    counts = plain_counts(rows, 97)
    got = {r["word"]: r for r in LLM_QUERIES["op13_spelling_variants"](spark, SF_SMALL).collect()}
    assert {w: r["n"] for w, r in got.items()} == counts
    gapped = {}
    for w in counts:
        for i in range(len(w)):
            gapped.setdefault(w[:i] + w[i + 1:], set()).add(w)
    near = {w: {v for g in [w, *(w[:i] + w[i + 1:] for i in range(len(w)))] for v in {*gapped.get(g, ()), *([g] if g in counts else [])}
                if one_edit(w, v)} for w in counts}
    assert {w: r["n_near"] for w, r in got.items()} == {w: len(v) for w, v in near.items()}


def test_spelling_odd_rows(spark):
    long = "q" * 40_000
    texts = [None, "", "1 2 3", " ".join([long] * 3 + [long + "z"] * 3), "HOUSE house House hOuse hous's housé housé housé", "Ärger ärger Ärger äRGER Ärger"]
    docs = docs_of(spark, texts, extra=[*CLASHING, "'x' as word", "3 as n", "'y' as run"])
    docs = docs.unionByName(docs.where("doc_id = 4").withColumn("doc_id", F.lit(None).cast("long")))
    got = {r["word"]: (r["form"], r["root"], r["n"]) for r in spelling.variant_groups(spelling.frequent_words(docs)).collect()}
    assert got[long] == (None, long, 3) and got[long + "z"] == (None, long + "z", 3)
    assert got["house"] == (None, "house", 8) and got["housé"] == (None, "housé", 6)
    assert got["Ärger"][2] == 3 and "ärger" not in got
    assert spelling.variant_groups(spelling.frequent_words(docs.where("false"))).collect() == []


@pytest.mark.parametrize("key", ["op12_merkle_manifest", "op13_spelling_variants"])
def test_queries_equal_sql(spark, key):
    from oracle_compare import compare

    result = compare(spark, SF if key.startswith("op12") else SF_SMALL, key, LLM_QUERIES[key], LLM_ORACLE[key])
    assert result["columns_match"] and result["values_match"], result
