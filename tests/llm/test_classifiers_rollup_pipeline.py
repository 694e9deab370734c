"""Classifiers by held-out accuracy, rollups by brute force, and the pipeline stage by stage."""

from __future__ import annotations

import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabsmith.llm import language_id, quality, token_rollup, tokens
from tabsmith.llm.common import sampled, staged
from tabsmith.llm.queries import LLM_ORACLE, LLM_QUERIES, graded_labels, tokenizer_path

from .conftest import CLASHING, DOCS, SF, docs_of


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_languages_of_held_out_documents(spark):
    got = {r["doc_id"]: r for r in LLM_QUERIES["op7_language_id"](spark, SF).collect()}
    table = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(table)
    for r in table:
        assert got[r["doc_id"]]["held_out"] == held_out(r["doc_id"]) and 0 <= got[r["doc_id"]]["score"] <= 1
    tested = [r for r in table if held_out(r["doc_id"])]
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in tested]) > 0.97


def test_languages_of_odd_texts(spark):
    texts = ["the cat and the dog", "le chat et le chien"] * 30 + [None, "", "12 34 !?", "a", "the cat " * 60000]
    df = docs_of(spark, texts, CLASHING)
    rows = {r["doc_id"]: r for r in language_id.identify(df).collect()}
    assert [rows[i]["lang_pred"] for i in (60, 61, 62)] == ["und"] * 3 and rows[60]["score"] == 0.0
    assert rows[63]["lang_pred"] in ("en", "fr") and rows[64]["lang_pred"] == rows[0]["lang_pred"] == "en"
    assert rows[1]["lang_pred"] == "fr"
    kept = language_id.keep_identified(df)
    assert kept.columns == df.columns and {60, 61, 62}.isdisjoint(r["doc_id"] for r in kept.select("doc_id").collect())
    assert language_id.identify(df.limit(0)).count() == 0
    unlabelled = language_id.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in unlabelled} == {"und"}


def test_signs_that_are_no_letters_are_undetermined(spark):
    texts = ["the cat and the dog", "le chat et le chien"] * 20 + ["½ ²", "Ⅷ ①", "３ ٣", "__", "½ a"]
    rows = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs_of(spark, texts)).collect()}
    assert [rows[i] for i in range(40, 45)] == ["und"] * 4 + [rows[44]] and rows[44] in ("en", "fr")


def test_sample_is_dealt_over_groups_and_stays_the_same(spark):
    """A group with nine tenths of the rows gets no more than the others, and the partitioning changes nothing."""
    rows = [(i, "big" if i % 10 else ("small" if i % 20 else "tiny"), f"t{i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = [sorted(tuple(r) for r in sampled(df.repartition(n), F.col("doc_id").cast("string"), 300, "lang").collect()) for n in (1, 13)]
    assert got[0] == got[1] and len(got[0]) == 300
    assert Counter(lang for _, lang, _ in got[0]) == {"big": 100, "small": 100, "tiny": 100}
    assert sampled(df, F.col("doc_id"), 10_000, "lang").count() == 6000 and sampled(df, F.col("doc_id"), 50).count() == 50
    assert sampled(df.limit(0), F.col("doc_id"), 50, "lang").count() == 0


def test_every_labelled_row_teaches(spark):
    """More rows than one block holds: the last language by name is learned, however rare; every row counts in the thresholds."""
    texts = {"a": "the cat and the dog", "b": "le chat et le chien", "c": "der hund und die katze"}
    rows = [(i, lang, f"{texts[lang]} {'xyzuvw'[i % 6]}") for i, lang in enumerate("a" * 3900 + "b" * 2400 + "c" * 40)]
    docs = spark.createDataFrame(rows + rows[:20], "doc_id long, lang string, text string")
    model = language_id.fit(docs)
    assert {lang: model.predict(text)[0] for lang, text in texts.items()} == {lang: lang for lang in texts}
    again = language_id.fit(docs.repartition(7))
    assert again.families == model.families and np.allclose(again.family_weights, model.family_weights, atol=1e-5)
    counts, size = Counter(), Counter(lang for _, lang, _ in rows + rows[:20])
    for _, lang, text in rows + rows[:20]:
        counts.update((lang, g) for g in set(language_id.trigrams(text).tolist()))
    known = language_id.known_grams(docs)
    assert known.tolist() == sorted({g for (lang, g), n in counts.items() if n >= max(1, np.ceil(language_id.KNOWN_IN * size[lang]))})
    held = spark.createDataFrame([("a", texts["a"])] * 1950 + [("a", "the cat qqqq")] * 50 + [("c", "12")], "lang string, text string")
    share = language_id.known_share("the cat qqqq", known)[0]
    least = language_id.least_shares(held, known)
    assert 0 < share < 0.9 and set(least) == {"a", None} and least["a"] == least[None]
    assert abs(least["a"] - language_id.CLEAN_SLACK * share) <= 1 / language_id.SHARE_STEPS


def test_noise_and_unlearned_scripts_are_rejected(spark):
    import random

    rng = random.Random(3)
    letters = {"ascii": "abcdefghijklmnopqrstuvwxyz", "cyrillic": [chr(c) for c in range(0x430, 0x450)],
               "greek": [chr(c) for c in range(0x3B1, 0x3CA)], "han": [chr(c) for c in range(0x4E00, 0x5E00)]}
    noise = [" ".join("".join(rng.choices(some, k=rng.randint(2, 9))) for _ in range(60)) for some in letters.values() for _ in range(5)]
    noise += ["zzzz " * 50, "qx" * 300]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = spark.createDataFrame([(10 ** 9 + i, t, None, "a", len(t)) for i, t in enumerate(noise)], DOCS)
    kept = {r["doc_id"] for r in language_id.keep_identified(docs.unionByName(odd)).select("doc_id").collect()}
    clean = {r["doc_id"] for r in docs.where("text rlike '[a-z]'").collect()}
    assert not [i for i in kept if i >= 10 ** 9]
    assert len(kept & clean) > 0.99 * len(clean)


def test_no_task_of_the_language_stage_has_two_python_steps(spark, monkeypatch):
    """Each step in a row holds a worker process of its own, so that a task with two takes twice the memory."""
    plans = []

    def noted(run):
        def noting(df, *rest):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return run(df, *rest)
        return noting

    monkeypatch.setattr(language_id, "staged", noted(staged))
    for name in ("collect", "toPandas"):
        monkeypatch.setattr(type(spark.range(0)), name, noted(getattr(type(spark.range(0)), name)))
    docs = docs_of(spark, ["the cat and the dog", "le chat et le chien"] * 60)
    language_id.keep_identified(docs).collect()
    language_id.identify(docs).collect()
    in_task = [sum("InPandas" in line or "ArrowEvalPython" in line for line in part.splitlines())
               for plan in plans for part in plan.split("Exchange")]
    assert sum(in_task) >= 12 and max(in_task) == 1


def test_repeated_rows_teach_once_and_blocks_come_whole():
    rows = pd.DataFrame([(b, lang, i, bytes([b, i])) for b in (0, 1, 4) for lang in ("en", "fr") for i in (1, 1, 2, 3, 3)], columns=["_block", "lang", "doc_id", "x"])
    for size in (1, 4, 7, 100):
        blocks = list(language_id.whole_blocks(rows[k:k + size] for k in range(0, len(rows), size)))
        assert [b["_block"].unique().tolist() for b in blocks] == [[0], [1], [4]]
        assert all(b[["lang", "doc_id"]].values.tolist() == [[lang, i] for lang in ("en", "fr") for i in (1, 2, 3)] for b in blocks)
    assert list(language_id.whole_blocks([])) == list(language_id.whole_blocks([rows[:0]])) == []


def peak_mb(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_fits_hold_their_rows_once():
    """A block's vectors are unpacked into one matrix; grades are counted for the features of the sample alone."""
    packed = pd.Series([zlib.compress(np.full(1 << language_id.BITS, k % 5, dtype=np.float16).tobytes(), 1) for k in range(1000)])
    assert np.array_equal(language_id._unpacked(packed)[:, 0], np.arange(1000) % 5)
    assert peak_mb(lambda: language_id._unpacked(packed)) < 1.2 * 1000 * (1 << language_id.BITS) * 4 / 1e6
    rows = graded(90, np.random.default_rng(5))
    cells, grades = [quality.features(t) for t, _ in rows], [g for _, g in rows]
    assert peak_mb(lambda: quality.fit_sample(cells, grades)) < 4 * 8 * quality.N_FEATURES / 1e6


def test_trigrams_do_not_depend_on_slices(monkeypatch):
    text = "Der Zug fährt, 12 le train part. " * 40
    whole = np.sort(language_id.trigrams(text))
    monkeypatch.setattr(language_id, "SLICE_CHARS", 37)
    assert np.array_equal(whole, np.sort(language_id.trigrams(text)))


def test_features_do_not_depend_on_slices(monkeypatch):
    text = "Der Zug fährt, le train part. " * 40
    whole = language_id.features(text)
    monkeypatch.setattr(language_id, "SLICE_CHARS", 37)
    assert np.allclose(whole, language_id.features(text), atol=1e-6)


def test_families_group_alike_languages():
    means = {"a": np.array([1, 0.9, 0]), "b": np.array([0.9, 1, 0]), "c": np.array([0, 0.1, 1]), "d": np.array([0.1, 0, 1])}
    assert sorted(language_id.group_families(means)) == [["a", "b"], ["c", "d"]]


def graded(n, random):
    """Texts with their grades: bad words, shouting, or neither."""
    out = []
    for _ in range(n):
        words = [f"w{random.integers(0, 400)}" for _ in range(random.integers(20, 80))]
        grade = int(random.integers(0, 3))
        if grade == 0:
            for _ in range(4):
                words[random.integers(0, len(words))] = f"vile{random.integers(0, 3)}"
        out.append((" ".join(words).upper().replace(" ", "!! ") if grade == 1 else " ".join(words), grade))
    return out


def test_grades_of_held_out_texts(spark):
    random = np.random.default_rng(2)
    rows = graded(700, random)
    df = docs_of(spark, [t for t, _ in rows] + [None, "", "w1 " * 50000], CLASHING)
    ratings = spark.createDataFrame([(i, g if i < 500 else None) for i, (_, g) in enumerate(rows)] + [(None, 1), (10 ** 9, 2), (0, 2)],
                                    "doc_id long, rating int")
    got = {r["doc_id"]: r for r in quality.grade(df, ratings, 2).collect()}
    assert len(got) == 703 and got[700]["tail"] == got[701]["tail"]
    tested = range(500, 700)
    assert np.mean([got[i]["selected"] == (rows[i][1] == 2) for i in tested]) > 0.95
    means = [np.mean([got[i]["expected_grade"] for i in tested if rows[i][1] == g]) for g in range(3)]
    assert means[0] < means[1] < means[2]
    kept = quality.keep_good(df, ratings, 2)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.select("doc_id").collect()} == {i for i in got if got[i]["selected"]}
    assert quality.grade(df.limit(0), ratings, 2).count() == 0
    alone = quality.grade(df, ratings.where("rating = 2"), 2).select("expected_grade", "tail").distinct().collect()
    assert [tuple(r) for r in alone] == [(2.0, 1.0)]
    nothing = quality.grade(df, ratings.limit(0), 2).select("expected_grade", "selected").distinct().collect()
    assert [tuple(r) for r in nothing] == [(0.0, True)]


def test_gradient_of_the_ordinal_likelihood(monkeypatch):
    random = np.random.default_rng(1)
    rows = graded(120, random)
    seen = []

    def check(loss, p):
        p = p + random.normal(0, 0.1, len(p))
        value, gradient = loss(p)
        for i in [*range(min(5, len(p))), len(p) - 2, len(p) - 1]:
            step = np.zeros(len(p))
            step[i] = 1e-5
            seen.append(abs((loss(p + step)[0] - loss(p - step)[0]) / 2e-5 - gradient[i]))
        return p

    monkeypatch.setattr(quality, "minimise", check)
    quality.fit_sample([quality.features(t) for t, _ in rows], [g for _, g in rows])
    assert max(seen) < 1e-5


def test_labelled_table(spark):
    got = {r["doc_id"]: r["selected"] for r in LLM_QUERIES["op10_quality_classifier"](spark, SF).collect()}
    ratings = {r["doc_id"]: r["rating"] for r in graded_labels(spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    good = [got[i] for i, g in ratings.items() if g == 2 and i in got]
    bad = [got[i] for i, g in ratings.items() if g is not None and g < 2 and i in got]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.5


def test_rollup_equals_brute_force(spark, tmp_path):
    path = tokenizer_path("byte_bpe_50k.json")
    texts = ["a b c", "d e", None, "f g h i", "a b c", "long " * 20000]
    df = docs_of(spark, texts, CLASHING)
    rollup = token_rollup.TokenRollup(spark, str(tmp_path / "rollup"))
    assert rollup.totals().count() == 0
    state = {}

    def put(ids, revised=lambda t: t):
        for i in ids:
            t = revised(texts[i] or "")
            state[i] = {"bpe": len(tokens.encode(path, t)), "words": len(t.split())}

    def check():
        want = {}
        for i, counts in state.items():
            for version, n in counts.items():
                key = (("a", "b", None)[i % 3], ("en", "fr")[i % 2], version)
                docs, total = want.get(key, (0, 0))
                want[key] = (docs + 1, total + n)
        got = {(r["source"], r["lang"], r["version"]): (r["docs"], r["tokens"]) for r in rollup.totals().collect()}
        assert got == want

    count = lambda d: token_rollup.counted(d, {"bpe": path}, words="words")
    assert rollup.apply("1", count(df.unionByName(df.where("doc_id = 1"))))  # a repeated row counts once
    put(range(6))
    check()
    assert not rollup.apply("1", count(df))
    check()
    gone = spark.createDataFrame([(0,), (0,), (99,), (None,)], "doc_id long")
    assert rollup.apply("2", deletes=gone)
    del state[0]
    check()
    assert rollup.apply("3", count(df.where("doc_id in (3, 5)").withColumn("text", F.lit("now short"))))
    put((3, 5), lambda t: "now short")
    check()
    assert rollup.apply("4", count(df.where("doc_id = 0")), deletes=gone.where("doc_id = 99"))
    put([0])
    check()
    assert rollup.apply("5", count(df.limit(0))) and not rollup.apply("2", deletes=gone)
    check()


def test_a_batch_that_broke_off_is_written_over(spark, tmp_path):
    rollup = token_rollup.TokenRollup(spark, str(tmp_path / "rollup"))
    counts = token_rollup.counted(docs_of(spark, ["a b", "c"]), {}, words="w")
    counts.limit(1).selectExpr("doc_id", "source", "lang", "version", "1L as docs", "tokens").write.parquet(rollup._folder("ledger", "1"))
    assert rollup.committed() == [] and rollup.apply("1", counts)
    assert sum(r["tokens"] for r in rollup.totals().collect()) == 3


def test_registered_totals(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    toxic = {r["doc_id"] for r in labels if r["toxic"] == 1}
    poor = {r["doc_id"] for r in labels if r["quality"] == 0} - toxic
    path, want = tokenizer_path("byte_bpe_50k.json"), {}
    for d in docs:
        if d["doc_id"] not in toxic:
            text = d["text"].translate(str.maketrans("", "", "|!#$%&*")) if d["doc_id"] in poor else d["text"]
            for version, n in (("byte_bpe_50k", len(tokens.encode(path, text))), ("words", len(text.encode().split()))):
                key = (d["source"], d["lang"], version)
                want[key] = tuple(np.add(want.get(key, (0, 0)), (1, n)))
    got = {(r["source"], r["lang"], r["version"]): (r["docs"], r["tokens"]) for r in LLM_QUERIES["op9_token_counts"](spark, SF).collect()}
    assert got == want


def test_revised_documents_are_chosen_by_label(spark, tmp_path, monkeypatch):
    texts = ["a ! b | c", "a ! b | c", "a ! b | c", "d e", "f & g"]
    docs_of(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 0, 0), (1, 1, 0), (2, 0, 1), (3, 0, 0), (0, 0, 0), (None, 0, 0)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    batches = {}
    apply = token_rollup.TokenRollup.apply

    def recorded(self, batch, sets=None, deletes=None):
        batches[batch] = sets
        return apply(self, batch, sets, deletes)

    monkeypatch.setattr(token_rollup.TokenRollup, "apply", recorded)
    totals = LLM_QUERIES["op9_token_counts"](spark, str(tmp_path)).where("version = 'words'").collect()
    assert {(r["source"], r["lang"]): r["tokens"] for r in totals} == {("a", "en"): 3, ("b", "fr"): 5, ("a", "fr"): 2, ("b", "en"): 3}
    assert {r["doc_id"] for r in batches["3-revised"].collect()} == {0, 3}


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = staged(stage(spark, docs, SF), name)
        assert after.columns == docs.columns
        before, now = {r["doc_id"]: r for r in docs.collect()}, [r for r in after.collect()]
        assert all(before[r["doc_id"]] == r for r in now)
        kept.append(len(now) / len(before))
        docs = after
    assert kept[0] > 0.95 and kept[1] > 0.7 and kept[2] < 1.0
    ratings = {r["doc_id"]: r["rating"] for r in graded_labels(spark, SF).collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    total = sum(r["length"] for r in packed)
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert len({r["sequence_id"] for r in packed}) <= -(-total // 2048) + 2
    assert np.mean([ratings.get(r["doc_id"], 2) == 2 for r in packed]) > 0.8


def test_pipeline_of_odd_tables(spark):
    texts = [None, "", "   ", "12", "same words in two rows of the table", "same words in two rows of the table", "long words " * 30000]
    df = docs_of(spark, texts)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for table in (df, df.limit(0)):
            out = stage(spark, table, SF)
            assert out.columns == df.columns, name
            out.count()
    assert corpus_pipeline.STAGES[-1][1](spark, df, SF).where("doc_id < 3").count() == 3


@pytest.mark.parametrize("key", sorted(LLM_ORACLE))
def test_oracle_agrees(spark, key):
    from oracle_compare import compare

    result = compare(spark, SF, key, LLM_QUERIES[key], LLM_ORACLE[key])
    assert result["columns_match"] and result["values_match"], result
