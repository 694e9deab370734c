"""Predictions of the classifiers, computed again from their models letter by letter and word by word."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from tabsmith.llm import language_id, quality

from .conftest import SF_SMALL

M32 = (1 << 32) - 1


@pytest.fixture(scope="module")
def documents():
    rows = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["text", "lang"]).to_pylist()
    return [(r["text"], r["lang"]) for r in rows if r["text"] and language_id.has_letter(r["text"])]


def plain_grams(text):
    """Unit vector of square-rooted n-gram counts, by cell."""
    codes = [ord(c) if not c.isascii() or c.isalpha() else 0x20 for c in text.lower()]
    counts = Counter()
    for i in range(len(codes)):
        gram = 0
        for n, code in enumerate(codes[i:i + language_id.LONGEST_GRAM], 1):
            gram = (gram * 0x01000193 + code + n) & M32
            counts[(gram * 0x9E3779B1 & M32) >> (32 - language_id.BITS)] += 1
    norm = math.sqrt(sum(counts.values()))
    return {cell: math.sqrt(n) / norm for cell, n in counts.items()}


def plain_language(model, text):
    """The family of largest margin, then a vote of the pairs; the score multiplies both shares."""
    x = plain_grams(text)
    margin = lambda w: language_id.SHARPNESS * (sum(float(w[c]) * v for c, v in x.items()) + float(w[-1]))
    family, score = 0, 1.0
    if len(model.families) > 1:
        margins = [margin(w) for w in model.family_weights]
        family = margins.index(max(margins))
        score = 1 / sum(math.exp(m - max(margins)) for m in margins)
    names = model.families[family]
    if len(names) == 1:
        return names[0], score
    votes, sure = Counter(), Counter()
    for (a, b), w in zip(model.pairs[family], model.pair_weights[family], strict=True):
        chance = 1 / (1 + math.exp(-margin(w)))
        votes[a if chance >= 0.5 else b] += 1
        sure[a] += chance
        sure[b] += 1 - chance
    best = max(range(len(names)), key=lambda k: (votes[k], sure[k], -k))
    return names[best], score * sure[best] / (len(names) - 1)


def test_language_predictions_are_recomputed(documents):
    learn, ask = documents[::2][:80], documents[1::2][:25]
    model = language_id.fit_sample(np.stack([language_id.features(t) for t, _ in learn]), [lang for _, lang in learn])
    assert sum(map(len, model.families)) == len({lang for _, lang in learn}) > 2
    for text, _ in ask:
        got, want = model.predict(text), plain_language(model, text)
        assert got[0] == want[0] and got[1] == pytest.approx(want[1], abs=1e-4)
    assert model.predict("½ 12") == ("und", 0.0)


def test_machines_are_near_the_optimum_of_their_penalty():
    """After its few epochs no step in one weight lowers a machine's loss (margin violations, half the squared weights) by a tenth."""
    random = np.random.default_rng(1)
    x = random.normal(size=(60, 5))
    positive = x @ np.array([1.0, -2.0, 0.5, 0.0, 1.0]) + random.normal(0, 0.5, 60) > 0.3
    w = language_id.svm(x, np.arange(60), positive).astype(float)
    y = np.where(positive, 1.0, -1.0)
    cost = language_id.PENALTY * np.where(positive, 1 / positive.sum(), 1 / (~positive).sum()) * 60 / 2

    def loss(v):
        return float(v @ v) / 2 + float((cost * np.maximum(0, 1 - y * (x @ v[:-1] + v[-1]))).sum())

    for k in range(6):
        for step in (-0.2, 0.2):
            assert loss(w + step * np.eye(6)[k]) > loss(w) * 0.9


def test_ordinal_scores_are_recomputed(documents):
    texts = [t for t, _ in documents[:60]]
    rated = [t + " spam" * 3 + " trash nonsense" for t in texts[::3]] + [t + " dull filler" for t in texts[1::3]] + texts[2::3]
    grades = [0] * len(texts[::3]) + [1] * len(texts[1::3]) + [2] * len(texts[2::3])
    model = quality.fit_sample([quality.features(t) for t in rated], grades)
    assert list(model.thresholds) == sorted(model.thresholds)
    for text in [*rated[::7], "", "unseen words only"]:
        words = {w.strip(quality.STRIPPED) for w in text.encode().lower().split()} - {b""}
        score = sum(model.weights[cell] for cell in {zlib.crc32(w) & ((1 << quality.BITS) - 1) for w in words})
        score += quality.SHAPE_VALUE * sum(model.weights[c] for c in quality.features(text) if c >= 1 << quality.BITS)
        above = [1 / (1 + math.exp(-max(-35.0, min(35.0, score - t)))) for t in model.thresholds]
        expected, tail = model.judge(text, 2)
        assert expected == pytest.approx(sum(above)) and tail == pytest.approx(above[1])
        assert sum(p * g for p, g in zip([1 - above[0], above[0] - above[1], above[1]], (0, 1, 2), strict=True)) == pytest.approx(expected)
