"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document is the set of its hashed words and of a few binned shape measures
(share of capitals, of signs, of repeated words and lines, word length). One
weight per hashed feature is shared by all grades; ordered thresholds cut the
score into grades: ``P(grade > j) = logistic(w.x - threshold[j])``. Expected
grade and tail probability ``P(grade >= g)`` select documents.

Fitted on a bounded sample of rated rows (at most ``SAMPLE_ROWS``, dealt evenly
over the grades in hash order, near copies of a sampled text left out); features
are kept that occur in ``MIN_DOCUMENTS`` of the sample and unevenly over the
grades. The fit runs in one executor task. Every document is scored from its
whole text.

Cases: a null text is empty and scored as such; with one grade to learn from
every document gets that grade, and with none grade 0 and tail probability 1,
so that nothing is rejected. Repeated rows are scored alike and teach once; a document rated
more than once teaches its lowest rating. Ratings of unknown documents and
null ratings teach nothing. Other columns are passed on untouched.
"""

from __future__ import annotations

import pickle
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import fitted_in_task, sampled

BITS = 20             # hashed word cells: 2 ** BITS
SHAPE_BINS = 12       # bins of each shape measure
SAMPLE_ROWS = 6000    # rated rows that the classifier is fitted on, at most
MIN_DOCUMENTS = 8     # of the sample that a feature must occur in
MIN_CHI_SQUARED = 40.0  # of a feature against the grades
MIN_LIFT = 2.0        # of some grade among the documents that have the feature; common words stay below
SHRINK = 1e-3         # L2 penalty of the weights
SHAPE_VALUE = 4.0   # of a shape measure against 1 of a word: there are few of them
STEPS = 250
START_GAP = 2.0       # first distance between thresholds
MIN_TAIL = 0.5        # a stage that keeps good documents rejects below it
SECOND_HASH = 0x5BD1E995
STRIPPED = b".,;:!?\"'()[]{}<>|*#-_$%&@=+~^/\\`"


def _bin(share: float) -> int:
    return min(SHAPE_BINS - 1, int(share * SHAPE_BINS))


def features(text: str | None) -> np.ndarray:
    """Distinct feature numbers of a text: hashed words, then one cell per shape measure."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.lower().split()
    mask = (1 << BITS) - 1
    distinct = {w.strip(STRIPPED) for w in set(words)}
    distinct.discard(b"")
    cells = {zlib.crc32(w) & mask for w in distinct}
    size, n = max(1, len(raw)), max(1, len(words))
    letters = max(1, sum(map(str.isalpha, text)))
    lines = text.split("\n")
    measures = (
        sum(map(str.isupper, text)) / letters,
        4.0 * (size - len(raw.translate(None, b"|!?*#$%&=<>{}[]\\/@^~_+"))) / size,
        4.0 * (size - len(raw.translate(None, b"0123456789"))) / size,
        1.0 - len(distinct) / n,
        1.0 - len(set(lines)) / len(lines),
        (size / n) / 24.0,
        np.log2(1 + n) / 20.0,
    )
    shapes = [(1 << BITS) + k * SHAPE_BINS + _bin(m) for k, m in enumerate(measures)]
    return np.array(sorted(cells) + shapes, dtype=np.int32)


N_FEATURES = (1 << BITS) + 7 * SHAPE_BINS


def _weight(cells: np.ndarray) -> np.ndarray:
    """A word that occurs counts 1, a shape measure more: there are few of them."""
    return np.where(cells < (1 << BITS), 1.0, SHAPE_VALUE)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class OrdinalModel:
    """Grades in rising order, a threshold between each two, and the shared weights."""

    grades: np.ndarray
    thresholds: np.ndarray
    weights: np.ndarray

    def above(self, cells: np.ndarray) -> np.ndarray:
        """P(grade > j) for every threshold."""
        return _logistic(self.weights[cells] @ _weight(cells) - self.thresholds)

    def judge(self, text: str | None, least: float) -> tuple[float, float]:
        """(expected grade, P(grade >= least)); nothing speaks against a text where there were no ratings."""
        if not len(self.grades):
            return 0.0, 1.0
        above = self.above(features(text))
        expected = float(self.grades[0] + above @ np.diff(self.grades))
        at = int(np.searchsorted(self.grades, least))
        tail = 1.0 if at == 0 else 0.0 if at == len(self.grades) else float(above[at - 1])
        return expected, tail


def telling(cells: np.ndarray, grade: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Features, numbered without gaps, that occur often enough and unevenly enough over the grades (chi-squared) to be learned from."""
    n, k, width = int(sizes.sum()), len(sizes), int(cells.max(initial=-1)) + 1
    seen = np.bincount(grade * width + cells, minlength=k * width).reshape(k, width)
    total = seen.sum(axis=0)
    expected = np.maximum(sizes[:, None] * total / n, 1e-9)
    chi_squared = ((seen - expected) ** 2 / expected).sum(axis=0) / np.maximum(1.0 - total / n, 1e-3)
    lift = (seen / expected).max(axis=0)
    return (total >= min(MIN_DOCUMENTS, max(1, n // 20))) & (chi_squared >= MIN_CHI_SQUARED) & (lift >= MIN_LIFT)


def fit_sample(rows: list[np.ndarray], ratings: list[int]) -> OrdinalModel:
    """Model from feature sets and ratings, by maximum penalised likelihood."""
    grades = np.array(sorted(set(ratings)), dtype=np.float64)
    if len(grades) < 2:
        return OrdinalModel(grades, np.zeros(0), np.zeros(N_FEATURES))
    y = np.searchsorted(grades, ratings)
    n, k = len(rows), len(grades)
    cells = np.concatenate(rows)
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    occurs = np.zeros(N_FEATURES, dtype=bool)
    occurs[cells] = True
    place = (np.cumsum(occurs, dtype=np.int32) - 1)[cells]  # counts by grade are kept of the sample's features only
    keep = telling(place, y[row], np.bincount(y, minlength=k))[place]
    cells, row = cells[keep], row[keep]
    values = _weight(cells)
    # every grade weighs the same, as the sample is dealt and not drawn
    importance = (n / k / np.bincount(y, minlength=k))[y]
    used, place = np.unique(cells, return_inverse=True)
    size = len(used)

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        """Penalised negative log-likelihood and its gradient; p: weights, first threshold, log gaps."""
        widths = np.exp(p[size + 1:])
        cuts = p[size] + np.concatenate([[0.0], np.cumsum(widths)])
        z = np.bincount(row, weights=p[place] * values, minlength=n)
        above = _logistic(z[:, None] - cuts)                      # n x (k - 1)
        full = np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))])
        chance = np.maximum(full[np.arange(n), y] - full[np.arange(n), y + 1], 1e-12)
        slope = np.hstack([np.zeros((n, 1)), above * (1 - above), np.zeros((n, 1))])
        scale = importance / chance / n
        upper, lower = slope[np.arange(n), y] * scale, slope[np.arange(n), y + 1] * scale
        by_cut = np.zeros((n, k + 1))
        by_cut[np.arange(n), y] += upper
        by_cut[np.arange(n), y + 1] -= lower
        by_cut = by_cut[:, 1:k].sum(axis=0)
        gradient = np.concatenate([
            np.bincount(place, weights=(lower - upper)[row] * values, minlength=size) + SHRINK * p[:size],
            [by_cut.sum()], np.cumsum(by_cut[::-1])[::-1][1:] * widths])
        return float(-(importance * np.log(chance)).sum() / n + SHRINK / 2 * (p[:size] @ p[:size])), gradient

    # a document without telling features starts in the highest grade; faults lower it
    p = minimise(loss, np.concatenate([np.zeros(size), [-START_GAP * (k - 1)], np.full(k - 2, np.log(START_GAP))]))
    weights = np.zeros(N_FEATURES)
    weights[used] = p[:size]
    return OrdinalModel(grades, p[size] + np.concatenate([[0.0], np.cumsum(np.exp(p[size + 1:]))]), weights)


def minimise(loss, p: np.ndarray) -> np.ndarray:
    """Limited-memory quasi-Newton steps with backtracking."""
    value, gradient = loss(p)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(STEPS):
        way = gradient.copy()
        coefficients = []
        for s, d, r in reversed(past):
            coefficients.append(r * (s @ way))
            way -= coefficients[-1] * d
        if past:
            s, d, _ = past[-1]
            way *= (s @ d) / (d @ d)
        for (s, d, r), c in zip(past, reversed(coefficients), strict=True):
            way += (c - r * (d @ way)) * s
        slope, step = way @ gradient, 1.0 if past else 1.0 / max(1.0, np.abs(gradient).sum())
        while step > 1e-10:
            new_value, new_gradient = loss(p - step * way)
            if new_value <= value - 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, d = -step * way, new_gradient - gradient
        if s @ d > 1e-12:
            past = [*past[-9:], (s, d, 1.0 / (s @ d))]
        done = value - new_value < 1e-7 * abs(value)
        p, value, gradient = p + s, new_value, new_gradient
        if done:
            break
    return p


def fit(docs: DataFrame, ratings: DataFrame, teaches: Column | None = None) -> OrdinalModel:
    """Fit on a bounded sample of ``ratings`` (doc_id, rating), texts taken from ``docs``."""
    rated = ratings.where(F.col("doc_id").isNotNull() & F.col("rating").isNotNull())
    rated = rated.groupBy("doc_id").agg(F.min("rating").cast("long").alias("rating"))
    if teaches is not None:
        rated = rated.where(teaches)
    ids = sampled(rated.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "rating"),
                  F.col("doc_id").cast("string"), SAMPLE_ROWS, "rating")
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # SAMPLE_ROWS rows at most

    @F.pandas_udf("x binary, near_a long, near_b long")
    def cells_of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(features(t).tobytes(), *near_keys(t)) for t in texts], columns=["x", "near_a", "near_b"])

    def learn(rows: pd.DataFrame | None) -> bytes:
        seen: set = set()
        cells, grades = [], []
        for x, a, b, rating in zip(*(rows[c] for c in ("x", "near_a", "near_b", "rating")), strict=True) if rows is not None else ():
            keys = {("a", a), ("b", b)}
            if not keys & seen:  # a text that is copied many times is one piece of evidence
                cells.append(np.frombuffer(x, dtype=np.int32))
                grades.append(rating)
            seen |= keys
        return pickle.dumps(fit_sample(cells, grades))

    rows = (chosen.select("doc_id", "rating", cells_of("text").alias("f"))
            .groupBy("doc_id", "rating").agg(F.min("f").alias("f")).orderBy("doc_id").limit(SAMPLE_ROWS))
    return pickle.loads(fitted_in_task(rows.select("rating", "f.*"), learn))


def near_keys(text: str | None) -> tuple[int, int]:
    """Two least shingle hashes: near copies share one of them most of the time."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    shingles = {b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))}
    return min(map(zlib.crc32, shingles)), min(zlib.crc32(s, SECOND_HASH) for s in shingles)


def with_quality(docs: DataFrame, model: OrdinalModel, least: float) -> DataFrame:
    """``docs`` with ``_quality``: a struct of expected_grade and tail."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("expected_grade double, tail double")
    def judged(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.judge(t, least) for t in texts], columns=["expected_grade", "tail"])

    return docs.withColumn("_quality", judged("text"))


def grade(docs: DataFrame, ratings: DataFrame, least: float, min_tail: float = MIN_TAIL, teaches: Column | None = None) -> DataFrame:
    """One row per document: doc_id, expected_grade, tail (P(grade >= least)), selected."""
    rows = with_quality(docs.select("doc_id", "text"), fit(docs, ratings, teaches), least)
    return rows.select("doc_id", "_quality.expected_grade", "_quality.tail", (F.col("_quality.tail") >= min_tail).alias("selected"))


def keep_good(docs: DataFrame, ratings: DataFrame, least: float, min_tail: float = MIN_TAIL) -> DataFrame:
    """The rows of ``docs`` with ``P(grade >= least)`` of at least ``min_tail``; same columns."""
    return with_quality(docs, fit(docs, ratings), least).where(F.col("_quality.tail") >= min_tail).drop("_quality")
