"""Language identification in two steps: the family first, then the language within it.

Texts become hashed character n-gram counts (lengths 1 to 3, lower case, ASCII
digits and signs as one), square-rooted and scaled to unit length. Languages
are grouped into families by how alike their mean vectors are. One linear
support vector machine per family separates it from the others; within a
family one per pair of languages decides by vote.

Every labelled row teaches. The families come from the mean vectors of all
rows. The rows are then dealt by hash into blocks of about ``BLOCK_ROWS``; every
block fits each machine on its own rows, and a machine's weights are their mean
over the blocks, each weighed by the rows of its rarer side. A language with
too few rows to give each block ``LEAST_ROWS`` has its rows dealt to several
blocks, up to all, so that every block holds every language. Every text is
predicted, from the whole text and nothing else.

The score tells the learned languages apart and says nothing of others, so a
stage that keeps identified documents also asks how many of a text's letter
trigrams training knows (:func:`known_share`): noise, code and unlearned
languages and scripts hold few. Trigrams are counted over all labelled rows that
teach, and the least share is calibrated per language on all that do not, with
room for chance in short texts. The driver sees a vector per language and
machine, the known trigrams and a histogram of shares per language.

Cases: a text that is null or has no letter (Unicode L*: no number signs) is ``und`` with score 0; so is
every text where there is nothing to learn from. Rows without an id or a label
teach nothing. Repeated rows are predicted alike and teach once. Very long
texts are counted in full, in slices. Columns other than those named are passed on untouched
by :func:`with_language`.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import staged

BITS = 12             # hashed n-gram cells: 2 ** BITS
LONGEST_GRAM = 3
BLOCK_ROWS = 3000     # labelled rows that a machine is fitted on at once, about
LEAST_ROWS = 50       # rows of a language in a block, about, where it has fewer for all blocks
PENALTY = 10.0        # cost of a margin violation
EPOCHS = 12
SHARPNESS = 4.0       # of the logistic curve from a margin to a probability
SLICE_CHARS = 200_000
MIN_SCORE = 0.3       # below it a stage that keeps identified documents rejects
KNOWN_IN = 0.001          # a known trigram is in this share of a language's texts
GRAMS_AT_ONCE = 1 << 21   # trigrams that a task holds before it counts them
SHARE_STEPS = 10_000      # steps of the histogram of shares
CLEAN_QUANTILE = 0.01     # of the calibration rows' shares of a language ...
CLEAN_SLACK = 0.85        # ... times this is the least share
CHANCE = 2.0              # standard errors below it that a short text may fall
UNDETERMINED = "und"

WORD_SIGN = re.compile(r"\w")   # letters, and signs that only look like numbers or letters
_PLAIN = np.array([c if chr(c).isalpha() else 0x20 for c in range(128)], dtype=np.uint32)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for documents that teach nothing: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def features(text: str) -> np.ndarray:
    """Unit vector of hashed n-gram counts of a whole text."""
    counts = np.zeros(1 << BITS)
    for start in range(0, len(text), SLICE_CHARS):
        # a slice carries on the last characters of the one before, so no n-gram is lost or doubled
        lead = min(start, LONGEST_GRAM - 1)
        piece = text[start - lead:start + SLICE_CHARS].lower()
        code = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        code = np.where(code < 128, _PLAIN[np.minimum(code, 127)], code).astype(np.uint32)
        gram = np.zeros(len(code), dtype=np.uint32)
        for n in range(1, LONGEST_GRAM + 1):
            gram = (gram[:len(gram) - (n > 1)] * np.uint32(0x01000193) + code[n - 1:] + np.uint32(n)).astype(np.uint32)
            own = gram[max(0, lead - n + 1):]
            cell = (own * np.uint32(0x9E3779B1)).astype(np.uint32) >> np.uint32(32 - BITS)
            counts += np.bincount(cell, minlength=1 << BITS)
    counts = np.sqrt(counts)
    norm = np.sqrt(counts @ counts)
    return (counts / norm if norm else counts).astype(np.float32)


def trigrams(text: str) -> np.ndarray:
    """Letter trigrams of a whole text, as often as they occur: code points packed into 63 bits, words padded with blanks."""
    found = [np.zeros(0, dtype=np.int64)]
    for start in range(0, len(text), SLICE_CHARS):
        lead = min(start, 2)
        piece = text[start - lead:start + SLICE_CHARS].lower()
        code = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        code = np.where(code < 128, _PLAIN[np.minimum(code, 127)], code).astype(np.int64)
        code = np.concatenate([[0x20] * (start == 0), code, [0x20] * (start + SLICE_CHARS >= len(text))]).astype(np.int64)
        a, b, c = code[:-2], code[1:-1], code[2:]
        found.append((a << 42 | b << 21 | c)[b != 0x20])
    return np.concatenate(found)


def known_share(text: str, known: np.ndarray) -> tuple[float, int]:
    """Share of a text's letter trigrams that are in ``known`` (sorted), and their number."""
    grams = trigrams(text)
    if not len(grams) or not len(known):
        return 0.0, len(grams)
    at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    return float(np.mean(known[at] == grams)), len(grams)


def has_letter(text: str | None) -> bool:
    """Whether some code point is a letter (Unicode categories L*)."""
    return text is not None and any(m.group().isalpha() for m in WORD_SIGN.finditer(text))


def svm(x: np.ndarray, rows: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Weights (the last one is the bias) of a linear support vector machine on some rows, by dual coordinate descent.

    ``x`` is read in place, so the sample is held once however many machines are fitted.
    """
    y = np.where(positive, 1.0, -1.0)
    # classes of unequal size weigh the same
    cost = PENALTY * np.where(positive, 1.0 / max(1, positive.sum()), 1.0 / max(1, (~positive).sum())) * len(y) / 2
    alpha, w, bias = np.zeros(len(y)), np.zeros(x.shape[1], dtype=x.dtype), 0.0
    square = np.einsum("ij,ij->i", x, x)[rows] + 1.0
    random = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in random.permutation(len(y)):
            own = x[rows[i]]
            new = min(max(alpha[i] - (y[i] * (float(w @ own) + bias) - 1.0) / square[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w += x.dtype.type(step) * own
                bias += step
                alpha[i] = new
    return np.append(w, bias).astype(np.float32)


def group_families(means: dict[str, np.ndarray]) -> list[list[str]]:
    """Languages merged by average likeness of their means until about sqrt(n) families are left."""
    families = [[name] for name in sorted(means)]
    wanted = max(2, round(len(families) ** 0.5))
    while len(families) > wanted:
        pairs = [(np.mean([means[p] @ means[q] / (np.linalg.norm(means[p]) * np.linalg.norm(means[q]) + 1e-12) for p in a for q in b]), -i, -j)
                 for i, a in enumerate(families) for j, b in enumerate(families[:i])]
        _, i, j = max(pairs)
        families[-j] = sorted(families[-j] + families.pop(-i))
    return families


@dataclass
class LanguageModel:
    """Families of languages, a weight row per family and per pair within one."""

    families: list[list[str]] = field(default_factory=list)
    family_weights: np.ndarray | None = None
    pairs: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    pair_weights: dict[int, np.ndarray] = field(default_factory=dict)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.families or not has_letter(text):
            return UNDETERMINED, 0.0
        x = np.append(features(text), np.float32(1.0))
        family, score = 0, 1.0
        if len(self.families) > 1:
            margins = SHARPNESS * (self.family_weights @ x)
            family = int(margins.argmax())
            odds = np.exp(margins - margins.max())
            score = float(odds[family] / odds.sum())
        names = self.families[family]
        if len(names) == 1:
            return names[0], score
        votes, sure = np.zeros(len(names)), np.zeros(len(names))
        for (a, b), margin in zip(self.pairs[family], self.pair_weights[family] @ x, strict=True):
            chance = 1.0 / (1.0 + np.exp(-SHARPNESS * margin))
            votes[a if margin >= 0 else b] += 1
            sure[a] += chance
            sure[b] += 1.0 - chance
        best = int(np.lexsort((-np.arange(len(names)), sure, votes))[-1])
        return names[best], score * float(sure[best]) / (len(names) - 1)


def machines(families: list[list[str]]) -> list[tuple[list[str], list[str]]]:
    """(languages of the positive side, of the negative side): one machine per family, then one per pair within each."""
    names = [name for family in families for name in family]
    sides = [(family, [n for n in names if n not in family]) for family in families] if len(families) > 1 else []
    return sides + [([a], [b]) for family in families for i, a in enumerate(family) for b in family[i + 1:]]


def fit_block(x: np.ndarray, languages: list[str], families: list[list[str]]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(machine, rows of its rarer side, weights) of the machines that have rows on both sides."""
    label = np.array(languages)
    for number, (one, other) in enumerate(machines(families)):
        positive, negative = np.isin(label, one), np.isin(label, other)
        rarer = int(min(positive.sum(), negative.sum()))
        if rarer:
            rows = np.flatnonzero(positive | negative)
            yield number, rarer, svm(x, rows, positive[rows])


def assembled(families: list[list[str]], weights: dict[int, np.ndarray]) -> LanguageModel:
    """Model of the families with the weights of :func:`machines`."""
    model = LanguageModel(families)
    number = len(families) if len(families) > 1 else 0
    if number:
        model.family_weights = np.stack([weights[k] for k in range(number)])
    for k, names in enumerate(families):
        if len(names) > 1:
            model.pairs[k] = [(a, b) for a in range(len(names)) for b in range(a + 1, len(names))]
            model.pair_weights[k] = np.stack([weights[number + i] for i in range(len(model.pairs[k]))])
            number += len(model.pairs[k])
    return model


def fit_sample(x: np.ndarray, languages: list[str]) -> LanguageModel:
    """Model from the vectors and labels of one block."""
    if not languages:
        return LanguageModel()
    label = np.array(languages)
    families = group_families({name: x[label == name].mean(axis=0) for name in set(languages)})
    return assembled(families, {number: w for number, _, w in fit_block(x, languages, families)})


def labelled(docs: DataFrame, teaches: Column) -> DataFrame:
    """(doc_id, lang, text) of the labelled rows for which ``teaches`` holds."""
    known = F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    return docs.where(teaches & known).select("doc_id", "lang", "text")


def _unpacked(vectors: pd.Series) -> np.ndarray:
    out = np.empty((len(vectors), 1 << BITS), dtype=np.float32)
    for row, vector in zip(out, vectors, strict=True):
        row[:] = np.frombuffer(zlib.decompress(vector), dtype=np.float16)
    return out


def added_up(parts: Iterable[tuple]) -> Iterator[pd.DataFrame]:
    """One frame (key, weight, total): sums of the weights and vectors of ``parts`` (key, weight, vector) by key."""
    sums: dict = {}
    for key, weight, part in parts:
        n, vector = sums.get(key, (0, 0.0))
        sums[key] = n + weight, vector + part
    if sums:
        yield pd.DataFrame([(k, n, v.tobytes()) for k, (n, v) in sums.items()], columns=["key", "weight", "total"])


def mean_vectors(rows: DataFrame) -> dict:
    """{key: (weight, mean vector)} of rows (key, weight, total) that their tasks have added up, added up by key."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from added_up((k, n, np.frombuffer(total)) for b in batches for k, n, total in zip(b["key"], b["weight"], b["total"], strict=True))

    return {r["key"]: (r["weight"], np.frombuffer(bytes(r["total"])) / r["weight"])
            for r in rows.repartition("key").mapInPandas(add, rows.schema).collect()}


def whole_blocks(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The blocks of rows that come in order of (_block, lang, doc_id, x), one at a time; a repeated row once."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        for number, rows in batch.groupby("_block", sort=False):
            if held and held[0]["_block"].iat[0] != number:
                yield pd.concat(held, ignore_index=True).drop_duplicates(["lang", "doc_id"])
                held = []
            held.append(rows.drop_duplicates(["lang", "doc_id"]))
    if held:
        yield pd.concat(held, ignore_index=True).drop_duplicates(["lang", "doc_id"])


def fit(teaching: DataFrame) -> LanguageModel:
    """Fit on all rows (doc_id, lang, text): families by the means of all, machines by blocks.

    No task has two Python steps in a row: each would hold a worker process of its own.
    """

    @F.pandas_udf("binary")
    def vector(texts: pd.Series) -> pd.Series:
        return pd.Series([zlib.compress(features(t).astype(np.float16).tobytes(), 1) if has_letter(t) else None for t in texts], dtype=object)

    # A filter on a function that counts as deterministic would be pushed below the selection, and it would run twice.
    vector = vector.asNondeterministic()

    def by_language(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from added_up((lang, len(own), _unpacked(own).sum(axis=0, dtype=float)) for batch in batches for lang, own in batch.groupby("lang")["x"])

    rows = staged(teaching.select("doc_id", "lang", vector("text").alias("x")).where("x is not null"), "language-vectors")
    means = mean_vectors(rows.select("lang", "x").mapInPandas(by_language, "key string, weight long, total binary"))
    if not means:
        return LanguageModel()
    families = group_families({lang: mean for lang, (_, mean) in means.items()})
    blocks = -(-sum(n for n, _ in means.values()) // BLOCK_ROWS)
    copies = {lang: min(blocks, -(-LEAST_ROWS * blocks // n)) for lang, (n, _) in means.items()}
    copies = F.create_map(*[F.lit(v) for pair in copies.items() for v in pair])[F.col("lang")]

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from added_up((k, rarer, rarer * w.astype(float)) for block in whole_blocks(batches)
                            for k, rarer, w in fit_block(_unpacked(block["x"]), block["lang"].tolist(), families))

    place = F.xxhash64(F.col("doc_id").cast("string"), "lang")
    dealt = rows.withColumn("_copy", F.explode(F.sequence(F.lit(0), copies - 1))).select(
        F.pmod(place + F.col("_copy"), F.lit(blocks)).alias("_block"), "doc_id", "lang", "x").repartition(blocks, "_block")
    ordered = dealt.sortWithinPartitions("_block", "lang", "doc_id", "x")
    fitted = mean_vectors(ordered.mapInPandas(learn, "key int, weight long, total binary"))
    return assembled(families, {k: w.astype(np.float32) for k, (_, w) in fitted.items()})


def known_grams(teaching: DataFrame) -> np.ndarray:
    """Sorted trigrams that enough texts of some language hold; the share that is enough bounds their number."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def counts() -> pd.DataFrame:
            parts = []
            for lang, grams in held.items():
                gram, n = np.unique(np.concatenate(grams), return_counts=True)
                parts.append(pd.DataFrame({"lang": lang, "gram": gram, "n": n}))
            return pd.concat(parts, ignore_index=True)

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                own = np.unique(trigrams(text))
                held.setdefault(lang, []).append(own)
                size += len(own)
                if size >= GRAMS_AT_ONCE:
                    yield counts()
                    held, size = {}, 0
        if held:
            yield counts()

    texts = {r["lang"]: r["n"] for r in teaching.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not texts:
        return np.zeros(0, dtype=np.int64)
    enough = F.create_map(*[F.lit(v) for lang, n in texts.items() for v in (lang, max(1, int(np.ceil(KNOWN_IN * n))))])[F.col("lang")]
    sums = teaching.select("lang", "text").mapInPandas(counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return np.sort(sums.where(F.col("n") >= enough).select("gram").distinct().toPandas()["gram"].to_numpy(dtype=np.int64))


def least_shares(calibration: DataFrame, known: np.ndarray) -> dict[str | None, float]:
    """Least share of known trigrams by language; under None that of a language without calibration rows.

    The quantile of all rows, to a step of their histogram.
    """
    shared = calibration.sparkSession.sparkContext.broadcast(known)

    @F.pandas_udf("int")
    def step(texts: pd.Series) -> pd.Series:
        return pd.Series([int(known_share(t, shared.value)[0] * SHARE_STEPS) if has_letter(t) else None for t in texts], dtype="Int32")

    step = step.asNondeterministic()  # else it runs twice, for the filter and for the column
    steps = calibration.select("lang", step("text").alias("step")).where("step is not null")
    rows = steps.groupBy("lang", "step").agg(F.count(F.lit(1)).alias("n")).collect()  # ``SHARE_STEPS`` rows a language at most
    counts: dict[str | None, np.ndarray] = {None: np.zeros(SHARE_STEPS + 1, dtype=np.int64)}
    for r in rows:
        for lang in (r["lang"], None):
            counts.setdefault(lang, np.zeros(SHARE_STEPS + 1, dtype=np.int64))[r["step"]] += r["n"]

    def quantile(n: np.ndarray) -> float:
        return float(np.searchsorted(np.cumsum(n), int(CLEAN_QUANTILE * (n.sum() - 1)), side="right")) / SHARE_STEPS

    return {lang: CLEAN_SLACK * quantile(n) if n.any() else 0.0 for lang, n in counts.items()}


def is_known(text: str | None, lang: str, known: np.ndarray, least: dict[str | None, float]) -> bool:
    """Whether enough of a text's trigrams are known for the language that it was given."""
    if not has_letter(text):
        return False
    share, n = known_share(text, known)
    level = least.get(lang, least[None])
    return share > 0 and share >= level - CHANCE * (level * (1.0 - level) / n) ** 0.5


def with_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``_language``: a struct of lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    return docs.withColumn("_language", predicted("text"))


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    rows = docs.select("doc_id", "text", "lang")
    model = fit(labelled(rows, ~held_out()))
    out = with_language(rows.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "_language.lang_pred", "_language.score")


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` in a learned language, identified with at least ``min_score``; same columns."""
    teaching = labelled(docs, ~held_out())
    model, known = fit(teaching), known_grams(teaching)
    shared = docs.sparkSession.sparkContext.broadcast((model, known, least_shares(labelled(docs, held_out()), known)))

    @F.pandas_udf("boolean")
    def identified(texts: pd.Series) -> pd.Series:
        model, known, least = shared.value

        def keeps(text: str | None) -> bool:
            lang, score = model.predict(text)
            return lang != UNDETERMINED and score >= min_score and is_known(text, lang, known, least)

        return pd.Series([keeps(t) for t in texts], dtype=bool)

    return docs.where(identified("text"))
