"""Personal data in whole texts: patterns, and a character BiLSTM-CRF that adds what they miss.

Kinds: email, ip, card, phone. The base spans follow fixed patterns, leftmost
and non-overlapping per kind; a match that fails its check (address parts,
number of digits, Luhn sum) is dropped and not tried again in part. The tagger
(:mod:`tabsmith.llm.tagger`) adds spans in other spellings (``name (at) host
(dot) com``, ``10[.]0[.]0[.]1``, national phone numbers, dotted card numbers)
and those that a greedy pattern lost to a neighbour (a phone number followed by
a card number). A tagged span stays if it passes :func:`acceptable` and touches
no base span. It shows in ``spans`` alone: counts and digest are of the base spans.

Training. Labelled spans are written into short passages of the corpus by rule,
in the spellings above, beside things that look alike and are none (hex tokens,
dates, versions, order numbers); base spans in
the passages are labelled as well. At most ``SAMPLE_PASSAGES`` passages are
taken, by the least hashes of id and text, and fitted in one executor task; only the
weights, some 30 kB, pass through the driver.

Decoding. Each kind of span holds a digit or an at sign, spelled or not, so a
place farther than ``CONTEXT`` from all of these is outside every span. The
rest of a text, cut nowhere else, is read in windows of ``WINDOW`` that overlap
by ``OVERLAP``; the scores of two windows are averaged where they overlap, each
weighed by its distance from the window's edge, and one Viterbi pass over the
whole stretch reconciles all windows. Memory is bounded by the
windows of one group of texts (``GROUP_CHARS``) or by one longer text.

Cases: a null or empty text has no spans (the digest of no text); texts are
read whole, whatever their length, in time linear in it; equal texts have equal
spans; repeated rows and null ids stay as they are; an empty table gives no
rows; without any text there is nothing to tag, and nothing is trained.
Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import io
import re
from collections.abc import Iterator
from random import Random
from string import ascii_lowercase

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import fitted_in_task, sampled
from tabsmith.llm.tagger import Tagger, classes_of, new_tagger, train

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

SAMPLE_PASSAGES, PASSAGE_CHARS = 3000, 240
HIDDEN, SEED = 16, 71
TRAIN_STEPS, TRAIN_WIDTH, TRAIN_LENGTH, RATE = 400, 64, 72, 0.03

CONTEXT, WINDOW, OVERLAP = 48, 256, 64
GROUP_CHARS, WINDOWS_AT_ONCE = 1 << 21, 1024

LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
FOUR_PARTS = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
DIGIT_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE_CHAIN = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SPELLED_AT = re.compile(r"[(\[{] ?at ?[)\]}]", re.IGNORECASE)
SPELLED_DOT = re.compile(r" ?[(\[{] ?(?:dot|\.) ?[)\]}] ?| \. ", re.IGNORECASE)


# --- spans by pattern --------------------------------------------------------

def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _part_fits(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) <= 3 and int(short or 0) <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each at sign with a host behind it, and all of the local part before it."""
    free = 0
    for host in HOST.finditer(text):
        at = start = host.start()
        while start > free and text[start - 1] in LOCAL_PART:
            start -= 1
        if start < at:
            yield start, host.end()
            free = host.end()


def ips(text: str) -> Iterator[tuple[int, int]]:
    # A match takes all of its last run of digits, so that the next one begins at the start of a run.
    for m in FOUR_PARTS.finditer(text):
        if all(_part_fits(p) for p in m.group().split(".")):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in DIGIT_CHAIN.finditer(text):
        digits = digits_of(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE_CHAIN.finditer(text):
        if 9 <= len(digits_of(m.group())) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the spans that the patterns give, in order."""
    if not text:
        return []
    return sorted((start, kind, end) for kind, found in enumerate((emails, ips, cards, phones)) for start, end in found(text))


def acceptable(kind: int, text: str, start: int, end: int) -> bool:
    """Whether a tagged span is one of its kind in some spelling, and no part of a longer word or number."""
    span = text[start:end]
    if (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum()):
        return False
    if kind == EMAIL:
        plain = SPELLED_DOT.sub(".", SPELLED_AT.sub("@", span)).replace(" @", "@").replace("@ ", "@")
        return next(emails(plain), None) == (0, len(plain))
    if kind == IP:
        plain = SPELLED_DOT.sub(".", span)
        return next(ips(plain), None) == (0, len(plain))
    digits = digits_of(span)
    if not digits or not (span[-1].isdigit() and (span[0].isdigit() or span[0] in "+(")):
        return False
    if kind == CARD:
        return 12 <= len(digits) <= 19 and luhn(digits) and bool(re.fullmatch(r"[0-9](?:[ ./·-]{0,2}[0-9])+", span))
    spaced = span[0] in "+(" or digits.startswith("00") or bool(re.search(r"[0-9][ ./()-]+[0-9]", span))
    return spaced and 9 <= len(digits) <= 15 and bool(re.fullmatch(r"\+?[0-9(](?:[ ./()-]{0,3}[0-9])+", span))


# --- labelled spans for training --------------------------------------------

def _number(random: Random, n: int) -> str:
    return "".join(random.choices("0123456789", k=n))


def _word(random: Random, low: int = 3, high: int = 9) -> str:
    return "".join(random.choices(ascii_lowercase, k=random.randrange(low, high)))


def _pick(random: Random, *choices: str) -> str:
    return random.choice(choices)


def written_span(random: Random, kind: int) -> str:
    """A made-up value of a kind in one of its spellings."""
    if kind == EMAIL:
        local = _pick(random, _word(random), f"{_word(random)}.{_word(random)}", f"{_word(random)}{_number(random, 2)}",
                      f"{_word(random)}.{_number(random, 2)}", f"{_word(random)}_{_word(random)}", f"{_word(random)}+{_word(random)}")
        at = _pick(random, "@", "@", " @ ", "(at)", " (at) ", "[at]", " [at] ", " [ at ] ", "{at}")
        dot = _pick(random, ".", ".") if at == "@" else _pick(random, ".", "(dot)", " (dot) ", "[dot]", " [dot] ")
        host = _pick(random, _word(random), f"{_word(random)}{_number(random, 1)}", f"{_word(random)}-{_word(random)}")
        parts = [host, *([_word(random)] if random.random() < 0.4 else []), _pick(random, "com", "org", "net", "de", "fr", "es", "io", "edu")]
        return local + at + dot.join(parts)
    if kind == IP:
        return _pick(random, ".", ".", ".", "[.]", " . ", "(.)", " [.] ").join(str(random.randrange(256)) for _ in range(4))
    if kind == CARD:
        body = _pick(random, "4", "5", "37", "6") + _number(random, random.choice([13, 14, 14, 14, 15]))
        digits = next(body + str(d) for d in range(10) if luhn(body + str(d)))
        gap = _pick(random, "", "", "", " ", "-", ".", "/", "  ")
        return gap.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    a, b, c = _number(random, 3), _number(random, 3), _number(random, 4)
    country = _pick(random, "+1", "+49", "+33", "+34", "+44", "0049", "001")
    return _pick(random, f"{country} ({a}) {b}-{c}", f"{country} {a} {b} {c}", f"{country}-{a}-{b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}",
                 f"{a}.{b}.{c}", f"0{a}/{b}{c}", f"0{a} {b} {c}", f"+{_number(random, 11)}", f"{country} {a}/{b} {c}")


def lookalike(random: Random) -> str:
    """Something with digits or at signs that is no personal data. Digit sums are left to :func:`acceptable`."""
    hexes = "".join(random.choices("0123456789abcdef", k=random.randrange(8, 41)))
    year = str(random.randrange(1900, 2100))
    return _pick(random, hexes, f'"{hexes}"', f"AKIA{hexes[:16].upper()}", f"password={hexes}", f"{year}-{_number(random, 2)}-{_number(random, 2)}",
                 f"{_number(random, 1)}.{_number(random, 1)}.", f"v{_number(random, 1)}.{_number(random, 2)}.{_number(random, 1)}",
                 _number(random, random.randrange(1, 9)), f"{_number(random, 3)}.{_number(random, 2)} EUR", f"@{_word(random)}",
                 f"{_number(random, 2)}:{_number(random, 2)}", f"#{_number(random, 5)}", f"{_number(random, 1)},{_number(random, 3)}",
                 f"{year}-{int(year) + 1}", f"{_number(random, 2)} @ {_number(random, 1)}.{_number(random, 2)}", f"ISBN {_number(random, 10)}")


def training_row(random: Random, passages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Classes and tags of ``TRAIN_LENGTH`` letters: a passage with written spans and lookalikes."""
    passage = random.choice(passages)
    offset = random.randrange(max(1, len(passage) - TRAIN_LENGTH))
    passage = passage[offset:offset + 2 * TRAIN_LENGTH]
    text, tags = "", []

    def add(part: str, kind: int | None = None) -> None:
        nonlocal text
        text += part
        if kind is None:
            own = [0] * len(part)
            for start, k, end in base_spans(part):
                own[start:end] = [1 + 2 * k] + [2 + 2 * k] * (end - start - 1)
        else:
            own = [1 + 2 * kind] + [2 + 2 * kind] * (len(part) - 1)
        tags.extend(own)

    cut = random.randrange(40)
    add(passage[:cut].rsplit(" ", 1)[0])
    for _ in range(random.randrange(1, 4)):
        add(_pick(random, " ", " ", " ", ", ", ": ", "\n", " ("))
        draw = random.random()
        if draw < 0.6:
            kind = random.randrange(4)
            add(written_span(random, kind), kind)
        elif draw < 0.9:
            add(lookalike(random))
        if random.random() < 0.6:
            more = random.randrange(4, 30)
            add(_pick(random, " ", " ", ". ", ", ", ") ") + passage[cut:cut + more])
            cut += more
    add(" " + passage[cut:])
    while len(text) < TRAIN_LENGTH:
        add(" " + _word(random))
    return classes_of(text[:TRAIN_LENGTH]), np.array(tags[:TRAIN_LENGTH])


def fitted(passages: list[str]) -> Tagger:
    random = Random(SEED)
    tagger = new_tagger(len(KINDS), HIDDEN, SEED)

    def batches():
        for _ in range(TRAIN_STEPS):
            rows = [training_row(random, passages) for _ in range(TRAIN_WIDTH)]
            yield np.stack([c for c, _ in rows], axis=1), np.stack([t for _, t in rows], axis=1)

    train(tagger, batches(), RATE, TRAIN_STEPS)
    return tagger


def packed(tagger: Tagger) -> bytes:
    out = io.BytesIO()
    np.savez(out, hidden=tagger.hidden, **tagger.weights)
    return out.getvalue()


def unpacked(data: bytes) -> Tagger:
    with np.load(io.BytesIO(data)) as stored:
        weights = {k: stored[k] for k in stored.files}
    return Tagger(int(weights.pop("hidden")), weights)


def fit(docs: DataFrame) -> bytes:
    """Weights trained on passages of ``docs``, in one executor task."""
    text = F.col("text")
    # A passage lies around the first digit or at sign of a text, in other texts at a place chosen by the hash.
    first = F.coalesce(F.regexp_instr(text, F.lit("[0-9@]")), F.lit(0))
    place = F.when(first > 0, first - PASSAGE_CHARS // 3).otherwise(F.pmod(F.col("hash"), F.length(text)))
    passages = (docs.where(F.length(text) > 0).select("doc_id", text, F.xxhash64("doc_id", text).alias("hash"))
                .select("hash", F.substring(text, F.greatest(place, F.lit(1)).cast("int"), F.lit(PASSAGE_CHARS)).alias("passage")))
    return fitted_in_task(sampled(passages, F.col("hash"), SAMPLE_PASSAGES).select("passage"),
                          lambda rows: packed(new_tagger(len(KINDS), HIDDEN, SEED) if rows is None else fitted(rows["passage"].tolist())))


# --- decoding -----------------------------------------------------------------

def stretches(text: str) -> list[tuple[int, int]]:
    """The parts of a text within ``CONTEXT`` of a digit or an at sign."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    marks = np.flatnonzero((codes - np.uint32(48) < 10) | (codes == 64))
    spelled = [m.start() for m in SPELLED_AT.finditer(text)]
    if spelled:
        marks = np.sort(np.concatenate((marks, spelled)))
    if not len(marks):
        return []
    gaps = np.flatnonzero(np.diff(marks) > 2 * CONTEXT)
    starts, ends = marks[np.append(0, gaps + 1)], marks[np.append(gaps, len(marks) - 1)]
    return [(max(0, int(a) - CONTEXT), min(len(text), int(b) + CONTEXT + 1)) for a, b in zip(starts, ends, strict=True)]


def windows(length: int) -> list[tuple[int, int]]:
    """Overlapping windows over a stretch."""
    stride = WINDOW - OVERLAP
    count = max(1, -(-(length - OVERLAP) // stride))
    return [(i * stride, min(length, i * stride + WINDOW)) for i in range(count)]


def stretch_scores(tagger: Tagger, rows: list[np.ndarray]) -> list[np.ndarray]:
    """Scores of whole stretches, from those of their windows."""
    cut = [(i, a, b) for i, row in enumerate(rows) for a, b in windows(len(row))]
    total = [np.zeros((len(row), tagger.tags), np.float32) for row in rows]
    weight = [np.zeros((len(row), 1), np.float32) for row in rows]
    cut.sort(key=lambda w: w[1] - w[2])
    for n in range(0, len(cut), WINDOWS_AT_ONCE):
        some = cut[n:n + WINDOWS_AT_ONCE]
        for (i, a, b), scores in zip(some, tagger.emissions([rows[i][a:b] for i, a, b in some]), strict=True):
            near_edge = np.minimum(np.arange(1, b - a + 1), np.arange(b - a, 0, -1))[:, None].astype(np.float32)
            total[i][a:b] += scores * near_edge
            weight[i][a:b] += near_edge
    return [t / w for t, w in zip(total, weight, strict=True)]


def tagged_runs(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the runs of a tag row."""
    found, n = [], len(tags)
    starts = np.flatnonzero(tags % 2 == 1)
    for start in starts:
        end = start + 1
        while end < n and tags[end] == tags[start] + 1:
            end += 1
        found.append((int(start), int(tags[start]) // 2, int(end)))
    return found


def spans_of(tagger: Tagger, texts: list[str]) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    added: list[list] = [[] for _ in texts]
    at = [(i, a, b) for i, t in enumerate(texts) for a, b in stretches(t)]
    if at:
        scores = stretch_scores(tagger, [classes_of(texts[i][a:b]) for i, a, b in at])
        for (i, a, _), tags in zip(at, tagger.best_tags(scores), strict=True):
            for start, kind, end in tagged_runs(tags):
                start, end = start + a, end + a
                if acceptable(kind, texts[i], start, end) and not any(s < end and start < e for s, _, e in base[i]):
                    added[i].append((start, kind, end))
    return [(b, sorted(b + more)) for b, more in zip(base, added, strict=True)]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _row(base: list, spans: list) -> tuple:
    counts = [sum(kind == k for _, kind, _ in base) for k in range(len(KINDS))]
    return (*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))


RESULT = {**{f"n_{kind}": "long" for kind in KINDS}, "base_sha256": "string", "spans": "string"}


def _groups(texts: list[str]) -> Iterator[list[str]]:
    """Texts in order, in groups of about ``GROUP_CHARS``."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > GROUP_CHARS:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def find_spans(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_<kind> and base_sha256 of the base spans, and all spans."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    model = fit(rows)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = unpacked(model)
        for batch in batches:
            found = [_row(*spans) for group in _groups(batch["text"].tolist()) for spans in spans_of(tagger, group)]
            yield pd.DataFrame(found, columns=list(RESULT)).assign(doc_id=batch["doc_id"].to_numpy())[["doc_id", *RESULT]]

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(find, f"doc_id {id_type}, " + ", ".join(f"{k} {v}" for k, v in RESULT.items()))
