"""Spelling variants: words of a corpus one edit apart, grouped under their most frequent form.

Words are counted in Spark. Two words are near if they differ by exactly one
inserted, deleted or replaced code point. A word's form is its near word of
largest count (ties: smallest in code-point order) where that count is at least
``FORM_RATIO`` times its own; its root is where the forms lead.

Near words come from bidirectional FM-index search schemes. One edit leaves
either half of a word untouched, so the half is matched exactly, from the
middle outwards, and the search goes on across the other half with one error.
The index of a block of words is over ``$word$word$...$``: a suffix array gives
the Burrows-Wheeler transforms of this text and of its reverse, their rank
tables turn an interval of suffix ranks (kept for both directions at once) into
that of one more letter on either side, and the delimiters anchor both ends.
All words of a block are searched at once, one numpy step a letter.

Blocks. The vocabulary grows with the corpus, so it is sorted twice, by word
and by reversed word, and cut into blocks of about ``BLOCK_CHARS`` code points.
Words that share their first half lie together in the one order, those that
share their last half in the other. A block announces the halves that its words
may be matched by, and an equal join on the half sends each word to the blocks
that can hold a near word, seldom more than one. Where more than
``QUERIES_PER_TASK`` words come to a block, copies of it take a share each.

Cases: null texts have no words; a null id takes the place of an empty number
in the hash that picks damaged runs; texts and words of any length are whole
(a block holds at least one word); equal counts are ordered by code points; a
word without near words has no form and is its own root; an empty table, or
one without frequent words, gives no rows. Columns other than id and text are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import ascii_lower, staged

#: A run of basic Latin letters and those of the Latin-1 block from A with grave on.
RUN_PATTERN = r"[A-Za-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT = 5, 3
FORM_RATIO = 2
DAMAGED_EVERY = 97

BLOCK_CHARS = 1 << 16
QUERIES_PER_TASK = 1 << 14
LETTERS_AT_ONCE = 1 << 18
#: Counts double from form to form, so that no chain of forms is longer than the bits of a count.
CHAIN_DOUBLINGS = 6
BY_START, BY_END = 0, 1


# --- the index -------------------------------------------------------------

def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of an integer text in their order, by prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        second = np.zeros(n, dtype=np.int64)
        second[:n - step] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        new = np.empty(n, dtype=np.int64)
        new[order] = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        if new[order[-1]] == n - 1:
            return order
        rank, step = new, step * 2
        if step >= n:
            return order


def rank_table(bwt: np.ndarray, letters: int) -> np.ndarray:
    """table[i, c]: how often letter c occurs in the first i places."""
    table = np.zeros((len(bwt) + 1, letters), dtype=np.int32)
    table[np.arange(1, len(bwt) + 1), bwt] = 1
    return np.cumsum(table, axis=0, out=table)


@dataclass
class Intervals:
    """Suffix-rank intervals of patterns: starts in the text's and in the reversed text's order, and sizes."""

    lo: np.ndarray
    lo_reversed: np.ndarray
    size: np.ndarray

    def at(self, rows) -> "Intervals":
        return Intervals(self.lo[rows], self.lo_reversed[rows], self.size[rows])


END, DELIMITER = 0, 1


class WordIndex:
    """Bidirectional FM-index over delimited words."""

    def __init__(self, words: list[str]):
        self.words = words
        joined = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        self.alphabet = np.unique(joined)
        lengths = np.array([len(w) for w in words])
        text = np.full(len(joined) + len(words) + 2, DELIMITER, dtype=np.int64)
        ends = np.cumsum(lengths + 1)
        self.starts = ends - lengths - 1  # places of the delimiters before the words
        inside = np.ones(len(text), dtype=bool)
        inside[self.starts] = inside[-2:] = False
        text[inside] = np.searchsorted(self.alphabet, joined) + 2
        text[-1] = END
        letters = len(self.alphabet) + 2
        self.suffixes = suffix_array(text)
        turned = np.append(text[-2::-1], END)
        self.left_ranks = rank_table(text[self.suffixes - 1], letters)
        self.right_ranks = rank_table(turned[suffix_array(turned) - 1], letters)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=letters))))[:-1]
        self.size = len(text)

    def codes(self, word: str) -> np.ndarray:
        """Letters of a word; -1 for one that no word of the index has."""
        points = np.frombuffer(word.encode("utf-32-le"), dtype="<u4")
        place = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[place] == points, place + 2, -1)

    def whole(self, n: int) -> Intervals:
        return Intervals(np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, self.size, np.int64))

    def _counts(self, found: Intervals, left: bool) -> tuple[np.ndarray, np.ndarray]:
        """Per interval and letter: the letter's number before the interval and inside it."""
        table, lo = (self.left_ranks, found.lo) if left else (self.right_ranks, found.lo_reversed)
        first = table[lo]
        return first, table[lo + found.size] - first

    def _stepped(self, found: Intervals, first, inside, rows, letters, left: bool) -> Intervals:
        size = inside[rows, letters].astype(np.int64)
        smaller = np.cumsum(inside, axis=1)[rows, letters] - size
        main = self.before[letters] + first[rows, letters]
        if left:
            return Intervals(main, found.lo_reversed[rows] + smaller, size)
        return Intervals(found.lo[rows] + smaller, main, size)

    def by_letter(self, found: Intervals, letters: np.ndarray, left: bool) -> Intervals:
        """Each pattern with its own letter added at one side; size 0 where there is none."""
        known = letters >= 0
        first, inside = self._counts(found, left)
        step = self._stepped(found, first, inside, np.arange(len(letters)), np.where(known, letters, 0), left)
        step.size[~known] = 0
        return step

    def by_any(self, found: Intervals, left: bool) -> tuple[np.ndarray, np.ndarray, Intervals]:
        """(row, letter, interval) of every word letter that the index has at that side of a pattern."""
        first, inside = self._counts(found, left)
        rows, letters = np.nonzero(inside[:, DELIMITER + 1:])
        letters = letters + DELIMITER + 1
        return rows, letters, self._stepped(found, first, inside, rows, letters, left)

    def word_at(self, found: Intervals) -> np.ndarray:
        """Number of the word whose delimited form each interval stands for."""
        return np.searchsorted(self.starts, self.suffixes[found.lo])


def near_in_index(index: WordIndex, queries: list[str], side: int) -> tuple[np.ndarray, np.ndarray]:
    """(query number, word number) of words one edit from a query, the edit not in the query's half on ``side``.

    The half is matched exactly from the middle outwards to its delimiter, then
    the search goes the other way with one error to the other delimiter.
    """
    left_first = side == BY_START
    lengths = np.array([len(q) for q in queries])
    halves = lengths // 2 if left_first else lengths - lengths // 2
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max())
    # Letters from the middle outwards: towards the exact half's end, and towards the other end.
    exact = np.full((len(queries), int(halves.max()) + 1), -1, dtype=np.int64)
    other = np.full((len(queries), longest - int(halves.min()) + 2), -1, dtype=np.int64)
    for i, q in enumerate(queries):
        codes, cut = index.codes(q), lengths[i] // 2
        one, two = (codes[:cut][::-1], codes[cut:]) if left_first else (codes[cut:], codes[:cut][::-1])
        exact[i, :len(one)], exact[i, len(one)] = one, DELIMITER
        other[i, :len(two)], other[i, len(two)] = two, DELIMITER
    rest = lengths - halves
    query = order
    found = index.whole(len(query))
    matched_query, matched = [], []
    for t in range(exact.shape[1]):  # the exact half and its delimiter
        going = halves[query] >= t
        matched_query.append(query[~going]), matched.append(found.at(~going))
        query, found = query[going], found.at(going)
        if not len(query):
            break
        found = index.by_letter(found, exact[query, t], left=left_first)
        kept = found.size > 0
        query, found = query[kept], found.at(kept)
    matched_query.append(query), matched.append(found)
    query, found = np.concatenate(matched_query), _joined(matched)
    results = []
    done_query, done = np.empty(0, np.int64), index.whole(0)  # with one error so far, all at the same letter
    left = not left_first
    for t in range(other.shape[1]):
        live = rest[query] >= t
        query, found = query[live], found.at(live)
        past = rest[done_query] < t
        results.append((done_query[past], done.at(past)))
        done_query, done = done_query[~past], done.at(~past)
        if not len(query) and not len(done_query):
            break
        letters = other[query, t]
        rows, any_letter, grown = index.by_any(found, left)
        replaced = (any_letter != letters[rows]) & (rest[query[rows]] > t)  # not the delimiter
        # One letter too many in the word: the query's letter is still to come, in this very step.
        more_query, more = query[rows], index.by_letter(grown, letters[rows], left)
        went = index.by_letter(done, other[done_query, t], left)
        skipped = rest[query] > t  # the query's letter is missing in the word
        next_query, next_found = query[skipped], found.at(skipped)
        new_query = [done_query, more_query, query[rows][replaced]]
        new = [went, more, grown.at(replaced)]
        found = index.by_letter(found, letters, left)
        kept = found.size > 0
        query, found = query[kept], found.at(kept)
        done_query, done = np.concatenate([*new_query, next_query]), _joined([*new, next_found])
        kept = done.size > 0
        done_query, done = done_query[kept], done.at(kept)
    results.append((done_query, done))
    at = np.concatenate([q for q, _ in results])
    return at, index.word_at(_joined([f for _, f in results]))


def _joined(parts: list[Intervals]) -> Intervals:
    return Intervals(*(np.concatenate([getattr(p, name) for p in parts]) for name in ("lo", "lo_reversed", "size")))


# --- the corpus ------------------------------------------------------------

def frequent_words(docs: DataFrame, damaged_every: int | None = None) -> DataFrame:
    """(word, n) of the words of at least ``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences.

    With ``damaged_every``, a run whose crc32 with its document's id is
    divisible by it loses the code point that the crc32 picks.
    """
    found = docs.select("doc_id", F.explode(F.regexp_extract_all(F.col("text"), F.lit(RUN_PATTERN), F.lit(0))).alias("run"))
    word: Column = F.col("run")
    runs = found.withColumn("run", F.when(word.rlike("[A-Z]"), ascii_lower(word)).otherwise(word))
    if damaged_every:
        named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
        runs = runs.withColumn("hash", F.crc32(named.cast("binary")))
        place = (F.col("hash") % F.length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
        word = F.when(F.col("hash") % damaged_every == 0, cut).otherwise(F.col("run"))
    counts = runs.select(word.alias("word")).where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= MIN_COUNT)


def _half(length: Column, side: Column) -> Column:
    """Code points of the half that a search on ``side`` matches exactly."""
    return F.when(side == BY_START, F.floor(length / 2)).otherwise(F.ceil(length / 2)).cast("int")


def _numbering(block_chars: int):
    """Block numbers within a sorted range, by the code points so far."""

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, used, block, side = TaskContext.get().partitionId(), 0, 0, None
        for rows in batches:
            blocks = []
            for length, own_side in zip(rows["key"].str.len(), rows["side"], strict=True):
                if used and (own_side != side or used + length > block_chars):
                    used, block = 0, block + 1
                used, side = used + length, own_side
                blocks.append((part << 32) + block)
            yield rows.assign(block=blocks)

    return number


def blocks_of(words: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(side, key, word, n, block): the vocabulary sorted by word and by reversed word, cut into blocks."""
    sides = words.select("word", "n", F.explode(F.array(F.lit(BY_START), F.lit(BY_END))).alias("side"))
    keyed = sides.select("side", F.when(F.col("side") == BY_START, F.col("word")).otherwise(F.reverse("word")).alias("key"), "word", "n")
    ranged = keyed.repartitionByRange("side", "key").sortWithinPartitions("side", "key")
    return ranged.mapInPandas(_numbering(block_chars), "side int, key string, word string, n long, block long")


def _searched(key, words: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    if not len(words) or not len(queries):
        return pd.DataFrame({"word": [], "near": [], "near_n": []}).astype({"word": str, "near": str, "near_n": "int64"})
    index = WordIndex(words["word"].tolist())
    side, found, asked = int(words["side"].iloc[0]), [], sorted(queries["word"], key=len)
    while asked:  # words of like length together, so that the letter matrix stays small
        share = max(1, LETTERS_AT_ONCE // len(asked[-1]))
        asked, some = asked[:-share], asked[-share:]
        query, number = np.unique(np.stack(near_in_index(index, some, side)), axis=1)
        found.append(pd.DataFrame({"word": np.array(some, dtype=object)[query], "near": words["word"].to_numpy()[number],
                                   "near_n": words["n"].to_numpy()[number]}))
    return pd.concat(found)


def near_words(words: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(word, near, near_n): every word of (word, n) with every word one edit away, once."""
    blocks = staged(blocks_of(words, block_chars), "spelling-blocks")
    length = F.length("word")
    halves = [_half(length + d, F.col("side")) for d in (-1, 0, 1)]  # of queries a letter shorter, equal, longer
    announced = blocks.select("side", "block", "key", F.explode(F.array_distinct(F.array(*halves))).alias("h")).select(
        "side", "block", F.expr("substring(key, 1, h)").alias("half")).distinct()
    queries = blocks.select("side", "word", F.substring(F.col("key"), F.lit(1), _half(length, F.col("side"))).alias("half"))
    sent = staged(queries.join(announced, ["side", "half"]).select("block", "word"), "spelling-sent")
    shares = sent.groupBy("block").agg(F.ceil(F.count("*") / QUERIES_PER_TASK).cast("int").alias("shares"))
    dealt = sent.join(shares, "block").select("block", F.pmod(F.xxhash64("word"), F.col("shares")).alias("share"), "word")
    copies = blocks.join(shares, "block").select(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares").cast("long") - 1)).alias("share"), "side", "word", "n")
    pairs = copies.groupBy("block", "share").cogroup(dealt.groupBy("block", "share")).applyInPandas(
        _searched, "word string, near string, near_n long")
    return pairs.distinct()


def variant_groups(words: DataFrame) -> DataFrame:
    """One row per word of (word, n): word, form, root, n, n_near, form_n."""
    words = staged(words, "spelling-words")
    first = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w")))
    best = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), first.alias("best"))
    frequent = -F.col("best.m") >= FORM_RATIO * F.col("n")
    formed = staged(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(frequent, F.col("best.w")).alias("form"), F.when(frequent, -F.col("best.m")).alias("form_n")), "spelling-forms")
    root = formed.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(CHAIN_DOUBLINGS):
        root = staged(root, "spelling-roots")
        further = root.select(F.col("word").alias("via"), F.col("root").alias("further"))
        hops = root.join(further, F.col("root") == F.col("via"), "left")
        root = hops.select("word", F.coalesce("further", "root").alias("root"))
    return formed.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
