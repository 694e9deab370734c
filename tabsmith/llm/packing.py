"""Pack documents into as few sequences of fixed length as possible.

1. Tokenise (in Spark tasks) and cut: a document longer than a sequence gives
   full pieces, with its remainder first. Each piece gets its length's running
   number within its task, and is written as a small row.
2. Count pieces by length: a histogram of at most ``sequence_length`` bins,
   which is all that the driver ever sees.
3. Solve the configuration linear program over that histogram by
   multiplicative weights. A configuration is a multiset of lengths that fits
   one sequence; the program covers all pieces with as few as possible. Lengths
   are grouped into classes of like numbers of pieces, each as long as its
   longest. Every round a knapsack dynamic program over the classes' prices
   gives the best configurations, and prices follow the coverage. The mean of
   the rounds is rounded to whole sequences, shorter pieces take places that
   longer classes leave, and the residue goes by best fit into what is free.
   Should best fit alone need fewer sequences, its plan is taken. Prices over
   the best total bound the number from below (:func:`sequence_bound`).
4. Place (in Spark tasks): a piece's rank among its length, the running number
   plus the count in earlier tasks, decides its sequence and offset by
   arithmetic on the plan. No group is ever gathered.

Cases: a null or empty text is the separator id alone; repeated rows are
packed each; equal documents go anywhere; an empty table gives no rows. Extra
input columns are not read. Texts are encoded whole.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm import tokens
from tabsmith.llm.common import staged

SEQUENCE_LENGTH = 2048
SEPARATOR_ID = 0
ROUNDS = 300          # knapsack rounds of the multiplicative-weights solver
CLASSES = 128         # classes of lengths that the program is solved over
RATE = 0.02           # how fast a covered class loses price
NEAR_BEST = 0.005     # share below the best total price at which a configuration is used e times less
SCALES = (0.8, 0.9, 0.96, 1.0)  # of the fractional solution before it is rounded; the best plan is taken
LEVELS = 3            # times that the program is solved, each for what the least scale has left
ROWS_PER_BATCH = 4096


def cut(n: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: full ones, the shorter one first."""
    if n <= longest:
        return [(0, n)]
    first = n % longest or longest
    return [(0, first)] + [(start, longest) for start in range(first, n, longest)]


def pieces(docs: DataFrame, tokenizer: str, longest: int = SEQUENCE_LENGTH, with_ids: bool = False) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32[, ids], task, number)."""
    rows = docs.select("doc_id", "text")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []), "task", "number"]

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        counted = np.zeros(longest + 1, dtype=np.int64)
        out: list[tuple] = []
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.append(tokens.encode(tokenizer, text), np.uint32(SEPARATOR_ID)).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), longest)):
                    own = ids[start:start + length]
                    number = int(counted[length])
                    counted[length] += 1
                    out.append((doc_id, k, start, length, zlib.crc32(own.tobytes()), *([own.astype(np.int32)] if with_ids else []), task, number))
                if len(out) >= ROWS_PER_BATCH:
                    yield _frame(out, columns)
                    out = []
        if out:
            yield _frame(out, columns)

    id_type = rows.schema["doc_id"].dataType.simpleString()
    ids = "ids array<int>, " if with_ids else ""
    return rows.mapInPandas(encode, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, {ids}task int, number long")


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns)
    if frame["doc_id"].isna().any():
        frame["doc_id"] = frame["doc_id"].astype("Int64")
    return frame


def length_classes(counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(longest length, pieces) of runs of lengths with about equal numbers of pieces, ``most`` or a few more."""
    longest, pieces_in = [], []
    for length in np.flatnonzero(counts)[::-1].tolist():
        if not pieces_in or pieces_in[-1] * most >= counts.sum():
            longest.append(length)
            pieces_in.append(0)
        pieces_in[-1] += int(counts[length])
    return np.array(longest[::-1], dtype=np.int64), np.array(pieces_in[::-1], dtype=np.float64)


def knapsack(lengths: np.ndarray, prices: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By room: greatest total price of lengths (with repeats) that fit it, the room it uses, and a length to take there."""
    best, used, pick = np.zeros(room + 1), np.zeros(room + 1, dtype=np.int64), np.full(room + 1, -1, dtype=np.int64)
    fitting = np.searchsorted(lengths, np.arange(room + 1), side="right")
    for w in range(int(lengths[0]), room + 1):
        totals = best[w - lengths[:fitting[w]]] + prices[:fitting[w]]
        i = int(totals.argmax())
        if totals[i] > best[w - 1]:
            best[w], used[w], pick[w] = totals[i], w, i
        else:
            best[w], used[w], pick[w] = best[w - 1], used[w - 1], pick[w - 1]
    return best, used, pick


def configurations(lengths: np.ndarray, used: np.ndarray, pick: np.ndarray, room: int) -> list[np.ndarray]:
    """For every length the best configuration that holds it, as rows (owner, its lengths' indexes) step by step."""
    owner, free, steps = np.arange(len(lengths)), room - lengths, [np.stack([np.arange(len(lengths))] * 2)]
    while len(owner):
        i = pick[free]
        owner, free, i = owner[i >= 0], used[free][i >= 0], i[i >= 0]
        steps.append(np.stack([owner, i]))
        free = free - lengths[i]
    return steps


@dataclass(frozen=True)
class Relaxation:
    """A fractional solution of the configuration program over length classes, and a bound on the number of sequences."""

    lengths: np.ndarray
    uses: dict[tuple[int, ...], float]
    bound: float


def relax(counts: np.ndarray, room: int, classes: int, rounds: int) -> Relaxation:
    """Multiplicative weights on the covering program: every class is covered as often as it has pieces.

    A round prices the classes, solves the knapsack for the best configuration
    and, from the same table, for the best one with each class in it. Prices
    over the best total are a solution of the dual program, so they bound the
    number of sequences; for the bound a class counts with its own lengths'
    least. The round uses the configurations near the best total in proportion
    to their classes' pieces, and each class's price falls or rises with its
    coverage. The mean of the later rounds is the fractional solution.
    """
    lengths, pieces_in = length_classes(counts, classes)
    log_price, spread = np.log(lengths / room), np.arange(len(lengths))
    bound, uses, mean_of = 0.0, {}, rounds - rounds // 2
    for t in range(rounds):
        price = np.exp(log_price - log_price.max())
        best, used, pick = knapsack(lengths, price, room)
        value, total = price + best[room - lengths], best[room]
        least = float(pieces_in @ price / total)
        bound = max(bound, least)
        weight = pieces_in * np.exp((value / total - 1.0) / NEAR_BEST)
        weight *= least / weight.sum()
        steps = configurations(lengths, used, pick, room)
        covered = np.zeros(len(lengths))
        for owner, i in steps:
            np.add.at(covered, i, weight[owner])
        if t >= mean_of:
            held: list[list[int]] = [[] for _ in spread]
            for owner, i in steps:
                for o, k in zip(owner.tolist(), i.tolist(), strict=True):
                    held[o].append(k)
            for o in np.flatnonzero(weight > 1e-6 * least).tolist():
                key = tuple(sorted(held[o], reverse=True))
                uses[key] = uses.get(key, 0.0) + weight[o] / (rounds - mean_of)
        log_price -= RATE / (1.0 + 4.0 * t / rounds) * (np.minimum(covered / pieces_in, 5.0) - 1.0)
    return Relaxation(lengths, uses, bound)


def rounded(solution: Relaxation, counts: np.ndarray, room: int, scale: float) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """Whole sequences from the fractional solution, times ``scale``, and the pieces that they leave.

    Running sums of the uses are rounded, so that their total is kept. Places
    of a class go to its pieces, longest first, and then to shorter ones.
    """
    order = sorted(solution.uses)
    sums = np.floor(np.cumsum([solution.uses[c] for c in order]) * scale + 0.5).astype(np.int64)
    times = np.diff(sums, prepend=0)
    left = counts.copy()
    # Places by class, longest class first; each run of equal sequences takes its places in one go.
    queue = {k: [] for k in range(len(solution.lengths))}
    sequences = [(c, int(t)) for c, t in zip(order, times, strict=True) if t]
    filled: list[list[tuple[int, int, int]]] = [[] for _ in sequences]  # (first, last + 1, length) of a slot's sequences
    for number, (config, t) in enumerate(sequences):
        for k in config:
            queue[k].append((number, t))
    length = room
    for k in range(len(solution.lengths) - 1, -1, -1):
        length = min(length, int(solution.lengths[k]))
        for number, t in queue[k]:
            start = 0
            while start < t:
                while length > 0 and not left[length]:
                    length -= 1
                if length <= 0:
                    break
                take = min(t - start, int(left[length]))
                left[length] -= take
                filled[number].append((start, start + take, length))
                start += take
    plan = []
    for (_, t), parts in zip(sequences, filled, strict=True):
        edges = sorted({0, t, *(e for a, b, _ in parts for e in (a, b))})
        for a, b in itertools.pairwise(edges):
            held = tuple(x for first, last, x in parts if first <= a < last)
            if held:
                plan.append((held, b - a))
    return plan, left


def plan_sequences(counts: np.ndarray, room: int = SEQUENCE_LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths in one sequence, number of such sequences)] that use up ``counts`` by length."""
    left = np.array(counts, dtype=np.int64)
    full = [((room,), int(left[room]))] if left[room] else []
    left[room] = 0
    plans, begun, least = [best_fit(left.copy(), room)], [], volume_bound(left, room)
    for _ in range(LEVELS):
        # Neither stop changes the plan: the first of equal ones is taken, and best fit is exact for what is left of one length.
        if np.count_nonzero(left) < 2 or sequences_of(plans[0]) <= least:
            break
        solution = relax(left, room, CLASSES, ROUNDS)
        tried = [rounded(solution, left, room, scale) for scale in SCALES]
        plans += [best_fit(rest.copy(), room, begun + part) for part, rest in tried]
        part, left = tried[0]  # the sure part; the next level solves the program anew for the rest
        begun = begun + part
    return full + min(plans, key=sequences_of)


def sequences_of(plan: list[tuple[tuple[int, ...], int]]) -> int:
    return sum(number for _, number in plan)


def volume_bound(counts: np.ndarray, room: int) -> int:
    return int(-(-(counts * np.arange(len(counts))).sum() // room))


def sequence_bound(counts: np.ndarray, room: int = SEQUENCE_LENGTH, classes: int = 256, rounds: int = 300) -> int:
    """No plan needs fewer sequences: prices of the relaxation, each length priced at its class's shorter neighbour."""
    left = np.array(counts, dtype=np.int64)
    full, left[room] = int(left[room]), 0
    if not left.any():
        return full
    lower = lowered(left, classes)
    return full + max(volume_bound(left, room), int(np.ceil(relax(lower, room, len(counts), rounds).bound - 1e-6)))


def lowered(counts: np.ndarray, classes: int) -> np.ndarray:
    """The histogram with every length cut to the least of its class."""
    longest, _ = length_classes(counts, classes)
    lower, present = np.zeros_like(counts), np.flatnonzero(counts)
    for length, k in zip(present, np.searchsorted(longest, present), strict=True):
        own = present[np.searchsorted(present, longest[k - 1], side="right")] if k else present[0]
        lower[own] += counts[length]
    return lower


def best_fit(counts: np.ndarray, room: int, begun: Sequence[tuple[tuple[int, ...], int]] = ()) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, over groups of equal sequences instead of single items; ``begun`` sequences are filled up."""
    by_space: dict[int, list[list]] = {}   # free space -> [[lengths, number of sequences]]
    for held, number in begun:
        by_space.setdefault(room - sum(held), []).append([held, number])
    for length in np.flatnonzero(counts)[::-1].tolist():
        waiting = int(counts[length])
        while waiting:
            space = min((s for s in by_space if s >= length), default=None)
            if space is None:
                per = room // length
                whole, part = divmod(waiting, per)
                if whole:
                    by_space.setdefault(room - per * length, []).append([(length,) * per, whole])
                if part:
                    by_space.setdefault(room - part * length, []).append([(length,) * part, 1])
                break
            groups = by_space[space]
            lengths, number = groups.pop()
            if not groups:
                del by_space[space]
            per = min(space // length, waiting)
            used = min(number, waiting // per)
            if used < number:
                by_space.setdefault(space, []).append([lengths, number - used])
            by_space.setdefault(space - per * length, []).append([lengths + (length,) * per, used])
            waiting -= used * per
    return [(tuple(lengths), number) for groups in by_space.values() for lengths, number in groups]


def slots(plan: list[tuple[tuple[int, ...], int]], room: int) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first sequence, pieces per sequence, offset of the first), by rank."""
    rank = np.zeros(room + 1, dtype=np.int64)
    rows: dict[int, list] = {}
    first = 0
    for lengths, number in plan:
        offset = 0
        for length, per in sorted(((x, lengths.count(x)) for x in set(lengths)), reverse=True):
            rows.setdefault(length, []).append((int(rank[length]), first, per, offset))
            rank[length] += per * number
            offset += per * length
        first += number
    return {length: np.array(r, dtype=np.int64) for length, r in rows.items()}


def place(ranked: DataFrame, plan: list[tuple[tuple[int, ...], int]], room: int) -> DataFrame:
    """``sequence_id`` and ``offset`` for rows with ``length`` and ``rank``; the plan is bounded by the histogram."""
    by_length = ranked.sparkSession.sparkContext.broadcast(slots(plan, room))
    columns = [c for c in ranked.columns if c != "rank"]

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, offset = np.zeros(len(batch), dtype=np.int64), np.zeros(len(batch), dtype=np.int64)
            for length, rows in batch.groupby("length").indices.items():
                table = by_length.value[int(length)]
                rank = batch["rank"].to_numpy()[rows]
                row = table[np.searchsorted(table[:, 0], rank, side="right") - 1]
                k = rank - row[:, 0]
                sequence[rows] = row[:, 1] + k // row[:, 2]
                offset[rows] = row[:, 3] + k % row[:, 2] * int(length)
            yield batch[columns].assign(sequence_id=sequence, offset=offset)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInPandas(look_up, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, longest: int = SEQUENCE_LENGTH, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset."""
    cut_up = staged(pieces(docs, tokenizer, longest, with_ids), "pack-pieces")
    by_task = staged(cut_up.groupBy("length", "task").agg(F.count("*").alias("n")), "pack-counts")
    histogram = np.zeros(longest + 1, dtype=np.int64)
    for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # ``longest`` rows at most
        histogram[row["length"]] = row["n"]
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = (cut_up.join(before, ["length", "task"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []),
                      (F.col("before") + F.col("number")).alias("rank")))
    return place(ranked, plan_sequences(histogram, longest), longest)
