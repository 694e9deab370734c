"""Large CSV files with line breaks in quoted fields, read by many tasks.

Spark reads a multi-line CSV file in one task, because a line break ends a
record only outside quotes, and whether a place is inside depends on every
quote before it. Here the file is read as physical lines, by byte ranges like
any splittable text, and a prefix scan over the ranges gives each its state:

1. Every range counts its quotes, and the records that would begin in it if it
   began outside quotes, and if it began inside. One row per range.
2. Sums over a file's ranges give each range's state (odd number of quotes
   before it: inside) and the number of records before it.
3. Every range numbers its lines' records. A record of one line is complete;
   the lines of a longer one, wherever the range borders lie, are put together
   by (file, record). Only these lines are shuffled.
4. Spark's own CSV parser parses the records.

Files may name the same columns in different orders; each is read by its own
header. RFC 4180 holds: a field that contains quotes is quoted, and quotes in it
are doubled. A record that breaks this, or has another number of fields than
its header, fails the job. Records end with a line feed, with or without a
carriage return; empty lines between records are skipped; a header lies within
its file's first range. A compressed file is one range.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Quoted and unquoted fields of one record; possessive, so that long fields need no stack.
FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
RECORD = rf"(?s)\A{FIELD}(?:,{FIELD})*+\z"

RANGE_KEYS = ("file", "start")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines in file order within each (file, start), with the number of quotes and whether the line is empty."""
    text = spark.read.option("lineSep", "\n").text(path)
    line = F.regexp_replace("value", r"\r\z", "")
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value",
                       F.regexp_count("value", F.lit('"')).alias("quotes"), (line == "").alias("empty"))


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Pieces of the batches that belong to one range, in order."""
    for batch in batches:
        starts = batch["start"].to_numpy()
        files = batch["file"].dictionary_encode()
        codes = files.indices.to_numpy()
        cuts = [0, *(np.flatnonzero((np.diff(starts) != 0) | (np.diff(codes) != 0)) + 1), len(starts)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield (files.dictionary[codes[a]].as_py(), int(starts[a])), batch.slice(a, b - a)


class _Count:
    """Quotes and record starts of a range so far, for either state that it may begin in."""

    def __init__(self):
        self.odd, self.lines, self.begun = 0, 0, [0, 0]

    def add(self, piece: pa.RecordBatch):
        """(first line's number, state before each line, records begun up to and with each line, for either state)."""
        quotes = piece["quotes"].to_numpy() & 1
        empty = piece["empty"].to_numpy(zero_copy_only=False)
        after = (self.odd + np.cumsum(quotes)) & 1
        before = np.concatenate(([self.odd], after[:-1]))
        begun = [self.begun[state] + np.cumsum((before == state) & ~empty) for state in (0, 1)]
        first = self.lines
        self.odd, self.lines, self.begun = int(after[-1]), first + len(after), [int(b[-1]) for b in begun]
        return first, before, after, begun


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per range: whether its quotes are odd, the records that begin in it for either state, its file's header."""
    rows = []
    for key, pieces in groupby(_by_range(batches), key=lambda x: x[0]):
        count, header, open_header = _Count(), [], key[1] == 0
        for _, piece in pieces:
            _, _, after, begun = count.add(piece)
            if open_header:
                own = np.flatnonzero(begun[0] == 1)
                header += piece["value"].take(own).to_pylist()
                open_header = not (len(own) and begun[0][-1] > 1)
        rows.append((*key, count.odd, *count.begun, "\n".join(header) if key[1] == 0 else None))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), COUNT_TYPES, strict=True)], list(COUNT_NAMES))


COUNT_SHAPE = "file string, start long, odd int, begun0 long, begun1 long, header string"
COUNT_NAMES = tuple(part.split()[0] for part in COUNT_SHAPE.split(", "))
COUNT_TYPES = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string())


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every line with its number, and its state and record for either state that its range may begin in."""
    for _, pieces in groupby(_by_range(batches), key=lambda x: x[0]):
        count = _Count()
        for _, piece in pieces:
            first, before, after, begun = count.add(piece)
            arrays = [piece["file"], piece["start"], piece["value"], piece["empty"], pa.array(np.arange(first, first + len(before))),
                      pa.array(before.astype(np.int32)), pa.array(after.astype(np.int32)), *(pa.array(b.astype(np.int64)) for b in begun)]
            yield pa.RecordBatch.from_arrays(arrays, list(LINE_NAMES))


LINE_SHAPE = "file string, start long, value string, empty boolean, line long, before int, after int, begun0 long, begun1 long"
LINE_NAMES = tuple(part.split()[0] for part in LINE_SHAPE.split(", "))


def ranges(lines: DataFrame) -> DataFrame:
    """(file, start, inside, records, header): each range's state, the records before it and its file's header."""
    counts = lines.select(*RANGE_KEYS, F.when(F.col("start") == 0, F.col("value")).alias("value"), "quotes", "empty").mapInArrow(
        _counted, COUNT_SHAPE)
    file = Window.partitionBy("file")
    earlier = file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    with_state = counts.withColumn("inside", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    begun = F.when(F.col("inside") == 1, F.col("begun1")).otherwise(F.col("begun0"))
    return with_state.select(
        *RANGE_KEYS, "inside", F.coalesce(F.sum(begun).over(earlier), F.lit(0)).alias("records"), F.max("header").over(file).alias("header"),
        (F.sum("odd").over(file) % 2 == 1).alias("unclosed"))


def records(spark: SparkSession, path: str, states: DataFrame) -> DataFrame:
    """(header, record) of every record after the header, whichever ranges its lines lie in."""
    lines = _lines(spark, path).mapInArrow(_numbered, LINE_SHAPE).join(states, list(RANGE_KEYS))
    begun = F.when(F.col("inside") == 1, F.col("begun1")).otherwise(F.col("begun0"))
    before, after = (F.col("inside").bitwiseXOR(F.col(c)) for c in ("before", "after"))
    placed = lines.select("file", "start", "line", "value", "empty", "header", "unclosed", (F.col("records") + begun).alias("number"),
                          before.alias("open"), after.alias("left_open")).where((F.col("number") > 1) & ~(F.col("empty") & (F.col("open") == 0)))
    closed = F.when(F.col("unclosed"), F.raise_error(F.concat(F.lit("CSV quote never closed in "), F.col("file")))).otherwise(F.col("value"))
    alone = (F.col("open") == 0) & (F.col("left_open") == 0)
    single = placed.where(alone).select("header", closed.alias("record"))
    parts = F.array_sort(F.collect_list(F.struct("start", "line", closed.alias("value"))))
    longer = placed.where(~alone).groupBy("file", "number").agg(F.first("header").alias("header"), parts.alias("parts")).select(
        "header", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("record"))
    return single.unionByName(longer).select("header", F.regexp_replace("record", r"\r\z", "").alias("record"))


def column_names(header: str) -> list[str]:
    return next(csv.reader([header.removesuffix("\r")], strict=True))


def _well_formed(record: Column) -> Column:
    bad = record.contains('"') & ~record.rlike(RECORD)
    return F.when(bad, F.raise_error(F.concat(F.lit("MALFORMED CSV record: "), F.left(record, F.lit(200))))).otherwise(record)


def read(spark: SparkSession, path: str, options: dict, columns: list[str] | None = None, staged: Callable | None = None) -> DataFrame:
    """All records of the files at ``path`` as string columns, in the order of ``columns`` or of the first file's header.

    ``staged`` writes the ranges (one row each) and reads them back, so that
    they are counted once. The distinct headers are read on the driver while
    the plan is built: one row per order of columns, however many files.
    """
    states = ranges(_lines(spark, path))
    states = staged(states) if staged else states
    first = states.where("header <> ''").groupBy("header").agg(F.min("file").alias("file")).orderBy("file").collect()
    layouts = {r["header"]: column_names(r["header"]) for r in first}
    names = columns or next(iter(layouts.values()), [])
    for header, own in layouts.items():
        if sorted(own) != sorted(names) or len(set(own)) != len(own):
            raise ValueError(f"CSV files of {path} name other columns: {own} instead of {names}")
    if not layouts:
        return spark.createDataFrame([], ", ".join(f"`{n}` string" for n in names) or "value string").select(*names)
    shape = ", ".join(f"_{i} string" for i in range(len(names)))
    parsed = F.from_csv(_well_formed(F.col("record")), shape, {**{k: str(v) for k, v in options.items() if k != "header"},
                                                              "mode": "FAILFAST", "multiLine": "true", "maxCharsPerColumn": "-1"})
    rows = records(spark, path, states).select("header", parsed.alias("fields"))

    def field(name: str) -> Column:
        by_layout = [(h, F.col(f"fields._{own.index(name)}")) for h, own in layouts.items()]
        if len({own.index(name) for own in layouts.values()}) == 1:
            return by_layout[0][1]
        value = F.when(F.col("header") == by_layout[0][0], by_layout[0][1])
        for header, column in by_layout[1:]:
            value = value.when(F.col("header") == header, column)
        return value

    return rows.select(*[field(n).alias(n) for n in names])
