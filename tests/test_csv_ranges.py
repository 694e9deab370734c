"""Multi-line CSV read by byte ranges: equal to the one-task reader wherever the borders lie."""

from __future__ import annotations

import random

import pytest

from tabsmith.plans import address_job
from tabsmith.sources import csv_ranges
from tabsmith.sources.files import CSV_OPTIONS, read_text_csv

FIELDS = ("", "abc", "a,b", "one\ntwo", 'say "x"', "é", '"', "\n\n", "x\r\ny", " padded ", "\\", '",\n"', "long" * 20)


@pytest.fixture
def ranges_of(spark):
    """Sets the size of byte ranges; the defaults come back after the test."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]

    def resize(size: int):
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "1")

    yield resize
    for k, v in zip(keys, before, strict=True):
        spark.conf.set(k, v)


def written(path, columns, n, seed, eol="\n", last_eol=True):
    """A file of random records; returns them by column name."""
    pick = random.Random(seed)
    records = [{c: pick.choice(FIELDS) for c in columns} | {columns[0]: f"{seed}-{i}"} for i in range(n)]
    quoted = lambda v: '"' + v.replace('"', '""') + '"' if any(c in v for c in ',"\n\r') else v
    lines = [",".join(columns), *(",".join(quoted(r[c]) for c in columns) + (eol if pick.random() < 0.05 else "") for r in records)]
    path.write_bytes((eol.join(lines) + (eol if last_eol else "")).encode())
    return records


def texts(df, columns):
    """Rows in order; an empty field and a null are the same in CSV."""
    return sorted(tuple(r[c] or "" for c in columns) for r in df.collect())


def test_one_file_by_many_tasks_equals_one_task(spark, ranges_of, tmp_path):
    columns = ["id", "b", "c"]
    records = written(tmp_path / "a.csv", columns, 400, 1)
    one_task = texts(spark.read.options(**CSV_OPTIONS).option("multiLine", True).csv(str(tmp_path / "a.csv")), columns)
    ranges_of(1000)
    assert csv_ranges._lines(spark, str(tmp_path / "a.csv")).rdd.getNumPartitions() > 8
    got = texts(read_text_csv(spark, str(tmp_path / "a.csv")), columns)
    assert got == one_task == sorted(tuple(r[c] for c in columns) for r in records)


@pytest.mark.parametrize("size", [7, 16, 23, 64])
def test_borders_inside_quotes(spark, ranges_of, tmp_path, size):
    """Borders within quoted line breaks, within doubled quotes, between carriage return and line feed; ranges without a record."""
    text = 'id,b\r\n1,"x\r\ny ""z"" "\r\n2,"' + "\n" * 30 + 'w"\r\n\r\n3,""""""\r\n4,plain\r\n5,"' + "long " * 20 + '"'
    (tmp_path / "a.csv").write_bytes(text.encode())
    ranges_of(size)
    got = [tuple(r) for r in read_text_csv(spark, str(tmp_path / "a.csv")).orderBy("id").collect()]
    assert got == [("1", 'x\r\ny "z" '), ("2", "\n" * 30 + "w"), ("3", '""'), ("4", "plain"), ("5", "long " * 20)]


def test_files_with_other_column_orders(spark, ranges_of, tmp_path):
    columns = ["id", "b", "c"]
    records = written(tmp_path / "a.csv", columns, 60, 1) + written(tmp_path / "b.csv", ["c", "b", "id"], 60, 2, "\r\n", False)
    ranges_of(700)
    df = read_text_csv(spark, str(tmp_path))
    assert df.columns == columns
    assert texts(df, columns) == sorted(tuple(r[c] for c in columns) for r in records)
    declared = read_text_csv(spark, str(tmp_path), ["b", "id", "c"])
    assert declared.columns == ["b", "id", "c"] and texts(declared, columns) == texts(df, columns)


def test_job_over_files_with_other_column_orders(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("address,city,state,zip\n1 main st,x,ga,30301\n")
    (tmp_path / "in" / "b.csv").write_text('zip,state,city,address\n30302,ga,macon,"2 oak rd\nrear"\n')
    address_job.main([str(tmp_path / "in"), str(tmp_path / "out")])
    got = {r["zip"]: (r["address"], r["city"], r["cleaned_state"], r["cleaned_zip"]) for r in read_text_csv(spark, str(tmp_path / "out")).collect()}
    assert got == {"30301": ("1 main st", "x", "Georgia", "30301"), "30302": ("2 oak rd\nrear", "macon", "Georgia", "30302")}


@pytest.mark.parametrize("other", ["id,b\n1,2\n", "id,b,x\n1,2,3\n", "id,b,b\n1,2,3\n"])
def test_other_columns_fail(spark, tmp_path, other):
    (tmp_path / "a.csv").write_text("id,b,c\n1,2,3\n")
    (tmp_path / "b.csv").write_text(other)
    with pytest.raises(ValueError, match="other columns"):
        read_text_csv(spark, str(tmp_path))


def test_single_line_reader_fails_on_another_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,id\n3,4\n")
    with pytest.raises(Exception, match="header"):
        read_text_csv(spark, str(tmp_path), multi_line=False).collect()


@pytest.mark.parametrize("text,message", [("a,b\n1\n", "MALFORMED"), ('a,b\n1,"x\n2,3\n', "never closed"), ('a,b\n1,x"y\n2,z"w\n', "MALFORMED"),
                                          ('a,b\n1,"x"y\n', "MALFORMED")])
def test_malformed_files_fail(spark, tmp_path, text, message):
    (tmp_path / "a.csv").write_text(text)
    with pytest.raises(Exception, match=message):
        read_text_csv(spark, str(tmp_path / "a.csv")).collect()


@pytest.mark.parametrize("text,columns,rows", [("a,b\n", ["a", "b"], []), ("", [], []), ('"a\nb",c\n1,2\n', ["a\nb", "c"], [("1", "2")]),
                                               ("a\n\n\nx", ["a"], [("x",)]), ("﻿a,b\n1,2\n", ["a", "b"], [("1", "2")])])
def test_odd_files(spark, tmp_path, text, columns, rows):
    (tmp_path / "a.csv").write_text(text)
    df = read_text_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == columns and [tuple(r) for r in df.collect()] == rows
