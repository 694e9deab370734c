"""The address job as a stream: files dropped later are cleaned once, and a
restarted query resumes from its checkpoint without re-reading old files."""

from __future__ import annotations

import pytest

from tabsmith.streaming import address_stream

COLS = ["address", "city", "state", "zip"]


def _drop(spark, folder, rows):
    (spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLS)).coalesce(1).write.mode("append")
     .option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(folder))


def _read(spark, folder):
    return (spark.read.option("header", True).option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False).csv(folder))


def test_stream_resumes_from_checkpoint(spark, tmp_path):
    inbox, outbox, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    _drop(spark, inbox, [("1 main st.", " atlanta ", "ga", "30301-1234")])
    address_stream.start(spark, inbox, outbox, checkpoint=ckpt).awaitTermination()
    first = _read(spark, outbox).collect()
    assert [(r["cleaned_address"], r["cleaned_city"], r["cleaned_state"], r["cleaned_zip"]) for r in first] == [
        ("1 Main Street", "Atlanta", "Georgia", "30301")]

    _drop(spark, inbox, [("2 oak rd", "macon", "fl", "31201")])
    address_stream.start(spark, inbox, outbox, checkpoint=ckpt).awaitTermination()  # restarted query
    out = sorted(r["cleaned_address"] for r in _read(spark, outbox).collect())
    assert out == ["1 Main Street", "2 Oak Road"]  # the first file is not processed twice


def test_two_default_starts_with_files_in_between(spark, tmp_path):
    """The checkpoint is the caller's to name; without one nothing starts, so no file can be skipped."""
    inbox, outbox = str(tmp_path / "in"), str(tmp_path / "out")
    with pytest.raises(TypeError):
        address_stream.start(spark, inbox, outbox)
    for n in (1, 2, 3):
        _drop(spark, inbox, [(f"{n} main st", "macon", "ga", "31201")])
        address_stream.start(spark, inbox, outbox, str(tmp_path / "ckpt")).awaitTermination()
    assert sorted(r["cleaned_address"] for r in _read(spark, outbox).collect()) == [f"{n} Main Street" for n in (1, 2, 3)]
