"""CSV in and out by RFC 4180, and the sessions and folders that jobs rely on."""

from __future__ import annotations

import pytest

from tabsmith.plans import address_job
from tabsmith.session import build_session, shared_dir
from tabsmith.sources.files import read_text_csv, write_csv

ROWS = [
    ('1 "Main" st, Apt 2', "x", "ga", "30301"),
    ("2 oak rd\nrear building", " macon ", "fl", "01234"),
    (None, "", "ga", None),
    ('"', ",", "\\", '""'),
]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "address string, city string, state string, zip string")
    write_csv(df, str(tmp_path / "out"))
    back = read_text_csv(spark, str(tmp_path / "out"))
    assert _as_text(back) == _as_text(df)


def _as_text(df):
    """Rows in order; an empty field and a null are the same in CSV."""
    return sorted(tuple(v or "" for v in r) for r in df.collect())


def test_address_job_reads_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "in.csv").write_text('address,city,state,zip\n"1 ""Main"" st, Apt 2",x,ga,30301\n"2 oak rd\nrear",macon,fl,31201-9\n')
    address_job.main([str(tmp_path / "in.csv"), str(tmp_path / "out")])
    got = {r["zip"]: (r["address"], r["cleaned_state"], r["cleaned_zip"]) for r in read_text_csv(spark, str(tmp_path / "out")).collect()}
    assert got == {"30301": ('1 "Main" st, Apt 2', "Georgia", "30301"), "31201-9": ("2 oak rd\nrear", "Florida", "31201")}


def test_malformed_row_fails(spark, tmp_path):
    (tmp_path / "in.csv").write_text("address,city,state,zip\na,b\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed|FAILFAST"):
        read_text_csv(spark, str(tmp_path / "in.csv")).collect()


def test_submitted_partition_count_survives(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "777")
    try:
        assert build_session(master=None).conf.get("spark.sql.shuffle.partitions") == "777"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_shared_folder_must_be_named_off_a_local_master():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())
