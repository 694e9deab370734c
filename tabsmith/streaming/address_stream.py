"""The address cleaning job (T18) over a folder that keeps receiving CSV
files: each new file is cleaned once and appended to the output.

The cleaning is the same projection as the batch job (stateless, no
watermark needed). Progress is kept in the checkpoint folder that the caller
names; a restarted or failed job that names the same one resumes without
re-reading, skipping or duplicating files.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tabsmith.plans.address_job import clean_addresses
from tabsmith.sources.files import CSV_OPTIONS

INPUT_COLUMNS = ("address", "city", "state", "zip")


def start(spark: SparkSession, input_dir: str, output_dir: str, checkpoint: str, columns=INPUT_COLUMNS,
          available_now: bool = True, max_files_per_trigger: int = 1000, multi_line: bool = True) -> StreamingQuery:
    """Start the stream. ``checkpoint`` belongs to ``output_dir``: the output
    keeps a log of its batches, so a new checkpoint with an old output would
    skip files. ``columns`` declares the CSV header (a stream needs its schema
    up front; every column is read as text, and a file with another header
    fails). With ``available_now`` the query processes what is there and
    stops."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    src = (spark.readStream.schema(schema).options(**CSV_OPTIONS).option("mode", "FAILFAST")
           .option("multiLine", multi_line).option("enforceSchema", False)
           .option("maxFilesPerTrigger", max_files_per_trigger).csv(input_dir))
    writer = (clean_addresses(src).writeStream.format("csv").options(**CSV_OPTIONS)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start(output_dir)
