"""Token counts as delta-maintained rollups.

The table is a folder with three parts, each with one folder per batch:
``ledger`` holds signed rows per document and tokenizer version, ``rollup`` the
batch's change of the additive totals by source, language and version, and
``commits`` the mark that makes the batch count. Totals are the sum of the
committed rollups. A batch brings documents that are set (inserted or counted
anew) or deleted; only the ledger rows of those documents are read to find what
must be taken back.

Commits are idempotent: a batch that is committed is not applied again, and one
that broke off left no mark and is written over. Writers of one table must not
run at the same time.

Cases: a null source or language is a group of its own; a null text counts 0;
of rows that set the same document and version in one batch the one with the
most tokens holds; a deletion with or without counts takes back all versions of
the document; deleting or revising an unknown document changes nothing or adds
it. Rows without an id can't be found again: they only add up. A batch without
rows commits and changes nothing. Extra input columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.llm import tokens
from tabsmith.llm.common import word_count

GROUP = ("source", "lang", "version")
LEDGER = "doc_id long, source string, lang string, version string, docs long, tokens long"
ROLLUP = "source string, lang string, version string, docs long, tokens long"
COMMIT = "batch string"


def bpe_counts(tokenizer: str, text: Column, changed: Column) -> Column:
    """Numbers of ids of a text and of its changed form under a tokenizer file; an equal form is not encoded again."""

    @F.pandas_udf("array<long>")
    def count(texts: pd.Series, forms: pd.Series) -> pd.Series:
        out = []
        for one, other in zip(texts, forms, strict=True):
            n = len(tokens.encode(tokenizer, one))
            out.append(np.array([n, n if other is None else len(tokens.encode(tokenizer, other))]))
        return pd.Series(out, dtype=object)

    return count(text, F.when(~changed.eqNullSafe(text), F.coalesce(changed, F.lit(""))))


def counted(docs: DataFrame, tokenizers: Mapping[str, str], words: str | None = None, changed: Column | None = None) -> DataFrame:
    """Rows (doc_id, source, lang, version, tokens, changed_tokens), one per document and version.

    ``tokenizers`` maps a version's name to its file; ``words`` names the
    version that counts words, if any. ``changed`` is another form of the text
    (the same by default), counted in the same pass: only where it differs is
    there anything to do.
    """
    text = F.col("text")
    form = text if changed is None else changed
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", text, form.alias("_form"))
    counts = {version: bpe_counts(path, text, F.col("_form")) for version, path in tokenizers.items()}
    if words:
        rows = rows.withColumn("_words", word_count(text))
        again = F.when(F.col("_form").eqNullSafe(text), F.col("_words")).otherwise(word_count(F.col("_form")))
        counts[words] = F.array("_words", again)
    pairs = F.array(*(F.struct(F.lit(v).alias("version"), c.alias("tokens")) for v, c in counts.items()))
    rows = rows.select("doc_id", "source", "lang", F.explode(pairs).alias("c"))
    return rows.select("doc_id", "source", "lang", "c.version", F.col("c.tokens")[0].alias("tokens"), F.col("c.tokens")[1].alias("changed_tokens"))


class TokenRollup:
    """Token totals kept in a folder that all machines share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, part: str, batch: str) -> str:
        return f"{self.path}/{part}/batch={batch}"

    def is_committed(self, batch: str) -> bool:
        mark = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self._folder('commits', batch)}/_SUCCESS")
        return mark.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)

    def committed(self) -> list[str]:
        """Names of the committed batches, in order."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        system = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
        return sorted(b for b in (n.removeprefix("batch=") for n in names) if self.is_committed(b))

    def _read(self, part: str, schema: str) -> DataFrame:
        folders = [self._folder(part, b) for b in self.committed()]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def apply(self, batch: str, sets: DataFrame | None = None, deletes: DataFrame | None = None) -> bool:
        """Commit a batch: ``sets`` as :func:`counted` gives it, ``deletes`` with (doc_id). False if it was committed before."""
        if self.is_committed(batch):
            return False
        changes = []
        gone = []
        if sets is not None:
            named = sets.where(F.col("doc_id").isNotNull()).groupBy("doc_id", "version").agg(F.max(F.struct("tokens", "source", "lang")).alias("s"))
            named = named.select("doc_id", "s.source", "s.lang", "version", "s.tokens")
            unnamed = sets.where(F.col("doc_id").isNull()).select("doc_id", "source", "lang", "version", "tokens")
            changes.append(named.unionByName(unnamed).select("doc_id", *GROUP, F.lit(1).cast("long").alias("docs"), F.col("tokens").cast("long").alias("tokens")))
            gone.append(named.select("doc_id", "version"))
        if deletes is not None:
            gone.append(deletes.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("string").alias("version")))
        if self.committed():
            ledger = self._read("ledger", LEDGER)
            for touched in gone:
                changes.append(self._taken_back(ledger, touched.distinct()))
        rows = changes[0] if changes else self.spark.createDataFrame([], LEDGER)
        for more in changes[1:]:
            rows = rows.unionByName(more)
        # a document that is both set and deleted is taken back once
        signed = rows.groupBy("doc_id", *GROUP, F.signum("docs").alias("sign"), F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).alias("_each"))
        rows = signed.agg(F.max(F.struct(F.abs("docs").alias("docs"), F.abs("tokens").alias("tokens"))).alias("d"))
        rows = rows.select("doc_id", *GROUP, (F.col("sign") * F.col("d.docs")).cast("long").alias("docs"), (F.col("sign") * F.col("d.tokens")).cast("long").alias("tokens"))
        rows.write.mode("overwrite").parquet(self._folder("ledger", batch))
        written = self.spark.read.schema(LEDGER).parquet(self._folder("ledger", batch))
        self._sums(written).write.mode("overwrite").parquet(self._folder("rollup", batch))
        self.spark.createDataFrame([(batch,)], COMMIT).coalesce(1).write.mode("overwrite").parquet(self._folder("commits", batch))
        return True

    @staticmethod
    def _taken_back(ledger: DataFrame, touched: DataFrame) -> DataFrame:
        """Negative rows for what the ledger holds of the touched documents (version null: of all versions)."""
        t = touched.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"))
        held = ledger.join(t, (F.col("doc_id") == F.col("_id")) & (F.col("_version").isNull() | (F.col("version") == F.col("_version"))), "left_semi")
        held = held.groupBy("doc_id", *GROUP).agg((-F.sum("docs")).alias("docs"), (-F.sum("tokens")).alias("tokens"))
        return held.where("docs <> 0 or tokens <> 0")

    @staticmethod
    def _sums(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens) over the committed batches."""
        return self._sums(self._read("rollup", ROLLUP)).where("docs <> 0 or tokens <> 0")
