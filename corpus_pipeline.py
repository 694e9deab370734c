"""Corpus pipeline: identify languages, keep good documents, drop near duplicates, mix sources, pack.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
one's documents. All but the last return the columns of ``documents``:

1. language: documents whose language is undetermined or uncertain go.
2. quality: documents that the ordinal classifier grades as toxic or of low
   quality go.
3. near_dup: one document of each near-duplicate group stays (five-word
   shingles, 80 % similarity), the one with the least id.
4. mix: sources are mixed to their target weights; a document may repeat.
5. pack: one row per piece with its place in a sequence of 2048 tokens.

Each stage states what it does with nulls, empty texts, ties and repeated rows
in its operator's module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabsmith.llm import language_id, mixing, near_dup, packing, quality
from tabsmith.llm.common import DOCUMENT_COLUMNS, let_workers_import, read_table, staged
from tabsmith.llm.queries import GOOD_GRADE, PACK_TOKENIZER, graded_labels, tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return language_id.keep_identified(docs.select(*DOCUMENT_COLUMNS))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs.select(*DOCUMENT_COLUMNS), graded_labels(spark, sf_dir), GOOD_GRADE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return near_dup.deduplicated(docs.select(*DOCUMENT_COLUMNS), words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs.select(*DOCUMENT_COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return packing.pack(docs, tokenizer_path(PACK_TOKENIZER))


STAGES = [
    ("language", identify_language),
    ("quality", keep_quality),
    ("near_dup", drop_near_duplicates),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: The classifiers, sketches and tokenizer are not expressible in SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return last(spark, docs, sf_dir)
