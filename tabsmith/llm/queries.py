"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.llm import (
    fingerprints, html_extract, language_id, merkle, mixing, near_dup, packing, pii, quality, spelling, token_rollup, url_filter, vector_search,
)
from tabsmith.llm.common import DOCUMENT_COLUMNS, ascii_lower, read_table, staged
from tabsmith.llm.oracles import SPELLING_SQL, manifest_sql
from tabsmith.session import stage_path

ALLOW_RULES = ("org/", "com/fr/")
BLOCK_RULES = ("example.org/es/", "example.org/en/1", "com/de/")


SEARCH_TOP = 5
QUERY_EVERY = 50
PACK_TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    """Path of one of the installed public tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = vector_search.quantised(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return vector_search.search(vectors, F.col("vec_id") % QUERY_EVERY == 0, SEARCH_TOP)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mix_sizes(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(docs, tokenizer_path(PACK_TOKENIZER))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", "page_id", "url")
    return url_filter.judge_urls(pages, ALLOW_RULES, BLOCK_RULES)


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_groups(read_table(spark, sf_dir, "documents", "doc_id", "text"), words=3, percent=85)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches: all documents, the toxic ones deleted, those of low quality counted anew without signs."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic").where("doc_id is not null")
    versions = {"byte_bpe_50k": tokenizer_path("byte_bpe_50k.json")}
    toxic = labels.where("toxic = 1").select("doc_id").distinct()
    poor = labels.where("quality = 0").select("doc_id").distinct().join(toxic, "doc_id", "left_anti")
    unsigned = F.regexp_replace("text", r"[|!#$%&*]+", "")
    # Both forms are counted in one pass; then counts are joined, not texts.
    counts = staged(token_rollup.counted(docs, versions, words="words", changed=unsigned), "token-counts")
    rollup = token_rollup.TokenRollup(spark, stage_path(spark, "token-rollup"))
    rollup.apply("1-load", counts)
    revised = counts.join(poor, "doc_id").select("doc_id", "source", "lang", "version", F.col("changed_tokens").alias("tokens"))
    rollup.apply("2-toxic", deletes=toxic)
    rollup.apply("3-revised", revised)
    rollup.apply("2-toxic", deletes=toxic)  # a batch that comes twice counts once
    return rollup.totals()


GOOD_GRADE = 2


def graded_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, rating): 0 toxic, 1 of low quality, 2 neither; null where a label is missing."""
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    rating = F.when(F.col("toxic") == 1, 0).when((F.col("toxic") == 0) & (F.col("quality") == 0), 1)
    return labels.select("doc_id", rating.when((F.col("toxic") == 0) & (F.col("quality") == 1), GOOD_GRADE).alias("rating"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return quality.grade(docs, graded_labels(spark, sf_dir), GOOD_GRADE)


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_spans(read_table(spark, sf_dir, "documents", "doc_id", "text"))


MANIFEST_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", *DOCUMENT_COLUMNS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.manifest(docs, MANIFEST_FIELDS, "lang", tampered, {"text": ascii_lower(F.col("text"))})


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return spelling.variant_groups(spelling.frequent_words(docs, damaged_every=spelling.DAMAGED_EVERY))


LLM_QUERIES = {
    "op1_vector_search": op1_vector_search,
    "op2_mix_sources": op2_mix_sources,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_html_extract": op4_html_extract,
    "op5_url_filter": op5_url_filter,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_language_id": op7_language_id,
    "op8_fingerprints": op8_fingerprints,
    "op9_token_counts": op9_token_counts,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_pii": op11_pii,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_spelling_variants": op13_spelling_variants,
}

LLM_ORACLE: dict[str, str] = {
    "op1_vector_search": f"""
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: coalesce(p[1] * p[2], 0))), 0)::BIGINT AS score
  FROM usable a JOIN usable b ON b.vec_id <> a.vec_id WHERE a.vec_id % {QUERY_EVERY} = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= {SEARCH_TOP}""",
    "op2_mix_sources": f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::DOUBLE AS weight,
         ({mixing.MAX_REPEATS} * source_size)::DOUBLE AS cap, (sum(source_size) OVER ())::DOUBLE AS total FROM totals
),
ordered AS (
  SELECT *, coalesce(sum(cap) OVER earlier, 0) AS caps_before,
         sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS weight_left FROM weighed
  WINDOW earlier AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
marked AS (SELECT *, cap / weight * weight_left <= total - caps_before AS capped FROM ordered),
goals AS (
  SELECT source, source_size, if(capped, cap, (total - sum(if(capped, cap, 0)) OVER ()) * weight
                                              / sum(if(capped, 0, weight)) OVER ()) AS target FROM marked
),
rated AS (
  SELECT *, if(source_size > 0, least(target / source_size, {mixing.MAX_REPEATS}.0), 0) AS rate FROM goals
),
drawn AS (
  SELECT sized.*, k AS draw, source_size, target, floor(rate)::BIGINT AS whole,
         ('0x' || substr(md5(concat_ws('|', doc_id, size, k // {mixing.DRAWS_PER_HASH})), k % {mixing.DRAWS_PER_HASH} * 8 + 1, 8))::BIGINT
         / 4294967296.0::DOUBLE < rate - floor(rate) AS again
  FROM sized JOIN rated ON rated.source IS NOT DISTINCT FROM sized.source, range({mixing.SEEDS}) draws(k)
),
best AS (
  SELECT source, draw FROM drawn GROUP BY source, draw
  QUALIFY row_number() OVER (PARTITION BY source
    ORDER BY abs(max(whole * source_size) + sum(if(again, size, 0)) - max(target)), draw) = 1
)
SELECT doc_id, size, source_size, target, size * (whole + again::INT) AS taken
FROM drawn JOIN best ON best.draw = drawn.draw AND best.source IS NOT DISTINCT FROM drawn.source""",
    "op12_merkle_manifest": manifest_sql(MANIFEST_FIELDS, {"text": "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"}),
    "op13_spelling_variants": SPELLING_SQL,
}
