"""Queries of this subpackage: one for each operator, over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, lm_scoring, ngram_join, packing, quality_classifier, quality_rules, tiff, token_shards, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.write_shards(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.score_quality(docs, quality_classifier.fit_quality(docs, table(spark, sf_dir, "labels")))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_classes(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


def op7_tiff_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no media, so every web page becomes a TIFF file first."""
    return tiff.decode_media(tiff.media_of(table(spark, sf_dir, "pages")))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm_scoring.score_lm(docs, lm_scoring.fit_lm(docs))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_severity(docs, toxicity.fit_severity(docs, table(spark, sf_dir, "labels")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.score_rules(docs, quality_rules.fit_rules(docs, table(spark, sf_dir, "labels"), quality_rules.PRIOR_SHARE))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_token_shards": op3_token_shards,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_tiff_pages": op7_tiff_pages,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_toxicity": op9_toxicity,
    "op10_quality_rules": op10_quality_rules,
}

#: DuckDB SQL for the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op2_chat_formatting": r"""
WITH m AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS body,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), p AS (
  SELECT conv_id, k, role, '<|im_start|>' || role || chr(10) AS head, body || '<|im_end|>' AS tail FROM m
), q AS (
  SELECT *, coalesce(sum(length(head) + length(tail) + 1) OVER (PARTITION BY conv_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS s FROM p
)
SELECT conv_id, CAST(count(*) AS INTEGER) AS n_messages, string_agg(head || tail || chr(10), '' ORDER BY k) AS text,
       coalesce(list(CAST(s AS INTEGER) ORDER BY k) FILTER (WHERE role = 'assistant'), []) AS starts,
       coalesce(list(CAST(s + length(tail) AS INTEGER) ORDER BY k) FILTER (WHERE role = 'assistant'), []) AS ends
FROM q GROUP BY conv_id
""",
    "op5_ngram_jaccard_join": r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(text), '[a-z0-9\x{80}-\x{10ffff}]+') AS t FROM documents
), sets AS MATERIALIZED (
  SELECT r, CASE WHEN len(t) < 3 THEN [array_to_string(t, ' ')] ELSE list_distinct([t[i] || ' ' || t[i+1] || ' ' || t[i+2] for i in range(1, len(t) - 1)]) END AS s
  FROM words WHERE len(t) > 0
), grams AS MATERIALIZED (
  SELECT r, len(s) AS n, hash(unnest(s)) AS g FROM sets
), shared AS MATERIALIZED (
  SELECT g.* FROM grams g JOIN (SELECT g FROM grams GROUP BY g HAVING count(*) > 1) USING (g)
), links AS MATERIALIZED (
  SELECT a.r AS x, b.r AS y FROM shared a JOIN shared b ON a.g = b.g AND a.r < b.r AND 2 * a.n >= b.n AND 2 * b.n >= a.n GROUP BY a.r, b.r, a.n, b.n HAVING count(*) / (a.n + b.n - count(*)) >= 0.5
), both_ways AS MATERIALIZED (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT x, y FROM both_ways UNION SELECT reach.x, l.y FROM reach JOIN both_ways l ON reach.y = l.x
), least AS (
  SELECT x, min(w.doc_id) AS class_id FROM reach JOIN words w ON w.r = reach.y GROUP BY x
), counted AS (
  SELECT x, count(*) AS n_links FROM both_ways GROUP BY x
)
SELECT w.doc_id, least(w.doc_id, l.class_id) AS class_id, coalesce(c.n_links, 0) AS n_links
FROM words w LEFT JOIN least l ON l.x = w.r LEFT JOIN counted c ON c.x = w.r
""",
}
