"""Corpus pipeline: documents to packed contexts.

Each stage takes (spark, docs, sf_dir) and gives all it keeps; results are
written as Parquet and read again between stages, and deleted when the next one
is written.

Defined results: a null doc_id is never labelled and takes part like others; a
null or empty text has no features and is judged as such by the first two
stages, is never a near duplicate, and is not packed; rows that are repeated, or
whose texts are, leave one row, of least doc_id; several texts of one doc_id are
judged apart; labels without a document are not used; empty documents give no
contexts and empty labels reject nothing; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from retrograph.llm import common, ngram_join, packing, quality_classifier, quality_rules

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; without labels of both classes all."""
    return quality_classifier.filter_quality(docs, quality_classifier.fit_quality(docs, _labels(spark, sf_dir)))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at or above the log-ratio threshold; without trusted documents all."""
    return quality_rules.filter_rules(docs, quality_rules.fit_rules(docs, _labels(spark, sf_dir), quality_rules.PRIOR_SHARE))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates."""
    return ngram_join.drop_repeated_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed contexts of all documents that are left."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("best-fit packing", pack),
]

#: SQL can't express the trained classifier; the tests hold run() against a slow version of its stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of a folder of tables."""
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            old = path
            docs, path = common.stored(docs, "stage")
            if old:
                common.dropped(spark, old)
    return docs
