"""Statistics of count tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _stats(counts: DataFrame, keys: list[str], exact: bool, summed: bool) -> DataFrame:
    distinct = F.count("*") if summed else F.count_distinct("text") if exact else F.approx_count_distinct("text")
    return counts.groupBy(*keys).agg(F.count("*").alias("row_count"), F.sum("count").alias("occurrences"), distinct.alias("distinct_texts"))


def stats_by_corpus(counts: DataFrame, exact: bool = False, summed: bool = False) -> DataFrame:
    """Rows, occurrences and distinct texts of each language and corpus.

    ``summed`` says that a text has one row in its language and corpus, as after
    counting or summing up, so its rows are its distinct texts.
    """
    return _stats(counts, ["lang", "corpus"], exact, summed)


def stats_by_size(counts: DataFrame, exact: bool = False, summed: bool = False) -> DataFrame:
    """The same for each n-gram size."""
    return _stats(counts, ["lang", "corpus", "n"], exact, summed)


def top_rows(counts: DataFrame, k: int = 20) -> DataFrame:
    """The k rows with the greatest counts; ties by language, corpus, text, size, key."""
    return counts.orderBy(F.desc("count"), "lang", "corpus", "text", "n", "norm_key").limit(k)


def table_counts(raw: DataFrame, compacted: DataFrame, marks: DataFrame, lang: str | None = None, corpus: str | None = None) -> DataFrame:
    """Rows of the three tables, for one language or corpus where given."""
    parts = []
    for name, df in (("ngram_counts", raw), ("ngram_totals", compacted), ("ngram_compactions", marks)):
        for column, value in (("lang", lang), ("corpus", corpus)):
            if value is not None:
                df = df.where(F.col(column) == value)
        parts.append(df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count"))
    return parts[0].union(parts[1]).union(parts[2])


def compacted_counts(raw: DataFrame) -> DataFrame:
    """What ``table_counts`` would give if all raw rows were compacted as one corpus, in one pass over them."""
    texts = raw.groupBy("lang", "n", "text").agg(F.count("*").alias("parts"))
    by = texts.groupBy("lang", "n").agg(F.sum("parts").alias("parts"), F.count("*").alias("texts"))
    held = by.agg(*(F.coalesce(x, F.lit(0)).cast("bigint").alias(n) for n, x in (("ngram_counts", F.sum("parts")), ("ngram_totals", F.sum("texts")), ("ngram_compactions", F.count("*")))))
    return held.select(F.explode(F.create_map(*(x for n in held.columns for x in (F.lit(n), F.col(n))))).alias("table_name", "row_count"))


def sizes(counts: DataFrame) -> DataFrame:
    """The n-gram sizes there are, of each language and corpus."""
    return counts.select("lang", "corpus", "n").distinct()


def compaction_state(raw: DataFrame, compacted: DataFrame, marks: DataFrame) -> DataFrame:
    """For every language, corpus and size of the raw table: its rows, the compacted rows, when they were compacted."""
    key = ["lang", "corpus", "n"]
    left = raw.groupBy(*key).agg(F.count("*").alias("raw_rows"))
    middle = compacted.groupBy(*key).agg(F.count("*").alias("total_rows"))
    return left.join(middle, key, "left").join(marks.select(*key, "compacted_at"), key, "left").withColumn("total_rows", F.coalesce("total_rows", F.lit(0).cast("bigint")))
