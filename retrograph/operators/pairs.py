"""Pairs of texts whose keys are each other's reversal, and words that reverse into several texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.policies import SearchPolicy
from . import ngrams

SIDE = ["lang", "corpus", "text", "n", "count", "norm_key"]
PAIR = [f"{side}_{c}" for side in ("source", "target") for c in SIDE] + ["pair_score"]


def pair_score(source_count: Column, target_count: Column) -> Column:
    return F.round(F.log(source_count + 1) + F.log(target_count + 1), 6)


def reverse_pairs(source: DataFrame, target: DataFrame, *, palindromes: bool = False, identical: bool = False) -> DataFrame:
    """Inner join of two tables of summed counts on reverse(source key) = target key.

    The reversed key is an ordinary equi-join key: the sizes of the two sides
    decide at run time whether one is broadcast or both are shuffled, and a key
    with very many texts is split as skew.
    """
    left = source.select(*(F.col(c).alias(f"source_{c}") for c in SIDE))
    right = target.select(*(F.col(c).alias(f"target_{c}") for c in SIDE))
    if not palindromes:  # a key that is its own reversal can only meet itself
        left = left.where(F.reverse("source_norm_key") != F.col("source_norm_key"))
    pairs = left.join(right, F.reverse("source_norm_key") == F.col("target_norm_key"))
    if not identical:
        pairs = pairs.where(~((F.col("source_lang") == F.col("target_lang")) & (F.col("source_corpus") == F.col("target_corpus")) & (F.col("source_text") == F.col("target_text"))))
    return pairs.withColumn("pair_score", pair_score(F.col("source_count"), F.col("target_count"))).select(*PAIR)


def ordered_pairs(pairs: DataFrame, limit: int = 0) -> DataFrame:
    """By the sum of both counts, then the texts, then keys and sizes."""
    out = pairs.orderBy(F.desc(F.col("source_count") + F.col("target_count")), "source_text", "target_text", "source_norm_key", "target_norm_key", "source_n", "target_n")
    return out.limit(limit) if limit else out


def search(counts: DataFrame, policy: SearchPolicy, *, compacted: bool = False) -> DataFrame:
    """Pairs of two corpora of a count table; sums and filters come before the join."""
    common = {"min_norm_len": policy.min_norm_len, "max_norm_len": policy.max_norm_len, "compacted": compacted}
    source = ngrams.select_counts(counts, lang=policy.source_lang, corpus=policy.source_corpus, n=policy.source_n, min_count=policy.min_source_count, **common)
    target = ngrams.select_counts(counts, lang=policy.target_lang, corpus=policy.target_corpus, n=policy.target_n, min_count=policy.min_target_count, **common)
    return ordered_pairs(reverse_pairs(source, target, palindromes=policy.include_palindromes, identical=policy.include_identical_text), policy.max_results)


def decompose(source: DataFrame, target: DataFrame, k: int = 3) -> DataFrame:
    """source, word_count, phrase: texts whose reversed key is the keys of up to k target texts, one after another.

    ``source`` and ``target`` have a column ``text``.  Every round joins what is
    left of a key with the fragments it can begin with: the rest's beginnings of
    all fragment lengths there are, so the join is an equality on whole keys.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    origins = target.where("text is not null").select("text", T.norm_key(F.col("text")).alias("key")).where("key <> ''").distinct()
    fragments = origins.select("key").distinct()
    lengths = [r[0] for r in fragments.select(F.length("key").alias("n")).distinct().orderBy("n").collect()]  # as many as keys have lengths
    words = source.where("text is not null").select("text").distinct().select(F.col("text").alias("source"), F.reverse(T.norm_key(F.col("text"))).alias("rest"))
    state = words.where("rest <> ''").select("source", "rest", F.array().cast("array<string>").alias("path"))
    solved = None
    for step in range(k):
        sizes = F.array(*(F.lit(n) for n in lengths)) if lengths else F.array().cast("array<int>")
        heads = state.select("source", "rest", "path", F.explode(F.filter(sizes, lambda n: n <= F.length("rest"))).alias("size"))
        if step + 1 == k:
            heads = heads.where(F.col("size") == F.length("rest"))
        heads = heads.withColumn("head", F.expr("substring(rest, 1, size)"))
        met = heads.join(fragments, heads["head"] == fragments["key"], "left_semi").select("source", F.expr("substring(rest, size + 1)").alias("rest"), F.concat("path", F.array("head")).alias("path"))
        done = met.where("rest = ''").select("source", "path")
        solved = done if solved is None else solved.union(done)
        state = met.where("rest <> ''")
    return expand_paths(solved, origins, k)


def expand_paths(solved: DataFrame, origins: DataFrame, k: int) -> DataFrame:
    """Every spelling of every fragment of a path, joined by blanks."""
    done = None
    for size in range(1, k + 1):
        rows = solved.where(F.size("path") == size).withColumn("phrase", F.lit(""))
        for i in range(size):
            side = origins.select(F.col("text").alias("word"), F.col("key").alias("fragment"))
            rows = rows.join(side, F.col("path")[i] == F.col("fragment")).select("source", "path", (F.concat_ws(" ", "phrase", "word") if i else F.col("word")).alias("phrase"))
        rows = rows.select("source", F.size(F.split("phrase", T.WHITE)).alias("word_count"), "phrase")
        done = rows if done is None else done.union(rows)
    return done.distinct()


def grouped(decomposed: DataFrame) -> DataFrame:
    """source, word_count and the sorted phrases."""
    return decomposed.groupBy("source", "word_count").agg(F.sort_array(F.collect_set("phrase")).alias("phrases"))
