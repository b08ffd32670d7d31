"""Review of pairs: filters, order, key check, and filtering by word lists and sizes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.policies import ReviewPolicy

TABLE = ["source_text", "target_text", "pair_score", "source_count", "target_count", "source_n", "target_n", "source_norm_key", "target_norm_key"]


def filter_review(pairs: DataFrame, policy: ReviewPolicy = ReviewPolicy()) -> DataFrame:
    """Pairs within the filters; best score first, then counts, then texts."""
    for side, wanted in (("source", policy.source_contains), ("target", policy.target_contains)):
        wanted = wanted.strip().lower()
        if wanted:
            pairs = pairs.where(F.lower(f"{side}_text").contains(wanted))
    for column, least in (("pair_score", policy.min_pair_score), ("source_count", policy.min_source_count), ("target_count", policy.min_target_count)):
        pairs = pairs.where(F.col(column) >= least)
    for column, n in (("source_n", policy.source_n), ("target_n", policy.target_n)):
        if n is not None:
            pairs = pairs.where(F.col(column) == n)
    return pairs.orderBy(F.desc("pair_score"), F.desc("source_count"), F.desc("target_count"), "source_text", "target_text").limit(policy.limit)


def review_table(pairs: DataFrame) -> DataFrame:
    return pairs.select(*TABLE)


def key_check(pairs: DataFrame) -> DataFrame:
    """Pairs with the reversed source key and whether it is the target key."""
    return pairs.withColumn("reversed_source_key", F.reverse("source_norm_key")).withColumn("status", F.when(F.col("reversed_source_key") == F.col("target_norm_key"), "match").otherwise("mismatch"))


def detail(pairs: DataFrame) -> DataFrame:
    """Pairs with a description of each in Markdown."""
    rows = [("Language", "lang"), ("Corpus", "corpus"), ("Tokens", "n"), ("Count", "count"), ("Norm key", "norm_key")]
    lines: list[Column] = [F.concat(F.lit("## "), "source_text", F.lit(" ⇄ "), "target_text"), F.lit(""), F.concat(F.lit("**Score:** `"), F.col("pair_score").cast("string"), F.lit("`")), F.lit(""), F.lit("| Field | Source | Target |"), F.lit("|---|---:|---:|")]
    lines += [F.concat(F.lit(f"| {title} | `"), F.col(f"source_{c}").cast("string"), F.lit("` | `"), F.col(f"target_{c}").cast("string"), F.lit("` |")) for title, c in rows]
    checked = key_check(pairs)
    lines += [F.lit(""), F.concat(F.lit("`reverse("), "source_norm_key", F.lit(") = "), "reversed_source_key", F.lit("`")), F.lit(""), F.concat(F.lit("Key check: **"), "status", F.lit("**"))]
    return checked.withColumn("detail", F.concat_ws("\n", *lines))


def sub_ngrams(text: Column) -> Column:
    """All stretches of neighbouring words of a text."""
    words = F.filter(F.split(text, T.WHITE), lambda w: w != "")
    starts = F.filter(F.sequence(F.lit(0), F.size(words)), lambda i: i < F.size(words))
    return F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(F.lit(1), F.size(words) - i), lambda n: F.array_join(F.slice(words, i + 1, n), " "))))


#: Words of a list that is compared with every row in place; beyond it texts are joined.
LIST_IN_PLACE = 1000


def drop_listed(pairs: DataFrame, listed: DataFrame, side: str) -> DataFrame:
    """Pairs whose text on that side holds no stretch of words from ``listed`` (a column ``word``); case counts.

    A short list is compared with each row where it is, without a shuffle.  For
    a long one only distinct texts are spread into stretches; two joins by
    equality give the texts to drop and then the pairs that stay.
    """
    column = f"{side}_text"
    words = [r[0] for r in listed.select("word").where("word is not null").distinct().limit(LIST_IN_PLACE + 1).collect()]
    if len(words) <= LIST_IN_PLACE:
        # stretches of words are what lies between blanks of the text with one blank around each word
        spaced = F.concat(F.lit(" "), F.regexp_replace(column, T.WHITE, " "), F.lit(" "))
        whole = [f" {w} " for w in words if w and not w.startswith(" ") and not w.endswith(" ") and "  " not in w]
        if not whole:
            return pairs
        rows = pairs.withColumn("__spaced", spaced)
        if len(whole) <= 50:
            listed_in = reduce(lambda a, b: a | b, (F.col("__spaced").contains(w) for w in whole))
        else:
            listed_in = F.exists(F.array(*map(F.lit, whole)), lambda w: F.contains("__spaced", w))
        return rows.where(~listed_in | F.col("__spaced").isNull()).drop("__spaced")
    texts = pairs.select(F.col(column).alias("__text")).distinct()
    spread = texts.select("__text", F.explode(sub_ngrams(F.col("__text"))).alias("__part"))
    bad = spread.join(listed.select(F.col("word").alias("__part")).distinct(), "__part", "left_semi").select("__text").distinct()
    return pairs.join(bad, pairs[column] == bad["__text"], "left_anti")


def keep_size(pairs: DataFrame, side: str, n: int) -> DataFrame:
    """Pairs with n words on that side; 0 keeps all."""
    return pairs if n <= 0 else pairs.where(F.size(F.filter(F.split(f"{side}_text", T.WHITE), lambda w: w != "")) == n)


def filter_pairs(pairs: DataFrame, source_words: DataFrame | None = None, target_words: DataFrame | None = None, source_n: int = 0, target_n: int = 0) -> DataFrame:
    """Size and word filters of both sides."""
    for side, n, words in (("source", source_n, source_words), ("target", target_n, target_words)):
        pairs = keep_size(pairs, side, n)
        if words is not None:
            pairs = drop_listed(pairs, words, side)
    return pairs


def in_view_order(listed: DataFrame) -> DataFrame:
    """The list with words of few tokens first, then short ones, then by themselves."""
    tokens = F.size(F.filter(F.split("word", T.WHITE), lambda w: w != ""))
    return listed.orderBy(tokens, F.length("word"), "word")


def common_words(words: DataFrame, zipf: DataFrame, lang: str, threshold: float = 3.0) -> DataFrame:
    """Words whose frequency in ``zipf`` (lang, token, zipf) reaches the threshold; words that aren't there have 0."""
    known = zipf.where(F.col("lang") == lang).groupBy(F.lower("token").alias("__token")).agg(F.max("zipf").alias("__zipf"))
    rows = words.join(known, F.lower("word") == F.col("__token"), "left")
    return rows.where(F.coalesce("__zipf", F.lit(0.0)) >= threshold).select(*words.columns)


def add_words(listed: DataFrame, new: DataFrame) -> DataFrame:
    """The list with those new words that it doesn't have."""
    fresh = new.select("word").where("trim(word) <> ''").distinct()
    return listed.select("word").union(fresh.join(listed, "word", "left_anti"))
