"""N-gram counts of document collections, their scores, and the export view."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lang as L
from ..functions import text as T
from ..plans.policies import ExportPolicy, NgramPolicy
from . import packed

KEY = ["lang", "corpus", "text", "n", "norm_key"]


def by_language(lang: Column, lists: dict[str, frozenset[str]], x: Column) -> Column:
    """Whether the word is in the list of its language; no language, no list."""
    test = None
    for name in sorted(lists):
        member = x.isin(*sorted(lists[name]))
        test = F.when(lang == name, member) if test is None else test.when(lang == name, member)
    return test.otherwise(F.lit(False))


def token_valid(token: Column, lang: Column, policy: NgramPolicy = NgramPolicy()) -> Column:
    """Length within bounds, or a word of one letter that the language knows."""
    size = F.length(token)
    short = by_language(lang, L.ONE_LETTER, T.strip_accents(token))
    return (size <= policy.max_token_len) & ((size >= policy.min_token_len) | short)


def is_stopword(token: Column, lang: Column) -> Column:
    return by_language(lang, L.STOPWORDS, T.strip_accents(token))


def all_stopwords(words: Column, lang: Column) -> Column:
    return F.forall(words, lambda w: is_stopword(w, lang))


def ngram_valid(words: Column, lang: Column, policy: NgramPolicy = NgramPolicy()) -> Column:
    """All tokens valid, the key long enough, and not all words stopwords unless that is allowed."""
    ok = F.forall(words, lambda w: token_valid(w, lang, policy)) & (F.length(T.norm_key(F.array_join(words, " "))) >= policy.min_norm_len)
    return ok if policy.include_all_stopword_ngrams else ok & ~all_stopwords(words, lang)


def chunk_rows(docs: DataFrame) -> DataFrame:
    """lang, corpus, chunk: the pieces of every text between strong punctuation."""
    rows = docs.where("text is not null").select("lang", "corpus", "text")
    text = F.col("text")
    for step, marks in ((T.remove_urls, ("http", "www")), (T.remove_markers, ("[", "{{"))):  # most texts have nothing to remove
        some = reduce(lambda a, b: a | b, (text.contains(m) for m in marks))
        rows = rows.select("lang", "corpus", T.once(F.when(some, step(text)).otherwise(text)).alias("text"))
    cleaned = rows.select("lang", "corpus", T.once(T.normalize_spacing(text)).alias("cleaned"))
    return cleaned.select("lang", "corpus", F.explode(T.chunks(F.col("cleaned"))).alias("chunk"))


def token_rows(docs: DataFrame) -> DataFrame:
    """lang, corpus, tokens: the words of every chunk that has any."""
    return chunk_rows(docs).select("lang", "corpus", T.once(T.tokens(F.col("chunk"))).alias("tokens")).where(F.size("tokens") > 0)


def count_ngrams(docs: DataFrame, policy: NgramPolicy = NgramPolicy(), weights: dict[tuple[str | None, str | None], int] | None = None) -> DataFrame:
    """lang, corpus, text, n, count, norm_key of documents (lang, corpus, text).

    Size and key follow from the text, so they are worked out after the one
    shuffle, once for each n-gram.  With ``weights``, the amount of text of each
    language and corpus, a task's result has few of them.
    """
    buckets = packed.bucket_count(docs)
    shares, buckets = packed.shared_out(weights, buckets) if weights else (None, buckets)
    return keyed(packed.count(token_rows(docs), policy, buckets, shares=shares))


def count_pairable(docs: DataFrame, source: str, target: str, policy: NgramPolicy = NgramPolicy()) -> DataFrame:
    """Counts of two languages without n-grams that can't have a partner in the other one.

    A first pass over the documents finds which stretches of letters each
    language has, a second one counts only n-grams whose key, backwards, is
    made of the other language's.  So what is summed, shuffled and joined
    follows the pairs there can be and not the n-grams there are.
    """
    spark = docs.sparkSession
    tokens = token_rows(docs.where(F.col("lang").isin(source, target)))
    seen = packed.stretches(tokens)
    others = {lang: seen[other] for lang, other in ((source, target), (target, source)) if other in seen}
    if source not in seen or target not in seen:
        tokens = tokens.where(F.lit(False))
    return keyed(packed.count(tokens, policy, packed.bucket_count(docs), packed.pairable(spark.sparkContext.broadcast(others))))


def key_of(text: str) -> Column:
    """The key of a text of lower-case words one blank apart."""
    together = F.replace(F.col(text), F.lit(" "), F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), together).otherwise(F.translate(together, T.ACCENTED + "ç", T.PLAIN + "c"))  # ASCII needs no folding


def keyed(counted: DataFrame) -> DataFrame:
    """Counts (lang, corpus, text, count) with their sizes and keys."""
    return counted.select("lang", "corpus", "text", size_of("text").alias("n"), "count", key_of("text").alias("norm_key"))


def size_of(text: str) -> Column:
    """Words of a text whose words are one blank apart."""
    return (F.length(text) - F.length(F.replace(F.col(text), F.lit(" "), F.lit(""))) + 1).cast("int")


def totals(counts: DataFrame) -> DataFrame:
    """One row for each n-gram, whatever the number of partial counts."""
    return counts.groupBy(*KEY).agg(F.sum("count").alias("count")).select("lang", "corpus", "text", "n", "count", "norm_key")


def totals_by_text(counts: DataFrame) -> DataFrame:
    """``totals`` of counts whose sizes and keys follow from their texts: only texts travel."""
    return keyed(packed.total(counts, packed.bucket_count(counts)))


def ngram_score(words: Column, count: Column, lang: Column) -> Column:
    """Log count, less for one-letter words, trigrams and stopwords, more for handy key lengths."""
    single = F.size(F.filter(words, lambda w: F.length(w) == 1))
    length = F.length(F.array_join(words, ""))
    score = F.log(count + 1) - F.lit(0.5) * single
    score = F.when(F.size(words) == 3, score - F.lit(0.25)).otherwise(score)
    score = F.when(all_stopwords(words, lang), score - F.lit(0.75)).otherwise(score)
    return F.round(F.when(length.between(4, 12), score + F.lit(0.2)).otherwise(score), 6)


def select_counts(counts: DataFrame, *, lang: str | None = None, corpus: str | None = None, n: int = 0, min_norm_len: int = 0, max_norm_len: int = 0, min_count: int = 1, compacted: bool = False) -> DataFrame:
    """Summed counts with filters; language, corpus and size reach the scan, the least count follows the sum."""
    for name, value in (("lang", lang), ("corpus", corpus)):
        if value is not None:
            counts = counts.where(F.col(name) == value)
    if n:
        counts = counts.where(F.col("n") == n)
    if min_norm_len:
        counts = counts.where(F.length("norm_key") >= min_norm_len)
    if max_norm_len:
        counts = counts.where(F.length("norm_key") <= max_norm_len)
    return (counts if compacted else totals(counts)).where(F.col("count") >= min_count)


def export_ngrams(counts: DataFrame, policy: ExportPolicy = ExportPolicy(), *, lang: str | None = None, corpus: str | None = None, compacted: bool = False) -> DataFrame:
    """lang, corpus, text, n, count, score, norm_key; most frequent first, then by text, size and key."""
    rows = select_counts(counts, lang=lang, corpus=corpus, n=policy.n, min_norm_len=policy.min_norm_len, max_norm_len=policy.max_norm_len, min_count=policy.min_count, compacted=compacted)
    rows = rows.orderBy(F.desc("count"), "text", "n", "norm_key")
    if policy.limit:
        rows = rows.limit(policy.limit)
    return rows.select("lang", "corpus", "text", "n", "count", ngram_score(F.split("text", " "), F.col("count"), F.col("lang")).alias("score"), "norm_key")
