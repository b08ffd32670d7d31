"""Phrases of several pieces by a bounded beam search.

A piece is a pair of texts that reverse into each other.  A candidate keeps
running sums, so a round is one cross join of at most ``beam_size`` candidates
with at most ``piece_limit`` pieces, both bounded by the policy and not by the
data, one projection and one top-k; the search over all pieces happens once,
in ``filter_pieces``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lang as L
from ..functions import text as T
from ..plans.policies import PhrasePolicy
from ..sources import scratch
from .ngrams import by_language

#: (text, language) to log plausibility for each token.
Scorer = Callable[[Column, Column], Column]

PIECE = ["id", "source_text", "target_text", "pair_score", "source_count", "target_count", "source_n", "target_n", "source_norm_key", "target_norm_key", "source_lang", "target_lang"]


def quality(pair_score: Column, source_count: Column, target_count: Column) -> Column:
    """Rounded, so that equal counts on swapped sides are a tie and not a matter of the last bit."""
    return F.round(pair_score + F.log(source_count + 1) + F.log(target_count + 1), 9)


def filter_pieces(pieces: DataFrame, policy: PhrasePolicy = PhrasePolicy()) -> DataFrame:
    """The best pieces within the thresholds, with ``quality``; ties by id."""
    kept = pieces.where(
        (F.col("source_norm_key") == F.reverse("target_norm_key"))
        & (F.col("source_count") >= policy.min_source_count)
        & (F.col("target_count") >= policy.min_target_count)
        & (F.col("pair_score") >= policy.min_pair_score)
        & (F.col("source_n") <= policy.max_source_n)
        & (F.col("target_n") <= policy.max_target_n)
    )
    return kept.withColumn("quality", quality(F.col("pair_score"), F.col("source_count"), F.col("target_count"))).orderBy(F.desc("quality"), "id").limit(policy.piece_limit)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), T.WHITE), lambda w: w != "")


def _language(lang: Column, default: str) -> Column:
    return F.when(lang.isNull() | (lang == ""), F.lit(default)).otherwise(lang)


def fragment_penalty(text: Column, lang: Column, policy: PhrasePolicy) -> Column:
    """For a text of function words only, or one that begins or ends weakly."""
    w = words(text)
    none = by_language(lang, L.FUNCTION_WORDS, F.lit(""))
    whole = F.forall(w, lambda x: by_language(lang, L.FUNCTION_WORDS, x)) | none
    last, first = by_language(lang, L.WEAK_LAST, F.element_at(w, -1)), by_language(lang, L.WEAK_FIRST, F.element_at(w, 1))
    p = policy.fragment_penalty
    return F.when(F.size(w) == 0, F.lit(p)).otherwise(F.when(whole, F.lit(p)).otherwise(F.lit(0.0)) + F.when(last, F.lit(0.5 * p)).otherwise(F.lit(0.0)) + F.when(first, F.lit(0.25 * p)).otherwise(F.lit(0.0)))


def _end(items: Column, at: int) -> Column:
    return F.when(F.size(items) > 0, F.element_at(items, at))


def prepared(pieces: DataFrame, policy: PhrasePolicy, zipf: DataFrame | None = None) -> DataFrame:
    """Pieces with all that doesn't depend on their place: ranks, logs, words at the ends, penalties, word frequencies."""
    s_lang, t_lang = _language(F.col("source_lang"), "es"), _language(F.col("target_lang"), "pt")
    out = filter_pieces(pieces, policy).withColumns(
        {
            "s_lang": s_lang,
            "t_lang": t_lang,
            "s_log": F.log(F.col("source_count") + 1),
            "t_log": F.log(F.col("target_count") + 1),
            "s_first": _end(words(F.col("source_text")), 1),
            "s_last": _end(words(F.col("source_text")), -1),
            "t_first": _end(words(F.col("target_text")), 1),
            "t_last": _end(words(F.col("target_text")), -1),
            "fragment": fragment_penalty(F.col("source_text"), s_lang, policy) + fragment_penalty(F.col("target_text"), t_lang, policy),
            "own_key": F.concat_ws("\t", "source_norm_key", "target_norm_key"),
            "other_key": F.concat_ws("\t", "target_norm_key", "source_norm_key"),
            "s_words": F.size(words(F.col("source_text"))),
            "t_words": F.size(words(F.col("target_text"))),
        }
    )
    for side in ("source", "target"):
        name = f"{side[0]}_zipf"
        if zipf is None:
            out = out.withColumn(name, F.lit(0.0))
            continue
        known = zipf.groupBy(F.col("lang").alias(f"{side[0]}_lang"), F.col("token").alias("word")).agg(F.max("zipf").alias("zipf"))
        each = out.select("id", f"{side[0]}_lang", F.explode(words(F.col(f"{side}_text"))).alias("word")).join(known, [f"{side[0]}_lang", "word"])
        out = out.join(each.groupBy("id").agg(F.sum("zipf").alias(name)), "id", "left").withColumn(name, F.coalesce(name, F.lit(0.0)))
    rank = F.row_number().over(Window.orderBy(F.desc("quality"), "id"))  # at most piece_limit rows
    return out.withColumn("piece_rank", rank)


def _weak_ends(first: Column, last: Column, lang: Column, policy: PhrasePolicy) -> Column:
    p = policy.edge_penalty
    weak_first, weak_last = by_language(lang, L.WEAK_FIRST, first), by_language(lang, L.WEAK_LAST, last)
    return F.when(weak_first, F.lit(0.5 * p)).otherwise(F.lit(0.0)) + F.when(weak_last, F.lit(p)).otherwise(F.lit(0.0))


_PIECES = "array<struct<id:bigint,source_text:string,target_text:string,pair_score:double,source_count:bigint,target_count:bigint,source_norm_key:string,target_norm_key:string>>"


def _extended(size: int) -> dict[str, Column]:
    """Running values of a candidate (c.*) with one more piece (p.*)."""
    c, p = lambda n: F.col(f"c.{n}"), lambda n: F.col(f"p.{n}")
    own = F.struct(p("id").cast("bigint").alias("id"), p("source_text"), p("target_text"), p("pair_score"), p("source_count").cast("bigint").alias("source_count"), p("target_count").cast("bigint").alias("target_count"), p("source_norm_key"), p("target_norm_key"))
    least = p("s_log") + p("t_log")
    start = size == 1
    return {
        "pieces": F.array(own).cast(_PIECES) if start else F.concat(c("pieces"), F.array(own)),
        "keys": F.array(p("own_key")) if start else F.concat(c("keys"), F.array(p("own_key"))),
        "repeated": F.lit(0) if start else c("repeated") + F.exists(c("pieces"), lambda x: x["id"] == p("id")).cast("int"),
        "reciprocal": F.lit(0) if start else c("reciprocal") + F.array_contains(c("keys"), p("other_key")).cast("int"),
        **{n: p(m) if start else c(n) + p(m) for n, m in (("pair_sum", "pair_score"), ("s_sum", "s_log"), ("t_sum", "t_log"), ("fragments", "fragment"), ("s_zipf", "s_zipf"), ("t_zipf", "t_zipf"), ("s_words", "s_words"), ("t_words", "t_words"))},
        "least": least if start else F.least(c("least"), least),
        "s_first": p("s_first") if start else F.coalesce(c("s_first"), p("s_first")),
        "s_last": p("s_last") if start else F.coalesce(p("s_last"), c("s_last")),
        "t_first": p("t_first") if start else F.coalesce(p("t_first"), c("t_first")),
        "t_last": p("t_last") if start else F.coalesce(c("t_last"), p("t_last")),
        "first_s_lang": p("s_lang") if start else c("first_s_lang"),
        "first_t_lang": p("t_lang") if start else c("first_t_lang"),
        "last_t_lang": p("t_lang"),
        "beam_rank": F.lit(0) if start else c("beam_rank"),
        "piece_rank": p("piece_rank"),
    }


def _score(size: int, policy: PhrasePolicy) -> Column:
    col = F.col
    frequent = lambda side: F.when(col(f"{side}_words") > 0, col(f"{side}_zipf") / col(f"{side}_words")).otherwise(F.lit(0.0))
    score = col("pair_sum") / size + col("s_sum") / size + col("t_sum") / size + F.lit(0.25) * col("least")
    score = score + F.lit(policy.wordfreq_weight) * (frequent("s") + frequent("t")) + F.lit(policy.plausibility_weight) * (col("source_plausibility") + col("target_plausibility"))
    score = score - F.lit(0.75 * max(size - 2, 0)) - F.lit(10.0) * col("repeated") - F.lit(policy.reciprocal_penalty) * col("reciprocal")
    edges = _weak_ends(col("s_first"), col("s_last"), col("first_s_lang"), policy) + _weak_ends(col("t_first"), col("t_last"), col("last_t_lang"), policy)
    return F.round(score - edges - col("fragments"), 6)


def _joined(name: str, backwards: bool, separator: str) -> Column:
    items = F.reverse("pieces") if backwards else F.col("pieces")
    return F.array_join(F.transform(items, lambda x: x[name]), separator)


def generate_phrases(pieces: DataFrame, policy: PhrasePolicy = PhrasePolicy(), zipf: DataFrame | None = None, scorer: Scorer | None = None) -> DataFrame:
    """Ranked phrases, of ``min_pieces`` to ``max_pieces`` pieces; equal scores in the order in which they were found.

    ``zipf`` (lang, token, zipf) adds word frequencies and ``scorer`` a language
    model; without them both count 0.
    """
    usable = scratch.cut(prepared(pieces, policy, zipf))
    beam: DataFrame | None = None
    found: DataFrame | None = None
    for size in range(1, policy.max_pieces + 1):
        p = usable.alias("p")
        if beam is None:
            rows = p.select(*(v.alias(k) for k, v in _extended(1).items()))
        else:
            rows = beam.alias("c").crossJoin(F.broadcast(p))  # at most beam_size times piece_limit, whatever the data
            if not policy.allow_repeated_pieces:
                rows = rows.where(~F.exists("c.pieces", lambda x: x["id"] == F.col("p.id")))
            rows = rows.select(*(v.alias(k) for k, v in _extended(size).items()))
        for side, backwards, lang in (("source", False, "first_s_lang"), ("target", True, "first_t_lang")):
            value = scorer(_joined(f"{side}_text", backwards, " "), F.col(lang)) if scorer else F.lit(0.0)
            rows = rows.withColumn(f"{side}_plausibility", value)
        rows = rows.withColumn("score", _score(size, policy)).orderBy(F.desc("score"), "beam_rank", "piece_rank").limit(policy.beam_size)
        rank = F.row_number().over(Window.orderBy(F.desc("score"), "beam_rank", "piece_rank"))  # at most beam_size rows
        beam = scratch.cut(rows.withColumn("rank", rank).drop("beam_rank", "piece_rank").withColumnRenamed("rank", "beam_rank"))
        if size >= policy.min_pieces:
            own = beam.withColumn("size", F.lit(size))
            found = own if found is None else found.union(own)
    return ranked(found, policy)


def ranked(found: DataFrame, policy: PhrasePolicy) -> DataFrame:
    """One candidate of each key (the best, of equals the first), best first."""
    key = F.sort_array(F.transform("pieces", lambda x: x["id"])).cast("string") if policy.collapse_permutations else F.concat_ws("\t", _joined("source_norm_key", False, ""), _joined("target_norm_key", True, ""))
    rows = found.withColumn("result_key", key)
    same = Window.partitionBy("result_key")
    rows = rows.withColumn("seen", F.min(F.struct("size", "beam_rank")).over(same)).withColumn("place", F.row_number().over(same.orderBy(F.desc("score"), "size", "beam_rank"))).where("place = 1")
    rows = rows.orderBy(F.desc("score"), "seen").limit(policy.max_results)
    total = lambda name, kind: F.aggregate("pieces", F.lit(0).cast(kind), lambda s, x: s + x[name])
    field = lambda name: F.transform("pieces", lambda x: x[name])
    return rows.select(
        _joined("source_text", False, " ").alias("source_phrase"),
        _joined("target_text", True, " ").alias("target_phrase"),
        F.col("score").alias("phrase_score"),
        "source_plausibility",
        "target_plausibility",
        F.size("pieces").alias("piece_count"),
        (_joined("source_norm_key", False, "") == F.reverse(_joined("target_norm_key", True, ""))).alias("formal_ok"),
        _joined("source_norm_key", False, "").alias("source_norm_key"),
        _joined("target_norm_key", True, "").alias("target_norm_key"),
        F.round(total("pair_score", "double"), 6).alias("pair_score_sum"),
        total("source_count", "bigint").alias("source_count_sum"),
        total("target_count", "bigint").alias("target_count_sum"),
        F.array_min(field("source_count")).alias("min_source_count"),
        F.array_min(field("target_count")).alias("min_target_count"),
        F.transform("pieces", lambda x: F.concat(x["source_text"], F.lit(" / "), x["target_text"])).alias("pieces"),
        field("id").alias("piece_ids"),
        field("source_count").alias("source_counts"),
        field("target_count").alias("target_counts"),
    )
