"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Tokens are words and runs of marks with their case; a token that repeats the
one before it is replaced by one common token.  Token 1- and 2-grams are hashed
into ``BUCKETS`` buckets.  Two multinomials are counted, over all documents (the
raw corpus) and over all documents that the labels trust (quality 1).  The
target is smoothed towards the raw corpus with a prior mass, a share of the
trusted n-grams (``PRIOR_SHARE`` in the queries) or a fixed number of n-grams
(``PRIOR``).  With a share the ratios depend on the two mixes of text and not
on their sizes, so the threshold means the same at every size; with a fixed
number they shrink to 0 where few n-grams are trusted.  A document scores the
mean over its n-grams of log target/raw, rounded to 6 digits; it is kept if the
score is at least ``THRESHOLD``.  The rule is the same for every document.

Defined results: a document without tokens (null, empty, blank) scores 0 and is
kept; without trusted documents the two multinomials are equal, all scores are
0; repeated rows count as often as they occur and score alike; of repeated
label rows of a doc_id the smaller label counts; null doc_id is never trusted; other
columns are carried by ``filter_rules`` unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytescan, common

BITS = 16
BUCKETS = 1 << BITS
PRIOR = 10.0 * BUCKETS
#: Prior mass as a share of the trusted n-grams; no ratio is below log(s / (1 + s)).
PRIOR_SHARE = 0.1
THRESHOLD = -0.25
#: Share of trusted documents that may lie below a lowered threshold when the target hasn't seen them.
MISSED = 0.15
#: Trusted ids up to this number are broadcast; beyond it the join shuffles.
BROADCAST_IDS = 2_000_000

_REPEAT = np.uint64(0x5851F42D4C957F2D)


def token_grams(raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and row offsets of 1-grams, then of 2-grams."""
    words = bytescan.Words(raw, at, fold=False, marks=True)
    again = np.zeros(len(words.hash) + 1, dtype=bool)
    again[1:-1] = words.hash[1:] == words.hash[:-1]
    again[words.offset] = False
    words.hash[again[:-1]] = _REPEAT
    for n in (1, 2):
        grams, offset = words.grams(n)
        yield (grams >> np.uint64(64 - BITS)).astype(np.int32), offset


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log target/raw of each bucket from the counts of both."""
    share = (raw + 0.5) / (raw.sum() + 0.5 * len(raw))
    return np.log((target + PRIOR * share) / (target.sum() + PRIOR) / share)


def share_log_ratios(raw: np.ndarray, target: np.ndarray, share: float = PRIOR_SHARE) -> np.ndarray:
    """Log target/raw of each bucket with a prior mass of ``share`` times the target; 0 for buckets that weren't counted."""
    out = np.zeros(len(raw))
    if target.sum():
        at = np.flatnonzero(raw)
        out[at] = np.log(((target[at] / target.sum()) / (raw[at] / raw.sum()) + share) / (1 + share))
    return out


def _trusted_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Text of every document, and which half of the trusted ones it is in: 1 or 2, or 0 if it isn't trusted."""
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("__trusted")).agg(F.min("quality").alias("__least"))
    trusted = known.where("__least = 1").select("__trusted")
    if trusted.count() <= BROADCAST_IDS:
        trusted = F.broadcast(trusted)
    rows = docs.select(docs["doc_id"].cast("bigint").alias("__id"), docs["text"].alias("__text"))
    half = F.when(F.col("__trusted").isNotNull(), 1 + F.pmod(F.xxhash64("__text"), F.lit(2))).otherwise(0)
    return rows.join(trusted, F.col("__id") == F.col("__trusted"), "left").select("__text", half.cast("int").alias("__half"))


def _count_halves(rows: DataFrame) -> np.ndarray:
    """Counts of every bucket over all documents and over each half of the trusted ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, BUCKETS), np.int64)
        for batch in batches:
            half = np.asarray(batch.column(1))
            for lo, hi, raw, at in bytescan.chunks(batch.column(0)):
                for bucket, offset in token_grams(raw, at):
                    total[0] += np.bincount(bucket, minlength=BUCKETS)
                    own = np.repeat(half[lo:hi], np.diff(offset))
                    for k in (1, 2):
                        total[k] += np.bincount(bucket[own == k], minlength=BUCKETS)
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(t[at]) for t in total)], ["bucket", "raw", "first", "second"])

    common.prepare(rows.sparkSession)
    found = rows.mapInArrow(run, "bucket int, raw bigint, first bigint, second bigint").groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ("raw", "first", "second"))).toArrow()
    out = np.zeros((3, BUCKETS))
    for k, name in enumerate(("raw", "first", "second")):
        out[k, found["bucket"].to_numpy()] = found[name].to_numpy()
    return out


def count_grams(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of every bucket over all documents and over the trusted ones."""
    raw, first, second = _count_halves(_trusted_rows(docs, labels))
    return raw, first + second


def unseen_threshold(rows: DataFrame, models: tuple[RuleModel, RuleModel], missed: float = MISSED) -> float:
    """The score that all but ``missed`` of the trusted documents reach by the other half's model; at most ``THRESHOLD``.

    Scores are told apart by 3 digits, so few reach the driver.
    """
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def maker():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            half = np.asarray(batch.column(1))
            for k in (1, 2):
                text = batch.column(0).filter(pa.array(half == k))
                yield pa.RecordBatch.from_arrays([pa.array(np.floor(shared.value[2 - k].scores(text) * 1000).astype(np.int32))], ["score"])

        return step

    found = common.map_arrow(rows.where("__half > 0"), maker, "score int").groupBy("score").agg(F.count("*").alias("n")).orderBy("score").toArrow()
    score, n = (found[c].to_numpy() for c in ("score", "n"))
    if not len(score):
        return THRESHOLD
    at = np.searchsorted(np.cumsum(n), missed * n.sum())
    return min(THRESHOLD, float(score[at]) / 1000)


class RuleModel:
    """Log ratio of every bucket, and the threshold of scores."""

    def __init__(self, table: np.ndarray, threshold: float = THRESHOLD) -> None:
        self.table = table
        self.threshold = threshold

    def scores(self, text: pa.Array) -> np.ndarray:
        out = np.empty(len(text))
        for lo, hi, raw, at in bytescan.chunks(text):
            total, count = np.zeros(hi - lo), np.zeros(hi - lo)
            for bucket, offset in token_grams(raw, at):
                total += bytescan.row_sums(self.table[bucket], offset)
                count += np.diff(offset)
            out[lo:hi] = total / np.maximum(count, 1)
        return np.round(out, 6)


def fit_rules(docs: DataFrame, labels: DataFrame, prior_share: float | None = None) -> RuleModel:
    """Smoothed with a share of the trusted n-grams, or without one with ``PRIOR`` n-grams and a fixed threshold."""
    rows = _trusted_rows(docs, labels)
    raw, first, second = _count_halves(rows)
    if prior_share is None:
        return RuleModel(log_ratios(raw, first + second))
    halves = tuple(RuleModel(share_log_ratios(raw, t, prior_share)) for t in (first, second))
    return RuleModel(share_log_ratios(raw, first + second, prior_share), unseen_threshold(rows, halves))


def score_rules(docs: DataFrame, model: RuleModel, threshold: float | None = None) -> DataFrame:
    """doc_id, mean log ratio, and the decision, for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    threshold = model.threshold if threshold is None else threshold

    def maker():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            s = shared.value.scores(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array(s >= threshold)], ["doc_id", "log_ratio", "keep"])

        return step

    return common.map_arrow(docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"]), maker, "doc_id bigint, log_ratio double, keep boolean")


def filter_rules(docs: DataFrame, model: RuleModel, threshold: float | None = None) -> DataFrame:
    """The documents at or above the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    threshold = model.threshold if threshold is None else threshold
    return common.keep_rows(docs, "text", lambda: lambda text: shared.value.scores(text) >= threshold)
