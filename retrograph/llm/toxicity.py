"""Toxicity: cumulative-link ordinal regression on sparse text features.

Features are the presence of words and of word beginnings of 4 and 5 bytes (so that
inflected forms share weight), identified by 64-bit hashes.  One weight vector
is shared by ordered thresholds t1 < t2 < t3: P(grade >= k) = logistic(x.w - tk), so
P(grade = k) is the difference of two neighbours.  Training minimises the
negative log likelihood of the grades by proximal gradient descent with an L1
penalty on a bounded sample of labelled documents (``max_labelled``); weights are evidence of toxicity and
can't be negative.  All but telling features get weight 0, so long documents
gather no noise, and clean words can't hide toxic ones.

The labels are 0/1.  Grade 0 is a clean document; a toxic one is graded 1, 2 or
3 by how many of its words are distinctive of toxic documents in the sample (up
to 2, up to 5, more).  The output is the expected grade, and the decision
P(grade >= 1) >= ``DECIDE``.

Defined results: null, empty and wordless texts score as documents without any
feature; without labelled rows of both classes every document has severity 0
and isn't toxic; repeated rows score alike; null doc_id passes through; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import bytescan, common

STEMS = (4, 5)
GRADES = 3
DECIDE = 0.4
_GRADE_WORDS = (2, 5)
#: Least distance of neighbouring thresholds.
_APART = 1e-2
_BITMAP_BITS = 22


def _features(raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hashes, word numbers and rows, for each kind of feature."""
    words = bytescan.Words(raw, at)
    row = words.row()
    every = np.arange(len(row))
    yield words.hash, every, row
    running = bytescan.prefix_hash(bytescan.lower(raw))
    for n in STEMS:
        long = np.flatnonzero(words.end - words.start >= n)
        start = words.start[long]
        yield bytescan.mix(bytescan.span_hash(running, start, start + n) + np.uint64(n)), long, row[long]


class SeverityModel:
    """Weights of the telling features, by hash, and the thresholds between grades."""

    def __init__(self, names: np.ndarray, weights: np.ndarray, limits: np.ndarray) -> None:
        order = np.argsort(names)
        self.names, self.weights, self.limits = names[order], weights[order], limits
        self.seen = np.zeros(1 << _BITMAP_BITS, bool)
        self.seen[(self.names >> np.uint64(64 - _BITMAP_BITS)).astype(np.int64)] = True

    def linear(self, text: pa.Array) -> np.ndarray:
        out = np.zeros(len(text))
        if not len(self.names):
            return out
        for lo, hi, raw, at in bytescan.chunks(text):
            found = []
            for names, _, row in _features(raw, at):
                hit = np.flatnonzero(self.seen[(names >> np.uint64(64 - _BITMAP_BITS)).astype(np.int64)])
                where = np.minimum(np.searchsorted(self.names, names[hit]), len(self.names) - 1)
                real = self.names[where] == names[hit]
                found.append(row[hit[real]] * len(self.names) + where[real])
            row, name = np.divmod(np.unique(np.concatenate(found)), len(self.names))
            out[lo:hi] = np.bincount(row, weights=self.weights[name], minlength=hi - lo)
        return out

    def at_least(self, text: pa.Array) -> np.ndarray:
        """P(grade >= k) for k = 1..3, one row for each text."""
        return 1 / (1 + np.exp(-np.clip(self.linear(text)[:, None] - self.limits[None, :], -60, 60)))


def _untrained() -> SeverityModel:
    return SeverityModel(np.empty(0, np.uint64), np.empty(0), np.full(GRADES, 60.0))


def ordinal_loss(z: np.ndarray, limits: np.ndarray, grade: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Negative log likelihood of grades 0, 1, ... given linear scores, and its gradients by score and by threshold."""
    n, k = len(z), len(limits)
    above = np.ones((n, k + 2))  # P(grade >= k), from k = 0 to one beyond the last
    above[:, 1:-1] = 1 / (1 + np.exp(-np.clip(z[:, None] - limits, -60, 60)))
    above[:, -1] = 0
    every = np.arange(n)
    low, high = above[every, grade], above[every, grade + 1]
    own = np.maximum(low - high, 1e-12)
    slope = weight[:, None] * above[:, 1:-1] * (1 - above[:, 1:-1]) / own[:, None]
    by_limit = (slope * (grade[:, None] == np.arange(1, k + 1))).sum(0) - (slope * (grade[:, None] == np.arange(k))).sum(0)
    return float(-(weight * np.log(own)).sum()), weight * (low + high - 1), by_limit


def train(text: pa.Array, toxic: np.ndarray, rounds: int = 250, l1: float = 1e-3, least_docs: int = 2) -> SeverityModel:
    """Fit shared weights and ordered thresholds."""
    if len(np.unique(toxic)) < 2:
        return _untrained()
    names, rows, words = [], [], []
    base = 0
    for lo, hi, raw, at in bytescan.chunks(text):
        top = base
        for name, word, row in _features(raw, at):
            names.append(name)
            rows.append((row + lo).astype(np.int32))
            words.append((word + base).astype(np.int32))
            top = max(top, base + len(name))
        base = top
    rows, words = np.concatenate(rows), np.concatenate(words)
    kinds = np.unique(np.concatenate([np.unique(x) for x in names]))
    feature = np.concatenate([np.searchsorted(kinds, x).astype(np.int32) for x in names])
    names.clear()
    n = len(toxic)
    code = np.unique(feature * np.int64(n) + rows)
    f, d = (x.astype(np.int32) for x in (code // n, code % n))
    del code
    in_toxic = np.bincount(f[toxic[d] == 1], minlength=len(kinds))
    in_clean = np.bincount(f[toxic[d] == 0], minlength=len(kinds))
    odds = np.log((in_toxic + 0.5) / (toxic.sum() + 1)) - np.log((in_clean + 0.5) / ((toxic == 0).sum() + 1))
    marked = (odds > 2) & (in_toxic >= least_docs)
    telling = np.unique(words[marked[feature]])
    home = np.zeros(base, np.int32)
    home[words] = rows
    del feature, words, rows
    count = np.bincount(home[telling], minlength=n)
    grade = np.where(toxic == 1, 1 + np.searchsorted(_GRADE_WORDS, count, side="left"), 0)
    used = np.flatnonzero(in_toxic + in_clean >= least_docs)
    place = np.full(len(kinds), -1)
    place[used] = np.arange(len(used))
    ok = place[f] >= 0
    f, d = place[f[ok]], d[ok]
    w, limits = np.zeros(len(used)), np.array([1.0, 2.0, 3.0])
    seen_w, seen_l = np.full(len(used), 1e-6), np.full(GRADES, 1e-6)
    weight = np.where(toxic == 1, 0.5 / max(toxic.sum(), 1), 0.5 / max((toxic == 0).sum(), 1))
    for _ in range(rounds):
        z = np.bincount(d, weights=w[f], minlength=n)
        _, error, h = ordinal_loss(z, limits, grade, weight)
        g = np.bincount(f, weights=error[d], minlength=len(used))
        seen_w += g * g
        step = 0.3 / np.sqrt(seen_w)
        w = np.maximum(w - step * (g + l1), 0)
        seen_l += h * h
        limits = limits - 0.3 * h / np.sqrt(seen_l)
        limits = np.maximum.accumulate(limits - _APART * np.arange(GRADES)) + _APART * np.arange(GRADES)
    keep = np.flatnonzero(w)
    return SeverityModel(kinds[used[keep]], w[keep], limits)


def fit_severity(docs: DataFrame, labels: DataFrame, max_labelled: int = 6000) -> SeverityModel:
    """Train on at most ``max_labelled`` labelled documents, a third of them toxic."""
    return train(*common.labelled_sample(docs, labels, "toxic", max_labelled, share=1 / 3))


def score_severity(docs: DataFrame, model: SeverityModel) -> DataFrame:
    """doc_id, expected grade (0 to 3), and the decision, for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def maker():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            p = shared.value.at_least(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.round(p.sum(1), 6)), pa.array(p[:, 0] >= DECIDE)], ["doc_id", "severity", "toxic"])

        return step

    return common.map_arrow(docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"]), maker, "doc_id bigint, severity double, toxic boolean")
