"""Quality classifier: supervised subword embeddings.

Every word, every word that repeats its neighbour, and every byte 3-gram and
5-gram of the raw text (case and punctuation kept) has a hashed, learned
vector.  A document is the average of its vectors; a softmax over two classes
follows.  Training is numpy stochastic gradient descent (AdaGrad steps) on a
bounded sample of labelled documents (``max_labelled``); whole texts are used.

Averaging and the output layer are both linear, so after training every bucket
holds one number, the difference of the two logits it adds; scoring is a table
look-up and a mean per document.

Defined results: a null or empty text has no features and gets the bias alone
(``prior``); with no labelled rows of one class every document scores 1.0 and
is kept; repeated rows get equal scores; null doc_id passes through; columns
other than doc_id and text are carried by ``filter_quality`` unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import bytescan, common

BITS = 17
BUCKETS = 1 << BITS
DIM = 8


def _families(raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature buckets and their row offsets, one pair for each kind of feature."""
    shift = np.uint64(64 - BITS)
    words = bytescan.Words(raw, at)
    yield (words.hash >> shift).astype(np.int32), words.offset
    same = np.zeros(len(words.hash), dtype=bool)
    same[1:] = words.hash[1:] == words.hash[:-1]
    again = np.flatnonzero(same)
    again = again[~np.isin(again, words.offset)]
    yield np.full(len(again), 1, np.int32), np.searchsorted(again, words.offset)
    for n in (3, 5):
        start = np.arange(len(raw) - n + 1 if len(raw) >= n else 0)
        code = bytescan.byte_grams(raw, n)
        code *= np.uint64(0x9E3779B97F4A7C15 + 2 * n)
        inside = np.ones(len(start), dtype=bool)
        for k in range(1, n):
            edge = at[1:-1] - k
            inside[edge[(edge >= 0) & (edge < len(start))]] = False
        idx = (code >> shift).astype(np.int32)
        yield idx[inside], np.searchsorted(np.flatnonzero(inside), at)


class QualityModel:
    """Logit share of every bucket, the bias and the decision threshold."""

    def __init__(self, table: np.ndarray, bias: float, threshold: float = 0.6) -> None:
        self.table, self.bias, self.threshold = table, bias, threshold

    def probability(self, text: pa.Array) -> np.ndarray:
        """Probability of the good class for each text."""
        out = np.empty(len(text))
        for lo, hi, raw, at in bytescan.chunks(text):
            total, count = np.zeros(hi - lo), np.zeros(hi - lo)
            for idx, offset in _families(raw, at):
                total += bytescan.row_sums(self.table[idx], offset)
                count += np.diff(offset)
            out[lo:hi] = 1 / (1 + np.exp(-(total / np.maximum(count, 1) + self.bias)))
        return out


def train(text: pa.Array, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.15, seed: int = 1) -> QualityModel:
    """Fit hashed vectors and the softmax layer on labelled texts."""
    if len(np.unique(y)) < 2:
        return QualityModel(np.zeros(BUCKETS, np.float32), 40.0)
    index, share, ends = [], [], [0]
    for lo, hi, raw, at in bytescan.chunks(text):
        rows, buckets = [], []
        for idx, offset in _families(raw, at):
            rows.append(np.repeat(np.arange(hi - lo), np.diff(offset)))
            buckets.append(idx)
        key, count = np.unique((np.concatenate(rows) << BITS) | np.concatenate(buckets), return_counts=True)
        row = key >> BITS
        size = np.bincount(row, weights=count, minlength=hi - lo)
        index.append((key & (BUCKETS - 1)).astype(np.int32))
        share.append((count / size[row]).astype(np.float32))
        ends.extend(ends[-1] + np.cumsum(np.bincount(row, minlength=hi - lo)))
    index, share, ends = np.concatenate(index), np.concatenate(share), np.asarray(ends)
    gen = np.random.default_rng(seed)
    vectors = gen.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = gen.uniform(-0.5, 0.5, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)
    seen = np.full((BUCKETS, DIM), 1e-8, np.float32)
    seen_out, seen_bias = np.full((DIM, 2), 1e-8, np.float32), np.full(2, 1e-8, np.float32)
    weight = len(y) / (2 * np.maximum(np.bincount(y, minlength=2), 1))
    for _ in range(epochs):
        order = gen.permutation(len(y))
        for s in range(0, len(y), batch):
            docs = order[s : s + batch]
            size = ends[docs + 1] - ends[docs]
            row = np.repeat(np.arange(len(docs)), size)
            at = np.arange(size.sum()) + np.repeat(ends[docs] - np.concatenate(([0], np.cumsum(size)[:-1])), size)
            idx, val = index[at], share[at]
            rows = vectors[idx]
            hidden = np.stack([np.bincount(row, weights=rows[:, d] * val, minlength=len(docs)) for d in range(DIM)], 1).astype(np.float32)
            z = hidden @ out + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(docs)), y[docs]] -= 1
            p *= weight[y[docs]][:, None] / len(docs)
            back = p @ out.T
            for value, sums, grad in ((out, seen_out, hidden.T @ p), (bias, seen_bias, p.sum(0))):
                sums += grad**2
                value -= rate * grad / np.sqrt(sums)
            used, place = np.unique(idx, return_inverse=True)
            step = back[row] * val[:, None]
            grad = np.stack([np.bincount(place, weights=step[:, d], minlength=len(used)) for d in range(DIM)], 1).astype(np.float32)
            seen[used] += grad**2
            vectors[used] -= rate * grad / np.sqrt(seen[used])
    return QualityModel((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fit_quality(docs: DataFrame, labels: DataFrame, max_labelled: int = 3000) -> QualityModel:
    """Train on at most ``max_labelled`` labelled documents, half of each class."""
    return train(*common.labelled_sample(docs, labels, "quality", max_labelled))


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, probability of the good class, and the decision, for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def maker():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            p = shared.value.probability(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array(p >= shared.value.threshold)], ["doc_id", "quality", "keep"])

        return step

    return common.map_arrow(docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"]), maker, "doc_id bigint, quality double, keep boolean")


def filter_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The documents the classifier accepts, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def maker():
        return lambda text: shared.value.probability(text) >= shared.value.threshold

    return common.keep_rows(docs, "text", maker)
