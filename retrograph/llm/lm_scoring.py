"""LM scoring: a hashed maximum-entropy word model with class-factored softmax.

A word is one of 2**bits outcomes by its hash, eight for every distinct word of
the corpus (at most 2**``WORD_BITS``).  The first ``CLASSES`` of its bits are
its class, and its probability is P(class | context) P(word | class, context).

*Classes.*  The features are a bias, the last word, the last two words, and the
word before the last (a skip), hashed to 2**``CLASS_BITS`` rows of class
weights.  They are trained by distributed gradient updates: tasks sum counts,
or the counts that the weights expect, one softmax for each distinct context,
and send them by ranges of rows, in every round over all documents.

*Words of a class.*  The features are the word's frequency, the last word, and
the last two words, each with the word itself, and only those that occur at
least twice.  Their weights grow with the corpus and are kept nowhere as a
whole: events (last words, word, document) are shuffled by their last word, and
the task that holds all events of a last word trains its weights by gradient
steps and scores its events.  As the features are nested, normalisers and
expected counts cost no more than the features that occur: what a feature adds
to the sum over its class is added to the sum of the one that it refines.  Each
event is left out of the counts that its own features aim at, and words that
occur once give their share to words that are not known.

Nothing is shared between classes, so a last word with more than ``SPLIT``
events goes to a task for each class of the next word, with the same results.  A
task with more than ``PART_EVENTS`` events keeps them in local files and goes
through them in slices of whole contexts; what the slices share are only the
distinct pairs of words.  Scores so depend on no limit of this kind.

Scoring sums log probabilities per document in sparse numpy batches.

Defined results: a document without words (null, empty) has 0 words, log
probability 0 and a null mean; repeated rows score alike; null doc_id passes
through; an empty table gives an empty result; other columns are not read.
Sums of floats may differ in the last digits with the partitioning.
"""

from __future__ import annotations

import os
import pickle
import tempfile
from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import bytescan, common

CLASSES = 32
CLASS_BITS = 14
WORD_BITS = 23
ROUNDS = 2
RATE = 0.5
#: Gradient steps for the words of a class, and what is added to the counts of one and of two last words.
WORD_ROUNDS = 2
PULL = (5.0, 2.0)
BLOCK_WORDS = 2_000_000
#: Words whose events one task trains on and scores.
PART_WORDS = 1_000_000
SPLIT = 500_000
#: Events that a task holds in memory at once.
PART_EVENTS = 2_000_000
#: Ranges of rows, and of words, that are added up apart from one another.
RANGES = 40

_ROWS = 1 << CLASS_BITS
_STEP = 1 << 12
_FIELDS = 3
_NONE = 1 << WORD_BITS
_U = np.uint64


class Events:
    """Classes, words and class features of the words of a chunk."""

    def __init__(self, words: bytescan.Words) -> None:
        h = words.hash
        self.offset = words.offset
        n = len(h)
        last, before = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        last[1:], before[2:] = h[:-1], h[:-2]
        first = words.offset[:-1][np.diff(words.offset) > 0]
        last[first] = 0
        before[first] = 0
        before[first[first + 1 < n] + 1] = 0
        self.hash, self.last, self.before = h, last, before
        self.cls = (h >> _U(59)).astype(np.int64)

    def rows(self) -> list[np.ndarray]:
        """A row of class weights for each feature but the bias."""
        features = (bytescan.mix(self.last + _U(11)), bytescan.mix(self.last * _U(0xC2B2AE3D27D4EB4F) + self.before + _U(13)), bytescan.mix(self.before + _U(17)))
        return [(f >> _U(64 - CLASS_BITS)).astype(np.int32) for f in features]

    def contexts(self) -> np.ndarray:
        """What the class depends on: its rows of weights, as one number."""
        key = np.zeros(len(self.cls), np.uint64)
        for r in self.rows():
            key = (key << _U(CLASS_BITS)) | r.astype(np.uint64)
        return key

    @staticmethod
    def words(hashes: np.ndarray, bits: int = WORD_BITS) -> np.ndarray:
        """Outcomes by hash; no word is the one after the last."""
        return np.where(hashes == 0, 1 << bits, (hashes >> _U(64 - bits)).astype(np.int64))


def add_counts(events: Events, total: np.ndarray) -> None:
    """Add how often features and classes occur together; the last row is the bias."""
    for r in events.rows():
        total[:_ROWS].reshape(-1)[:] += np.bincount(r.astype(np.int64) * CLASSES + events.cls, minlength=_ROWS * CLASSES)
    total[_ROWS] += np.bincount(events.cls, minlength=CLASSES)


def _add_ranked(total: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Add values to rows that are in ascending order."""
    first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    total[rows[first]] += np.add.reduceat(values, first, axis=0)


def _add(total: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Add values to rows in any order."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    ranked = rows[order]
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    size = np.diff(np.append(first, len(ranked)))
    sums = values[order[first]]
    several = np.flatnonzero(size > 1)
    if len(several):
        n = size[several]
        ends = np.cumsum(n)
        at = np.arange(ends[-1]) + np.repeat(first[several] - ends + n, n)
        sums[several] = np.add.reduceat(values[order[at]], ends - n, axis=0)
    total[ranked[first]] += sums


def _softmax(keys: np.ndarray, power: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows and class shares, not yet divided by their sum, of contexts; ``power`` is e to the weights."""
    rows = [((keys >> _U(CLASS_BITS * j)) & _U(_ROWS - 1)).astype(np.int32) for j in reversed(range(_FIELDS))]
    z = power[rows[0]] * power[rows[1]]
    z *= power[rows[2]]
    z *= power[_ROWS]
    return rows, z


def add_expected(keys: np.ndarray, weights: np.ndarray, total: np.ndarray) -> None:
    """Add the expected counts over contexts: a softmax for each distinct one, times how often it occurs.

    Contexts are taken in order of their keys and in slices whose
    probabilities stay in the processor's cache.
    """
    power = np.exp(weights)
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    count = np.diff(np.append(first, len(keys))).astype(np.float32)
    keys = keys[first]
    for s in range(0, len(keys), _STEP):
        rows, z = _softmax(keys[s : s + _STEP], power)
        z *= (count[s : s + _STEP] / z.sum(1))[:, None]
        total[_ROWS] += z.sum(0)
        _add_ranked(total, rows[0], z)
        for r in rows[1:]:
            _add(total, r, z)


def start(counts: np.ndarray, pull: float = 20.0) -> np.ndarray:
    """Class weights from counts: the bias gives log shares, other rows a part of their log ratio to them."""
    share = (counts[_ROWS] + 1) / (counts[_ROWS].sum() + CLASSES)
    seen = counts.sum(1, keepdims=True)
    weights = np.log((counts + pull * share) / (seen + pull) / share) * 0.5
    weights[_ROWS] = np.log(share)
    return weights.astype(np.float32)


def step(weights: np.ndarray, counts: np.ndarray, expected: np.ndarray, rate: float = RATE, pull: float = 5.0) -> np.ndarray:
    """One gradient step, scaled by the greater of count and expected count; weights stay within 8 of 0."""
    return np.clip(weights + rate * (counts - expected) / (np.maximum(counts, expected) + pull), -8, 8).astype(np.float32)


def _gather(docs: DataFrame, weights: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Counts by feature and class and by word, or with weights the counts by feature and class that they expect."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(weights)
    size, width = -(-(_ROWS + 1) // RANGES), -(-(_NONE + 1) // RANGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((_ROWS + 1, CLASSES), np.float64 if shared.value is None else np.float32)
        held: list[np.ndarray] = []
        found: list[tuple[np.ndarray, np.ndarray]] = []
        words = 0

        def flush() -> None:
            if held and shared.value is None:
                found.append(np.unique(np.concatenate(held), return_counts=True))
            elif held:
                add_expected(np.concatenate(held), shared.value, total)
            held.clear()

        for batch in batches:
            for _, _, raw, at in bytescan.chunks(batch.column(0)):
                events = Events(bytescan.Words(raw, at))
                if shared.value is None:
                    add_counts(events, total)
                    held += [Events.words(events.hash), np.full(np.count_nonzero(np.diff(events.offset)), _NONE)]
                else:
                    held.append(events.contexts())
                words += len(events.hash)
                if words >= BLOCK_WORDS:
                    flush()
                    words = 0
        flush()
        parts = list(range(RANGES))
        blobs = [total[k * size : (k + 1) * size].astype("<f4").tobytes() for k in parts]
        if found:
            word, count = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(word, kind="stable")
            word, count = word[order], count[order]
            cut = np.searchsorted(word, np.arange(RANGES + 1) * width)
            for k in np.flatnonzero(np.diff(cut)):
                s = slice(cut[k], cut[k + 1])
                parts.append(RANGES + int(k))
                blobs.append(np.stack((word[s], count[s])).astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], ["part", "blob"])

    def add(group: pa.Table) -> pa.Table:
        part = group["part"][0].as_py()
        blobs = [np.frombuffer(x.as_buffer(), "<f4" if part < RANGES else "<u4") for chunk in group["blob"].chunks for x in chunk]
        if part < RANGES:
            out = np.zeros(len(blobs[0]))
            for v in blobs:
                out += v
        else:
            word, count = np.concatenate([v.reshape(2, -1) for v in blobs], axis=1).astype(np.int64)
            least = (part - RANGES) * width
            sums = np.bincount(word - least, count)
            at = np.flatnonzero(sums)
            out = np.stack((at + least, sums[at].astype(np.int64)))
        return pa.table([group["part"].slice(0, 1), pa.array([out.tobytes()], pa.binary())], ["part", "blob"])

    common.prepare(spark)
    sums = docs.select("text").mapInArrow(run, "part int, blob binary").groupBy("part").applyInArrow(add, "part int, blob binary").toArrow()
    rows, words = np.zeros((_ROWS + 1, CLASSES)), np.zeros(_NONE + 1 if weights is None else 0, np.int64)
    for part, blob in zip(sums["part"].to_pylist(), sums["blob"].to_pylist(), strict=True):
        if part < RANGES:
            rows[part * size : (part + 1) * size] = np.frombuffer(blob).reshape(-1, CLASSES)
        else:
            word, count = np.frombuffer(blob, np.int64).reshape(2, -1)
            words[word] = count
    return rows, words


@dataclass
class Model:
    """Class weights and what is known of every word; all of a size that doesn't depend on the corpus beyond 2**``WORD_BITS`` words."""

    weights: np.ndarray
    bits: int
    #: Log probability of each word within its class.
    share: np.ndarray
    #: Words with more than ``split`` events, which are shared out by class, and how many each has.
    hot: np.ndarray
    times: np.ndarray
    split: int
    #: Words of the corpus.
    total: int

    def often(self, word: np.ndarray) -> np.ndarray:
        """How often frequent words occur; 0 for others."""
        if not len(self.hot):
            return np.zeros(len(word), np.int64)
        at = np.minimum(np.searchsorted(self.hot, word), len(self.hot) - 1)
        return np.where(self.hot[at] == word, self.times[at], 0)


def word_shares(count: np.ndarray) -> np.ndarray:
    """Log probability of words within their class: each is counted once less, and what that leaves of words that occur once is spread evenly."""
    once = np.count_nonzero(count == 1)
    known = np.maximum(count - 1, 0).astype(np.float32)
    known += (once + 1) / len(count)
    known = known.reshape(CLASSES, -1)
    known /= known.sum(1, keepdims=True, dtype=np.float64)
    return np.log(known, out=known).ravel()


def fit_lm(docs: DataFrame, rounds: int = ROUNDS, split: int = SPLIT) -> Model:
    """Class weights after all rounds, each over all documents, and the counts of words."""
    counts, words = _gather(docs, None)
    weights = start(counts)
    for _ in range(rounds):
        weights = step(weights, counts, _gather(docs, weights)[0])
    bits = min(WORD_BITS, max(12, int(np.count_nonzero(words)).bit_length() + 3))
    own, docs_with_words = words[:-1].reshape(1 << bits, -1).sum(1, dtype=np.int64), int(words[-1])
    del words
    hot = np.flatnonzero(own > split)
    times = own[hot]
    if docs_with_words > split:
        hot, times = np.append(hot, len(own)), np.append(times, docs_with_words)
    return Model(weights, bits, word_shares(own), hot, times, split, int(own.sum()))


def class_log_probabilities(events: Events, weights: np.ndarray) -> np.ndarray:
    """Log probability of the class of each word."""
    power, keys = np.exp(weights), events.contexts()
    out = np.zeros(len(keys))
    for s in range(0, len(keys), _STEP):
        _, z = _softmax(keys[s : s + _STEP], power)
        out[s : s + _STEP] = np.log(z[np.arange(len(z)), events.cls[s : s + _STEP]] / z.sum(1))
    return out


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal keys begin, and the run of each place."""
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new), np.cumsum(new, dtype=np.int32) - 1


def _numbered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order, and which of them each place has."""
    ranked = np.argsort(key, kind="stable")
    at, run = _runs(key[ranked])
    which = np.empty(len(key), np.int32)
    which[ranked] = run
    return key[ranked[at]], which


def _kinds(context: np.ndarray, word: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (context, word) in ascending order, how often each counts, and which of them each place has."""
    order = np.lexsort((word, context)).astype(np.int32)
    context, word = context[order], word[order]
    at, run = _runs(context, word)
    which = np.empty(len(run), np.int32)
    which[order] = run
    return context[at], word[at].astype(np.int64), np.add.reduceat(n[order].astype(np.float64), at), which


def _fit_words(kept: dict | _Files, slices: int, share: np.ndarray, rounds: int) -> None:
    """Train on slices of whole contexts, and replace each by the log probabilities of its kinds of events.

    ``kept`` has the kinds of each slice by its number.  Weights of (last, word)
    belong to all slices, those of (last, before, word) to one.
    """
    per = len(share) // CLASSES
    pair, pair_n = np.empty(0, np.int64), np.empty(0)
    for i in range(slices):
        context, word, n = kept[i]
        own, two = _numbered(((context >> 24) << 24) | word)
        kept[i] = context, word, n, own, two
        own_n = np.bincount(two, n)
        pair, number = _numbered(np.concatenate((pair, own)))
        pair_n = np.bincount(number, np.concatenate((pair_n, own_n)))
        del context, word, n, own, two, own_n, number
    # (last, word) within (last, class)
    _, base = _runs((pair >> 24) * CLASSES + (pair & 0xFFFFFF) // per)
    base_n = np.bincount(base, pair_n)
    q = np.exp(share[pair & 0xFFFFFF].astype(np.float64))

    def begin(seen: np.ndarray, prior: np.ndarray, whole: np.ndarray, part: np.ndarray, pull: float) -> np.ndarray:
        """Weights that give features their counted share of a whole, one less each, and what is left to all others alike."""
        p = (seen - 1 + pull * prior) / (whole[part] + pull)
        left, rest = (np.maximum(1 - np.bincount(part, x, len(whole)), 1e-6) for x in (p, prior))
        return np.log(p / prior * (rest / left)[part])

    one = np.flatnonzero(pair_n >= 2)
    weight = np.zeros(len(pair))
    weight[one] = begin(pair_n[one], q[one], base_n, base[one], PULL[0])
    others = np.maximum(1 - np.bincount(base[one], q[one], len(base_n)), 1e-6)
    for k in range(rounds + 1):
        value = q * np.exp(weight)
        z = others + np.bincount(base[one], value[one], len(base_n))
        rates, refined = np.zeros(len(base_n)), np.zeros(len(pair))
        for i in range(slices):
            if k == 0:
                context, word, n, own, two = kept[i]
                two = np.searchsorted(pair, own).astype(np.int32)[two]
                cell_at, cell = _runs(context, word // per)  # (context, class)
                fine = np.flatnonzero(n >= 2)
                cell_n, fine_n = np.bincount(cell, n), n[fine]
                refine = begin(fine_n, value[two[fine]] / z[base[two[fine]]], cell_n, cell[fine], PULL[1])
                state = two, cell, cell_n, base[two[cell_at]], fine.astype(np.int32), fine_n, share[word]
                del context, word, n, own, cell_at
            else:
                *state, refine = kept[i]
            two, cell, cell_n, cell_base, fine, fine_n, prior = state
            fine_two, fine_cell = two[fine], cell[fine]
            more = np.expm1(refine)
            whole = np.maximum(z[cell_base] + np.bincount(fine_cell, value[fine_two] * more, len(cell_n)), 1e-12)
            if k == rounds:
                score = prior.astype(np.float64) + weight[two] - np.log(whole)[cell]
                score[fine] += refine
                kept[i] = score
                continue
            rate = cell_n / whole
            rates += np.bincount(cell_base, rate, len(base_n))
            refined += np.bincount(fine_two, rate[fine_cell] * more, len(pair))
            fine_aim, fine_expected = fine_n - 1, rate[fine_cell] * value[fine_two] * (more + 1)
            refine += RATE * (fine_aim - fine_expected) / (np.maximum(fine_aim, fine_expected) + PULL[1])
            kept[i] = *state, refine
        if k < rounds:
            aim, expected = pair_n[one] - 1, (value * (rates[base] + refined))[one]
            weight[one] += RATE * (aim - expected) / (np.maximum(aim, expected) + PULL[0])


def word_log_probabilities(group: np.ndarray, before: np.ndarray, word: np.ndarray, counted: np.ndarray, share: np.ndarray, rounds: int = WORD_ROUNDS) -> np.ndarray:
    """Log probability of each event's word within its class.

    ``group`` numbers the last words; ``counted`` is 1 for the events that
    features are counted and trained on, 0 for those only to be scored.
    """
    if not len(group):
        return np.zeros(0)
    *kinds, which = _kinds((group.astype(np.int64) << 24) | before.astype(np.int64), word, counted)
    kept = {0: kinds}
    _fit_words(kept, 1, share, rounds)
    return kept[0][which]


_PACKED = "part int, block bigint, blob binary"


class _Files:
    """Values by name, each in a file of its own."""

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def __setitem__(self, name: int | tuple[int, int], value: object) -> None:
        with open(f"{self.folder}/{name}", "wb") as f:
            pickle.dump(value, f, protocol=5)

    def __getitem__(self, name: int | tuple[int, int]):
        with open(f"{self.folder}/{name}", "rb") as f:
            return pickle.load(f)


class PartEvents:
    """Events of a part: last word, word before, word, number of the block, document in it.

    Beyond ``limit`` they are in files, sorted by a hash of their context, so
    that any range of hashes can be read apart from the others.
    """

    KINDS = ("<u4", "<u4", "<u4", "<u4", "<u2")
    BINS = 1 << 12

    def __init__(self, limit: int, stack: ExitStack) -> None:
        self.limit, self.stack, self.folder = limit, stack, None
        self.held: list[tuple[np.ndarray, ...]] = []
        self.count = 0
        #: Where each bin of hashes begins in every file.
        self.cuts: list[np.ndarray] = []

    def add(self, *columns: np.ndarray) -> None:
        if self.held and self.count + len(columns[0]) > self.limit:
            self._write()
        self.held.append(columns)
        self.count += len(columns[0])

    def _taken(self) -> tuple[np.ndarray, ...]:
        columns = tuple(np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held.clear()
        self.count = 0
        return columns

    def _write(self) -> None:
        if self.folder is None:
            local = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
            self.folder = self.stack.enter_context(tempfile.TemporaryDirectory(prefix="lm-", dir=local))
        columns = self._taken()
        bins = (bytescan.mix((columns[0].astype(np.uint64) << _U(24)) + columns[1] + _U(1)) >> _U(52)).astype(np.uint16)
        order = np.argsort(bins, kind="stable")
        for k, (x, kind) in enumerate(zip(columns, self.KINDS, strict=True)):
            x[order].astype(kind).tofile(f"{self.folder}/events-{len(self.cuts)}-{k}")
        self.cuts.append(np.searchsorted(bins[order], np.arange(self.BINS + 1)))

    def slices(self) -> Iterator[Iterator[tuple[np.ndarray, ...]]]:
        """Slices of whole contexts, each as pieces of columns; of about ``limit`` events, unless a context has more."""
        if self.folder is None:
            yield iter([self._taken()] if self.held else [])
            return
        if self.held:
            self._write()
        ends = np.sum(self.cuts, axis=0)
        lo = 0
        while lo < self.BINS:
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + self.limit, side="right")) - 1)
            if ends[hi] > ends[lo]:
                yield self._pieces(lo, hi)
            lo = hi

    def _pieces(self, lo: int, hi: int) -> Iterator[tuple[np.ndarray, ...]]:
        for j, cut in enumerate(self.cuts):
            if n := int(cut[hi] - cut[lo]):
                yield tuple(np.fromfile(f"{self.folder}/events-{j}-{k}", kind, n, offset=int(cut[lo]) * np.dtype(kind).itemsize) for k, kind in enumerate(self.KINDS))


def _three(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]).tobytes()


def _numbers(blob: memoryview, count: int, at: int) -> np.ndarray:
    """Numbers that were written by ``_three``."""
    wide = np.zeros((count, 4), np.uint8)
    wide[:, :3] = np.frombuffer(blob, np.uint8, 3 * count, at).reshape(count, 3)
    return wide.view("<u4").ravel()


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    part, block, blob = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table([pa.array(part, pa.int32()), pa.array(block, pa.int64()), pa.array(blob, pa.binary())], ["part", "block", "blob"])


def _events(docs: DataFrame, shared, parts: int, kind: int) -> DataFrame:
    """Events by part of their last words, and with part -1 - k what is known of a block's documents.

    A block's number is even if its events count, and its second bit is set if they are scored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, ...]] = []
        known: list[tuple[np.ndarray, ...]] = []
        words = n_docs = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            last, before, word, part, doc = (np.concatenate(x) for x in zip(*held, strict=True))
            block = number << 2 | kind
            order = np.argsort((part << 24) | last)
            cut = np.searchsorted(part[order], np.arange(parts + 1))
            rows = []
            for p in np.flatnonzero(np.diff(cut)):
                at = order[cut[p] : cut[p + 1]]
                own = last[at]
                first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                blob = [np.array([len(first), len(at)], "<i8"), own[first].astype("<u4"), np.diff(np.append(first, len(at))).astype("<u4")]
                rows.append((int(p), block, b"".join(x.tobytes() for x in blob) + _three(before[at]) + _three(word[at]) + doc[at].astype("<u2").tobytes()))
            if kind & 2:
                ids, real, count, total = (np.concatenate(x) for x in zip(*known, strict=True))
                rows.append((-1 - number % parts, block, b"".join((ids.astype("<i8").tobytes(), count.astype("<i8").tobytes(), total.astype("<f8").tobytes(), real.astype("<u1").tobytes()))))
            held.clear()
            known.clear()
            number += 1
            yield from _rows(rows).to_batches()

        for batch in batches:
            ids = batch.column(0)
            real = np.asarray(ids.is_valid())
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            for start_, stop, raw, at in bytescan.chunks(batch.column(1)):
                for lo in range(start_, stop, 1 << 15):
                    hi = min(lo + (1 << 15), stop)
                    cut = at[lo - start_ : hi - start_ + 1]
                    own_raw, own_at = raw[cut[0] : cut[-1]], cut - cut[0]
                    if held and (words >= BLOCK_WORDS or n_docs + hi - lo > 1 << 16):
                        yield from flush()
                        words = n_docs = 0
                    events = Events(bytescan.Words(own_raw, own_at))
                    row = np.repeat(np.arange(hi - lo), np.diff(events.offset))
                    last, before, word = (Events.words(h, model.bits) for h in (events.last, events.before, events.hash))
                    group = bytescan.mix(last.astype(np.uint64) + _U(1 << 40))
                    some = np.flatnonzero(model.often(last))
                    group[some] = bytescan.mix(group[some] + events.cls[some].astype(np.uint64) + _U(1))
                    part = (((group >> _U(32)) * _U(parts)) >> _U(32)).astype(np.int64)
                    held.append((last, before, word, part, row + n_docs))
                    total = bytescan.row_sums(class_log_probabilities(events, model.weights), events.offset) if kind & 2 else np.zeros(hi - lo)
                    known.append((ids[lo:hi], real[lo:hi], np.diff(events.offset), total))
                    words += len(events.hash)
                    n_docs += hi - lo
        if held:
            yield from flush()

    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"]).mapInArrow(run, _PACKED)


def _unpacked(blob: memoryview) -> tuple[np.ndarray, ...]:
    """Last word, word before, word and document of a block's events."""
    m, n = map(int, np.frombuffer(blob, "<i8", 2))
    last = np.repeat(np.frombuffer(blob, "<u4", m, 16), np.frombuffer(blob, "<u4", m, 16 + 4 * m))
    at = 16 + 8 * m
    return last, _numbers(blob, n, at), _numbers(blob, n, at + 3 * n), np.frombuffer(blob, "<u2", n, at + 6 * n).copy()


def _score_part(batches: Iterator[pa.RecordBatch], share: np.ndarray, limit: int) -> Iterator[pa.RecordBatch]:
    """Train on a part's counted events, score the others, and sum the scores by document of each block."""
    blocks: list[int] = []
    with ExitStack() as stack:
        events = PartEvents(limit, stack)
        for batch in batches:
            parts, numbers = np.asarray(batch.column("part")), np.asarray(batch.column("block"))
            for part, block, blob in zip(parts, numbers, batch.column("blob"), strict=True):
                if part < 0:
                    yield from _rows([(1, int(block), blob.as_py())]).to_batches()
                    continue
                last, before, word, doc = _unpacked(memoryview(blob.as_buffer()))
                events.add(last, before, word, np.full(len(last), len(blocks), np.uint32), doc)
                blocks.append(int(block))
        if not blocks:
            return
        counted = (np.array(blocks) & 1) == 0
        pieces: list[int] = []
        kept: dict | _Files | None = None
        for i, own in enumerate(events.slices()):
            if kept is None:
                kept = {} if events.folder is None else _Files(events.folder)
            found = []
            for j, (last, before, word, block, doc) in enumerate(own):
                *kinds, which = _kinds((last.astype(np.int64) << 24) | before, word, counted[block])
                kept[i, j] = which, block, doc
                found.append(kinds)
            del last, before, word, block, doc, which
            pieces.append(len(found))
            if len(found) > 1:
                size = [len(x[0]) for x in found]
                *kinds, which = _kinds(*(np.concatenate(x) for x in zip(*found, strict=True)))
                for j, own_which in enumerate(np.split(which, np.cumsum(size)[:-1])):
                    of, block, doc = kept[i, j]
                    kept[i, j] = own_which[of], block, doc
            kept[i] = kinds
            del found, kinds
        _fit_words(kept, len(pieces), share, WORD_ROUNDS)
        for i, n in enumerate(pieces):
            score = kept[i]
            for j in range(n):
                yield from _rows(_by_document(blocks, *kept[i, j], score)).to_batches()


def _by_document(blocks: list[int], which: np.ndarray, block: np.ndarray, doc: np.ndarray, score: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Sums of scores by document, a row for each block that is scored."""
    order = np.argsort(block, kind="stable")
    first, _ = _runs(block[order])
    rows = []
    for at in np.split(order, first[1:]):
        name = blocks[block[at[0]]]
        if name & 2:
            own = doc[at]
            total, there = np.bincount(own, score[which[at]]), np.unique(own)
            rows.append((0, name, there.astype("<u2").tobytes() + total[there].astype("<f8").tobytes()))
    return rows


def _sum_block(group: pa.Table) -> pa.Table:
    """Documents of a block with the sums of all parts."""
    kinds, blobs = np.asarray(group["part"]), [memoryview(x.as_buffer()) for chunk in group["blob"].chunks for x in chunk]
    head = blobs[int(np.flatnonzero(kinds == 1)[0])]
    n = len(head) // 25
    ids, count, total = np.frombuffer(head, "<i8", n), np.frombuffer(head, "<i8", n, 8 * n), np.frombuffer(head, "<f8", n, 16 * n).copy()
    real = np.frombuffer(head, "u1", n, 24 * n) == 1
    for k in np.flatnonzero(kinds == 0):
        m = len(blobs[k]) // 10
        total[np.frombuffer(blobs[k], "<u2", m)] += np.frombuffer(blobs[k], "<f8", m, 2 * m)
    mean = pa.array(np.round(total / np.maximum(count, 1), 6), mask=count == 0)
    return pa.table([pa.array(ids, mask=~real), pa.array(count), pa.array(np.round(total, 4)), mean], ["doc_id", "n_words", "log_prob", "mean_log_prob"])


def score_lm(docs: DataFrame, model: Model, corpus: DataFrame | None = None) -> DataFrame:
    """doc_id, n_words, log probability, and its mean per word, for every document.

    ``corpus`` holds the documents that the model was fitted to, if these are
    others than those to be scored.
    """
    common.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    parts = max(1, -(-model.total // PART_WORDS))
    events = _events(docs, shared, parts, 2 if corpus is None else 3)
    if corpus is not None:
        events = events.unionByName(_events(corpus, shared, parts, 0))
    limit = PART_EVENTS

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _score_part(batches, shared.value.share, limit)

    sums = events.groupBy("part").applyInArrow(score, _PACKED)
    return sums.groupBy("block").applyInArrow(_sum_block, "doc_id bigint, n_words bigint, log_prob double, mean_log_prob double")
