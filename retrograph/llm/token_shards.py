"""Token ids as binary shards, compressed by a Re-Pair grammar.

Every map task encodes its documents with the byte-level BPE and closes a shard
after ``SHARD_TOKENS`` ids (a longer document makes a shard of its own).  In a
shard, frequent pairs of neighbouring symbols are replaced by nonterminals,
again and again: a pass takes all pairs that occur at least ``least`` times,
where ``least`` falls to a quarter from pass to pass down to ``MIN_COUNT`` (two), and
replaces the more frequent one where two overlap.  It ends when no pair occurs
``MIN_COUNT`` times.  Pairs don't cross documents.

A shard row holds the documents' ids and where each begins (in symbols and in
tokens), the symbols as little-endian numbers of ``width`` bytes, the rules (two
symbols each, of 4 bytes) and the expansion length of every rule.  With the
lengths ``ShardReader`` finds any token without expanding what lies before it.

Shards depend on how rows are split into tasks; what they decode to doesn't.

Defined results: null and empty texts are documents without tokens; a null
doc_id stays null in the list; repeated rows are stored as often as they occur;
an empty table gives no shards; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import bpe, common

SHARD_TOKENS = 1 << 20
MIN_COUNT = 2

_SPREAD = np.int64(0x1E3779B97F4A7C15)
_LOW, _SHIFT = (1 << 18) - 1, np.int64(40)

SCHEMA = "shard_id bigint, doc_ids array<bigint>, symbol_starts array<int>, token_starts array<int>, n_tokens int, n_rules int, width int, symbols binary, rules binary, lengths binary"


def _frequent(code: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes (-1 is none) that occur at least ``least`` times, the more frequent ones, and for each place its code's number or -1.

    Codes are looked up by a hash; of those that share one, the most frequent
    is taken and the others are left to later passes.
    """
    bucket = ((code * _SPREAD) >> _SHIFT) & _LOW
    heavy = np.flatnonzero((np.bincount(bucket, minlength=_LOW + 1) >= least)[bucket])
    own = np.sort(code[heavy])
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.empty(0, np.int64)
    count = np.diff(np.append(first, len(own)))
    many = (count >= least) & (own[first] >= 0)
    pairs, count = own[first[many]], count[many]
    order = np.argsort(count, kind="stable")
    pairs, count = pairs[order], count[order]
    table = np.full(_LOW + 1, -1, np.int32)
    table[((pairs * _SPREAD) >> _SHIFT) & _LOW] = np.arange(len(pairs))
    which = np.full(len(code), -1, np.int32)
    if len(pairs):
        found = table[bucket[heavy]]
        which[heavy] = np.where(pairs[found] == code[heavy], found, -1)
    return pairs, count, which


def _apart(weight: np.ndarray) -> np.ndarray:
    """Places of pairs to replace: none next to another, the heavier one first, from the left among equals."""
    best = weight > 0
    best[1:] &= weight[1:] >= weight[:-1]
    best[:-1] &= weight[:-1] >= weight[1:]
    at = np.flatnonzero(best)
    if not len(at):
        return at
    first = np.concatenate(([True], at[1:] != at[:-1] + 1))
    head = np.maximum.accumulate(np.where(first, at, 0))
    return at[(at - head) % 2 == 0]


def compress(ids: np.ndarray, at: np.ndarray, size: int, min_count: int = MIN_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, where each document's begin, and the rules (numbered from ``size``)."""
    symbols, starts = ids.astype(np.int64), at.astype(np.int64)
    rules: list[np.ndarray] = []
    made, least = size, max(min_count, len(ids) // 64)
    while len(symbols) > 1:
        code = (symbols[:-1] << 32) | symbols[1:]
        last = starts[1:-1]
        code[last[(last > 0) & (last < len(symbols))] - 1] = -1
        pairs, count, which = _frequent(code, least)
        if len(pairs):
            place = _apart(np.where(which >= 0, count[which], 0))
            which = which[place]
            taken = np.bincount(which, minlength=len(pairs))
            real = taken >= min(min_count, taken.max())
            keep = real[which]
            place, which = place[keep], which[keep]
            number = np.cumsum(real) - 1 + made
            rules.append(np.stack((pairs[real] >> 32, pairs[real] & 0xFFFFFFFF), 1))
            made += int(real.sum())
            symbols[place] = number[which]
            stay = np.ones(len(symbols), bool)
            stay[place + 1] = False
            starts -= np.searchsorted(place + 1, starts)
            symbols = symbols[stay]
        elif least == min_count:
            break
        least = max(min_count, least // 4)
    return symbols, starts, np.concatenate(rules) if rules else np.empty((0, 2), np.int64)


def expansion_lengths(rules: np.ndarray, size: int) -> np.ndarray:
    """Tokens that each rule stands for; a rule uses earlier ones only."""
    out = np.ones(size + len(rules), np.int64)
    todo = np.arange(len(rules))
    done = np.ones(size + len(rules), bool)
    done[size:] = False
    while len(todo):
        ready = done[rules[todo, 0]] & done[rules[todo, 1]]
        own = todo[ready]
        out[size + own] = out[rules[own, 0]] + out[rules[own, 1]]
        done[size + own] = True
        todo = todo[~ready]
    return out[size:]


def _numbers(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]).tobytes()


class ShardReader:
    """Random access to the tokens of a shard row; ``size`` is the number of ids of the vocabulary."""

    def __init__(self, row: dict, size: int) -> None:
        wide = np.zeros((len(row["symbols"]) // row["width"], 4), np.uint8)
        wide[:, : row["width"]] = np.frombuffer(row["symbols"], np.uint8).reshape(-1, row["width"])
        self.symbols, self.size = wide.view("<u4").ravel().astype(np.int64), size
        self.rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2).astype(np.int64)
        self.length = np.concatenate((np.ones(size, np.int64), np.frombuffer(row["lengths"], "<u4").astype(np.int64)))
        self.ends = np.cumsum(self.length[self.symbols])
        self.doc_ids, self.tokens_at, self.symbols_at = row["doc_ids"], row["token_starts"], row["symbol_starts"]

    def tokens(self, lo: int, hi: int) -> list[int]:
        """Tokens lo..hi of the shard, expanding only what overlaps them."""
        if hi <= lo:
            return []
        k = int(np.searchsorted(self.ends, lo, side="right"))
        at = int(self.ends[k - 1]) if k else 0
        out: list[int] = []
        while at < hi:
            stack = [int(self.symbols[k])]
            k += 1
            while stack and at < hi:
                s = stack.pop()
                n = int(self.length[s])
                if at + n <= lo:
                    at += n
                elif s < self.size:
                    out.append(s)
                    at += 1
                else:
                    left, right = self.rules[s - self.size]
                    stack += (int(right), int(left))
        return out

    def document(self, k: int) -> list[int]:
        """Tokens of the k-th document."""
        return self.tokens(self.tokens_at[k], self.tokens_at[k + 1])


def _shard(shard_id: int, held: list[tuple[pa.Array, np.ndarray, np.ndarray]], size: int) -> pa.RecordBatch:
    docs = pa.concat_arrays([h[0] for h in held])
    ids = np.concatenate([h[1] for h in held])
    at = np.concatenate(([0], np.cumsum(np.concatenate([np.diff(h[2]) for h in held]))))
    symbols, starts, rules = compress(ids, at, size)
    top = size + len(rules)
    width = 2 if top <= 1 << 16 else 3 if top <= 1 << 24 else 4
    return pa.RecordBatch.from_arrays(
        [
            pa.array([shard_id]),
            pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
            *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x.astype(np.int32))) for x in (starts, at)),
            *(pa.array([x], pa.int32()) for x in (len(ids), len(rules), width)),
            *(pa.array([x], pa.binary()) for x in (_numbers(symbols, width), _numbers(rules.ravel(), 4), _numbers(expansion_lengths(rules, size), 4))),
        ],
        ["shard_id", "doc_ids", "symbol_starts", "token_starts", "n_tokens", "n_rules", "width", "symbols", "rules", "lengths"],
    )


def write_shards(docs: DataFrame, ranks: str = bpe.RANKS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row for each shard; all documents are in one."""
    shared = docs.sparkSession.sparkContext.broadcast(bpe.Vocabulary(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        encoder, size = bpe.worker_encoder(ranks, vocabulary, by_lattice=True), len(vocabulary.tokens)
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        tokens = 0
        for batch in batches:
            for lo, hi, ids, at in encoder.encode(batch.column(1)):
                done = 0
                while done < hi - lo:  # documents up to the one that fills the shard
                    stop = int(np.searchsorted(at, at[done] + shard_tokens - tokens))
                    stop = min(max(stop, done + 1), hi - lo)
                    held.append((batch.column(0).slice(lo + done, stop - done), ids[at[done] : at[stop]], at[done : stop + 1]))
                    tokens += int(at[stop] - at[done])
                    done = stop
                    if tokens >= shard_tokens:
                        yield _shard(number, held, size)
                        number, tokens, held = number + 1, 0, []
        if held:
            yield _shard(number, held, size)

    common.prepare(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"]).mapInArrow(run, SCHEMA)
