"""Best-fit packing of documents into fixed contexts by non-negative least squares.

Token counts (words and runs of marks) are rounded up to units of ``context /
UNITS`` tokens.  Patterns of up to ``MAX_PARTS`` lengths that fill a context
exactly are enumerated; their repeat counts are fitted to the histogram of
lengths by non-negative least squares, rounded, and lowered where they ask for
more documents than there are.  What remains is packed best-fit, longest first,
on the histogram.  The plan's size depends on ``UNITS`` alone, not on the data;
documents find their bin from their rank within their length, by a hash of
doc_id, piece and text first; the number of ranges of that hash depends on the
number of pieces, so bins don't depend on partitions.

Documents longer than the context are cut into pieces: full contexts and a
rest.  All pieces of all documents are packed.

Defined results: documents without tokens (null, empty, blank) are not packed;
a null doc_id is packed and stays null in the list; repeated rows are packed as often as
they occur, and take places that nothing tells apart; an empty
table gives no bins; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytescan, common

CONTEXT = 2048
UNITS = 256
MAX_PARTS = 3
#: Pieces that a range of the hash has on average, beyond ``LEAST_RANGES`` ranges.
RANGE_PIECES = 1 << 18
LEAST_RANGES = 64

Pattern = tuple[tuple[int, int], ...]


def patterns(units: int = UNITS, parts: int = MAX_PARTS) -> list[Pattern]:
    """All multisets of at most ``parts`` lengths with sum ``units``, as (length, times)."""
    found = []
    for k in range(1, parts + 1):
        for head in combinations_with_replacement(range(1, units // k + 1), k - 1):
            last = units - sum(head)
            if last >= (head[-1] if head else 1):
                found.append(tuple(sorted(Counter((*head, last)).items())))
    return found


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """Least squares a x = b with x >= 0, by active sets."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    right = a.T @ b
    scale = 1e-9 * max(1.0, float(np.abs(right).max(initial=0)))
    for _ in range(rounds):
        slope = right - a.T @ (a[:, free] @ x[free])
        slope[free] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= scale:
            break
        free[best] = True
        while True:
            at = np.flatnonzero(free)
            part = a[:, at]
            z = np.linalg.solve(part.T @ part + 1e-10 * np.eye(len(at)), right[at])
            if (z > 1e-12).all():
                x[:] = 0
                x[at] = z
                break
            low = z <= 1e-12
            step = np.min(x[at][low] / np.maximum(x[at][low] - z[low], 1e-300))
            x[at] += step * (z - x[at])
            free[at[x[at] <= 1e-12]] = False
            x[~free] = 0
            if not free.any():
                break
    return x


def best_fit(left: np.ndarray, units: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on counts of lengths 1..units; equal bins are handled together."""
    bins: dict[int, Counter[Pattern]] = {}
    for length in range(units, 0, -1):
        count = int(left[length])
        while count:
            fitting = [s for s, held in bins.items() if s >= length and held]
            space = min(fitting, default=units)
            each = space // length
            if fitting:
                pattern, have = next(iter(bins[space].items()))
            else:
                pattern, have = (), -(-count // each)
            full = min(have, count // each)
            took, times = (full, each) if full else (1, count)
            if fitting:
                bins[space][pattern] -= took
                bins[space] = +bins[space]
            bins.setdefault(space - times * length, Counter())[(*pattern, (length, times))] += took
            count -= took * times
    return [(p, n) for held in bins.values() for p, n in held.items() if n]


def plan(histogram: np.ndarray, parts: int = MAX_PARTS) -> list[tuple[Pattern, int]]:
    """Patterns and how often each is used, so that all lengths of the histogram (index 0 unused) are packed."""
    units = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    choice = patterns(units, parts)
    a = np.zeros((units, len(choice)))
    for k, p in enumerate(choice):
        for length, times in p:
            a[length - 1, k] = times
    scale = max(1.0, float(left.max(initial=0)))
    repeat = np.rint(nnls(a, left[1:] / scale) * scale).astype(np.int64) if left.sum() else np.zeros(len(choice), np.int64)
    used = np.flatnonzero(repeat)
    for k in used[np.argsort(repeat[used], kind="stable")[::-1]]:  # what there is bounds each repeat
        repeat[k] = min(repeat[k], *(left[length] // times for length, times in choice[k]))
        for length, times in choice[k]:
            left[length] -= times * repeat[k]
    return [(choice[k], int(repeat[k])) for k in used if repeat[k]] + best_fit(left, units)


class Placement:
    """Bin and slot of the document with a given rank within its length."""

    def __init__(self, chosen: list[tuple[Pattern, int]]) -> None:
        rows, base = [], 0
        taken: Counter[int] = Counter()
        for pattern, repeat in chosen:
            slot = 0
            for length, times in sorted(pattern, reverse=True):
                rows.append((length, taken[length], times, base, slot))
                taken[length] += times * repeat
                slot += times
            base += repeat
        self.bins = base
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.key = (table[:, 0] << 48) + table[:, 1]
        self.table = table

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = self.table[np.searchsorted(self.key, (length.astype(np.int64) << 48) + rank, side="right") - 1]
        k = rank - row[:, 1]
        return row[:, 3] + k // row[:, 2], row[:, 4] + k % row[:, 2]


def pieces(docs: DataFrame, context: int = CONTEXT, units: int = UNITS) -> DataFrame:
    """doc_id, hash of the text, piece number, tokens of the piece, and its length in units."""
    unit = context // units

    def maker():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            count = np.zeros(batch.num_rows, np.int64)
            for lo, hi, raw, at in bytescan.chunks(batch.column(2)):
                count[lo:hi] = bytescan.count_words(raw, at, marks=True)
            n = -(-count // context)
            row = np.repeat(np.arange(len(n)), n)
            piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            tokens = np.minimum(count[row] - piece * context, context)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(row)) for c in (0, 1)), pa.array(piece.astype(np.int32)), pa.array(tokens.astype(np.int32)), pa.array((-(-tokens // unit)).astype(np.int32))],
                ["doc_id", "body", "piece", "tokens", "units"],
            )

        return step

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), F.xxhash64(docs["text"]).alias("body"), docs["text"])
    return common.map_arrow(rows, maker, "doc_id bigint, body bigint, piece int, tokens int, units int")


def pack(docs: DataFrame, context: int = CONTEXT, units: int = UNITS) -> DataFrame:
    """One row for each filled context: bin_id, doc_ids, pieces, lengths (in order of place), tokens, n_docs."""
    if context % units:
        raise ValueError("context must be a multiple of units")
    spark = docs.sparkSession
    cut = common.written(pieces(docs, context, units), "pieces")
    ranges = max(LEAST_RANGES, 1 << (cut.count() // RANGE_PIECES).bit_length())
    cut = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "body"), F.lit(ranges)).cast("int"))
    counts = cut.groupBy("units", "shard").agg(F.count("*").alias("n"))
    histogram = np.zeros(units + 1, np.int64)
    for length, n in counts.groupBy("units").agg(F.sum("n")).collect():
        histogram[length] = n
    placement = spark.sparkContext.broadcast(Placement(plan(histogram)))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("units").orderBy("shard")) - F.col("n")).drop("n")
    ranked = cut.withColumn("rank", F.row_number().over(Window.partitionBy("units", "shard").orderBy("doc_id", "piece", "body")) - 1)
    ranked = ranked.join(before, ["units", "shard"]).withColumn("rank", F.col("rank") + F.col("before")).select("doc_id", "piece", "tokens", "units", "rank")

    def maker():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            bin_id, slot = placement.value.place(batch.column(3).to_numpy(), batch.column(4).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(bin_id), pa.array(slot.astype(np.int32)), *batch.columns[:3]], ["bin_id", "slot", "doc_id", "piece", "tokens"])

        return step

    placed = common.map_arrow(ranked, maker, "bin_id bigint, slot int, doc_id bigint, piece int, tokens int")
    held = placed.groupBy("bin_id").agg(F.sort_array(F.collect_list(F.struct("slot", "doc_id", "piece", "tokens"))).alias("held"))
    return held.select(
        "bin_id",
        F.col("held.doc_id").alias("doc_ids"),
        F.col("held.piece").alias("pieces"),
        F.col("held.tokens").alias("lengths"),
        F.aggregate("held", F.lit(0), lambda s, x: s + x["tokens"]).alias("tokens"),
        F.size("held").alias("n_docs"),
    )
