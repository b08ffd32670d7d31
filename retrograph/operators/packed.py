"""N-grams counted in Arrow batches: what tasks sum up travels as compressed blocks, not as a row for each n-gram.

A mapper numbers the words of a stretch of chunks, so an n-gram is one integer
and equal ones are summed by a sort.  Sums go to buckets by a hash of their
text; a bucket's blocks are summed by whole texts.  The number of buckets
follows the input, and a bucket that is larger than expected is summed in
several passes, so memory follows neither the input nor its splits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lang as L
from ..functions import text as T
from ..plans.policies import NgramPolicy
from ..sources import scratch

#: Words whose n-grams a mapper sums up at a time, and sums that a reducer holds at a time.
FLUSH, HELD = 500_000, 1_500_000
#: Bytes of input for a bucket.
BUCKET_BYTES = 2 << 20
COUNTED = "lang string, corpus string, text string, count bigint"
BLOCK = "bucket int, rows int, size bigint, langs array<string>, corpora array<string>, data binary"

_PLAIN = str.maketrans(T.ACCENTED + T.ACCENTED.upper(), T.PLAIN + T.PLAIN.upper())
#: Letters up to U+017F to what they are in a key.
FOLD = np.arange(0x180, dtype=np.uint64)
FOLD[[ord(c) for c in T.ACCENTED + "ç"]] = [ord(c) for c in T.PLAIN + "c"]

#: (language, corpus) to the first of its buckets and how many it has.
Shares = dict[tuple[str | None, str | None], tuple[int, int]]
Mapper = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def gathered(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """Tables of at least so many words, but for the last."""
    held: list[pa.RecordBatch] = []
    words = 0
    for batch in batches:
        held.append(batch)
        words += pc.sum(pc.list_value_length(batch.column("tokens"))).as_py() or 0
        if words >= least:
            yield pa.Table.from_batches(held)
            held, words = [], 0
    if words:
        yield pa.Table.from_batches(held)


def one_array(column: pa.ChunkedArray) -> pa.Array:
    out = column.combine_chunks()
    return pa.concat_arrays(out.chunks) if isinstance(out, pa.ChunkedArray) else out


def coded(column: pa.ChunkedArray) -> tuple[np.ndarray, list[str | None]]:
    """A number for each value, and the values; null is one."""
    found = one_array(column).dictionary_encode(null_encoding="encode")
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary.to_pylist()


class Words:
    """The words of a table (lang, corpus, tokens): numbers in order of the alphabet, rows, groups of language and corpus."""

    def __init__(self, table: pa.Table) -> None:
        tokens = one_array(table.column("tokens"))
        sizes = pc.list_value_length(tokens).to_numpy(zero_copy_only=False)
        flat = tokens.flatten()
        found = flat.dictionary_encode()
        order = pc.sort_indices(found.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.flat, self.words, self.ids = flat, found.dictionary.take(order), rank[found.indices.to_numpy()]
        self.length = pc.utf8_length(self.words).to_numpy().astype(np.int64)
        self.row = np.repeat(np.arange(len(sizes)), sizes)
        lang, self.langs = coded(table.column("lang"))
        corpus, corpora = coded(table.column("corpus"))
        groups, group = np.unique(lang * len(corpora) + corpus, return_inverse=True)
        self.groups = [(self.langs[x // len(corpora)], corpora[x % len(corpora)]) for x in groups.tolist()]
        self.lang, self.group = lang[self.row], group[self.row]

    def listed(self, lists: dict[str, frozenset[str]]) -> np.ndarray:
        """For each language and word whether its list has the word without accents."""
        longest = max((len(w) for held in lists.values() for w in held), default=0)
        at = np.flatnonzero(self.length <= longest)
        plain = pa.array([w.translate(_PLAIN) for w in self.words.take(at).to_pylist()], pa.string())
        out = np.zeros((len(self.langs), len(self.words)), bool)
        for k, lang in enumerate(self.langs):
            if lang in lists:
                out[k, at] = pc.is_in(plain, pa.array(sorted(lists[lang]), pa.string())).to_numpy(zero_copy_only=False)
        return out

    def letters(self) -> tuple[np.ndarray, np.ndarray]:
        """The folded letters of all words, one after another, and where each word begins, with the end."""
        lead = np.frombuffer(self.flat.buffers()[1], np.int32)[self.flat.offset : self.flat.offset + len(self.flat) + 1]
        data = np.frombuffer(self.flat.buffers()[2], np.uint8)[lead[0] : lead[-1]]
        first = (data & 0xC0) != 0x80
        at = np.flatnonzero(first)
        code = data[at].astype(np.int64)
        two = np.flatnonzero(code >= 0x80)
        code[two] = (code[two] & 0x1F) << 6 | (data[at[two] + 1] & 0x3F)
        begins = np.concatenate(([0], np.cumsum(first)))[lead - lead[0]]
        return FOLD[code], begins


def summed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    keys.sort()
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.diff(np.append(at, len(keys)))


def windows(held: Words, policy: NgramPolicy, keep: Callable[[int], np.ndarray] | None) -> Iterator[tuple[np.ndarray, list[np.ndarray], np.ndarray]]:
    """For each size the valid n-grams: their groups, words and counts."""
    ids, v = held.ids, max(1, len(held.words))
    valid = (held.length <= policy.max_token_len) & ((held.length >= policy.min_token_len) | held.listed(L.ONE_LETTER))
    good, stop, length = valid[held.lang, ids], held.listed(L.STOPWORDS)[held.lang, ids], held.length[ids]
    for n in range(1, policy.max_n + 1):
        count = len(ids) - n + 1
        if count <= 0:
            return
        part = [slice(k, k + count) for k in range(n)]
        ok = held.row[part[0]] == held.row[part[-1]]
        for p in part:
            ok &= good[p]
        if not policy.include_all_stopword_ngrams:
            ok &= ~np.logical_and.reduce([stop[p] for p in part])
        ok &= np.add.reduce([length[p] for p in part]) >= policy.min_norm_len
        if keep is not None:
            ok &= keep(n)
        at = np.flatnonzero(ok)
        key = held.group[at] * v + ids[at]
        if n > 1:
            key = key * v + ids[at + 1]
        pairs = None
        if n > 2:
            if len(held.groups) * v**3 >= 1 << 63:  # number what comes before the last word, so that it fits
                pairs, key = np.unique(key, return_inverse=True)
            key = key * v + ids[at + 2]
        key, counts = summed(key)
        words = []
        for k in range(n - 1, -1, -1):
            words.append(key % v)
            key = key // v
            if pairs is not None and k == n - 1:
                key = pairs[key]
        yield key, words[::-1], counts


def blocks(policy: NgramPolicy, buckets: int, keep: Callable[[Words], Callable[[int], np.ndarray]] | None = None, shares: Shares | None = None) -> Mapper:
    """Sums of a mapper's n-grams by bucket: lengths, groups, counts and texts of each, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, FLUSH):
            held = Words(table)
            first, own = (np.array(x, np.uint64) for x in zip(*((shares or {}).get(g, (0, buckets)) for g in held.groups), strict=True))
            hashed = pd.util.hash_array(held.words.to_numpy(zero_copy_only=False))
            texts, group, counts, bucket = [], [], [], []
            for g, words, c in windows(held, policy, keep and keep(held)):
                spelled = [held.words.take(pa.array(w)) for w in words]
                texts.append(pc.binary_join_element_wise(*spelled, " ") if len(words) > 1 else spelled[0])
                h = hashed[words[0]]
                for w in words[1:]:
                    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashed[w]
                group.append(g)
                counts.append(c)
                bucket.append(first[g] + (h >> np.uint64(33)) % own[g])
            if texts:
                yield from packed(held.groups, pa.concat_arrays(texts), *map(np.concatenate, (group, counts, bucket)), buckets)

    return run


def packed(groups: list[tuple[str | None, str | None]], texts: pa.Array, group: np.ndarray, counts: np.ndarray, bucket: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    bucket = bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    texts, group, counts = texts.take(pa.array(order)), group[order].astype(np.uint32), counts[order].astype(np.uint64)
    begins = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    data, lengths = memoryview(texts.buffers()[2] or b""), np.diff(begins).astype(np.uint32)
    found, first = np.unique(bucket[order], return_index=True)
    ends = np.append(first[1:], len(order))
    rows = []
    for b, i, j in zip(found.tolist(), first.tolist(), ends.tolist(), strict=True):
        raw = b"".join((lengths[i:j].tobytes(), group[i:j].tobytes(), counts[i:j].tobytes(), data[begins[i] : begins[j]]))
        rows.append((b, j - i, len(raw), pa.compress(raw, "zstd", asbytes=True)))
    if rows:
        b, n, size, blob = zip(*rows, strict=True)
        langs, corpora = zip(*groups, strict=True)
        same = [pa.array([list(x)] * len(rows), pa.list_(pa.string())) for x in (langs, corpora)]
        yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(n, pa.int32()), pa.array(size, pa.int64()), *same, pa.array(blob, pa.binary())], ["bucket", "rows", "size", "langs", "corpora", "data"])


def unpacked(table: pa.Table, known: dict[tuple[str | None, str | None], int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]]:
    """Each block's byte sums, groups (as numbered in ``known``, which grows), counts and texts."""
    for row in table.to_batches():
        langs, corpora = row.column("langs"), row.column("corpora")
        for k in range(row.num_rows):
            n, size = row.column("rows")[k].as_py(), row.column("size")[k].as_py()
            raw = pa.decompress(row.column("data")[k].as_buffer(), size, "zstd")
            lengths, group = np.frombuffer(raw, np.uint32, n), np.frombuffer(raw, np.uint32, n, 4 * n)
            counts, text = np.frombuffer(raw, np.uint64, n, 8 * n), raw.slice(16 * n)
            own = [known.setdefault(x, len(known)) for x in zip(langs[k].as_py(), corpora[k].as_py(), strict=True)]
            begins = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64))).astype(np.int32)
            yield begins, np.array(own, np.int32)[group], counts.astype(np.int64), pa.StringArray.from_buffers(n, pa.py_buffer(begins), text)


def unite(table: pa.Table) -> pa.Table:
    """lang, corpus, text, count of a bucket: its blocks summed by whole texts, in passes of bounded size."""
    passes = -(-sum(table.column("rows").to_pylist()) // HELD)
    known: dict[tuple[str | None, str | None], int] = {}
    out = []
    for turn in range(passes):
        parts = []
        for begins, group, counts, texts in unpacked(table, known):
            part = pa.table([pa.array(group), texts, pa.array(counts)], ["group", "text", "count"])
            if passes > 1:
                byte_sum = np.add.reduceat(np.frombuffer(texts.buffers()[2], np.uint8).astype(np.int64), begins[:-1])
                part = part.filter(pa.array((byte_sum + np.diff(begins)) % passes == turn))
            parts.append(part)
        out.append(pa.concat_tables(parts).combine_chunks().group_by(["group", "text"]).aggregate([("count", "sum")]))
    found = pa.concat_tables(out)
    group = found.column("group")
    lang, corpus = (pa.array([x[i] for x in known], pa.string()).take(one_array(group)) for i in (0, 1))
    return pa.table([lang, corpus, found.column("text"), found.column("count_sum")], ["lang", "corpus", "text", "count"])


def bucket_count(df: DataFrame) -> int:
    """Buckets for the input's size as Spark estimates it; where it can't, as many as make every partition of a shuffle even."""
    least = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(least, size // BUCKET_BYTES) if size < 1 << 50 else least


def shared_out(weights: dict[tuple[str | None, str | None], int], buckets: int) -> tuple[Shares, int]:
    """Buckets of its own for each language and corpus, in proportion to its weight; also how many there are.

    So a task that writes partitions has few of them, and the number of files
    follows the input and not partitions times tasks.
    """
    total, at, shares = max(1, sum(weights.values())), 0, {}
    for group, weight in weights.items():
        shares[group] = (at, max(1, round(buckets * weight / total)))
        at += shares[group][1]
    return shares, max(1, at)


def count(tokens: DataFrame, policy: NgramPolicy, buckets: int, keep: Callable[[Words], Callable[[int], np.ndarray]] | None = None, shares: Shares | None = None) -> DataFrame:
    """lang, corpus, text, count of the n-grams of token rows (lang, corpus, tokens)."""
    scratch.importable(tokens.sparkSession)
    found = tokens.mapInArrow(blocks(policy, buckets, keep, shares), BLOCK)
    return found.groupBy("bucket").applyInArrow(unite, COUNTED)


def counted_blocks(buckets: int) -> Mapper:
    """Blocks of rows (lang, corpus, text, count, bucket)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(batch)
            if held and (batch is None or sum(b.num_rows for b in held) >= FLUSH):
                table, held = pa.Table.from_batches(held), []
                (lang, langs), (corpus, corpora) = coded(table.column("lang")), coded(table.column("corpus"))
                groups, group = np.unique(lang * len(corpora) + corpus, return_inverse=True)
                names = [(langs[x // len(corpora)], corpora[x % len(corpora)]) for x in groups.tolist()]
                yield from packed(names, one_array(table.column("text")), group, table.column("count").to_numpy(), table.column("bucket").to_numpy(), buckets)

    return run


def total(counts: DataFrame, buckets: int) -> DataFrame:
    """lang, corpus, text, count of partial counts with these columns, summed by text."""
    scratch.importable(counts.sparkSession)
    rows = counts.select("lang", "corpus", "text", "count", F.pmod(F.xxhash64("text"), F.lit(buckets)).cast("int").alias("bucket"))
    return rows.mapInArrow(counted_blocks(buckets), BLOCK).groupBy("bucket").applyInArrow(unite, COUNTED)


# N-grams that can be half of a pair: every stretch of STRETCH letters of a key must occur, backwards, on the other side.
# The stretches there are depend on letters and not on the amount of text, so they fit a table of one size.

STRETCH, SLOTS, PARTS = 6, 1 << 25, 64
_MIX = np.uint64(0x9E3779B97F4A7C15)


def slots(letters: np.ndarray, backwards: bool) -> np.ndarray:
    """Where each stretch of letters, or its reversal, is in the table."""
    count = len(letters) - STRETCH + 1
    held = np.zeros(max(0, count), np.uint64)
    for k in range(STRETCH) if count > 0 else ():
        at = STRETCH - 1 - k if backwards else k
        held = held << np.uint64(9) | letters[at : at + count]
    return (held * _MIX >> np.uint64(64 - (SLOTS - 1).bit_length())).astype(np.int64)


def stretches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of each language's words: the parts of a mapper's tables."""
    seen: dict[str | None, np.ndarray] = {}
    for table in gathered(batches, FLUSH):
        for lang in set(table.column("lang").to_pylist()):
            own = Words(table.filter(pc.equal(table.column("lang"), lang)))
            seen.setdefault(lang, np.zeros(SLOTS, np.uint8))[slots(own.letters()[0], False)] = 1
    for lang, table in seen.items():
        parts = np.packbits(table).reshape(PARTS, -1)
        blobs = [pa.compress(x.tobytes(), "zstd", asbytes=True) for x in parts]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * PARTS, pa.string()), pa.array(range(PARTS), pa.int32()), pa.array(blobs, pa.binary())], ["lang", "part", "data"])


def either(table: pa.Table) -> pa.Table:
    """One part of all tables."""
    found = np.zeros(SLOTS // 8 // PARTS, np.uint8)
    for blob in table.column("data"):
        found |= np.frombuffer(pa.decompress(blob.as_buffer(), len(found), "zstd"), np.uint8)
    return pa.table([table.column("lang").slice(0, 1), table.column("part").slice(0, 1), pa.array([found.tobytes()], pa.binary())], ["lang", "part", "data"])


def stretches(tokens: DataFrame) -> dict[str, np.ndarray]:
    """The table of stretches of each language of token rows, as bits: SLOTS / 8 bytes for a language."""
    scratch.importable(tokens.sparkSession)
    kind = "lang string, part int, data binary"
    rows = tokens.mapInArrow(stretches_of, kind).groupBy("lang", "part").applyInArrow(either, kind).collect()
    parts: dict[str, dict[int, bytes]] = {}
    for lang, part, data in rows:
        parts.setdefault(lang, {})[part] = bytes(data)
    return {lang: np.frombuffer(b"".join(held[k] for k in range(PARTS)), np.uint8) for lang, held in parts.items()}


def pairable(others) -> Callable[[Words], Callable[[int], np.ndarray]]:
    """Whether n-grams can have a partner; ``others`` broadcasts, for each language, the other side's table."""

    def keep(held: Words) -> Callable[[int], np.ndarray]:
        letters, begins = held.letters()
        at = slots(letters, True)
        known = np.zeros(len(at), bool)
        spoken = np.repeat(held.lang, np.diff(begins))[: len(at)]
        for k, lang in enumerate(held.langs):
            table = others.value.get(lang)
            if table is not None:
                own = np.flatnonzero(spoken == k)
                known[own] = (table[at[own] >> 3] >> (7 - (at[own] & 7)).astype(np.uint8) & 1).astype(bool)
        missing = np.concatenate(([0], np.cumsum(~known)))

        def test(n: int) -> np.ndarray:
            first, end = begins[:-n], begins[n:]
            short = end - first < STRETCH
            return short | (missing[np.maximum(end - STRETCH + 1, 0)] == missing[np.minimum(first, len(known))])

        return test

    return keep
