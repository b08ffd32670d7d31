"""N-gram Jaccard self-join: which documents have word n-gram sets whose Jaccard similarity reaches a threshold.

Exact, with every document as a query and no cap on partners.  Documents with
equal texts are one *text* with a number of copies: texts are joined, and
copies are counted, never expanded into pairs.

1. Every document becomes its set of hashed word n-grams.  Map tasks pack the
   sets, split by ranges of the hash, into a few binary rows.
2. Each range counts in how many texts its n-grams occur.  Those of one text
   only can't be in any overlap and end here.
3. A text goes on if enough of its n-grams are shared to reach the threshold
   with anyone.  Its set is ordered by frequency, rarest first; by the prefix
   principle two similar sets share one of their first
   ``|x| - ceil(t|x|) + 1`` n-grams.
4. Texts that share a prefix n-gram and whose sizes allow the threshold are
   linked along each n-gram's list (a chain by size, so work is linear in the
   list), and connected components are found.
5. In each component sets are joined with *set-relation skipping*.  Inverted
   lists hold texts by position in order of size, so the blocks outside the
   sizes that a set can match are skipped; and a set that is very similar to
   one already answered derives its overlaps from that one's: only lists of
   n-grams in which the two differ are read.  Components of more than
   ``BLOCK`` texts are joined block against block by different tasks.

``similarity_classes`` gives one row for each document with its class, which is
the connected component of similar documents, and the number of its links;
``jaccard_pairs`` gives the pairs of texts with their similarity.

Defined results: a document with fewer than n words has one n-gram, all its
words; one without words (null, empty, punctuation) matches nothing, not even
its own copies.  Rows are joined by their texts, whatever their doc_ids: rows
without doc_id and several texts under one doc_id take part like others, and
rows that are repeated are copies.  An empty table gives no rows.  Other columns
are not read.  N-grams are compared by 48-bit hashes, texts by 64-bit ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytescan, common

N = 3
THRESHOLD = 0.5
#: Texts of a component that one task joins.
BLOCK = 2000
#: Ids up to this number are broadcast; beyond it the join shuffles.
BROADCAST_IDS = 2_000_000

_MASK = np.uint64(2**48 - 1)
_FLUSH = 1_500_000


def gram_sets(raw: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 48-bit n-gram hashes of each row, sorted, and their row offsets."""
    words = bytescan.Words(raw, at)
    grams, offset = words.grams(n)
    count = np.diff(words.offset)
    row = np.repeat(np.arange(len(count)), np.diff(offset))
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        total = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            has = count[short] > k
            total[has] += words.hash[words.offset[short[has]] + k] * np.uint64(0xA24BAED4963EE407 + 2 * k)
        grams, row = np.concatenate((grams, bytescan.mix(total))), np.concatenate((row, short))
    key = np.sort((row.astype(np.uint64) << np.uint64(48)) | (grams & _MASK))
    if len(key):
        key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    return key & _MASK, np.searchsorted(key, np.arange(len(count) + 1, dtype=np.uint64) << np.uint64(48))


def _six(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def _numbers(data: memoryview | pa.Buffer, count: int, at: int = 0) -> np.ndarray:
    """Numbers that were written by ``_six``."""
    wide = np.zeros((count, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8, 6 * count, at).reshape(count, 6)
    return wide.view("<u8").ravel()


def _pack(keys: np.ndarray, counts: np.ndarray, tokens: np.ndarray, level: np.ndarray | None = None, size: np.ndarray | None = None) -> bytes:
    """One blob: document keys, n-grams of each, n-grams, and a level of each n-gram or a size of each document."""
    parts = [np.array([len(keys), len(tokens), 1 if level is not None else 2 if size is not None else 0], "<i8"), keys.astype("<i8"), counts.astype("<i4"), _six(tokens)]
    if level is not None:
        parts.append(level.astype("u1"))
    elif size is not None:
        parts.append(size.astype("<i4"))
    return b"".join(p.tobytes() for p in parts)


def _unpack(blob: memoryview) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    m, n, more = np.frombuffer(blob, "<i8", 3)
    at = 24
    keys = np.frombuffer(blob, "<i8", m, at)
    at += 8 * m
    counts = np.frombuffer(blob, "<i4", m, at)
    at += 4 * m
    tokens = _numbers(blob, n, at)
    at += 6 * n
    return keys, counts, tokens, np.frombuffer(blob, "u1", n, at) if more == 1 else np.frombuffer(blob, "<i4", m, at) if more else None


def _split(part: np.ndarray, parts: int, doc: np.ndarray, keys: np.ndarray, tokens: np.ndarray, level: np.ndarray | None = None, size: np.ndarray | None = None) -> Iterator[tuple[int, bytes]]:
    """Pack n-grams (in order of document) by part; ``level`` goes by n-gram, ``size`` by document."""
    order = np.argsort(part.astype(np.uint16 if parts <= 65536 else np.int64), kind="stable")
    ends = np.cumsum(np.bincount(part, minlength=parts))
    for p in np.flatnonzero(np.diff(np.concatenate(([0], ends)))):
        at = order[ends[p - 1] if p else 0 : ends[p]]
        d = doc[at]
        first = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
        own = d[first]
        yield int(p), _pack(keys[own], np.diff(np.concatenate((first, [len(d)]))), tokens[at], None if level is None else level[at], None if size is None else size[own])


def _range(tokens: np.ndarray, parts: int) -> np.ndarray:
    return (((tokens >> np.uint64(16)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _blobs(column: pa.ChunkedArray) -> Iterator[memoryview]:
    for chunk in column.chunks:
        for x in chunk:
            yield memoryview(x.as_buffer())


def _gather(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    """Blobs of a group as one: document keys, n-grams of each, n-grams, levels or sizes."""
    found = [_unpack(b) for b in _blobs(column)]
    extra = None if not found or found[0][3] is None else np.concatenate([f[3] for f in found])
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3)) + (extra,)


_PACKED = "part int, kind int, blob binary"


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    part, kind, blob = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())], ["part", "kind", "blob"])


def _explode_sets(texts: DataFrame, n: int, parts: int) -> DataFrame:
    """Kind 0: packed n-grams by hash range; kind 1: key, set size and copies of texts, by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys, first, copies = np.unique(np.concatenate([h[0] for h in held]), return_index=True, return_counts=True)
            count, tokens = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            held.clear()
            own = np.zeros(len(count), bool)
            own[first] = True
            tokens = tokens[np.repeat(own, count)]
            order = np.argsort(first)
            keys, copies, count = keys[order], copies[order], count[own]
            doc = np.repeat(np.arange(len(keys)), count)
            rows = [(p, 0, b) for p, b in _split(_range(tokens, parts), parts, doc, keys, tokens)]
            home = keys.astype(np.uint64) % np.uint64(parts)
            for p in np.unique(home):
                at = home == p
                rows.append((parts + int(p), 1, b"".join(x.astype("<i8").tobytes() for x in (keys[at], count[at], copies[at]))))
            yield from _rows(rows).to_batches()

        for batch in batches:
            keys = np.asarray(batch.column(0))
            for lo, hi, raw, at in bytescan.chunks(batch.column(1)):
                tokens, offset = gram_sets(raw, at, n)
                use = np.diff(offset) > 0
                held.append((keys[lo:hi][use], np.diff(offset)[use], tokens))
                size += len(tokens)
                if size >= _FLUSH:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    return texts.select("node", "text").mapInArrow(run, _PACKED)


def _count_shared(packed: DataFrame, parts: int) -> DataFrame:
    """N-grams that occur in several texts, with the level of their frequency, by the text's key.

    A level is an eighth of a doubling, a byte instead of a number; orders by
    level and hash are the same for all documents, which is all the prefix needs.
    """

    def run(group: pa.Table) -> pa.Table:
        if group["kind"][0].as_py() == 1:
            return _rows([(int(p) - parts, 1, bytes(b)) for p, b in zip(group["part"].to_pylist(), _blobs(group["blob"]), strict=True)])
        keys, count, tokens, _ = _gather(group["blob"])
        own, first = np.unique(keys, return_index=True)
        if len(own) < len(keys):  # a text that several blobs hold
            keep = np.zeros(len(keys), bool)
            keep[first] = True
            tokens, keys, count = tokens[np.repeat(keep, count)], keys[keep], count[keep]
        doc = np.repeat(np.arange(len(keys), dtype=np.int32), count)
        order = np.argsort(tokens).astype(np.int32)
        ranked = tokens[order]
        new = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        df = np.diff(np.concatenate((new, [len(ranked)]))).astype(np.int32)
        del ranked
        many = np.repeat(df > 1, df)
        at, df = order[many], np.repeat(df, df)[many]
        back = np.lexsort((tokens[at], doc[at]))
        at, df = at[back], df[back]
        home = (keys.astype(np.uint64) % np.uint64(parts)).astype(np.int64)
        level = np.minimum(8 * np.log2(df), 255)
        return _rows([(p, 0, b) for p, b in _split(home[doc[at]], parts, doc[at], keys, tokens[at], level)])

    return packed.groupBy("part").applyInArrow(run, _PACKED)


def _ordered_sets(shared: DataFrame, threshold: float) -> DataFrame:
    """Texts that can reach the threshold with some other: shared n-grams, rarest first, and how many make the prefix."""

    def run(group: pa.Table) -> pa.Table:
        kinds = np.asarray(group["kind"])
        tables = [np.frombuffer(b, "<i8").reshape(3, -1) for b, k in zip(_blobs(group["blob"]), kinds, strict=True) if k == 1]
        out = {"key": [], "copies": [], "size": [], "prefix": [], "tokens": []}
        if tables and (kinds == 0).any():
            known = np.concatenate(tables, axis=1)
            names, first, own = np.unique(known[0], return_index=True, return_inverse=True)
            full, copies = known[1, first], np.bincount(own, known[2]).astype(np.int64)
            keys, count, tokens, df = _gather(group["blob"].filter(pa.array(kinds == 0)))
            doc = np.searchsorted(names, np.repeat(keys, count))
            have = np.bincount(doc, minlength=len(names))
            least = np.ceil(threshold * full - 1e-9).astype(np.int64)
            go = have >= np.maximum(least, 1)
            use = go[doc]
            doc, tokens, df = doc[use], tokens[use], df[use]
            order = np.lexsort((tokens, df, doc))
            doc, tokens = doc[order], tokens[order]
            at = np.searchsorted(doc, np.arange(len(names) + 1))
            for i in np.flatnonzero(go):
                part, size = tokens[at[i] : at[i + 1]], int(full[i])
                out["key"].append(int(names[i]))
                out["copies"].append(int(copies[i]))
                out["size"].append(size)
                out["prefix"].append(max(0, size - int(least[i]) + 1 - (size - len(part))))
                out["tokens"].append(_six(part).tobytes())
        return pa.table([pa.array(out["key"], pa.int64()), pa.array(out["copies"], pa.int64()), pa.array(out["size"], pa.int32()), pa.array(out["prefix"], pa.int32()), pa.array(out["tokens"], pa.binary())], list(out))

    return shared.groupBy("part").applyInArrow(run, "key bigint, copies bigint, size int, prefix int, tokens binary")


def _links(sets: DataFrame, threshold: float, parts: int) -> DataFrame:
    """Links (a, b) between keys, so that all pairs that share a prefix n-gram and fit in size are connected."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, size, prefix = (np.asarray(batch.column(i)) for i in (0, 1, 2))
            own = [_numbers(x.as_buffer(), p) for x, p in zip(batch.column(3), prefix, strict=True)]
            tokens = np.concatenate(own)
            doc = np.repeat(np.arange(len(keys)), prefix)
            yield from _rows([(p, 0, b) for p, b in _split(_range(tokens, parts), parts, doc, keys, tokens, size=size)]).to_batches()

    def link(group: pa.Table) -> pa.Table:
        keys, count, tokens, size = _gather(group["blob"])
        names, own = np.unique(keys, return_inverse=True)
        doc, size = np.repeat(own, count), np.repeat(size, count)
        order = np.lexsort((doc, size, tokens))
        doc, tokens, size = doc[order], tokens[order], size[order]
        near = (tokens[1:] == tokens[:-1]) & (size[:-1] >= threshold * size[1:] - 1e-9)
        root = _union(len(names), doc[:-1][near], doc[1:][near])
        at = np.flatnonzero(root != np.arange(len(names)))
        return pa.table([pa.array(names[at]), pa.array(names[root[at]])], ["a", "b"])

    packed = sets.where("prefix > 0").select("key", "size", "prefix", "tokens").mapInArrow(spread, _PACKED)
    return packed.groupBy("part").applyInArrow(link, "a bigint, b bigint")


def _union(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each one's connected component."""
    root = np.arange(n)
    if len(a):
        a, b = np.minimum(a, b), np.maximum(a, b)
        code = np.unique(a.astype(np.int64) * n + b)
        a, b = code // n, code % n
        while True:
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, root[a], low)
            np.minimum.at(new, root[b], low)
            new = new[new]
            if np.array_equal(new, root):
                break
            root = new
        while not np.array_equal(root, root[root]):
            root = root[root]
    return root


def components(edges: DataFrame, label: str = "components") -> tuple[DataFrame, str]:
    """Connected components of edges (a, b): (node, root), root being the least node; single nodes don't appear.  Also where they are stored.

    Alternates large-star and small-star steps until no edge changes; each
    round is written to the shared folder.  A node's least neighbour is found
    by an aggregate, so the edges of a hub need not come together in one task.
    """
    edges, path = common.stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
        both = edges.union(edges.select("b", "a"))
        large = both.where("b > a").join(both.groupBy("a").agg(F.min("b").alias("m")), "a")
        large = large.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        small = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        small = small.select("a", F.col("m").alias("b")).union(small.select(F.col("b").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()
        old = path
        edges, path = common.stored(small, label)
        common.dropped(edges.sparkSession, old)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")), path


def join_block(sizes: np.ndarray, sets: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs (i, j, overlap) of sets whose Jaccard similarity reaches the threshold.

    ``sizes`` are full set sizes in ascending order; ``sets`` hold the shared
    n-grams as sorted numbers below the number of distinct ones.
    """
    m = len(sizes)
    if m == 2:
        o = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        ok = o / (sizes[0] + sizes[1] - o) >= threshold
        return (np.array([0]), np.array([1]), np.array([o])) if ok else (np.empty(0, int),) * 3
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    lists = owner[order]
    coded = lists + m * flat[order]  # ascending: finds a position within a list

    def counted(tokens: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """How often each document of lo..hi is in the lists of the tokens; the blocks outside are skipped."""
        s, e = np.searchsorted(coded, tokens * m + lo), np.searchsorted(coded, tokens * m + hi)
        n = e - s
        at = np.arange(n.sum()) + np.repeat(s - np.concatenate(([0], np.cumsum(n)[:-1])), n)
        return np.bincount(lists[at] - lo, minlength=hi - lo)

    top = np.searchsorted(sizes, sizes / threshold + 1e-9, side="right")
    like = np.full(m, -1)
    differ = np.full(m, np.iinfo(np.int64).max)
    answers: dict[int, np.ndarray] = {}
    found: list[tuple[np.ndarray, ...]] = []
    for x in range(m - 1):
        lo, hi = x + 1, int(top[x])
        if hi <= lo:
            continue
        r = like[x]
        if r >= 0 and 2 * differ[x] < len(sets[x]):
            seen = int(top[r])
            o = np.zeros(hi - lo, np.int64)
            o[: seen - lo] = answers[r][lo - r - 1 :]
            o[: seen - lo] += counted(np.setdiff1d(sets[x], sets[r], assume_unique=True), lo, seen) - counted(np.setdiff1d(sets[r], sets[x], assume_unique=True), lo, seen)
            if hi > seen:
                o[seen - lo :] = counted(sets[x], seen, hi)
        else:
            o = counted(sets[x], lo, hi)
        ok = np.flatnonzero(o / (sizes[x] + sizes[lo:hi] - o) >= threshold)
        found.append((np.full(len(ok), x), ok + lo, o[ok]))
        y = ok + lo
        d = len(sets[x]) + np.array([len(sets[k]) for k in y], dtype=np.int64) - 2 * o[ok]
        closer = d < differ[y]
        if closer.any():
            like[y[closer]], differ[y[closer]] = x, d[closer]
            answers[x] = o
    return tuple(np.concatenate(f) for f in zip(*found, strict=True)) if found else (np.empty(0, int),) * 3


def _joined(sets: DataFrame, roots: DataFrame, threshold: float, parts: int, pairs: bool) -> DataFrame:
    """Rows (a, b, value) of texts: with ``pairs`` all similar ones and their similarity.

    Otherwise links that connect the same texts, and with b null how many
    documents with other texts are similar to a; counts of a text add up.
    """
    sized = roots.select("root", F.col("root").alias("key")).distinct().union(roots.select("root", F.col("node").alias("key")))
    blocks = sized.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    sized = sized.join(blocks, "root")
    task = F.expr("explode(flatten(transform(sequence(0, blocks - 1), k -> array(struct(least(k, mine) AS i, greatest(k, mine) AS j)))))")
    if sized.count() <= BROADCAST_IDS:
        sized = F.broadcast(sized)
    routed = sets.join(sized, "key").withColumn("mine", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).withColumn("task", task)
    routed = routed.select("key", "copies", "size", "tokens", "root", "mine", "task.i", "task.j")
    routed = routed.withColumn("part", F.pmod(F.xxhash64("root", "i", "j"), F.lit(parts)).cast("int"))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("root", "ascending"), ("i", "ascending"), ("j", "ascending"), ("size", "ascending"), ("key", "ascending")])
        root, i, j, size, mine, key, copies = (np.asarray(group[c]) for c in ("root", "i", "j", "size", "mine", "key", "copies"))
        size = size.astype(np.int64)
        blobs = [x.as_buffer() for chunk in group["tokens"].chunks for x in chunk]
        edge = np.flatnonzero(np.concatenate(([True], (root[1:] != root[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]), [True])))
        out: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        counts: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0))]
        for s, e in zip(edge[:-1], edge[1:], strict=True):
            if e - s < 2:
                continue
            own = [_numbers(b, b.size // 6) for b in blobs[s:e]]
            _, code = np.unique(np.concatenate(own), return_inverse=True)
            own = [np.sort(x) for x in np.split(code, np.cumsum([len(x) for x in own])[:-1])]
            a, b, o = join_block(size[s:e], own, threshold)
            if i[s] != j[s]:
                cross = mine[s:e][a] != mine[s:e][b]
                a, b, o = a[cross], b[cross], o[cross]
            if pairs:
                out.append((key[s:e][a], key[s:e][b], o / (size[s:e][a] + size[s:e][b] - o)))
                continue
            near = np.bincount(a, copies[s:e][b], e - s) + np.bincount(b, copies[s:e][a], e - s)
            at = np.flatnonzero(near)
            counts.append((key[s:e][at], near[at]))
            top = _union(e - s, a, b)
            b = np.flatnonzero(top != np.arange(e - s))
            out.append((key[s:e][top[b]], key[s:e][b], np.ones(len(b))))
        a, b, value = (np.concatenate(x) for x in zip(*out, strict=True))
        node, near = (np.concatenate(x) for x in zip(*counts, strict=True))
        return pa.table([pa.array(np.concatenate((a, node))), pa.array(np.concatenate((b, node)), mask=np.arange(len(a) + len(node)) >= len(a)), pa.array(np.concatenate((value, near)))], ["a", "b", "value"])

    return routed.groupBy("part").applyInArrow(run, "a bigint, b bigint, value double")


def _search(texts: DataFrame, n: int, threshold: float, pairs: bool) -> tuple[DataFrame, str]:
    """What ``_joined`` gives for texts (node, text), and where it is stored; a node may occur again with the same text."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    spark = texts.sparkSession
    common.prepare(spark)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), texts.rdd.getNumPartitions())
    sets, own = common.stored(_ordered_sets(_count_shared(_explode_sets(texts, n, parts), parts), threshold), "ngram-sets")
    roots, links = components(_links(sets, threshold, parts), "ngram-links")
    found = common.stored(_joined(sets, roots, threshold, parts, pairs), "ngram-found")
    common.dropped(spark, own, links)
    return found


def _bounded(df: DataFrame) -> DataFrame:
    """The table, to be broadcast if it has few rows; beyond that joins shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def _named(docs: DataFrame) -> DataFrame:
    """Rows with their doc_id and the hash of their text, null for a text without words."""
    has_words = docs["text"].rlike("[0-9A-Za-z]|[^\\x00-\\x7F]")
    return docs.select(F.struct("*").alias("row"), docs["doc_id"].cast("bigint").alias("id"), F.when(has_words, F.xxhash64(docs["text"])).alias("node"))


_LEAST = "struct(id IS NULL, id, node)"


def _classes(rows: DataFrame, n: int, threshold: float) -> DataFrame:
    """For each doc_id and text that has links or copies: how often it occurs, the links of each of its rows, and the class's first."""
    texts = rows.where("node is not null").select("node", F.col("row.text").alias("text"))
    found, path = _search(texts, n, threshold, False)
    groups, grouped = components(found.where("b is not null").select("a", "b"), "ngram-groups")
    links = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("value").cast("bigint").alias("links"))
    near = _bounded(groups.join(links, "node", "full").select("node", F.coalesce("root", "node").alias("root"), "links"))
    held = rows.where("node is not null").groupBy("id", "node").agg(F.count("*").alias("rows"))
    copies = held.groupBy("node").agg(F.sum("rows").alias("copies"), F.min(F.expr(_LEAST)).alias("least"))
    texts = copies.join(near, "node", "left").where("links is not null or copies > 1")
    texts = texts.select("node", "least", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    texts = common.written(texts, "ngram-texts")
    common.dropped(rows.sparkSession, path, grouped)
    first = texts.groupBy("root").agg(F.min("least").alias("first"))
    return held.join(_bounded(texts.join(first, "root").select("node", "links", "first")), "node")


def _marked(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows with what is known of their doc_id and text; a text that many rows share is joined without moving them, or with its rows split."""
    marks = _bounded(common.written(marks.withColumnsRenamed({"id": "marked_id", "node": "marked_node"}), "ngram-marks"))
    return rows.join(marks, (F.col("node") == F.col("marked_node")) & F.col("id").eqNullSafe(F.col("marked_id")), "left")


def similarity_classes(docs: DataFrame, n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id and n_links of every row.

    A row's links are the other rows whose similarity reaches the threshold,
    copies of its own text among them; a class is what links connect, and
    class_id is its least doc_id, null if no row of it has one.  A row without
    links is a class of its own.  Classes whose least doc_id is the same, as one
    doc_id has several texts, share the number.
    """
    rows = _named(docs)
    marks = _classes(rows, n, threshold).select("id", "node", "links", "first")
    rows = _marked(rows.select("id", "node"), marks)
    return rows.select(F.col("id").alias("doc_id"), F.when(F.col("first").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("class_id"), F.coalesce("links", F.lit(0)).alias("n_links"))


def jaccard_pairs(docs: DataFrame, n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of different texts that reach the threshold, each named by the least doc_id of its rows, with the similarity rounded to 6 digits."""
    rows = _named(docs)
    texts = rows.where("node is not null")
    pairs, _ = _search(texts.select("node", F.col("row.text").alias("text")), n, threshold, True)
    names = _bounded(texts.groupBy("node").agg(F.min("id").alias("id")).join(pairs.select("a").union(pairs.select("b")).distinct(), F.col("a") == F.col("node"), "left_semi"))
    for side in ("a", "b"):
        pairs = pairs.join(names.select(F.col("node").alias(side), F.col("id").alias(f"id_{side}")), side)
    swap = F.col("id_a").isNull() | (F.col("id_a") > F.col("id_b"))
    return pairs.select(F.when(swap, F.col("id_b")).otherwise(F.col("id_a")).alias("doc_id_a"), F.when(swap, F.col("id_a")).otherwise(F.col("id_b")).alias("doc_id_b"), F.round("value", 6).alias("jaccard"))


def drop_repeated_rows(docs: DataFrame, n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class of near duplicates, whatever the doc_ids; rows without words all stay.

    Texts are the nodes, so a row goes only for its own text: copies under one
    doc_id or without one are in the class, and another text under the same
    doc_id isn't.  The row of least doc_id stays, nulls last, then of least hash
    of the text; of rows that share both, one stays.
    """
    rows = _named(docs)
    marks = _classes(rows, n, threshold).withColumn("stays", F.expr(_LEAST) == F.col("first")).where("not stays or rows > 1")
    rows = _marked(rows, marks.select("id", "node", "stays"))
    once = rows.where("stays is null").select("row.*")
    first = F.row_number().over(Window.partitionBy("id", "node").orderBy(F.monotonically_increasing_id()))
    return once.unionByName(rows.where("stays").withColumn("first", first).where("first = 1").select("row.*"))
