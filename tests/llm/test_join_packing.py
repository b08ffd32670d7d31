import random
import re

import numpy as np
import pytest

from retrograph.llm import ngram_join, packing

from .data import awkward, frame, words

WORD = re.compile("[a-z0-9\x80-\U0010ffff]+")


def copies(seed=4):
    rnd = random.Random(seed)
    rows, k = [], 0
    for _ in range(60):
        base = words(rnd, rnd.randint(0, 70), "abcdefghij").split()
        for _ in range(rnd.choice([1, 1, 2, 6])):
            rows.append((k, " ".join(w if rnd.random() > 0.04 else "zz" for w in base)))
            k += 1
    return rows + [(k, None), (None, rows[0][1]), (k + 1, "a b"), (k + 2, "A, b!"), (k + 3, ""), (k + 4, "..."), rows[5], (k + 5, words(rnd, 20_000)), (k + 6, "one two three four"), (k + 6, "five six seven eight"), (k + 7, "one two three four")]


def gram_set(text, n=3):
    w = WORD.findall((text or "").lower())
    return set(zip(*(w[i:] for i in range(n)), strict=False)) if len(w) >= n else ({tuple(w)} if w else set())


def brute_pairs(rows, t, n=3):
    """Similar pairs of different texts, by their least doc_ids."""
    least = {}
    for i, x in rows:
        s = gram_set(x, n)
        if s:
            least.setdefault(x, (s, []))[1].append(i)
    texts = [(s, min((i for i in ids if i is not None), default=None)) for s, ids in least.values()]
    out = []
    for a, (x, i) in enumerate(texts):
        for y, j in texts[:a]:
            if len(x & y) / len(x | y) >= t:
                lo, hi = sorted((i, j), key=lambda k: (k is None, k))
                out.append((lo, hi, round(len(x & y) / len(x | y), 6)))
    return sorted(map(str, out))


def brute_classes(rows, t=0.5, n=3):
    """doc_id, class_id and number of links of every row, and the rows of each class."""
    sets = [gram_set(x, n) for _, x in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in enumerate(sets):
        for b in range(a):
            if x and sets[b] and len(x & sets[b]) / len(x | sets[b]) >= t:
                root[find(a)] = find(b)
                links[a] += 1
                links[b] += 1
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(rows[k][0])
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    return sorted(str((i, least[find(k)], links[k])) for k, (i, _) in enumerate(rows)), list(groups.values())


def kept_ids(rows, t=0.5):
    """One row of each class: the least doc_id, nulls last."""
    return sorted(min([i is None, i or 0] for i in ids) for ids in brute_classes(rows, t)[1])


def repeated():
    rows = copies(7)
    return rows + [(700, rows[0][1]), (700, rows[0][1] + " more"), (700, "another text of the same document id"), (None, rows[0][1]), (None, "two rows without an id"), (None, "two rows without an id"), (701, "!!!"), (702, "!!!")]


@pytest.mark.parametrize("t, n", [(0.5, 3), (0.8, 3), (0.3, 2), (1.0, 1)])
def test_pairs(spark, t, n):
    rows = copies()
    got = [str(tuple(r)) for r in ngram_join.jaccard_pairs(frame(spark, rows), n, t).collect()]
    assert sorted(got) == brute_pairs(rows, t, n)


@pytest.mark.parametrize("t, n", [(0.5, 3), (0.3, 2)])
def test_classes_and_links(spark, t, n):
    rows = repeated()
    got = ngram_join.similarity_classes(frame(spark, rows), n, t)
    assert got.columns == ["doc_id", "class_id", "n_links"]
    assert sorted(str(tuple(r)) for r in got.collect()) == brute_classes(rows, t, n)[0]


def test_in_blocks_and_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 0)
    rows = copies(9)
    assert sorted(str(tuple(r)) for r in ngram_join.jaccard_pairs(frame(spark, rows)).collect()) == brute_pairs(rows, 0.5)
    rows = repeated()
    assert sorted(str(tuple(r)) for r in ngram_join.similarity_classes(frame(spark, rows)).collect()) == brute_classes(rows)[0]


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in ngram_join.components(spark.createDataFrame(edges, "a bigint, b bigint"))[0].collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, **{k: 100 for k in range(101, 160)}, 201: 200}


def test_empty(spark):
    docs = frame(spark, [])
    assert ngram_join.jaccard_pairs(docs).collect() == []
    assert ngram_join.similarity_classes(docs).collect() == []
    assert ngram_join.drop_repeated_rows(docs).collect() == []
    with pytest.raises(ValueError):
        ngram_join.jaccard_pairs(docs, threshold=0)


def test_block_join_with_skipping():
    rng = np.random.default_rng(8)
    base = [np.unique(rng.integers(0, 60, 30)) for _ in range(6)]
    sets = []
    for _ in range(80):
        b = base[rng.integers(0, 6)]
        sets.append(np.unique(np.concatenate((b[rng.random(len(b)) > 0.1], rng.integers(0, 60, 2)))))
    sets.sort(key=len)
    a, b, o = ngram_join.join_block(np.array([len(s) for s in sets]), sets, 0.6)
    want = {(i, j, len(np.intersect1d(sets[i], sets[j]))) for i in range(80) for j in range(i + 1, 80) if len(np.intersect1d(sets[i], sets[j])) / len(np.union1d(sets[i], sets[j])) >= 0.6}
    assert set(zip(a.tolist(), b.tolist(), o.tolist(), strict=True)) == want


def count_tokens(text):
    return len(re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\t\n\x0b\x0c\r ]+", (text or "").encode()))


@pytest.mark.parametrize("context, units", [(64, 16), (2048, 256)])
def test_every_piece_is_packed_once_and_fits(spark, context, units):
    rows = awkward(3, 120)
    bins = packing.pack(frame(spark, rows), context, units).collect()
    want = []
    for i, t in rows:
        n = count_tokens(t)
        want += [(i is None, i or 0, k, min(context, n - k * context)) for k in range(-(-n // context))]
    got = [(d is None, d or 0, p, n) for b in bins for d, p, n in zip(b["doc_ids"], b["pieces"], b["lengths"], strict=True)]
    assert sorted(got) == sorted(want)
    unit = context // units
    assert all(sum(-(-n // unit) for n in b["lengths"]) <= units and b["tokens"] == sum(b["lengths"]) <= context and b["n_docs"] == len(b["doc_ids"]) for b in bins)
    assert sorted(b["bin_id"] for b in bins) == list(range(len(bins)))
    least = -(-sum(-(-w[3] // unit) for w in want) // units)
    assert len(bins) <= 1.1 * least + 2


def test_bins_do_not_depend_on_partitions(spark):
    rows = awkward(3, 120) + [(None, words(random.Random(k), 9)) for k in range(20)] + [(5, "the same number"), (5, "of tokens and id")]
    seen = []
    was = spark.conf.get("spark.sql.shuffle.partitions")
    for n in (2, 7):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            seen.append(sorted(map(str, packing.pack(frame(spark, rows).repartition(n), 64, 16).collect())))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", was)
    assert seen[0] == seen[1]


def test_packing_of_nothing(spark):
    assert packing.pack(frame(spark, [])).collect() == []
    assert packing.pack(frame(spark, [(1, None), (2, " ")])).collect() == []
    with pytest.raises(ValueError):
        packing.pack(frame(spark, []), 100, 64)


def test_least_squares():
    rng = np.random.default_rng(1)
    for _ in range(30):
        a, b = rng.random((8, 12)), rng.random(8)
        x = packing.nnls(a, b)
        slope = a.T @ (b - a @ x)
        assert (x >= 0).all() and (slope <= 1e-6).all() and np.abs(slope[x > 0]).max(initial=0) < 1e-6


def test_plan_covers_the_histogram():
    rng = np.random.default_rng(2)
    for units in (8, 24):
        histogram = np.concatenate(([0], rng.integers(0, 50, units)))
        used = np.zeros(units + 1, int)
        bins = 0
        for pattern, repeat in packing.plan(histogram):
            assert sum(length * times for length, times in pattern) <= units
            bins += repeat
            for length, times in pattern:
                used[length] += times * repeat
        assert (used == histogram).all()
        assert bins <= 1.03 * sum(n for _, n in packing.best_fit(histogram.copy(), units)) + 2
