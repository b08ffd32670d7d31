import base64
import os
import random

import numpy as np
import pyarrow as pa
import pytest

from retrograph.llm import bpe, token_shards

from .data import awkward, frame

tiktoken = pytest.importorskip("tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(bpe.RANKS), reason="no vocabulary")
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary()


@pytest.fixture(scope="module")
def public():
    with open(bpe.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rnd = random.Random(7)
    parts = ["'", "s", "l", "re", " ", "\n", " ", " ", "é", "1", "²", "!", "the ", "ing", "aa", "\t", "😀", "ß", "12", "'ve", "  ", "日", "\x85", "\x1c"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(600)] + ["a" * 5000, " " * 3000, "", "it's x'sfoo 'd'd !!'s 's\n's we'll've"]


def encode(vocabulary, texts, by_lattice=False):
    out = []
    for lo, hi, ids, at in bpe.Encoder(vocabulary, by_lattice).encode(pa.array(texts, pa.string())):
        out += [ids[at[k] : at[k + 1]].tolist() for k in range(hi - lo)]
    return out


def random_words():
    rnd = random.Random(8)
    return [" ".join("".join(rnd.choice("aeinorstlédcumpöхпто日本") for _ in range(rnd.randint(1, 60))) for _ in range(40)) for _ in range(50)]


@pytest.mark.parametrize("by_lattice", [False, True])
def test_ids_are_those_of_a_public_library(vocabulary, public, by_lattice):
    texts = odd_texts() + random_words()
    assert encode(vocabulary, texts, by_lattice) == [public.encode_ordinary(t) for t in texts]


def test_pairs_that_fit(vocabulary):
    rng = np.random.default_rng(2)
    lattice, n = bpe.Lattice(vocabulary), len(vocabulary.tokens)
    left, right = (np.concatenate((rng.integers(0, 300, 3000), rng.integers(0, n, 3000))) for _ in range(2))
    assert lattice.fits(left, right).tolist() == [vocabulary.fits(int(a), int(b)) for a, b in zip(left, right, strict=True)]


@pytest.mark.parametrize("by_lattice", [False, True])
def test_ids_with_small_memory(vocabulary, monkeypatch, by_lattice):
    texts = odd_texts()
    want = encode(vocabulary, texts, by_lattice)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    monkeypatch.setattr(bpe, "MAX_STATES", 20)
    monkeypatch.setattr(bpe.bytescan.chunks, "__defaults__", (300,))
    assert encode(vocabulary, texts, by_lattice) == want


@pytest.mark.parametrize("cut", [1, 2, 3, 7])
def test_streaming_decode(vocabulary, public, cut):
    for text in ["日本語 😀 été", "plain", ""]:
        ids = public.encode_ordinary(text)
        decoder = bpe.StreamDecoder(vocabulary.tokens)
        parts = [decoder.feed(ids[k : k + cut]) for k in range(0, len(ids), cut)]
        assert "".join(parts) + decoder.finish() == text
        assert all("�" not in p for p in parts)


def test_utf8_machine_replaces_like_python():
    rnd = random.Random(3)
    pool = [0x41, 0x80, 0xBF, 0xC0, 0xC3, 0xA9, 0xE0, 0xA0, 0xE2, 0x82, 0xAC, 0xED, 0x9F, 0xF0, 0x9F, 0x98, 0x80, 0xF4, 0x90, 0xFF]
    for _ in range(4000):
        data = bytes(rnd.choice(pool) for _ in range(rnd.randint(0, 9)))
        machine, out, at = bpe.Utf8Machine(), "", 0
        while at < len(data):
            n = rnd.randint(1, 3)
            out += machine.feed(data[at : at + n])
            at += n
        assert out + machine.finish() == data.decode("utf-8", "replace")


def test_documents(spark, public):
    rows = awkward()
    got = bpe.encode_documents(frame(spark, rows)).collect()
    key = lambda i, ids: (i is None, i or 0, ids is None, ids or [])
    want = [(i, None if t is None else public.encode_ordinary(t)) for i, t in rows]
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=lambda x: key(*x)) == sorted(want, key=lambda x: key(*x))
    assert all(r["round_trip"] is (None if r["ids"] is None else True) and r["n_tokens"] == (None if r["ids"] is None else len(r["ids"])) for r in got)
    assert bpe.encode_documents(frame(spark, [])).collect() == []


def test_grammar_round_trip():
    rng = np.random.default_rng(5)
    for kinds in (1, 2, 9, 300):
        for n in (0, 1, 2, 50, 4000):
            ids = rng.integers(0, kinds, n).astype(np.int32)
            at = np.sort(np.concatenate(([0, n], rng.integers(0, n + 1, 6))))
            row = token_shards._shard(3, [(pa.array(range(7)), ids, at)], 300).to_pylist()[0]
            reader = token_shards.ShardReader(row, 300)
            assert [reader.document(k) for k in range(7)] == [ids[at[k] : at[k + 1]].tolist() for k in range(7)]
            for _ in range(20):
                lo, hi = sorted(rng.integers(0, n + 1, 2))
                assert reader.tokens(lo, hi) == ids[lo:hi].tolist()


def test_no_pair_is_left_that_repeats():
    rng = np.random.default_rng(6)
    ids = rng.integers(0, 6, 3000).astype(np.int32)
    symbols, starts, rules = token_shards.compress(ids, np.array([0, 3000]), 6)
    pairs = list(zip(symbols[:-1].tolist(), symbols[1:].tolist(), strict=True))
    seen: dict = {}
    last = None
    for k, p in enumerate(pairs):  # occurrences that don't overlap
        if p == last and p[0] == p[1] and seen.get(p, (0, -2))[1] == k - 1:
            continue
        seen[p] = (seen.get(p, (0, -2))[0] + 1, k)
        last = p
    assert max(n for n, _ in seen.values()) < 2
    assert len(symbols) < 0.5 * len(ids) and len(rules)
    assert token_shards.expansion_lengths(rules, 6).min() == 2


def test_shards(spark, public):
    rows = awkward()
    size = len(bpe.Vocabulary().tokens)
    shards = [r.asDict() for r in token_shards.write_shards(frame(spark, rows), shard_tokens=5000).collect()]
    got = []
    for row in shards:
        reader = token_shards.ShardReader(row, size)
        got += [(i, reader.document(k)) for k, i in enumerate(row["doc_ids"])]
    want = [(i, public.encode_ordinary(t or "")) for i, t in rows]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert len({r["shard_id"] for r in shards}) == len(shards)
    assert token_shards.write_shards(frame(spark, [])).collect() == []
