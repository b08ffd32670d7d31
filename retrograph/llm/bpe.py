"""Byte-level BPE: encoding by a lazily determinised transducer, decoding by an incremental UTF-8 machine.

*Encoding.*  A rank file is compiled into the split of every token (its last
merge) and a trie of token bytes.  A sequence of tokens is the encoding of its
bytes exactly if every two neighbours are, so encodings are the runs of a
non-deterministic transducer whose states are (last token, place in the trie).
``Transducer`` determinises it as texts ask for it: a state is the set of runs
that are alive, with the tokens they don't agree on yet; what they agree on is
emitted.  Lookahead is bounded by what a merge can reach back.

Texts are cut by the usual pattern of such vocabularies (contractions, letters,
numbers, marks, white space) with numpy on whole Arrow columns; every distinct
piece goes through the transducer once in a worker, and is remembered by its
64-bit hash (up to ``CACHE_WORDS`` pieces, then the memory starts anew).  Where
only the ids matter, as in shards of ids, ``Lattice`` gives the same ones with
arrays, all new pieces of a chunk at once.

*Decoding.*  ``StreamDecoder`` takes ids in portions of any size; bytes of a
character that isn't complete are held back in the state of a UTF-8 machine.
Invalid bytes become U+FFFD, one for each maximal part.

Defined results: null text gives null ids, null count and null round trip; an
empty text gives no ids; repeated rows give equal ids; null doc_id passes
through; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import bytescan, common

RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
CACHE_WORDS = 3_000_000
#: States the transducer holds before it starts anew.
MAX_STATES = 100_000

_LETTER, _NUMBER, _SPACE, _MARK = range(4)
_SPACES = {*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}


def _kind(cp: int) -> int:
    if cp in _SPACES:
        return _SPACE
    return {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(cp))[0], _MARK)


@lru_cache(maxsize=None)
def _kinds(limit: int) -> np.ndarray:
    return np.array([_kind(cp) for cp in range(limit)], np.uint8)


def char_kinds(raw: np.ndarray) -> np.ndarray:
    """For each byte the kind of its character."""
    kind = _kinds(256)[raw]
    lead = np.flatnonzero(raw >= 0xC0)
    if not len(lead):
        return kind
    wide = np.concatenate((raw, np.zeros(3, np.uint8))).astype(np.int32)
    first = wide[lead]
    cp = ((first & 0x1F) << 6) | (wide[lead + 1] & 0x3F)
    three, four = np.flatnonzero((first >= 0xE0) & (first < 0xF0)), np.flatnonzero(first >= 0xF0)
    for at, n, mask in ((three, 3, 0x0F), (four, 4, 0x07)):
        if len(at):
            value = first[at] & mask
            for k in range(1, n):
                value = (value << 6) | (wide[lead[at] + k] & 0x3F)
            cp[at] = np.minimum(value, 0x10FFFF)
    found = _kinds(0x800 if not len(three) and not len(four) else 0x110000)[cp]
    out = np.concatenate((kind, np.zeros(3, np.uint8)))
    out[lead] = out[lead + 1] = found
    several = np.concatenate((three, four))
    out[lead[several] + 2] = found[several]
    out[lead[four] + 3] = found[four]
    return out[:-3]


def pieces(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """First bytes of the pieces that merges don't cross; each goes to the next one's start."""
    n = len(raw)
    if not n:
        return np.empty(0, np.int64)
    kind = char_kinds(raw)
    row = np.zeros(n + 1, bool)
    row[at] = True
    run = np.ones(n + 1, bool)
    run[1:n] = kind[1:] != kind[:-1]
    run |= row
    start = run.copy()
    # the last white space before something else stands alone; a blank joins what follows
    follow = np.flatnonzero(run[1:n] & ~row[1:n] & (kind[1:] != _SPACE) & (kind[:-1] == _SPACE)) + 1
    blank = follow - 1
    for _ in range(3):
        blank -= (raw[blank] & 0xC0) == 0x80
    start[blank] = True
    start[follow[raw[blank] == 32]] = False
    wide = np.concatenate((raw, np.zeros(3, np.uint8)))
    quote = np.flatnonzero(raw == 39)
    quote = quote[start[quote] & run[quote + 1] & ~row[quote + 1]]
    if len(quote):
        a, b = wide[quote + 1], np.where(row[np.minimum(quote + 2, n)], 0, wide[quote + 2])
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        hit = one | two
        start[quote[hit] + 1] = False
        start[quote[hit] + np.where(one, 2, 3)[hit]] = True
    return np.flatnonzero(start[:n])


class Vocabulary:
    """Tokens by id, the two parts of every token's last merge, and the trie of token bytes."""

    def __init__(self, path: str = RANKS) -> None:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        self.parts: list[tuple[int, int] | None] = [None] * len(self.tokens)
        self.pairs: dict[tuple[int, int], int] = {}
        self.trie: dict[int, int] = {}
        self.accept: list[int] = [-1]
        self.inner: list[bool] = [False]
        for token, rank in ranks.items():
            self.tokens[rank] = token
        for rank, token in enumerate(self.tokens):
            if not token:
                continue
            if len(token) > 1:
                halves = _merge(token, ranks, rank)
                if len(halves) != 2:  # no merge makes it
                    continue
                self.parts[rank] = (ranks[halves[0]], ranks[halves[1]])
                self.pairs[self.parts[rank]] = rank
            node = 0
            for byte in token:
                self.inner[node] = True
                key = node << 8 | byte
                if key not in self.trie:
                    self.trie[key] = len(self.accept)
                    self.accept.append(-1)
                    self.inner.append(False)
                node = self.trie[key]
            self.accept[node] = rank

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, are the encoding of their bytes.

        Walks the seam between them down through the merges that made both,
        latest first: a merge across the seam must not come before the merge
        that took one of its sides.
        """
        bound = len(self.tokens)
        while True:
            across = self.pairs.get((left, right))
            if across is not None and across < bound:
                return False
            outer_left, outer_right = self.parts[left], self.parts[right]
            if outer_left is None and outer_right is None:
                return True
            if outer_right is None or (outer_left is not None and left > right):
                bound, left = left, outer_left[1]
            else:
                bound, right = right + 1, outer_right[0]


def _merge(token: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """Merge bytes by the ranks under ``below``, least first, leftmost first."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
        if rank >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """Bytes to tokens; deterministic states are made when they are first reached."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.fit: dict[tuple[int, int], bool] = {}
        self._clear()

    def _clear(self) -> None:
        #: A state's runs: tokens not emitted yet, the last token, the place in the trie.
        self.runs: list[tuple[tuple[tuple[int, ...], int, int], ...]] = [(((), -1, 0),)]
        self.known = {self.runs[0]: 0}
        #: Tokens that end a piece with this byte in this state; what lies beyond an end needs no state.
        self.end: dict[int, tuple[int, ...]] = {}
        self.next: dict[int, tuple[int, tuple[int, ...]]] = {}

    def _fits(self, last: int, token: int) -> bool:
        if last < 0:
            return True
        fits = self.fit.get((last, token))
        if fits is None:
            fits = self.fit[last, token] = self.v.fits(last, token)
        return fits

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        v, alive, whole = self.v, [], None
        for held, last, node in self.runs[state]:
            child = v.trie.get(node << 8 | byte)
            if child is None:
                continue
            if v.inner[child]:
                alive.append((held, last, child))
            token = v.accept[child]
            if token >= 0 and whole is None and self._fits(last, token):
                whole = ((*held, token), token, 0)
        if whole is None:
            raise ValueError(f"the vocabulary can't express byte {byte}")
        alive.append(whole)
        k = 0
        while len(whole[0]) > k and all(len(r[0]) > k and r[0][k] == whole[0][k] for r in alive):
            k += 1
        runs = tuple(sorted((held[k:], last, node) for held, last, node in alive))
        new = self.known.get(runs)
        if new is None:
            new = self.known[runs] = len(self.runs)
            self.runs.append(runs)
        self.next[state << 8 | byte] = out = (new, whole[0][:k])
        return out

    def _finish(self, state: int, byte: int) -> tuple[int, ...]:
        v = self.v
        for held, last, node in self.runs[state]:
            child = v.trie.get(node << 8 | byte)
            if child is not None and v.accept[child] >= 0 and self._fits(last, v.accept[child]):
                found = self.end[state << 8 | byte] = (*held, v.accept[child])
                return found
        raise ValueError(f"the vocabulary can't express byte {byte}")

    def encode(self, word: bytes) -> list[int]:
        if len(self.runs) > MAX_STATES or len(self.end) > 8 * MAX_STATES:
            self._clear()
        state, out, known = 0, [], self.next
        if not word:
            return out
        for byte in word[:-1]:
            found = known.get(state << 8 | byte)
            if found is None:
                found = self._step(state, byte)
            state, emit = found
            if emit:
                out += emit
        last = self.end.get(state << 8 | word[-1])
        out += self._finish(state, word[-1]) if last is None else last
        return out


class _Table:
    """Numbers of distinct 64-bit keys, found for whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(12, int(len(keys)).bit_length() + 3)
        self.shift, self.probes = np.uint64(64 - bits), 0
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        todo = np.arange(len(keys))
        while len(todo):
            slot = self._slot(keys[todo], self.probes)
            _, first = np.unique(slot, return_index=True)
            first = first[self.values[slot[first]] < 0]
            self.keys[slot[first]], self.values[slot[first]] = keys[todo[first]], values[todo[first]]
            todo = np.delete(todo, first)
            self.probes += 1

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        return ((keys >> self.shift).astype(np.int64) + probe) & (len(self.keys) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys, 0)
        out = np.where(self.keys[slot] == keys, self.values[slot], -1)
        rest = np.flatnonzero((out < 0) & (self.values[slot] >= 0))
        for probe in range(1, self.probes):
            if not len(rest):
                break
            slot = self._slot(keys[rest], probe)
            hit = self.keys[slot] == keys[rest]
            out[rest[hit]] = self.values[slot[hit]]
            rest = rest[~hit & (self.values[slot] >= 0)]
        return out


class Lattice:
    """The transducer's runs for many pieces at once, with arrays instead of states.

    For every end of a piece's beginnings exactly one token fits the last token
    of what is before it.  All tokens within all pieces are looked up by hash,
    those that fit are taken from the left, and ids are read from the right.
    """

    #: Longer pieces go through the transducer.
    LONGEST = 48

    def __init__(self, vocabulary: Vocabulary) -> None:
        v = vocabulary
        used = np.array([k for k, t in enumerate(v.tokens) if len(t) == 1 or v.parts[k]], np.int64)
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in v.tokens])))
        running = bytescan.prefix_hash(np.frombuffer(b"".join(v.tokens), np.uint8))
        self.size = np.diff(bounds)
        self.tokens = _Table(bytescan.span_hash(running, bounds[used], bounds[used + 1]), used.astype(np.int32))
        self.longest = int(min(self.LONGEST, self.size[used].max()))
        self.left, self.right = (np.array([-1 if x is None else x[k] for x in v.parts], np.int32) for k in (0, 1))
        made = np.flatnonzero(self.left >= 0)
        self.pairs = _Table(self._pair(self.left[made], self.right[made]), made.astype(np.int32))

    @staticmethod
    def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return bytescan.mix((left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64))

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``Vocabulary.fits`` of many pairs."""
        ok = np.ones(len(left), bool)
        at, bound = np.arange(len(left)), np.full(len(left), len(self.size), np.int32)
        while len(at):
            across = self.pairs.find(self._pair(left, right))
            bad = (across >= 0) & (across < bound)
            ok[at[bad]] = False
            outer_left, outer_right = self.left[left], self.left[right]
            go = ~bad & ((outer_left >= 0) | (outer_right >= 0))
            at, left, right, outer_left, outer_right = (x[go] for x in (at, left, right, outer_left, outer_right))
            down = (outer_right < 0) | ((outer_left >= 0) & (left > right))
            bound = np.where(down, left, right + 1)
            left, right = np.where(down, self.right[left], left), np.where(down, right, outer_right)
        return ok

    def encode(self, running: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, one after another, and how many each has; ``running`` is the hash of the bytes they lie in."""
        size = end - start
        most = int(size.max())
        base = np.concatenate(([0], np.cumsum(size + 1)))
        piece = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(piece)) + np.repeat(start - np.cumsum(size) + size, size)
        left = end[piece] - at
        found: list[tuple[np.ndarray, ...]] = []
        for k in range(1, min(most, self.longest) + 1):
            some = np.flatnonzero(left >= k)
            token = self.tokens.find(bytescan.span_hash(running, at[some], at[some] + k))
            hit = np.flatnonzero(token >= 0)
            place = (at - start[piece])[some[hit]]
            found.append((piece[some[hit]], place, place + k, token[hit]))
        piece, lo, hi, token = (np.concatenate(f) for f in zip(*found, strict=True))
        order = np.argsort(hi.astype(np.uint16), kind="stable")
        piece, lo, hi, token = piece[order], base[piece[order]] + lo[order], base[piece[order]] + hi[order], token[order]
        bounds = np.searchsorted(hi - base[piece], np.arange(1, most + 2))
        last = np.full(base[-1], -1, np.int32)
        for s, e in zip(bounds[:-1], bounds[1:], strict=True):
            before = last[lo[s:e]]
            first = lo[s:e] == base[piece[s:e]]
            take = first | (before >= 0)
            check = np.flatnonzero(take & ~first)
            take[check] = self.fits(before[check], token[s:e][check])
            last[hi[s:e][take]] = token[s:e][take]
        place, own = base[1:] - 1, np.arange(len(size))
        out: list[tuple[np.ndarray, np.ndarray]] = []
        while len(own):
            token = last[place]
            if (token < 0).any():
                raise ValueError("the vocabulary can't express a byte")
            out.append((own, token))
            place = place - self.size[token]
            go = place > base[own]
            own, place = own[go], place[go]
        own, token = np.concatenate([o[0] for o in out][::-1]), np.concatenate([o[1] for o in out][::-1])
        order = np.argsort(own, kind="stable")
        return token[order], np.bincount(own, minlength=len(size))


class Encoder:
    """Token ids of whole Arrow columns; ``by_lattice`` sends new pieces through the lattice, all of a chunk at once."""

    def __init__(self, vocabulary: Vocabulary, by_lattice: bool = False) -> None:
        self.transducer = Transducer(vocabulary)
        self.lattice = Lattice(vocabulary) if by_lattice else None
        self._forget()

    def _forget(self) -> None:
        self.names, self.place = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.ends, self.ids, self.size = np.zeros(1, np.int64), np.empty(1 << 16, np.int32), 0
        self.slot_name, self.slot_place = np.zeros(1 << 20, np.uint64), np.full(1 << 20, -1, np.int64)

    def _find(self, names: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes, -1 where they are new."""
        slot = (names >> np.uint64(44)).astype(np.int64)
        out = np.where(self.slot_name[slot] == names, self.slot_place[slot], -1)
        rest = np.flatnonzero(out < 0)
        if len(rest) and len(self.names):
            at = np.minimum(np.searchsorted(self.names, names[rest]), len(self.names) - 1)
            out[rest] = np.where(self.names[at] == names[rest], self.place[at], -1)
        return out

    def _learn(self, names: np.ndarray, raw: np.ndarray, running: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """Encode the pieces from start to end; ``names`` are in ascending order."""
        short = np.flatnonzero(end - start <= Lattice.LONGEST) if self.lattice else np.empty(0, np.int64)
        if len(short):
            order = np.concatenate((short, np.setdiff1d(np.arange(len(start)), short)))
            flat, size = self.lattice.encode(running, start[short], end[short])
        else:
            order, flat, size = np.arange(len(start)), np.empty(0, np.int32), np.empty(0, np.int64)
        rest = order[len(short) :]
        if len(rest):
            body = raw.tobytes()
            found = [self.transducer.encode(body[s:e]) for s, e in zip(start[rest].tolist(), end[rest].tolist(), strict=True)]
            size = np.concatenate((size, np.array([len(f) for f in found], np.int64)))
            flat = np.concatenate((flat, np.fromiter((i for f in found for i in f), np.int32)))
        while self.size + len(flat) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
        self.ids[self.size : self.size + len(flat)] = flat
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(self.ends) - 1, len(self.ends) - 1 + len(order))
        self.ends = np.concatenate((self.ends, self.size + np.cumsum(size)))
        self.size += len(flat)
        at = np.searchsorted(self.names, names)
        self.names, self.place = np.insert(self.names, at, names), np.insert(self.place, at, number)
        slot = (names >> np.uint64(44)).astype(np.int64)
        free = self.slot_place[slot] < 0
        self.slot_name[slot[free]], self.slot_place[slot[free]] = names[free], number[free]

    def encode_rows(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows of bytes, one after another, and where each row's begin."""
        if len(self.names) > CACHE_WORDS:
            self._forget()
        start = pieces(raw, at)
        end = np.append(start[1:], len(raw))
        running = bytescan.prefix_hash(raw)
        names = bytescan.span_hash(running, start, end)
        place = self._find(names)
        new = np.flatnonzero(place < 0)
        if len(new):
            own, first = np.unique(names[new], return_index=True)
            self._learn(own, raw, running, start[new[first]], end[new[first]])
            place[new] = self._find(names[new])
        lo, size = self.ends[place], self.ends[place + 1] - self.ends[place]
        ends = np.cumsum(size)
        ids = self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(lo - ends + size, size)]
        return ids, np.concatenate(([0], ends))[np.searchsorted(start, at)]

    def encode(self, text: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Row range, ids and row offsets of consecutive pieces of the column."""
        for lo, hi, raw, at in bytescan.chunks(text):
            yield lo, hi, *self.encode_rows(raw, at)


class Utf8Machine:
    """Incremental UTF-8: what is complete comes out, up to three bytes are held."""

    #: Least and greatest second byte after lead bytes that restrict it.
    _SECOND = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}

    def __init__(self) -> None:
        self.held = b""

    @classmethod
    def _open(cls, tail: bytes) -> bool:
        """Whether the bytes begin a character that can still be completed."""
        lead = tail[0]
        need = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 0
        if len(tail) >= need:
            return False
        low, high = cls._SECOND.get(lead, (0x80, 0xBF))
        return all((low if k == 1 else 0x80) <= b <= (high if k == 1 else 0xBF) for k, b in enumerate(tail) if k)

    def feed(self, data: bytes) -> str:
        data = self.held + data
        self.held = b""
        for k in range(1, min(3, len(data)) + 1):
            if data[-k] >= 0xC0:
                if self._open(data[-k:]):
                    self.held, data = data[-k:], data[:-k]
                break
            if data[-k] < 0x80:
                break
        return data.decode("utf-8", "replace")

    def finish(self) -> str:
        data, self.held = self.held, b""
        return data.decode("utf-8", "replace")


class StreamDecoder:
    """Text of ids that come in portions."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens, self.machine = tokens, Utf8Machine()

    def feed(self, ids: list[int]) -> str:
        return self.machine.feed(b"".join(map(self.tokens.__getitem__, ids)))

    def finish(self) -> str:
        return self.machine.finish()


def decode_rows(tokens: np.ndarray, bounds: np.ndarray, ids: np.ndarray, at: np.ndarray) -> list[str]:
    """Texts of rows of ids; ``tokens`` are the bytes of all tokens, ``bounds`` where each begins."""
    lo, size = bounds[ids], bounds[ids + 1] - bounds[ids]
    ends = np.cumsum(size)
    data = tokens[np.arange(ends[-1] if len(ends) else 0) + np.repeat(lo - ends + size, size)].tobytes()
    cut = np.concatenate(([0], ends))[at].tolist()
    machine = Utf8Machine()
    return [machine.feed(data[s:e]) + machine.finish() for s, e in zip(cut[:-1], cut[1:], strict=True)]


_made: dict[tuple[str, bool], Encoder] = {}


def worker_encoder(name: str, vocabulary: Vocabulary, by_lattice: bool = False) -> Encoder:
    """The encoder of this worker, kept from task to task."""
    if (name, by_lattice) not in _made:
        _made.clear()
        _made[name, by_lattice] = Encoder(vocabulary, by_lattice)
    return _made[name, by_lattice]


def encode_documents(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """doc_id, n_tokens, ids, and whether the decoded ids are the text, for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(ranks))

    def maker():
        encoder = worker_encoder(ranks, shared.value)
        tokens = np.frombuffer(b"".join(shared.value.tokens), np.uint8)
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in shared.value.tokens])))

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            text = batch.column(1)
            for lo, hi, ids, at in encoder.encode(text):
                own, missing = text.slice(lo, hi - lo), text.slice(lo, hi - lo).is_null()
                null = missing.to_numpy(zero_copy_only=False)
                same = pc.equal(pa.array(decode_rows(tokens, bounds, ids, at), own.type), own)
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32), mask=np.append(null, False)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(at).astype(np.int32), mask=null), lists, same], ["doc_id", "n_tokens", "ids", "round_trip"])

        return step

    return common.map_arrow(docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"]), maker, "doc_id bigint, n_tokens int, ids array<int>, round_trip boolean")
