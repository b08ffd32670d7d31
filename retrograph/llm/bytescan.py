"""Vectorised scanning of Arrow text columns.

A text column is kept as the byte buffer Arrow hands over; words, n-grams and
their hashes are computed for a whole chunk of documents with numpy, so no
Python string is made per document or word.

A *word* is a maximal run of ASCII letters, ASCII digits and bytes of
non-ASCII characters; words never cross a document's end.  Hashing lower-cases
ASCII and Latin-1 letters.  Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer document makes a chunk of its own.
CHUNK_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_rng = np.random.default_rng(20240229)
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_KIND = np.where(_WORD, 1, 2).astype(np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(16, int(n - 1).bit_length())
            inverse = pow(_BASE, -1, 2**64)
            for name, base in (("up", _BASE), ("down", inverse)):
                table = np.full(size, base, dtype=np.uint64)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))
        return self.up, self.down


_powers = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on all input bits."""
    x = x ^ (x >> _U(33))
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, bytes and row offsets of consecutive pieces of whole rows."""
    raw, at = text_bytes(column)
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = int(np.searchsorted(at, at[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def lower(raw: np.ndarray) -> np.ndarray:
    """Lower-case ASCII letters and two-byte Latin-1 capitals."""
    low = _LOWER[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3) + 1
    if len(lead):
        lead = lead[(raw[lead] >= 0x80) & (raw[lead] <= 0x9E) & (raw[lead] != 0x97)]
        low[lead] += 32
    return low


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash; entry i covers the first i bytes."""
    up, _ = _powers.upto(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODE[data] * up[: len(data)], out=out[1:])
    return out


def span_hash(running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of byte spans from the running hash."""
    _, down = _powers.upto(len(running))
    return mix((running[end] - running[start]) * down[start])


class Words:
    """Words of a chunk: byte spans, 64-bit hashes and the offsets of each row's words.

    With ``marks`` runs of other characters than white space count as words too.
    """

    def __init__(self, raw: np.ndarray, at: np.ndarray, fold: bool = True, marks: bool = False) -> None:
        self.raw, self.at = raw, at
        kind = (_KIND if marks else _WORD)[raw]
        new = np.ones(len(raw) + 1, dtype=bool)
        new[1:-1] = kind[1:] != kind[:-1]
        new[at] = True
        inside = kind != 0
        self.start = np.flatnonzero(inside & new[:-1])
        self.end = np.flatnonzero(inside & new[1:]) + 1
        self.hash = span_hash(prefix_hash(lower(raw) if fold else raw), self.start, self.end)
        self.offset = np.searchsorted(self.start, at)

    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.offset))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and row offsets of the word n-grams that lie within one row."""
        count = np.maximum(np.diff(self.offset) - (n - 1), 0)
        offset = np.concatenate(([0], np.cumsum(count)))
        h = self.hash
        if n == 1:
            return h, offset
        pick = np.arange(offset[-1]) + np.repeat(self.offset[:-1] - offset[:-1], count)
        total = np.zeros(max(len(h) - n + 1, 0), dtype=np.uint64)
        for k in range(n):
            total += h[k : k + len(total)] * _U((0xD6E8FEB86659FD93 * (2 * k + 3)) % 2**64)
        return mix(total[pick]), offset


@lru_cache(maxsize=None)
def _gram_codes(n: int) -> tuple[np.uint64, ...]:
    gen = np.random.default_rng(n)
    return tuple(_U(int(x) | 1) for x in gen.integers(1, 2**63, n))


def byte_grams(raw: np.ndarray, n: int) -> np.ndarray:
    """Multiplicative hash of every n bytes; entry i starts at byte i."""
    size = max(len(raw) - n + 1, 0)
    wide = raw.astype(np.uint64)
    total = np.zeros(size, dtype=np.uint64)
    for k, code in enumerate(_gram_codes(n)):
        total += wide[k : k + size] * code
    return total


def row_sums(values: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Sum of each row's values; rows without values give zero."""
    running = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return running[offset[1:]] - running[offset[:-1]]


def count_words(raw: np.ndarray, at: np.ndarray, marks: bool = False) -> np.ndarray:
    """Number of words of each row, as ``Words`` would find them, without hashing."""
    kind = (_KIND if marks else _WORD)[raw]
    new = np.ones(len(raw), dtype=bool)
    new[1:] = kind[1:] != kind[:-1]
    new[at[at < len(raw)]] = True
    running = np.concatenate(([0], np.cumsum(new & (kind != 0))))
    return running[at[1:]] - running[at[:-1]]
