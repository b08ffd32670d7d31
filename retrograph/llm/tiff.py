"""Media columns: TIFF files to one row per page.

``read_pages`` walks the chain of image directories (classic and 64-bit files,
both byte and bit orders), reads strips or tiles, decodes none, PackBits, LZW or deflate,
undoes the horizontal and the floating-point predictor, joins separate planes,
and gives every page's samples row by row, interleaved, little-endian; samples
of 1, 2 and 4 bits come as bytes.  A page of more than ``PART_BYTES`` comes in
several rows of whole lines, each with the number of its first one.

LZW is decoded a table at a time with numpy: the place and width of every code
up to the next clear follows from its number, an entry is a stretch of the
output itself, and bytes are resolved by halving the chains of references.

Defined results: a null file gives no row; bytes that aren't TIFF give one row
with page null and ``error``; a page that can't be decoded (cut short, unknown
compression) gives a row with what its directory says, null pixels, ``error``
and the line from which on it can't, and the next pages are read on; a directory chain that
runs in a circle ends where it closes; repeated rows are decoded each; null id
passes through; an empty table gives an empty result; other columns are not read.

``write_file`` makes such files, for tests and for tables without media.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Decoded bytes of a page that one row holds, unless a single line has more.
PART_BYTES = 256 << 20

_TURNED = bytes(int(f"{k:08b}"[::-1], 2) for k in range(256))

NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 13: 4, 16: 8, 17: 8, 18: 8}
_CODES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 13: "I", 16: "Q", 17: "q", 18: "Q"}


class BadTiff(ValueError):
    """Bytes that can't be read as TIFF."""


def directories(data: bytes) -> Iterator[dict[int, tuple[int, ...]]]:
    """Integer tags of each image directory, in the order of the chain."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8:
        raise BadTiff("no byte order mark")
    magic = struct.unpack_from(order + "H", data, 2)[0]
    if magic not in (42, 43) or (magic == 43 and len(data) < 16):
        raise BadTiff("no version number")
    wide = magic == 43
    word, count_code, entry, inline = ("Q", "Q", 20, 8) if wide else ("I", "H", 12, 4)
    at = struct.unpack_from(order + word, data, 8 if wide else 4)[0]
    seen = set()
    while at and at not in seen:
        seen.add(at)
        try:
            n = struct.unpack_from(order + count_code, data, at)[0]
            at += struct.calcsize(count_code)
            if at + n * entry > len(data):
                raise BadTiff("directory beyond the end of the file")
            tags: dict[int, tuple[int, ...]] = {}
            for k in range(n):
                tag, kind, count = struct.unpack_from(order + "HH" + word, data, at + k * entry)
                size = _SIZES.get(kind, 0) * count
                if kind not in _CODES or size > len(data):
                    continue
                value = at + k * entry + 4 + struct.calcsize(word)
                if size > inline:
                    value = struct.unpack_from(order + word, data, value)[0]
                tags[tag] = struct.unpack_from(f"{order}{count}{_CODES[kind]}", data, value)
            tags[-1] = (order == ">",)
            at = struct.unpack_from(order + word, data, at + n * entry)[0]
        except (struct.error, OverflowError) as e:
            raise BadTiff("directory beyond the end of the file") from e
        yield tags


def unpack_bits(data: bytes, want: int) -> bytes:
    """PackBits, up to ``want`` bytes."""
    out, at, n = bytearray(), 0, len(data)
    while at < n and len(out) < want:
        k = data[at]
        if k < 128:
            out += data[at + 1 : at + 2 + k]
            at += k + 2
        else:
            if k > 128 and at + 1 < n:
                out += data[at + 1 : at + 2] * (257 - k)
            at += 2 if k > 128 else 1
    return bytes(out)


#: Number of the first code of a table that has 10, 11 and 12 bits.
_WIDER = (254, 766, 1790)


def _code_bits(n: int) -> tuple[np.ndarray, np.ndarray]:
    width = 9 + np.searchsorted(_WIDER, np.arange(n), side="right")
    return width, np.cumsum(width) - width


_TABLE_BITS = _code_bits(4200)


def _roots(parent: np.ndarray) -> np.ndarray:
    """Follow references to where they end."""
    while True:
        further = parent[parent]
        if np.array_equal(further, parent):
            return parent
        parent = further


def _expand(codes: np.ndarray) -> np.ndarray:
    """Bytes of the codes between two clears."""
    n = len(codes)
    own = np.arange(n)
    literal = codes < 256
    parent = np.where(literal, own, codes - 258)
    if (codes == 256).any() or (codes == 257).any() or (parent > own).any() or (parent[~literal] == own[~literal]).any():
        raise BadTiff("LZW code without an entry")
    size, ahead = np.where(literal, 0, 1), parent
    while True:  # an entry is one byte longer than the code it extends
        size = size + size[ahead]
        further = ahead[ahead]
        if np.array_equal(further, ahead):
            break
        ahead = further
    size = size + 1
    end = np.cumsum(size)
    start = end - size
    back = np.where(literal, 0, start - start[parent])
    place = np.arange(end[-1])
    source = _roots(place - np.repeat(back, size))
    values = np.zeros(int(end[-1]), np.uint8)
    values[start[literal]] = codes[literal]
    return values[source]


def unpack_lzw(data: bytes, want: int) -> bytes:
    """LZW with codes from the high bit, up to ``want`` bytes."""
    raw = np.concatenate((np.frombuffer(data, np.uint8), np.zeros(4, np.uint8))).astype(np.int32)
    bits, at, have = 8 * len(data), 0, 0
    out: list[np.ndarray] = []
    ended = False
    while not ended and at + 9 <= bits and have < want:
        width, offset = _TABLE_BITS
        while True:
            fit = int(np.searchsorted(offset + width, bits - at, side="right"))
            bit = at + offset[:fit]
            byte = bit >> 3
            window = (raw[byte] << 16) | (raw[byte + 1] << 8) | raw[byte + 2]
            codes = (window >> (24 - (bit & 7) - width[:fit])) & ((1 << width[:fit]) - 1)
            stops = np.flatnonzero((codes == 256) | (codes == 257))
            if len(stops) or fit < len(width):
                break
            width, offset = _code_bits((bits - at) // 9 + 2)  # a table that isn't cleared when full
        n = int(stops[0]) if len(stops) else fit
        if n:
            out.append(_expand(codes[:n].astype(np.int64)))
            have += len(out[-1])
        ended = not len(stops) or codes[n] == 257
        at += int(offset[n] + width[n]) if len(stops) else bits
    return b"".join(x.tobytes() for x in out)[:want]


def _inflate(data: bytes, want: int) -> bytes:
    try:
        return zlib.decompressobj().decompress(data, want)
    except zlib.error as e:
        raise BadTiff(f"deflate: {e}") from e


def _decode(data: bytes, compression: int, want: int) -> bytes:
    if compression == NONE:
        out = data[:want]
    elif compression == LZW:
        out = unpack_lzw(data, want)
    elif compression in (DEFLATE, OLD_DEFLATE):
        out = _inflate(data, want)
    elif compression == PACKBITS:
        out = unpack_bits(data, want)
    else:
        raise BadTiff(f"compression {compression}")
    if len(out) < want:
        raise BadTiff("strip or tile cut short")
    return out


def _samples(data: bytes, rows: int, columns: int, each: int, bits: int, big: bool, predictor: int) -> np.ndarray:
    """rows x columns x each samples of a strip or tile, without predictor, as little-endian unsigned numbers."""
    if bits < 8:
        line = (columns * each * bits + 7) // 8
        packed = np.unpackbits(np.frombuffer(data, np.uint8).reshape(rows, line), axis=1)[:, : columns * each * bits]
        weight = (1 << np.arange(bits - 1, -1, -1)).astype(np.uint8)
        return (packed.reshape(rows, columns, each, bits) * weight).sum(-1, dtype=np.uint8)
    size = bits // 8
    if predictor == 3:
        planes = np.frombuffer(data, np.uint8).reshape(rows, columns * size, each)
        planes = np.cumsum(planes, axis=1, dtype=np.uint8).reshape(rows, size, columns * each)
        return np.ascontiguousarray(planes[:, ::-1].transpose(0, 2, 1)).view(f"<u{size}").reshape(rows, columns, each)
    out = np.frombuffer(data, f"{'>' if big else '<'}u{size}").reshape(rows, columns, each).astype(f"<u{size}")
    if predictor == 2:
        out = np.cumsum(out, axis=1, dtype=out.dtype)
    return out


def read_page(data: bytes, tags: dict[int, tuple[int, ...]], part_bytes: int = PART_BYTES) -> Iterator[dict]:
    """A page's description, with its pixels or what is wrong with it; large pages in parts."""

    def one(tag: int, default: int) -> int:
        return int(tags[tag][0]) if tags.get(tag) else default

    page = {"width": one(256, 0), "height": one(257, 0), "bands": one(277, 1), "bits": one(258, 1), "sample_format": one(339, 1), "compression": one(259, NONE), "predictor": one(317, 1), "tiled": 322 in tags, "first_line": 0, "pixels": None, "error": None}
    line = 0
    try:
        for lines in _lines(data, tags, page, one, part_bytes):
            yield page | {"first_line": line, "pixels": lines.tobytes()}
            line += len(lines)
    except (ValueError, OverflowError) as e:
        yield page | {"first_line": line, "error": str(e)}


def _lines(data: bytes, tags: dict[int, tuple[int, ...]], page: dict, one, part_bytes: int) -> Iterator[np.ndarray]:
    """Samples of stretches of whole lines, each of at most ``part_bytes`` if a line has no more."""
    width, height, bands, bits = page["width"], page["height"], page["bands"], page["bits"]
    if width < 1 or height < 1 or bands < 1:
        raise BadTiff("no size")
    if bits not in (1, 2, 4, 8, 16, 32, 64) or len(set(tags.get(258, (bits,)))) > 1:
        raise BadTiff(f"samples of {tags.get(258)} bits")
    if page["predictor"] not in (1, 2, 3) or (page["predictor"] > 1 and bits < 8) or (page["predictor"] == 3 and bits < 16):
        raise BadTiff(f"predictor {page['predictor']}")
    turned = one(266, 1)
    if turned not in (1, 2):
        raise BadTiff(f"bit order {turned}")
    size = max(1, bits // 8)
    planes = bands if one(284, 1) == 2 and bands > 1 else 1
    each = bands // planes
    if page["tiled"]:
        across, down = one(322, 0), one(323, 0)
        offsets, counts = tags.get(324, ()), tags.get(325, ())
    else:
        across, down = width, min(one(278, height), height)
        offsets, counts = tags.get(273, ()), tags.get(279, ())
    if across < 1 or down < 1:
        raise BadTiff("no size of strips or tiles")
    columns, rows = -(-width // across), -(-height // down)
    if len(offsets) < columns * rows * planes:
        raise BadTiff("too few strips or tiles")
    if len(counts) < len(offsets):
        if page["compression"] != NONE:
            raise BadTiff("no sizes of strips or tiles")
        counts = (len(data),) * len(offsets)
    together = max(1, part_bytes // (width * bands * size))  # lines of a part
    held: list[np.ndarray] = []
    have = 0
    for y in range(rows):
        lines = down if page["tiled"] else min(down, height - y * down)
        want = lines * ((across * each * bits + 7) // 8)
        blocks = []
        for plane in range(planes):
            for x in range(columns):
                k = (plane * rows + y) * columns + x
                raw = data[offsets[k] : offsets[k] + counts[k]]
                raw = _decode(raw.translate(_TURNED) if turned == 2 else raw, page["compression"], want)
                blocks.append(_samples(raw, lines, across, each, bits, bool(tags[-1][0]), page["predictor"]))
        shown = min(down, height - y * down)
        out = np.concatenate([np.concatenate(blocks[p * columns : (p + 1) * columns], axis=1)[:shown, :width] for p in range(planes)], axis=2)
        for s in range(0, shown, together):
            if held and have + min(together, shown - s) > together:
                yield np.concatenate(held)
                held, have = [], 0
            held.append(out[s : s + together])
            have += len(held[-1])
            if have >= together:
                yield np.concatenate(held)
                held, have = [], 0
    if held:
        yield np.concatenate(held)


def read_pages(data: bytes, part_bytes: int = PART_BYTES) -> Iterator[dict]:
    """All pages of a file; a row with page None for what isn't TIFF or where the chain breaks."""
    empty = dict.fromkeys(("width", "height", "bands", "bits", "sample_format", "compression", "predictor", "tiled", "first_line", "pixels"))
    try:
        for k, tags in enumerate(directories(data)):
            for part in read_page(data, tags, part_bytes):
                yield {"page": k, **part}
    except BadTiff as e:
        yield {"page": None, **empty, "error": str(e)}


_FIELDS = [("page", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("bands", pa.int32()), ("bits", pa.int32()), ("sample_format", pa.int32()), ("compression", pa.int32()), ("predictor", pa.int32()), ("tiled", pa.bool_()), ("first_line", pa.int32()), ("pixels", pa.binary()), ("error", pa.string())]
_PORTION = 16 << 20


def decode_media(media: DataFrame, key: str = "page_id", column: str = "media", part_bytes: int = PART_BYTES) -> DataFrame:
    """One row for each page of each file, or part of a large page: the id and what ``read_pages`` gives."""
    schema = f"{key} bigint, page int, width int, height int, bands int, bits int, sample_format int, compression int, predictor int, tiled boolean, first_line int, pixels binary, error string"

    def maker():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ids: list[object] = []
            found: list[dict] = []
            held = 0

            def flush() -> pa.RecordBatch:
                arrays = [pa.array(ids, pa.int64()), *(pa.array([_fit(f[name], kind) for f in found], kind) for name, kind in _FIELDS)]
                return pa.RecordBatch.from_arrays(arrays, [key, *(name for name, _ in _FIELDS)])

            for i, data in zip(batch.column(0), batch.column(1), strict=True):
                if not data.is_valid:
                    continue
                for page in read_pages(data.as_py(), part_bytes):
                    ids.append(i.as_py())
                    found.append(page)
                    held += len(page["pixels"] or b"")
                    if held >= _PORTION:
                        yield flush()
                        ids, found, held = [], [], 0
            if found:
                yield flush()

        return step

    return common.map_arrow(media.select(F.col(key).cast("bigint").alias(key), F.col(column).cast("binary").alias("__media")), maker, schema)


def _fit(value: object, kind: pa.DataType) -> object:
    """A number that a broken directory claims, or None where it is no 32-bit number."""
    return None if kind == pa.int32() and value is not None and not -(2**31) <= value < 2**31 else value


# Writing: what the reader is held against, and how tables without media get some.


def pack_bits(data: bytes) -> bytes:
    """PackBits: runs of at least three, else literal stretches."""
    raw = np.frombuffer(data, np.uint8)
    first = np.flatnonzero(np.concatenate(([True], raw[1:] != raw[:-1]))) if len(raw) else np.empty(0, np.int64)
    size = np.diff(np.append(first, len(raw)))
    out, done = bytearray(), 0

    def literal(end: int) -> None:
        for s in range(done, end, 128):
            part = data[s : min(s + 128, end)]
            out.append(len(part) - 1)
            out.extend(part)

    long = size >= 3
    for s, n in zip(first[long].tolist(), size[long].tolist(), strict=True):
        literal(s)
        for k in range(0, n, 128):
            m = min(128, n - k)
            out.extend((257 - m if m > 1 else 0, data[s]))
        done = s + n
    literal(len(data))
    return bytes(out)


def pack_lzw(data: bytes) -> bytes:
    """LZW with codes from the high bit; the table is cleared when it is full."""
    codes: list[int] = []
    segments: list[list[int]] = []
    table: dict[int, int] = {}
    held, new = -1, 258
    for b in data:
        if held < 0:
            held = b
            continue
        key = held << 8 | b
        known = table.get(key)
        if known is not None:
            held = known
            continue
        codes.append(held)
        table[key] = new
        new += 1
        held = b
        if new == 4094:
            codes.append(held)
            segments.append(codes)
            codes, table, held, new = [], {}, -1, 258
    if held >= 0:
        codes.append(held)
    segments.append(codes)
    bits, last = [_number_bits(np.array([256]), np.array([9]))], 9
    for k, own in enumerate(segments):
        width = _TABLE_BITS[0][: len(own) + 1]
        end = 257 if k + 1 == len(segments) else 256
        bits.append(_number_bits(np.array([*own, end]), width))
        last = width[-1]
    return np.packbits(np.concatenate(bits)).tobytes() if last else b""


def _number_bits(values: np.ndarray, width: np.ndarray) -> np.ndarray:
    """The bits of numbers of different widths, high ones first."""
    end = np.cumsum(width)
    shift = np.repeat(end, width) - 1 - np.arange(end[-1])
    return ((np.repeat(values, width) >> shift) & 1).astype(np.uint8)


def _encode(data: bytes, compression: int) -> bytes:
    if compression == LZW:
        return pack_lzw(data)
    if compression in (DEFLATE, OLD_DEFLATE):
        return zlib.compress(data)
    return pack_bits(data) if compression == PACKBITS else data


def _block(image: np.ndarray, big: bool, predictor: int) -> bytes:
    size = image.dtype.itemsize
    if predictor == 2:
        image = np.diff(image, axis=1, prepend=np.zeros_like(image[:, :1]))
    if predictor == 3:
        rows, columns, each = image.shape
        planes = np.ascontiguousarray(image.astype(f"<u{size}")).view(np.uint8).reshape(rows, columns * each, size)[:, :, ::-1].transpose(0, 2, 1)
        planes = planes.reshape(rows, columns * size, each)
        return np.diff(planes, axis=1, prepend=np.zeros_like(planes[:, :1])).tobytes()
    return image.astype(f"{'>' if big else '<'}u{size}").tobytes()


def write_file(pages: list[dict], big: bool = False, wide: bool = False) -> bytes:
    """A file of pages: ``image`` (rows x columns x bands, unsigned), ``compression``, ``predictor``, ``tile`` or ``strip``, ``planar``, ``sample_format``."""
    order = ">" if big else "<"
    word = "Q" if wide else "I"
    out = bytearray((b"MM" if big else b"II") + struct.pack(order + ("HHHQ" if wide else "HI"), *((43, 8, 0, 0) if wide else (42, 0))))
    link = 8 if wide else 4
    for page in pages:
        image, compression, predictor = page["image"], page.get("compression", NONE), page.get("predictor", 1)
        height, width, bands = image.shape
        planes = [image[:, :, k : k + 1] for k in range(bands)] if page.get("planar") else [image]
        offsets, counts = [], []
        tile = page.get("tile")
        strip = page.get("strip", height)
        for plane in planes:
            if tile:
                padded = np.pad(plane, ((0, -height % tile), (0, -width % tile), (0, 0)))
                blocks = [padded[y : y + tile, x : x + tile] for y in range(0, height, tile) for x in range(0, width, tile)]
            else:
                blocks = [plane[y : y + strip] for y in range(0, height, strip)]
            for block in blocks:
                data = _encode(_block(block, big, predictor), compression)
                offsets.append(len(out))
                counts.append(len(data))
                out += data
        tags = {256: [width], 257: [height], 258: [8 * image.dtype.itemsize] * bands, 259: [compression], 262: [2 if bands == 3 else 1], 277: [bands], 284: [2 if page.get("planar") else 1], 317: [predictor], 339: [page.get("sample_format", 1)] * bands}
        tags |= {322: [tile], 323: [tile], 324: offsets, 325: counts} if tile else {273: offsets, 278: [strip], 279: counts}
        entries = bytearray()
        inline = 8 if wide else 4
        for tag in sorted(tags):
            values = tags[tag]
            body = struct.pack(f"{order}{len(values)}{word}", *values)
            if len(body) > inline:
                at = len(out)
                out += body
                body = struct.pack(order + word, at)
            entries += struct.pack(order + "HH" + word, tag, 16 if wide else 4, len(values)) + body.ljust(inline, b"\0")
        struct.pack_into(order + word, out, link, len(out))
        out += struct.pack(order + ("Q" if wide else "H"), len(tags)) + entries
        link = len(out)
        out += struct.pack(order + word, 0)
    return bytes(out)


def _raster(data: bytes, columns: int) -> np.ndarray:
    rows = max(1, -(-len(data) // columns))
    return np.frombuffer(data.ljust(rows * columns, b"\0"), np.uint8).reshape(rows, columns, 1)


_WAYS = (PACKBITS, LZW, DEFLATE, NONE)


def media_of(rows: DataFrame, key: str = "page_id", text: str = "html", columns: int = 256) -> DataFrame:
    """A TIFF file of each text: its bytes as grey values of a page of strips, then of a page of tiles with differences.

    Compression and byte order follow from the id.  A null text gives a null file.
    """

    def maker():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            files = []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                i = i or 0
                half = 0 if t is None else (len(t) + 1) // 2
                files.append(
                    None
                    if t is None
                    else write_file(
                        [
                            {"image": _raster(t[:half], columns), "compression": _WAYS[i % 4], "strip": 32},
                            {"image": _raster(t[half:], columns), "compression": _WAYS[(i + 1) % 4], "predictor": 1 + i % 2, "tile": 64},
                        ],
                        big=bool(i // 4 % 2),
                    )
                )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(files, pa.binary())], [key, "media"])

        return step

    return common.map_arrow(rows.select(F.col(key).cast("bigint").alias(key), F.col(text).alias("__text")), maker, f"{key} bigint, media binary")
