import struct
import zlib

import numpy as np
import pytest

from retrograph.llm import tiff

from .data import awkward


def test_lzw_example_of_the_specification():
    data = bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])
    assert tiff.pack_lzw(data).hex() == "8001e0408044080c068080"
    assert tiff.unpack_lzw(bytes.fromhex("8001e0408044080c068080"), 9) == data


def slow_lzw(data):
    """A decoder that reads a code at a time."""
    bits = "".join(f"{b:08b}" for b in data)
    at, width, out, table, last = 0, 9, b"", None, None
    while at + width <= len(bits):
        code = int(bits[at : at + width], 2)
        at += width
        if code == 257:
            break
        if code == 256:
            table, width, last = [bytes([k]) for k in range(256)] + [b"", b""], 9, None
            continue
        entry = table[code] if code < len(table) else last + last[:1]
        out += entry
        if last is not None:
            table.append(last + entry[:1])
        last = entry
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return out


def test_codecs():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 3, 127, 128, 129, 5000, 30_000):
        for k in (1, 2, 5, 256):
            data = rng.integers(0, k, n).astype(np.uint8).tobytes()
            packed = tiff.pack_lzw(data)
            assert tiff.unpack_lzw(packed, n) == data
            assert tiff.unpack_bits(tiff.pack_bits(data), n) == data
            if n <= 5000 and n:
                assert slow_lzw(packed) == data


def random_page(rng):
    kind = rng.choice([np.uint8, np.uint16, np.uint32, np.uint64])
    h, w, b = *rng.integers(1, 60, 2).tolist(), int(rng.integers(1, 4))
    page = {"image": rng.integers(0, int(rng.choice([3, 200])), (h, w, b)).astype(kind), "compression": int(rng.choice([1, 5, 8, 32773, 32946])), "predictor": int(rng.integers(1, 3)), "planar": bool(rng.random() < 0.5)}
    if kind == np.uint32 and rng.random() < 0.5:
        page |= {"image": rng.normal(size=(h, w, b)).astype(np.float32).view(np.uint32), "predictor": 3, "sample_format": 3}
    return page | ({"tile": 16} if rng.random() < 0.5 else {"strip": int(rng.integers(1, 40))})


def test_files_round_trip_and_damage():
    rng = np.random.default_rng(2)
    for _ in range(60):
        pages = [random_page(rng) for _ in range(int(rng.integers(1, 4)))]
        data = tiff.write_file(pages, big=bool(rng.random() < 0.5), wide=bool(rng.random() < 0.5))
        got = list(tiff.read_pages(data))
        assert [g["page"] for g in got] == list(range(len(pages)))
        for g, p in zip(got, pages, strict=True):
            assert g["error"] is None and g["pixels"] == p["image"].tobytes()
            assert (g["height"], g["width"], g["bands"]) == p["image"].shape
        for cut in rng.integers(0, len(data), 4):
            assert all(g["error"] or g["pixels"] for g in tiff.read_pages(data[:cut]))
        for _ in range(8):
            bad = bytearray(data)
            for _ in range(4):
                bad[rng.integers(0, len(bad))] = rng.integers(0, 256)
            list(tiff.read_pages(bytes(bad)))


def test_large_pages_come_in_parts():
    rng = np.random.default_rng(5)
    for _ in range(30):
        page = random_page(rng)
        parts = list(tiff.read_pages(tiff.write_file([page]), part_bytes=int(rng.integers(1, 3000))))
        assert b"".join(p["pixels"] for p in parts) == page["image"].tobytes()
        line = page["image"][0].nbytes
        assert [p["first_line"] for p in parts] == [sum(len(q["pixels"]) // line for q in parts[:k]) for k in range(len(parts))]
    image = np.arange(64, dtype=np.uint8).reshape(8, 8, 1)
    data = tiff.write_file([{"image": image, "strip": 2, "compression": 8}, {"image": image}])
    tags = next(tiff.directories(data))
    broken = bytearray(data)
    broken[tags[273][2] : tags[273][2] + 4] = b"\xff" * 4  # the third of four strips
    got = list(tiff.read_pages(bytes(broken), part_bytes=16))
    *whole, bad = (p for p in got if p["page"] == 0)
    assert b"".join(p["pixels"] for p in got if p["page"] == 1) == image.tobytes()
    assert [(p["first_line"], p["pixels"]) for p in whole] == [(0, image[:2].tobytes()), (2, image[2:4].tobytes())]
    assert bad["first_line"] == 4 and bad["error"] and bad["pixels"] is None


def test_turned_bit_order():
    image = np.arange(250, dtype=np.uint8).reshape(10, 25, 1)
    for compression in (1, 5, 8, 32773):
        data = tiff.write_file([{"image": image, "compression": compression}])
        tags = next(tiff.directories(data))
        raw = bytearray(data)
        for at, n in zip(tags[273], tags[279], strict=True):
            raw[at : at + n] = raw[at : at + n].translate(tiff._TURNED)
        (page,) = tiff.read_page(bytes(raw), tags | {266: (2,)})
        assert page["pixels"] == image.tobytes()
        (page,) = tiff.read_page(bytes(raw), tags | {266: (3,)})
        assert page["error"]


def test_bilevel_and_circle():
    bits = np.array([[1, 0, 1, 1, 0, 0, 0, 1, 1], [0, 1, 0, 0, 1, 1, 1, 0, 0]], np.uint8)
    packed = np.packbits(bits, axis=1).tobytes()
    tags = [(256, 9), (257, 2), (258, 1), (259, 1), (273, 8), (278, 2), (279, len(packed))]
    at = 8 + len(packed)
    data = b"II" + struct.pack("<HI", 42, at) + packed + struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", t, 4, 1, v) for t, v in tags) + struct.pack("<I", at)
    (page,) = tiff.read_pages(data)  # the chain leads back to this page
    assert page["pixels"] == bits.tobytes()


def test_broken_page_does_not_hide_the_next():
    image = np.arange(12, dtype=np.uint8).reshape(3, 4, 1)
    data = bytearray(tiff.write_file([{"image": image, "compression": 8}, {"image": image}]))
    data[8:12] = b"\xff" * 4  # the first page's stream
    first, second = tiff.read_pages(bytes(data))
    assert first["error"] and first["pixels"] is None and first["width"] == 4
    assert second["pixels"] == image.tobytes()


def test_table(spark):
    rows = awkward()
    frame = spark.createDataFrame([(i, t, 1, "w", "e") for i, t in rows], "page_id bigint, html string, page int, width string, error string")
    got = tiff.decode_media(tiff.media_of(frame)).collect()
    want = sorted(((i is None, i or 0, t.encode()) for i, t in rows if t is not None))
    pairs = list(zip(got[::2], got[1::2], strict=True))
    whole = sorted(((a["page_id"] is None, a["page_id"] or 0, a["pixels"].rstrip(b"\0") + b["pixels"].rstrip(b"\0")) for a, b in pairs))
    strip = lambda data: data[: (len(data) + 1) // 2].rstrip(b"\0") + data[(len(data) + 1) // 2 :].rstrip(b"\0")
    assert whole == [(n, i, strip(t)) for n, i, t in want]
    assert all(a["page"] == 0 and not a["tiled"] and b["page"] == 1 and b["tiled"] and a["error"] is None for a, b in pairs)
    odd = spark.createDataFrame([(1, b"nothing"), (2, b""), (3, None)], "page_id bigint, media binary")
    assert [(r["page_id"], r["page"], r["error"] is not None) for r in tiff.decode_media(odd).orderBy("page_id").collect()] == [(1, None, True), (2, None, True)]
    assert tiff.decode_media(odd.limit(0)).collect() == []


@pytest.mark.parametrize("code", [8, 32946])
def test_deflate_of_another_writer(code):
    assert tiff._decode(zlib.compress(b"abc" * 50, 9), code, 150) == b"abc" * 50
