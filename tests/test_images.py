"""Page images with numpy alone: PNG, colours, orientation, size, cuttings, wear, missing decoders."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.sources import images as I


def filtered(pixels: np.ndarray, bits: int, color: int, kind: int) -> bytes:
    """A PNG whose rows use one filter."""
    h, w, n = pixels.shape
    raw = pixels.astype(">u2" if bits == 16 else np.uint8).view(np.uint8).reshape(h, -1).astype(int)
    step, out = n * bits // 8, b""
    for y in range(h):
        up = raw[y - 1] if y else np.zeros(raw.shape[1], int)
        line = []
        for i, x in enumerate(raw[y]):
            a, b, c = (raw[y][i - step] if i >= step else 0), up[i], (up[i - step] if i >= step else 0)
            p = a + b - c
            paeth = min((a, b, c), key=lambda v: abs(p - v))
            line.append((x - [0, a, b, (a + b) // 2, paeth][kind]) % 256)
        out += bytes([kind]) + bytes(line)
    return I.MAGIC + I._chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, bits, color, 0, 0, 0)) + I._chunk(b"IDAT", zlib.compress(out)) + I._chunk(b"IEND", b"")


@pytest.mark.parametrize("kind", range(5))
@pytest.mark.parametrize(("bits", "color", "n"), [(8, 2, 3), (8, 6, 4), (8, 0, 1), (16, 2, 3), (16, 4, 2)])
def test_png_is_read(kind, bits, color, n):
    rng = np.random.default_rng(kind)
    pixels = rng.integers(0, 1 << bits, (7, 5, n))
    assert (I.read_png(filtered(pixels, bits, color, kind)) == pixels).all()


def test_png_round_trip_and_palette():
    rgb = np.random.default_rng(1).integers(0, 256, (9, 4, 3)).astype(np.uint8)
    assert (I.read_png(I.png(rgb)) == rgb).all()
    index = bytes([0, 0b00011011]) + bytes([0, 0b11100100])
    raw = I.MAGIC + I._chunk(b"IHDR", struct.pack(">IIBBBBB", 4, 2, 2, 3, 0, 0, 0)) + I._chunk(b"PLTE", bytes(range(12))) + I._chunk(b"tRNS", b"\x00") + I._chunk(b"IDAT", zlib.compress(index)) + I._chunk(b"IEND", b"")
    assert I.read_png(raw)[0].tolist() == [[0, 1, 2, 0], [3, 4, 5, 255], [6, 7, 8, 255], [9, 10, 11, 255]]
    assert I.to_rgb(I.read_png(raw))[0, 0].tolist() == [255, 255, 255]


def test_paper_is_white():
    assert I.to_rgb(np.array([[[10, 0], [10, 255]]], np.uint8)).tolist() == [[[255] * 3, [10] * 3]]
    deep = I.to_rgb(np.array([[[1000], [3000], [2000]]], np.uint16))
    assert deep[0, :, 0].tolist() == [0, 255, 127] and I.to_rgb(np.full((1, 1, 1), 7, np.uint16)).tolist() == [[[255] * 3]]


def test_upright():
    a = np.arange(6).reshape(2, 3, 1)
    shown = {n: I.upright(a, n)[:, :, 0].tolist() for n in range(1, 9)}
    assert shown == {1: [[0, 1, 2], [3, 4, 5]], 2: [[2, 1, 0], [5, 4, 3]], 3: [[5, 4, 3], [2, 1, 0]], 4: [[3, 4, 5], [0, 1, 2]], 5: [[0, 3], [1, 4], [2, 5]], 6: [[3, 0], [4, 1], [5, 2]], 7: [[5, 2], [4, 1], [3, 0]], 8: [[2, 5], [1, 4], [0, 3]]}
    exif = b"II*\x00\x08\x00\x00\x00\x01\x00" + struct.pack("<HHIHH", 274, 3, 1, 6, 0) + b"\x00" * 4
    assert I.orientation(b"\xff\xd8\xff\xe1\x00\x00Exif\x00\x00" + exif) == 6
    assert I.orientation(b"\xff\xd8Exif\x00\x00XX") == 1 and I.orientation(b"") == 1


def test_size_and_wear():
    flat = np.full((60, 90, 3), 200, np.uint8)
    small, scale = I.capped(flat, 1350)
    assert small.shape == (30, 45, 3) and scale == 0.5 and (small == 200).all()
    assert I.capped(flat)[1] == 1.0
    for level in I.WEAR:
        a, b = I.worn(flat, level, 3), I.worn(flat, level, 3)
        assert (a == b).all() and a.shape == flat.shape
    assert set(np.unique(I.worn(flat, 2, 1))) <= {0, 255} and (I.worn(flat, 0) == 200).all()
    with pytest.raises(I.TooLarge):
        I.read_png(I.MAGIC + I._chunk(b"IHDR", struct.pack(">IIBBBBB", 1 << 16, 1 << 16, 8, 2, 0, 0, 0)))


def test_files_to_pages_and_cuttings(spark, tmp_path):
    page = np.zeros((100, 200, 3), np.uint8)
    page[:50, 100:] = 255
    (tmp_path / "a.png").write_bytes(I.png(page))
    (tmp_path / "b.jpg").write_bytes(b"\xff\xd8\xff\xe0 no library reads this")
    (tmp_path / "c.pdf").write_bytes(b"%PDF-1.4 nor this")
    pages = I.render(I.load_files(spark, [str(tmp_path / n) for n in ("a.png", "b.jpg", "c.pdf")])).cache()
    rows = {r["source"][-5:]: r for r in pages.collect()}
    assert (rows["a.png"]["width"], rows["a.png"]["height"], rows["a.png"]["scale"], rows["a.png"]["page"]) == (200, 100, 1.0, 0)
    assert all(rows[n]["png"] is None and rows[n]["error"] for n in ("b.jpg", "c.pdf"))
    doc = rows["a.png"]["doc_id"]
    blocks = spark.createDataFrame([(doc, 0, 3, "figure", [0.5, 0.0, 1.0, 0.5]), (doc, 0, 4, "figure", None)], "doc_id string, page int, block_no int, type string, bbox array<double>")
    got = I.figure_cuttings(blocks, pages).collect()
    assert [(r["image"], r["alt"]) for r in got] == [("figures/p0001_b03.png", "Figure (page 1)")]
    cut = I.read_png(bytes(got[0]["cut"]))
    assert cut.shape == (56, 107, 3) and (cut[:50, 7:] == 255).all()
    side = I.cuttings(pages.where("png IS NOT NULL").withColumns({"bbox": F.lit(None).cast("array<double>"), "turn": F.lit(90)}), turn="turn").first()
    assert (I.read_png(bytes(side["cut"])) == I.turned(page, 90)).all()
    I.save_images(I.page_files(pages), str(tmp_path / "out"))
    assert (tmp_path / "out" / doc / "pages" / "p0001.png").read_bytes() == I.png(page)
