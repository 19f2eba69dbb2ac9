"""Page images: files to pages, upright, on white paper and of bounded size; parts of them cut
out, turned, worn. Pages travel as PNG bytes in a column and are handled a file or page at a time.

PNG is read and written here, with numpy alone. Other formats need an imaging library and PDF a
renderer (PIL, pypdfium2); without them such a file gets an error in its row, not a failed task.
"""

from __future__ import annotations

import os
import struct
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from leafmill.functions.text import crop_box, document_id, page_name
from leafmill.operators.figures import crop_name
from leafmill.session import ship

# Pixels of a page and of a source at most, dots an inch of a rendered page.
PAGE_PIXELS, SOURCE_PIXELS, DPI = 40_000_000, 1_000_000_000, 200
MAGIC = b"\x89PNG\r\n\x1a\n"


class NoDecoder(Exception):
    """The file's format needs a library that is not there."""


class TooLarge(Exception):
    """A source of more pixels than are taken."""


# ------------------------------------------------------------------ PNG


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def png(rgb: np.ndarray) -> bytes:
    """An 8-bit image of rows, columns and 3 channels, as PNG."""
    height, width, _ = rgb.shape
    rows = np.zeros((height, width * 3 + 1), np.uint8)
    rows[:, 1:] = rgb.reshape(height, -1)
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return MAGIC + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + _chunk(b"IEND", b"")


def chunks(raw: bytes) -> Iterator[tuple[bytes, bytes]]:
    at = len(MAGIC)
    while at + 8 <= len(raw):
        (size,) = struct.unpack(">I", raw[at : at + 4])
        yield raw[at + 4 : at + 8], raw[at + 8 : at + 8 + size]
        at += size + 12


def _unfiltered(rows: np.ndarray, step: int) -> np.ndarray:
    """PNG's five row filters undone; rows begin with their filter's number."""
    out = np.zeros((len(rows) + 1, rows.shape[1] - 1 + step), np.uint8)  # a row above, a pixel left
    for y, row in enumerate(rows, 1):
        kind, body = row[0], row[1:]
        if kind == 0:
            out[y, step:] = body
        elif kind == 1:
            out[y, step:] = np.cumsum(body.reshape(-1, step), axis=0, dtype=np.uint8).ravel()
        elif kind == 2:
            out[y, step:] = body + out[y - 1, step:]
        else:
            now, up = bytearray(out[y].tobytes()), out[y - 1].tobytes()
            for i, x in enumerate(body.tolist(), step):
                a, b, c = now[i - step], up[i], up[i - step]
                if kind == 3:
                    now[i] = (x + (a + b) // 2) & 255
                else:
                    p = a + b - c
                    now[i] = (x + min((a, b, c), key=lambda v: abs(p - v))) & 255
            out[y] = np.frombuffer(bytes(now), np.uint8)
    return out[1:, step:]


CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def read_png(raw: bytes) -> np.ndarray:
    """Rows, columns and channels (gray, gray and alpha, RGB, RGBA) of 8 or 16 bits."""
    parts: dict[bytes, bytes] = {}
    for kind, body in chunks(raw):
        parts[kind] = parts.get(kind, b"") + body
    width, height, bits, color, _, _, woven = struct.unpack(">IIBBBBB", parts[b"IHDR"])
    if width * height > SOURCE_PIXELS:
        raise TooLarge(f"{width} x {height} pixels")
    if woven:
        raise NoDecoder("interlaced PNG needs an imaging library")
    n = CHANNELS[color]
    size = (width * n * bits + 7) // 8
    rows = np.frombuffer(zlib.decompress(parts[b"IDAT"]), np.uint8).reshape(height, size + 1)
    plain = _unfiltered(rows, max(1, n * bits // 8))
    if bits == 16:
        out = plain.reshape(height, -1).view(">u2").astype(np.uint16)
    elif bits == 8:
        out = plain
    else:
        out = (np.unpackbits(plain, axis=1).reshape(height, -1, bits) @ (1 << np.arange(bits)[::-1])).astype(np.uint8)
        out = out[:, : width * n] * (1 if color == 3 else 255 // ((1 << bits) - 1))
    out = out.reshape(height, width, n)
    if color == 3:
        palette = np.frombuffer(parts[b"PLTE"], np.uint8).reshape(-1, 3)
        alpha = np.full(len(palette), 255, np.uint8)
        given = np.frombuffer(parts.get(b"tRNS", b""), np.uint8)
        alpha[: len(given)] = given
        out = np.column_stack([palette, alpha])[out[:, :, 0]]
    return out


# ------------------------------------------------------------------ pixels

#: By the number of a file's orientation tag, what shows the page upright.
UPRIGHT = {2: np.fliplr, 3: lambda a: np.rot90(a, 2), 4: np.flipud, 5: lambda a: a.swapaxes(0, 1), 6: lambda a: np.rot90(a, -1), 7: lambda a: np.rot90(a, 2).swapaxes(0, 1), 8: np.rot90}


def upright(pixels: np.ndarray, orientation: int) -> np.ndarray:
    """SRC-08."""
    return UPRIGHT.get(orientation, lambda a: a)(pixels)


def orientation(raw: bytes) -> int:
    """The orientation tag of JPEG's or PNG's EXIF data; 1 where there is none or it is broken."""
    try:
        if raw[:8] == MAGIC:
            exif = next((body for kind, body in chunks(raw) if kind == b"eXIf"), b"")
        else:
            at = raw.find(b"Exif\x00\x00", 0, 1 << 16)
            exif = raw[at + 6 : at + (1 << 16)] if at >= 0 else b""
        order = {b"II": "<", b"MM": ">"}[exif[:2]]
        (first,) = struct.unpack_from(order + "I", exif, 4)
        (count,) = struct.unpack_from(order + "H", exif, first)
        for k in range(count):
            tag, _, _, value = struct.unpack_from(order + "HHIH", exif, first + 2 + 12 * k)
            if tag == 274:
                return value
    except (KeyError, struct.error):
        pass
    return 1


def to_rgb(pixels: np.ndarray) -> np.ndarray:
    """SRC-09: 8-bit RGB on white paper. Wider samples are stretched over the values they use."""
    a = pixels[:, :, None] if pixels.ndim == 2 else pixels
    color, alpha = (a[:, :, :-1], a[:, :, -1:]) if a.shape[2] in (2, 4) else (a, None)
    if a.dtype != np.uint8:
        low, high = float(color.min()), float(color.max())
        color = ((color - low) * (255.0 / (high - low))).astype(np.uint8) if high > low else np.full(color.shape, 255, np.uint8)
        alpha = None if alpha is None else (alpha // 257).astype(np.uint8)
    if alpha is not None:
        share = alpha / 255.0
        color = (color * share + 255 * (1 - share) + 0.5).astype(np.uint8)
    return np.repeat(color, 3, axis=2) if color.shape[2] == 1 else np.ascontiguousarray(color)


def _weights(old: int, new: int, lobes: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """For each of `new` samples the old ones it is made of, by a windowed sinc as wide as the
    reduction asks for, and their weights."""
    scale = max(old / new, 1.0)
    centre = (np.arange(new) + 0.5) * old / new
    reach = int(np.ceil(lobes * scale)) * 2 + 1
    at = np.floor(centre)[:, None].astype(int) - reach // 2 + np.arange(reach)
    x = (at + 0.5 - centre[:, None]) / scale
    w = np.where(np.abs(x) < lobes, np.sinc(x) * np.sinc(x / lobes), 0.0) * ((at >= 0) & (at < old))
    return at.clip(0, old - 1), w / w.sum(axis=1, keepdims=True)


def resampled(rgb: np.ndarray, width: int, height: int) -> np.ndarray:
    out = rgb.astype(np.float32)
    for axis, size in ((0, height), (1, width)):
        at, w = _weights(out.shape[axis], size)
        made = np.zeros((*out.shape[:axis], size, *out.shape[axis + 1 :]), np.float32)
        shape = (size, 1, 1) if axis == 0 else (1, size, 1)
        for k in range(at.shape[1]):
            made += out.take(at[:, k], axis=axis) * w[:, k].reshape(shape)
        out = made
    return (out + 0.5).clip(0, 255).astype(np.uint8)


def capped(rgb: np.ndarray, most: int = PAGE_PIXELS) -> tuple[np.ndarray, float]:
    """SRC-06: the page with `most` pixels at most, and its scale to four places."""
    height, width, _ = rgb.shape
    scale = min(1.0, (most / (width * height)) ** 0.5)
    if scale < 1.0:
        rgb = resampled(rgb, max(1, int(width * scale)), max(1, int(height * scale)))
    return rgb, round(scale, 4)


def turned(rgb: np.ndarray, degrees: int | None) -> np.ndarray:
    """REV-15: counterclockwise, by a quarter's multiples; other turns leave the page alone."""
    return np.ascontiguousarray(np.rot90(rgb, degrees // 90)) if degrees in (90, 180, 270) else rgb


# Skew in degrees, blur in pixels, noise, contrast and whether in two tones, by level.
WEAR = {0: (0.0, 0.0, 0.0, 1.0, False), 1: (0.6, 0.4, 4.0, 0.95, False), 2: (1.2, 0.8, 10.0, 0.85, True), 3: (2.5, 1.3, 16.0, 0.75, False)}


def worn(rgb: np.ndarray, level: int = 1, seed: int = 0) -> np.ndarray:
    """A clean page as a scan of it would look, the same for the same seed: gray, askew, flat,
    blurred, noisy, in two tones. (A scan's JPEG artefacts need an encoder and are left out.)"""
    skew, blur, noise, contrast, two_tone = WEAR[level]
    rng = np.random.default_rng(seed)
    page = rgb.astype(np.float32) @ np.array([0.299, 0.587, 0.114], np.float32)
    height, width = page.shape
    if skew:
        a = np.deg2rad(rng.uniform(-skew, skew))
        y, x = np.mgrid[:height, :width].astype(np.float32)
        y, x = y - height / 2, x - width / 2
        from_y = np.round(y * np.cos(a) - x * np.sin(a) + height / 2).astype(int)
        from_x = np.round(y * np.sin(a) + x * np.cos(a) + width / 2).astype(int)
        there = (from_y >= 0) & (from_y < height) & (from_x >= 0) & (from_x < width)
        page = np.where(there, page[from_y.clip(0, height - 1), from_x.clip(0, width - 1)], 255)
    low = 255 * (1 - contrast) / 2
    page = low + page * (255 - 2 * low) / 255
    if blur:
        reach = int(3 * blur) + 1
        bell = np.exp(-0.5 * (np.arange(-reach, reach + 1) / blur) ** 2)
        for axis in (0, 1):
            edge = [(reach, reach) if k == axis else (0, 0) for k in (0, 1)]
            padded = np.pad(page, edge, mode="edge")
            page = sum(b * padded.take(range(k, k + page.shape[axis]), axis=axis) for k, b in enumerate(bell / bell.sum()))
    page = (page + rng.normal(0.0, noise, page.shape)).clip(0, 255) if noise else page
    page = np.where(page > rng.integers(150, 191), 255, 0) if two_tone else page
    return np.repeat(page.astype(np.uint8)[:, :, None], 3, axis=2)


# ------------------------------------------------------------------ files


def frames(raw: bytes) -> Iterator[np.ndarray]:
    """SRC-06 to SRC-09, SRC-11: the pages of an image file. Of a TIFF every frame but the reduced
    copies (tag 254, bit 0), of others the first."""
    if raw[:8] == MAGIC:
        try:
            yield to_rgb(upright(read_png(raw), orientation(raw)))
            return
        except NoDecoder:
            pass
    try:
        from PIL import Image
    except ImportError as e:
        raise NoDecoder("this image format needs PIL, which is not installed") from e
    import io

    Image.MAX_IMAGE_PIXELS = SOURCE_PIXELS // 2  # the library refuses at twice that
    with Image.open(io.BytesIO(raw)) as im:
        tiff = im.format == "TIFF"
        pages = [k for k in range(getattr(im, "n_frames", 1)) if not tiff or _tag(im, k, 254, 0) & 1 == 0] if tiff else [0]
        for k in pages or [0]:
            im.seek(k)
            way = int(im.tag_v2.get(274, 1)) if tiff else orientation(raw)
            wide = im.mode in ("I", "F") or im.mode.startswith("I;16")
            pixels = np.asarray(im.convert("F") if wide else im.convert("RGBA"))
            yield to_rgb(upright(pixels, way))


def _tag(im, frame: int, tag: int, default: int) -> int:
    im.seek(frame)
    return int(im.tag_v2.get(tag, default))


def pdf_pages(raw: bytes, dpi: int) -> Iterator[tuple[np.ndarray, float]]:
    """SRC-05: each page and its scale."""
    try:
        import pypdfium2
    except ImportError as e:
        raise NoDecoder("PDF needs pypdfium2, which is not installed") from e
    pdf = pypdfium2.PdfDocument(raw)
    try:
        for page in pdf:
            width, height = page.get_size()
            scale = min(1.0, (PAGE_PIXELS / max(width * height * (dpi / 72) ** 2, 1e-9)) ** 0.5)
            yield to_rgb(np.asarray(page.render(scale=dpi / 72 * scale).to_pil().convert("RGB"))), round(scale, 4)
    finally:
        pdf.close()


def pages_of(raw: bytes, name: str, dpi: int = DPI) -> Iterator[tuple[np.ndarray, float]]:
    if name.lower().endswith(".pdf") or raw[:5] == b"%PDF-":
        yield from pdf_pages(raw, dpi)
    else:
        yield from (capped(page) for page in frames(raw))


PAGES = "doc_id string, source string, sha256 string, page int, width int, height int, scale double, png binary, error string"


def render(files: DataFrame, dpi: int = DPI) -> DataFrame:
    """SRC-05, SRC-06: files (doc_id, path, sha256, content) to pages. A file that cannot be read
    is one row with an error and no page."""
    ship(files.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in PAGES.split(", ")]
        for f in batches:
            for doc, path, digest, raw in f.itertuples(index=False):
                k = 0
                try:
                    for rgb, scale in pages_of(bytes(raw), path, dpi):
                        yield pd.DataFrame([(doc, path, digest, k, rgb.shape[1], rgb.shape[0], scale, png(rgb), None)], columns=names)
                        k += 1
                except Exception as e:  # noqa: BLE001  told in the row, as a dead letter
                    yield pd.DataFrame([(doc, path, digest, None, None, None, None, None, f"{type(e).__name__}: {e}"[:800])], columns=names)

    return files.select("doc_id", "path", "sha256", "content").mapInPandas(run, PAGES)


def load_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(doc_id, path, sha256, content) of the files at paths."""
    digest = F.sha2("content", 256)
    path = F.regexp_replace("path", "^file:/*", "/")
    return spark.read.format("binaryFile").load([os.path.abspath(p) for p in paths]).select(document_id(path, digest).alias("doc_id"), path.alias("path"), digest.alias("sha256"), "content")


def cuttings(rows: DataFrame, pad: float = 0.01, turn: str | None = None) -> DataFrame:
    """REV-04, REV-15: rows (png, width, height, bbox) with cut: the part in the box as PNG, the
    page first turned by the degrees in column `turn`."""
    ship(rows.sparkSession)
    size = F.array("width", "height")
    if turn:
        size = F.when(F.col(turn).isin(90, 270), F.array("height", "width")).otherwise(size)
    at = crop_box(F.col("bbox"), size[0], size[1], pad)

    @F.pandas_udf("binary")
    def cut(page: pd.Series, box: pd.Series, degrees: pd.Series) -> pd.Series:
        def one(raw, b, d):
            if raw is None:
                return None
            x0, y0, x1, y1 = b
            return png(turned(to_rgb(read_png(raw)), None if pd.isna(d) else int(d))[y0:y1, x0:x1])

        return pd.Series([one(*x) for x in zip(page, box, degrees, strict=True)], dtype=object)

    return rows.withColumn("cut", cut("png", at, F.col(turn).cast("int") if turn else F.lit(None).cast("int")))


@F.pandas_udf(BinaryType())
def sized(page: pd.Series, width: pd.Series, height: pd.Series, degrees: pd.Series) -> pd.Series:
    """A page at another size, then turned, as PNG."""

    def one(raw, w, h, d):
        if raw is None:
            return None
        rgb = to_rgb(read_png(raw))
        if pd.notna(w) and (rgb.shape[1], rgb.shape[0]) != (w, h):
            rgb = resampled(rgb, int(w), int(h))
        return png(turned(rgb, None if pd.isna(d) else int(d)))

    return pd.Series([one(*x) for x in zip(page, width, height, degrees, strict=True)], dtype=object)


def figure_cuttings(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """SNK-05: figures with a box, with image (the name their picture gets), alt and cut."""
    figures = blocks.where("type = 'figure' AND bbox IS NOT NULL").join(pages.select("doc_id", "page", "png", "width", "height"), ["doc_id", "page"])
    alt = F.concat(F.lit("Figure (page "), (F.col("page") + 1).cast("string"), F.lit(")"))
    return cuttings(figures, 0.005).withColumns({"image": crop_name(F.col("page"), F.col("block_no")), "alt": alt}).drop("png", "width", "height")


def save_images(rows: DataFrame, folder: str) -> None:
    """SNK-06: rows (doc_id, name, png) as files folder/doc_id/name, each there whole or not at all."""
    ship(rows.sparkSession)

    def write(part):
        for r in part:
            at = os.path.join(folder, str(r["doc_id"]), r["name"])
            os.makedirs(os.path.dirname(at), exist_ok=True)
            fd, temp = tempfile.mkstemp(dir=os.path.dirname(at), prefix=".part-", suffix=".png")
            try:
                with os.fdopen(fd, "wb") as f:
                    f.write(r["png"])
                os.replace(temp, at)
            except BaseException:
                os.unlink(temp)
                raise

    rows.select("doc_id", "name", "png").foreachPartition(write)


def page_files(pages: DataFrame) -> DataFrame:
    """(doc_id, name, png) of pages, as `save_images` takes them."""
    return pages.where("png IS NOT NULL").select("doc_id", F.concat(F.lit("pages/"), page_name(F.col("page")), F.lit(".png")).alias("name"), "png")
