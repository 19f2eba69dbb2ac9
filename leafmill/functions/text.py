"""Scalar functions on names, replies, boxes and math, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.schema import TRUNCATED

#: White space of Unicode; a set of characters, so that only a text's ends are looked at.
SPACE = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    """Without white space at both ends, Unicode's included."""
    return F.btrim(c, F.lit(SPACE))


def clean(c: Column) -> Column:
    """VAL-19: content without the truncation mark, stripped."""
    return strip(F.replace(F.coalesce(c, F.lit("")), F.lit(TRUNCATED), F.lit("")))


def stem(path: Column) -> Column:
    """SRC-04: a file's name as it stands in a document id."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    name = F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", "")
    name = F.btrim(F.regexp_replace(name, r"[^A-Za-z0-9._-]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(F.left(name, F.lit(60)), F.lit("")), F.lit("doc"))


def document_id(path: Column, digest: Column) -> Column:
    return F.concat_ws("-", stem(path), F.left(digest, F.lit(16)))


def page_name(page: Column) -> Column:
    """Numbered from 1, four digits."""
    return F.format_string("p%04d", page + 1)


def cap(pixels: Column, most: float = 40_000_000.0) -> Column:
    """SRC-10: the scale that brings a page down to so many pixels."""
    return F.when(pixels > 0, F.least(F.lit(1.0), F.sqrt(F.lit(most) / pixels))).otherwise(1.0)


def strip_thinking(reply: Column) -> Column:
    """SNK-08: a reply without its reasoning."""
    out = F.regexp_replace(reply, r"(?s)<think>.*?</think>\s*", "")
    out = F.when(F.contains(out, F.lit("</think>")), F.regexp_replace(F.substring_index(out, "</think>", -1), r"^\s+", "")).otherwise(out)
    return F.substring_index(out, "<think>", 1)


def data_url(content: Column, kind: str = "image/png") -> Column:
    """SNK-09."""
    return F.concat(F.lit(f"data:{kind};base64,"), F.replace(F.base64(content), F.lit("\r\n"), F.lit("")))


def strip_math_delims(c: Column) -> Column:
    """VAL-12: one pair of delimiters off, the first of the four that fits."""
    c, out = strip(c), None
    for a, b in (("$$", "$$"), ("\\[", "\\]"), ("\\(", "\\)"), ("$", "$")):
        n = len(a) + len(b)
        fits = F.startswith(c, F.lit(a)) & F.endswith(c, F.lit(b)) & (F.length(c) >= n)
        inner = strip(F.substring(c, F.lit(len(a) + 1), F.length(c) - n))
        out = F.when(fits, inner) if out is None else out.when(fits, inner)
    return out.otherwise(c)


def layout_box(text: Column) -> Column:
    """RDH-09: "x0 y0 x1 y1" in thousandths to clipped fractions, or null."""
    parts = F.split(strip(text), r"[,\s]+")
    v = F.transform(parts, lambda p: F.greatest(F.lit(0.0), F.least(F.lit(1.0), p.try_cast("double") / 1000)))
    at = lambda i: F.get(v, F.lit(i))
    return F.when((F.size(parts) == 4) & F.forall(parts, lambda p: p.try_cast("double").isNotNull()) & (at(2) > at(0)) & (at(3) > at(1)), v)


def pixel_box(box: Column, width: Column, height: Column) -> Column:
    """RDB-05: pixels to clipped, ordered fractions, or null."""
    x = lambda i: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.get(box, F.lit(i)) / width))
    y = lambda i: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.get(box, F.lit(i)) / height))
    x0, x1, y0, y1 = F.least(x(0), x(2)), F.greatest(x(0), x(2)), F.least(y(1), y(3)), F.greatest(y(1), y(3))
    whole = (F.size(box) == 4) & F.forall(box, lambda v: v.isNotNull())
    return F.when(whole & (x1 > x0) & (y1 > y0), F.array(x0, y0, x1, y1))


def resized(height: Column, width: Column, factor: int = 28, least: int = 56 * 56, most: int = 14 * 14 * 4 * 1280) -> Column:
    """RDB-04: (h, w), multiples of factor with an area in bounds; rounds half to even."""
    step = lambda c: c * factor
    h0 = F.greatest(F.lit(factor), step(F.bround(height / factor)))
    w0 = F.greatest(F.lit(factor), step(F.bround(width / factor)))
    big, small = F.sqrt(height * width / most), F.sqrt(F.lit(float(least)) / (height * width))
    side = lambda raw, c: F.when(h0 * w0 > most, F.greatest(F.lit(factor), step(F.floor(c / big / factor)))).when(h0 * w0 < least, step(F.ceil(c * small / factor))).otherwise(raw).cast("int")
    return F.struct(side(h0, height).alias("h"), side(w0, width).alias("w"))


def front_matter(reply: Column) -> Column:
    """RDM-03: (body, keys) of a reply with a leading block of `key: value` lines."""
    head = r"(?s)^\s*---\s*\n(.*?)\n---\s*\n?"
    block = F.regexp_extract(reply, head, 1)
    lines = F.filter(F.split(block, "\n"), lambda x: F.contains(x, F.lit(":")))
    pairs = F.transform(lines, lambda x: F.struct(strip(F.substring_index(x, ":", 1)).alias("k"), strip(F.regexp_replace(x, r"^[^:]*:", "")).alias("v")))
    last = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    keys = F.map_from_arrays(last, F.transform(last, lambda k: F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"]))
    return F.struct(F.regexp_replace(reply, head, "").alias("body"), keys.alias("keys"))


def outer_fence(reply: Column) -> Column:
    """RDM-04: one markdown, md or bare fence around a reply off; its end may be missing."""
    opening = r"^\s*```(?:markdown|md)?[ \t]*\n"
    return F.when(reply.rlike(opening), F.regexp_replace(F.regexp_replace(reply, opening, ""), r"\n?```\s*$", "")).otherwise(reply)


def rotation_asked(reply: Column) -> Column:
    """RDM-06: the turn that front matter asks for, else 0."""
    keys = front_matter(outer_fence(reply))["keys"]
    turn = F.try_element_at(keys, F.lit("rotation_correction"))
    invalid = F.lower(F.try_element_at(keys, F.lit("is_rotation_valid"))) == "false"
    return F.when(invalid & turn.isin("90", "180", "270"), turn.cast("int")).otherwise(0)


def dollar_math(reply: Column) -> Column:
    """RDM-08: inline math in parentheses to dollars."""
    return F.regexp_replace(reply, r"(?s)\\\(\s*(\S(?:(?!\\\(|\n\s*\n).)*?)\s*\\\)", r"\$$1\$")


def crop_box(box: Column, width: Column, height: Column, pad: float = 0.01) -> Column:
    """REV-04: a padded pixel box, or the whole page where there is none or it is too thin."""
    px, py = width * pad + 6, height * pad + 6
    at = lambda i: F.get(box, F.lit(i))
    low = lambda v: F.greatest(F.lit(0), v.cast("int"))
    x0, y0 = low(at(0) * width - px), low(at(1) * height - py)
    x1, y1 = F.least(width, (at(2) * width + px).cast("int")), F.least(height, (at(3) * height + py).cast("int"))
    whole = F.array(F.lit(0), F.lit(0), width.cast("int"), height.cast("int"))
    return F.when(box.isNull() | (x1 - x0 < 8) | (y1 - y0 < 8), whole).otherwise(F.array(x0, y0, x1, y1))


def fitted(width: Column, height: Column, most: int = 3072 * 2048, least: int = 1792 * 28, grid: int = 28) -> Column:
    """RDH-13: (w, h) as multiples of grid, brought into the bounds of the area, rounding half
    to even; what rounding put above the bound comes off side by side, the one whose loss keeps
    the shape better first. A size that is not positive stays as it is."""
    area, shape = width.cast("double") * height, width.cast("double") / F.nullif(height, F.lit(0))
    scale = F.when(area > most, F.sqrt(most / F.nullif(area, F.lit(0)))).when(area < least, F.sqrt(least / F.nullif(area, F.lit(0)))).otherwise(1.0)
    blocks = lambda side: F.greatest(F.lit(1), F.bround(side * scale / grid).cast("int"))
    start = F.struct(blocks(width).alias("w"), blocks(height).alias("h"), shape.alias("shape"))
    over = F.ceil(start["w"].cast("double") * start["h"] - most / grid**2).cast("int")

    def shrink(a, _):
        w, h = a["w"], a["h"]
        high = w.cast("double") * h * grid * grid > most
        by_w = F.abs((w - 1) / h - a["shape"]) < F.abs(w / F.nullif(h - 1, F.lit(0)) - a["shape"].alias("shape"))
        wide = F.when(w == 1, False).when(h == 1, True).otherwise(by_w)
        return F.struct(F.when(high & wide, w - 1).otherwise(w).alias("w"), F.when(high & ~wide & (h > 1), h - 1).otherwise(h).alias("h"), a["shape"].alias("shape"))

    steps = F.when(over > 0, F.sequence(F.lit(1), over)).otherwise(F.array().cast("array<int>"))
    done = F.aggregate(steps, start, shrink, lambda a: F.struct((a["w"] * grid).alias("w"), (a["h"] * grid).alias("h")))
    return F.when((width > 0) & (height > 0), done).otherwise(F.struct(width.cast("int").alias("w"), height.cast("int").alias("h")))


def sampling(attempt: Column) -> Column:
    """RDH-12: (temperature, top_p) of a layout-HTML reading: near greedy, then warmer by attempt."""
    warm = F.least(F.round(attempt * 0.2, 1), F.lit(0.8))
    return F.struct(F.when(attempt == 0, 0.0).otherwise(warm).alias("temperature"), F.when(attempt == 0, 0.1).otherwise(0.95).alias("top_p"))


def reader_tag(name: Column, model: Column) -> Column:
    """RDB-09: where a block comes from."""
    return F.concat_ws(":", F.lit("reader"), name, model)
