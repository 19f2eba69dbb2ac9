"""RDB-08: readers by name; others are added with `register`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import dollar_math, fitted, front_matter, outer_fence, resized, rotation_asked, sampling
from leafmill.operators.blocks import markdown_blocks
from leafmill.operators.html import layout_html_blocks
from leafmill.operators.layout import layout_blocks

Reader = Callable[[DataFrame], DataFrame]
# Temperatures of the Markdown readers by attempt, the long side of the pages that
# they see (and whether small pages grow to it), and how often a page is turned at most.
TEMPERATURES = (0.1, 0.1, 0.2, 0.3, 0.5, 0.8, 0.9, 1.0)
LONG_SIDE, TURNED_LONG_SIDE, TURNS = 1600, 1288, 3


def page_size(name: str, width: Column, height: Column) -> Column:
    """(w, h) of the image of a page that a reader is shown."""
    if name == "layout-json":
        return resized(height, width)
    if name == "layout-html":
        return fitted(width, height)
    side = {"markdown": LONG_SIDE, "dollar-markdown": TURNED_LONG_SIDE}.get(name)
    if side is None:
        return F.struct(width.alias("w"), height.alias("h"))
    scale = F.lit(float(side)) / F.greatest(width, height)
    scale = F.least(scale, F.lit(1.0)) if name == "markdown" else scale
    return F.struct(F.bround(width * scale).cast("int").alias("w"), F.bround(height * scale).cast("int").alias("h"))


def decoding(name: str, attempt: Column) -> Column:
    """RDB-09, RDH-12: (temperature, top_p) of a reading; null where the model's own holds."""
    if name == "layout-html":
        return sampling(attempt)
    warm = F.element_at(F.array(*map(F.lit, TEMPERATURES)), F.least(attempt, F.lit(len(TEMPERATURES) - 1)) + 1)
    return F.struct((warm if name == "dollar-markdown" else F.lit(None).cast("double")).alias("temperature"), F.lit(None).cast("double").alias("top_p"))


def asks_turn(name: str, reply: Column) -> Column:
    """RDM-06: the turn that a reply asks for before its page is read again, else 0."""
    return F.coalesce(rotation_asked(reply), F.lit(0)) if name == "dollar-markdown" else F.lit(0)


def markdown(replies: DataFrame) -> DataFrame:
    """RDM-07: replies (doc_id, page, text, cut) without fence and front matter, as blocks."""
    return markdown_blocks(replies.withColumn("text", front_matter(outer_fence(F.col("text")))["body"]))


def dollar_markdown(replies: DataFrame) -> DataFrame:
    """RDM-08: the same for a model that sets inline math in parentheses."""
    return markdown_blocks(replies.withColumn("text", dollar_math(front_matter(outer_fence(F.col("text")))["body"])))


READERS: dict[str, Reader] = {"markdown": markdown, "dollar-markdown": dollar_markdown, "layout-json": layout_blocks, "layout-html": layout_html_blocks}


def register(name: str, reader: Reader) -> None:
    READERS[name] = reader


def reader(name: str) -> Reader:
    if name not in READERS:
        raise ValueError(f"unknown reader {name!r}; known: {', '.join(sorted(READERS))}")
    return READERS[name]
