"""Types and vocabularies of the block model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The closed vocabulary of block types, and those no document text comes from.
BLOCK_TYPES = ("title", "heading", "text", "list", "formula", "table", "figure", "caption", "footnote", "header", "footer", "page_number", "code", "reference", "other")
DROPPED_TYPES = ("header", "footer", "page_number")
FLOATS = ("figure", "caption", "table", "footnote")
JOINABLE = ("text", "list", "reference")
MATH_TEXT = ("text", "list", "caption", "footnote", "heading", "title", "reference")
TRUNCATED = "<<TRUNCATED>>"

# The labels of layout replies (JSON, then HTML) and the block types they mean.
JSON_LABELS = {"caption": "caption", "footnote": "footnote", "formula": "formula", "list-item": "list", "page-footer": "footer", "page-header": "header", "picture": "figure", "section-header": "heading", "table": "table", "text": "text", "title": "title"}

HISTORY = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("source", "verdict", "decision", "proposal", "previous", "previous_source")]))
META = T.StructType(
    [T.StructField("level", T.IntegerType()), T.StructField("json_repaired", T.BooleanType()), T.StructField("repeated", T.IntegerType()), T.StructField("truncated_tail", T.BooleanType()), T.StructField("tail_recovered", T.BooleanType()), T.StructField("reviewed", T.StringType())]
    + [T.StructField(n, T.StringType()) for n in ("image", "alt", "kind", "description", "reader_description", "description_error")]
)
BLOCK = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("block_no", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("bbox", T.ArrayType(T.DoubleType())),
        T.StructField("source", T.StringType()),
        T.StructField("flags", T.ArrayType(T.StringType())),
        T.StructField("history", HISTORY),
        T.StructField("meta", META),
    ]
)


def known_type(block_type: Column) -> Column:
    """VAL-18: the type itself; one outside the vocabulary, or none, ends the query."""
    said = F.concat(F.lit("unknown block type: "), F.coalesce(block_type, F.lit("null")))
    return F.when(block_type.isin(*BLOCK_TYPES), block_type).otherwise(F.raise_error(said))
