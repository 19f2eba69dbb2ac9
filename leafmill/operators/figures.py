"""FIG: descriptions of figures, checked, sent back once, and set as Markdown."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.operators import tikz
from leafmill.operators.graphs import described, graph_markdown
from leafmill.session import settled
from leafmill.sources.models import answered

# How a structure is fenced, by kind.
FENCES = {"graph": "latex", "diagram": "mermaid", "commutative_diagram": "latex", "plot": "text"}


def needs_description(blocks: DataFrame) -> DataFrame:
    """VAL-20: figures with a picture and without a description."""
    return blocks.where("type = 'figure' AND coalesce(image, '') <> '' AND description IS NULL")


def crop_name(page: Column, block_no: Column) -> Column:
    """SNK-05: where a figure's picture goes."""
    return F.format_string("figures/p%04d_b%02d.png", page + 1, block_no)


def formatted(info: Column, graph: Column, problems: Column) -> Column:
    """FIG-04: info: kind, summary, structure, truncated; graph: as parsed, with problems."""
    head = F.trim(F.concat(F.lit("**Kind:** "), info["kind"], F.lit(". "), info["summary"]))
    given = info["structure"] != ""
    fine = (F.size(F.coalesce(graph["nodes"], F.array().cast(tikz.T.ArrayType(tikz.NODE)))) > 0) & (F.size(problems) == 0)
    said = F.transform(problems, lambda p: F.concat(F.lit("`"), F.trim(F.regexp_replace(F.replace(p, F.lit("`"), F.lit("'")), r"\s+", F.lit(" "))), F.lit("`")))
    why = F.when(F.size(problems) > 0, F.array_join(said, "; ")).otherwise("it did not parse")
    simple = F.when(fine, graph_markdown(graph["nodes"], graph["edges"])).otherwise(F.concat(F.lit("*(not available: the TikZ below failed the checks: "), why, F.lit(")*")))
    both = F.concat(F.lit("\n\n**Graph — Markdown (simple):** "), simple, F.lit("\n\n**Graph — TikZ:**\n\n```latex\n"), info["structure"], F.lit("\n```"))
    fence = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in FENCES.items() for x in kv]), info["kind"]), F.lit("text"))
    other = F.concat(F.lit("\n\n```"), fence, F.lit("\n"), info["structure"], F.lit("\n```"))
    cut = "\n\n*(cut off at the length limit: the description may be incomplete, and any structure is left out)*"
    tail = (
        F.when(info["truncated"], F.lit(cut))
        .when((info["kind"] == "graph") & given, both)
        .when(info["kind"] == "graph", F.lit("\n\n**Graph — Markdown (simple):** *(not available: no TikZ was given)*"))
        .when(given, other)
        .otherwise("")
    )
    return F.concat(head, tail)


def checked(rows: DataFrame) -> DataFrame:
    """FIG-02, FIG-03: rows (with a reply) with info, graph, flags and problems."""
    rows = rows.withColumn("info", described(F.col("reply")))
    code = F.when((F.col("info.kind") == "graph") & (F.col("info.structure") != ""), F.col("info.structure"))
    rows = rows.withColumn("graph", F.when(code.isNotNull(), tikz.graph(code)))
    flags = tikz.structure_flags(F.col("info.kind"), F.col("info.structure"), F.col("info.truncated"), F.col("graph"))
    none = F.array().cast("array<string>")
    cut = F.when(F.col("info.truncated"), F.array(F.lit("the answer was cut off at the length limit"))).otherwise(none)
    missing = F.when(F.array_contains("flags", "tikz_missing"), F.array(F.lit("no structure was given"))).otherwise(none)
    return rows.withColumn("flags", flags).withColumn("problems", F.concat(cut, missing, F.coalesce(F.col("graph.problems"), none)))


def describe(figures: DataFrame, model: Callable[[str], str], repair: Callable[[Column, Column], Column], **how) -> DataFrame:
    """FIG-05: figures (doc_id, page, block_no, request) described in two passes: those whose
    graph or diagram fails its checks are asked again, with what `repair` makes of their
    request and problems; the last answer stays either way."""
    keep = [c for c in figures.columns if c != "request"]
    first = checked(settled(answered(figures, model, **how)))
    poor = (F.size("flags") > 0) & F.col("info.kind").isin("graph", "commutative_diagram") & F.col("error_kind").isNull()
    again = first.where(poor).select(*keep, repair(F.col("request"), F.col("problems")).alias("request"))
    second = checked(settled(answered(again, model, **how))).withColumn("attempts", F.lit(2))
    out = first.where(~F.coalesce(poor, F.lit(False))).withColumn("attempts", F.lit(1)).unionByName(second)
    clean = F.size("problems") == 0
    return out.select(
        *keep, "error_kind", "error", "attempts", "flags",
        F.col("info.kind").alias("kind"),
        formatted(F.col("info"), F.col("graph"), F.col("problems")).alias("description"),
        F.when(clean, F.col("graph")).alias("graph"),
        F.when(~clean, F.col("graph")).alias("graph_partial"),
    )
