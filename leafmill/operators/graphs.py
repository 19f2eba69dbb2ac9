"""Graphs read from figures: comparable edges, their Markdown, and figure descriptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.text import strip
from leafmill.schema import TRUNCATED

# The kinds of figure; those whose transcription has a structure.
KINDS = ("plot", "graph", "diagram", "commutative_diagram", "table_image", "algorithm", "photo", "other")
STRUCTURED = ("graph", "diagram", "commutative_diagram", "plot")


def shown_name(nodes: Column, id_: Column) -> Column:
    """A node's label, or its id without one."""
    n = F.get(F.filter(nodes, lambda x: x["id"] == id_), F.lit(0))
    return F.coalesce(F.nullif(n["label"], F.lit("")), id_)


def edge_set(nodes: Column, edges: Column, by: str = "label") -> Column:
    """TIK-10: edges as sorted, distinct text: u>v directed, u-v (in order) if not."""
    end = (lambda x: shown_name(nodes, x)) if by == "label" else (lambda x: x)

    def one(e):
        u, v = end(e["u"]), end(e["v"])
        return F.when(e["directed"] & ~e["both"], F.concat_ws(">", u, v)).otherwise(F.concat_ws("-", F.least(u, v), F.greatest(u, v)))

    return F.array_sort(F.array_distinct(F.transform(edges, one)))


def graph_markdown(nodes: Column, edges: Column) -> Column:
    """TIK-11: a graph as a list of vertices and one of edges."""
    directed = F.size(F.filter(edges, lambda e: e["directed"]))
    kind = F.when(F.size(edges) == 0, "no edges").when(directed == F.size(edges), "directed").when(directed == 0, "undirected").otherwise("mixed")
    names = F.array_join(F.transform(nodes, lambda n: F.coalesce(F.nullif(n["label"], F.lit("")), n["id"])), ", ")
    head = F.concat(F.size(nodes).cast("string"), F.lit(" vertices, "), F.size(edges).cast("string"), F.lit(" edges ("), kind, F.lit(")\n\n- Vertices: "), names)

    def line(e):
        arrow = F.when(e["both"], "↔").when(e["directed"], "→").otherwise("—")
        label = F.when(F.coalesce(e["label"], F.lit("")) != "", F.concat(F.lit(" ("), e["label"], F.lit(")"))).otherwise("")
        return F.concat(F.lit("  - "), shown_name(nodes, e["u"]), F.lit(" "), arrow, F.lit(" "), shown_name(nodes, e["v"]), label)

    tail = F.concat(F.lit("\n- Edges:\n"), F.array_join(F.transform(edges, line), "\n"))
    return F.concat(head, F.when(F.size(edges) > 0, tail).otherwise(""))


def described(reply: Column) -> Column:
    """FIG-02: (kind, summary, structure, truncated) of a figure description."""
    cut = F.contains(reply, F.lit(TRUNCATED))
    r = F.replace(reply, F.lit(TRUNCATED), F.lit(""))
    said = F.regexp_replace(F.lower(strip(F.regexp_extract(r, r"(?i)\bKIND\W*:\W*([a-z_ ]+)", 1))), r"\s+", "_")
    kind = F.lit("other")
    for k in reversed(KINDS):
        kind = F.when((said == k) | F.startswith(said, F.lit(k + "_")), k).otherwise(kind)
    full = F.regexp_extract(r, r"(?s)<description>\s*(.*?)\s*</description>", 1)
    open_ = F.regexp_extract(r, r"(?s)<description>\s*(.*?)\s*(?:<structure>|(?=\n```)|\z)", 1)
    summary = F.when(F.contains(r, F.lit("</description>")), full).otherwise(open_)
    tagged = F.regexp_extract(r, r"(?s)<structure>\s*(.*?)\s*(?:</structure>|\z)", 1)
    fences = F.regexp_extract_all(F.regexp_replace(r, r"(?s)^.*</description>", ""), F.lit(r"(?s)```[^\n`]*\n(.*?)\n?```"), F.lit(1))
    other = F.when(kind.isin(*STRUCTURED), F.coalesce(F.try_element_at(fences, F.lit(-1)), F.lit(""))).otherwise("")
    structure = F.when(F.contains(r, F.lit("<structure>")), tagged).otherwise(other)
    structure = strip(F.regexp_replace(structure, r"^```[a-z-]*\n|\n?```\z", ""))
    return F.struct(kind.alias("kind"), strip(summary).alias("summary"), structure.alias("structure"), cut.alias("truncated"))
