"""Operators on small tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from leafmill.operators import assembly as A
from leafmill.operators import blocks as B
from leafmill.operators import reports as R
from leafmill.streaming.completion import completions

BLOCKS = "doc_id long, page int, block_no int, type string, content string, failed boolean, tail boolean"


def pages(spark, *given):
    rows = [(1, p, k, kind, text, "failed" in more, "tail" in more) for p, page in enumerate(given) for k, (kind, text, *more) in enumerate(page)]
    return spark.createDataFrame(rows, BLOCKS)


def markdown(spark, *given, marks=False):
    return A.assemble(pages(spark, *given), marks).first()["markdown"]


def test_paragraphs_join_over_a_page_break(spark):
    assert markdown(spark, [("text", "The proof of the")], [("text", "theorem is short.")]) == "The proof of the theorem is short.\n"
    assert markdown(spark, [("text", "It ends here.")], [("text", "next one")]) == "It ends here.\n\nnext one\n"
    assert markdown(spark, [("text", "no join")], [("text", "Upper case")]) == "no join\n\nUpper case\n"
    assert markdown(spark, [("text", "one")], [("list", "two")]) == "one\n\ntwo\n"


def test_floats_follow_the_joined_paragraph(spark):
    got = markdown(spark, [("text", "a split"), ("footnote", "note")], [("table", "| a |"), ("text", "paragraph"), ("header", "skip")], [("text", "goes on")])
    assert got == "a split paragraph goes on\n\n<sub>note</sub>\n\n| a |\n"


@pytest.mark.parametrize(("left", "right", "want"), [("sparsi-", "fication works", "sparsification works"), ("well-", "known fact", "well-known fact"), ("a $k$-", "connected graph", "a $k$-connected graph")])
def test_hyphens(spark, left, right, want):
    assert markdown(spark, [("text", left)], [("text", right)]) == want + "\n"


def test_hyphen_follows_the_document(spark):
    assert markdown(spark, [("text", "edge-cut and edge-")], [("text", "cut again")]).startswith("edge-cut and edge-cut")
    assert markdown(spark, [("text", "wellknown, wellknown; well-")], [("text", "known")]).startswith("wellknown, wellknown; wellknown")


def test_failed_and_cut_pages(spark):
    got = markdown(spark, [("text", "open")], [("other", "", "failed")], [("text", "go on"), ("text", "", "tail")], marks=True)
    assert "page 2: OCR failed" in got and "open\n" in got and "\n\ngo on\n" in got and "page 3: the reader's output was cut off" in got


def test_rendering(spark):
    rows = [("title", "T", None), ("heading", "H", 2), ("formula", "$$x$$", None), ("formula", " ", None), ("caption", "c", None), ("caption", "*c*", None), ("code", "x", None), ("footnote", "f", None), ("text", " t \n<<TRUNCATED>>", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, type string, content string, level int")
    got = [r[0] for r in df.orderBy("i").select(A.rendered(F.col("type"), F.col("content"), F.col("level"))).collect()]
    assert got == ["# T", "### H", "$$\nx\n$$", "", "*c*", "*c*", "```\nx\n```", "<sub>f</sub>", "t"]


def test_figures(spark):
    df = spark.createDataFrame([("", "a.png", None, "graph", "Graph — TikZ: x"), ("in it", None, "A", None, None)], "c string, image string, alt string, kind string, d string")
    got = [r[0] for r in df.select(A.figure_rendered(*(F.col(c) for c in ("c", "image", "alt", "kind", "d")))).collect()]
    assert got == ["![figure](a.png)\n\n<details><summary>Figure description (generated) — graph as Markdown and as TikZ</summary>\n\nGraph — TikZ: x\n\n</details>", "in it"]


def test_markdown_blocks():
    page = "# Paper\n\n## Intro ##\nOne line\nand more\n\n- a\n- b\n\n$$x\n+ y$$\n\\[1\\] D. Author\n\n<table>\n<tr>\n</table>\n![A plot](p.png)\n![figure](q.png)\n| a |\n| b |"
    assert B.split_markdown(page) == [
        ("title", "Paper", None, None), ("heading", "Intro", 1, None), ("text", "One line\nand more", None, None), ("list", "- a\n- b", None, None),
        ("formula", "x\n+ y", None, None), ("text", "\\[1\\] D. Author", None, None), ("table", "<table>\n<tr>\n</table>", None, None),
        ("figure", "", None, "A plot"), ("figure", "", None, None), ("table", "| a |\n| b |", None, None),
    ]
    assert B.split_markdown("whole\n\nopen para\nlast", True) == [("text", "whole", None, None)]
    assert B.split_markdown("a\n\n$$x\ny", True) == [("text", "a", None, None)]


def test_repeats_are_dropped_in_order(spark):
    box = lambda k: [float(k), 0.0, 1.0, 1.0]
    rows = [(1, 0, 0, box(1), "Text", "a"), (1, 0, 1, box(1), "Text", "b"), (1, 0, 2, box(2), "Text", "b")] + [(1, 1, i, box(i), "List", "x") for i in range(5)] + [(1, 2, i, box(i), "List", "x") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, page int, pos int, box array<double>, label string, text string")
    got = sorted(tuple(r) for r in B.drop_repeats(df).collect())
    assert got == [(1, 0, 0, 2), (1, 0, 2, 1), (1, 1, 0, 5), *[(1, 2, i, 1) for i in range(4)]]


def test_best_attempt_ignores_what_follows_a_clean_one(spark):
    df = spark.createDataFrame([(1, 0, 0.5, 0, 10), (1, 1, 0.0, 0, 5), (1, 2, 0.0, 0, 99), (2, 0, 0.2, 1, 1), (2, 1, 0.2, 1, 1)], "page int, attempt int, lost double, repeated int, kept_chars int")
    assert sorted(tuple(r) for r in B.best_attempt(df, ["page"]).collect()) == [(1, 1, 2), (2, 0, 2)]


def test_islands_and_shards(spark):
    df = spark.createDataFrame([(1, v) for v in (8, 0, 1, 2, 5, 7, 7)], "k int, v int")
    assert R.islands(df, ["k"], "v").first()["ranges"] == "0-2,5,7-8"
    got = {r["id"]: r["shard"] for r in R.shards(spark.range(100), ["id"], 3).collect()}
    assert got == {i: i % 3 for i in range(100)}


def test_report_lists_flagged_blocks_in_order(spark):
    rows = [(1, 1, 0, "text", ["empty"]), (1, 0, 1, "list", ["empty", "inline_math"]), (1, 0, 0, "text", [])]
    r = R.report(spark.createDataFrame(rows, "doc_id long, page int, block_no int, type string, flags array<string>")).first()
    assert r["block_types"] == {"text": 2, "list": 1} and r["open_flags"] == {"empty": 2, "inline_math": 1} and r["n_pages"] == 2
    assert [(b["page"], b["block"]) for b in r["flagged_blocks"]] == [(1, 1), (2, 0)]


def test_stream_tells_each_page_once(spark, tmp_path):
    """An item that comes twice counts once; a failed one is made up for."""
    schema = "doc_id long, page long, item string, expected long, ok boolean"
    rows = [(1, 0, "a", 2, True), (1, 0, "a", 2, True), (1, 1, "a", 1, False), (1, 0, "b", 2, True), (1, 1, "a", 1, True), (2, 0, "a", 3, True), (1, 0, "b", 2, True)]
    for r in rows:
        spark.createDataFrame([r], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        q = completions(stream).writeStream.format("memory").queryName("told").outputMode("append").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
        assert q.awaitTermination(120)
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    assert sorted((r["doc_id"], r["page"], r["n_items"]) for r in spark.table("told").collect()) == [(1, 0, 2), (1, 1, 1)]
