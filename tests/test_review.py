"""Review, graphs and sources on small tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.operators import graphs as G
from leafmill.operators import review as V
from leafmill.sources import files

ROW = "i int, type string, content string, flags array<string>, proposal string"


def gates(spark, *rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ROW)
    return [(r["ok"], r["why"]) for r in V.gated(df).orderBy("i").collect()]


def test_gate(spark):
    got = gates(
        spark,
        ("formula", "x+y", [], " "),
        ("formula", "x+y", [], "x <<TRUNCATED>>"),
        ("formula", "x+y", [], "{x+y"),
        ("text", "", ["empty"], "--"),
        ("text", "", ["empty"], "A whole new reading"),
        ("text", r"a\*b and more of it", [], "a*b and more of it"),
        ("formula", "x+y", [], "x + y"),
        ("text", "one two three", [], "something else entirely"),
        ("formula", "{x+y", ["latex_braces"], "{x+y}"),
    )
    assert [g[0] for g in got] == [False, False, False, False, True, False, True, False, True]
    assert [g[1] for g in got[:6]] == ["empty proposal", "truncated proposal", "introduces flags latex_braces", "not a transcription", "draft degenerate; reviewer re-read accepted", r"drops Markdown escapes \*"]
    assert got[7][1].endswith("> limit 0.35")


def test_review_outcomes(spark):
    rows = [
        (0, "formula", "x+y", "VERDICT: correct"),
        (1, "formula", "x+y", "VERDICT: fixed\n<latex>x + y</latex>"),
        (2, "formula", "x+y+z+w", "**VERDICT:** fixed\n<latex>$$x+y+z+v$$"),
        (3, "text", "some words here", "VERDICT: unreadable"),
        (4, "text", "some words here", "I cannot"),
        (5, "text", "some words here", "VERDICT: fixed\n```\nsome worts here\n```"),
        (6, "text", "some words here", "VERDICT: fixed\n<text>nothing like that at all</text>"),
    ]
    df = spark.createDataFrame([(*r, "reader", []) for r in rows], "i int, type string, content string, reply string, source string, flags array<string>")
    got = {r["i"]: (r["reviewed"], r["content"], r["source"], r["flags"]) for r in V.reviewed(df, "rev").collect()}
    assert got == {
        0: ("agreed", "x+y", "reader", []),
        1: ("agreed", "x+y", "reader", []),
        2: ("edited", "x+y+z+v", "rev", []),
        3: ("unreadable", "some words here", "reader", ["unreadable"]),
        4: ("no-proposal", "some words here", "reader", []),
        5: ("edited", "some worts here", "rev", []),
        6: ("rejected", "some words here", "reader", []),
    }


def test_policy(spark):
    rows = [("formula", "x", None, []), ("text", "x", None, []), ("text", "x", None, ["empty"]), ("figure", "x", None, ["empty"]), ("text", "x", None, ["page_failed"]), ("text", "", None, ["empty"]), ("text", "", [0.0], ["empty"]), ("text", "x", None, ["latex_unchecked"])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, type string, content string, bbox array<double>, flags array<string>")
    assert sorted(r["i"] for r in V.wanted(df).collect()) == [0, 2, 6]


def test_white_space_that_shows():
    assert V.formula_form(r"a + b") == V.formula_form("a+b") and V.formula_form(r"\in S") != V.formula_form(r"\inS")
    assert V.formula_form(r"\text{ and }") != V.formula_form(r"\text{and}")
    assert V.text_form("a  b\nc") == V.text_form("a b\n  c") and V.text_form("- a\n  - b") != V.text_form("- a\n- b")


def test_graphs(spark):
    df = spark.createDataFrame(
        [([("a", "A"), ("b", "")], [("a", "b", True, False, "x"), ("b", "a", False, False, "")])],
        "nodes array<struct<id:string,label:string>>, edges array<struct<u:string,v:string,directed:boolean,both:boolean,label:string>>",
    )
    r = df.select(G.edge_set(F.col("nodes"), F.col("edges")), G.graph_markdown(F.col("nodes"), F.col("edges"))).first()
    assert r[0] == ["A-b", "A>b"]
    assert r[1] == "2 vertices, 2 edges (mixed)\n\n- Vertices: A, b\n- Edges:\n  - A → b (x)\n  - b — A"


def test_descriptions(spark):
    replies = ["**KIND:** graph drawing\n<description> A tree </description>\n```tikz\n\\node;\n```", "KIND: photo\n<description>cut <<TRUNCATED>>", "nothing"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "i int, r string").orderBy("i")
    assert [tuple(r[0]) for r in df.select(G.described(F.col("r"))).collect()] == [("graph", "A tree", "\\node;", False), ("photo", "cut", "", True), ("other", "", "", False)]


def test_discovery(spark, tmp_path):
    for name, body in (("b.pdf", "1"), ("a.PNG", "2"), ("._x.pdf", "3"), ("no.txt", "4"), ("sub/b.pdf", "1"), ("sub/c.pdf", "1"), (".hid/d.pdf", "5")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(body)
    (tmp_path / "sub/loop").symlink_to(tmp_path)
    got = sorted(r["path"].removeprefix(f"{tmp_path}/") for r in files.discover(spark, [str(tmp_path), f"{tmp_path}/sub/../b.pdf"]).collect())
    assert got == ["a.PNG", "b.pdf", "sub/c.pdf"]


def test_placeholders(spark):
    notes = ["7", "N/A", "--", "(nothing to transcribe)", "[blank]", "(page number 7)", "(The image is blank.)", "(no text)", "(This page intentionally left blank)"]
    texts = ["(If $S$ is empty, there is nothing to prove.)", "Nothing is lost here", "(no text-book)", "x = 7"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(notes + texts)], "i int, t string").orderBy("i")
    assert [r[0] for r in df.select(V.placeholder(F.col("t"))).collect()] == [True] * len(notes) + [False] * len(texts)
