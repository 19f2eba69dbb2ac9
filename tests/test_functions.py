"""Validators and scalar functions on small tables of input and result."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from leafmill.functions import flags as V
from leafmill.functions import text as X


def values(spark, rows, column, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("c"))).collect()]


def test_latex(spark):
    cases = {
        r"\frac{a}{b}": [],
        r"{a": ["latex_braces"],
        r"\{a": [],
        r"a \\{}": [],
        r"}{": ["latex_braces"],
        r"\begin{array}x\end{array}": [],
        r"\begin{a}\begin{b}\end{a}\end{b}": ["latex_env"],
        r"\end{a}": ["latex_env"],
        r"\left( x \right)": [],
        r"\left( x": ["latex_leftright"],
        r"\leftarrow": [],
        r"a $ b": ["latex_delims"],
        r"a \$ b": [],
        r"x \] y": ["latex_delims"],
        r"x \\[2pt] y": [],
    }
    assert values(spark, list(cases), V.latex_flags) == list(cases.values())


def test_inline_math(spark):
    cases = {"plain": [], "$a$ and $b$": [], "$a": ["inline_math"], r"cost \$5": [], "$a$$b$": [], "see $$x$$ here": [], "$$x": ["inline_math"], "bad $\\frac{a$ x": ["latex_braces"], "$${a$$ and $b$": ["latex_braces"]}
    assert values(spark, list(cases), V.inline_math_flags) == list(cases.values())


def test_pipe_tables(spark):
    cases = {"| a | b |\n| 1 | 2 |": [], "| a | b |\n| 1 |": ["table_shape"], "| a |": ["table_parse"], "none": ["table_parse"], "| a \\| c | b |\n| 1 | 2 |": []}
    assert values(spark, list(cases), V.pipe_table_flags) == list(cases.values())


def test_html_tables():
    table = lambda *rows: "<table>" + "".join(f"<tr>{r}</tr>" for r in rows) + "</table>"
    assert V.html_table_flags(table("<td>a<td>b", "<td colspan=2>c")) == []
    assert V.html_table_flags(table("<td rowspan=2>a</td><td>b</td>", "<td>c</td>")) == []
    assert V.html_table_flags(table("<td>a<td>b", "<td>c")) == ["table_shape"]
    assert V.html_table_flags("<table></table>") == ["table_parse"]


def test_loops(spark):
    prose = " ".join(f"word{i}" for i in range(80))
    assert values(spark, [prose, prose + " the end" * 6, prose + " the end" * 5, "the " * 10, ""], V.tail_loop) == [False, True, False, False, False]
    assert not V.loops("text", prose)
    assert V.loops("text", f"{prose} {'over and ' * 20} {prose}")
    assert not V.loops("text", f"{prose} {'. ' * 40} {prose}")
    assert V.loops("text", " ".join(f"a{i % 70}" for i in range(3000)))
    assert not V.loops("text", prose + r"\begin{pmatrix}" + " 0 &" * 90 + r"\end{pmatrix} " + prose)
    assert V.loops("table", "| a | b |\n" * 8) and not V.loops("table", "\n".join(f"| {i} | 0 | 0 |" for i in range(9)))


@pytest.mark.parametrize(("unit", "n", "want"), [(["a"], 20, True), (["a", "b"], 19, False), (["-"], 50, False)])
def test_veto(unit, n, want):
    seq = ["x", "y", *unit * n, "z"]
    assert V.runs_of(seq, 60, 20, lambda u: not any(map(str.isalnum, "".join(u)))) is want


def test_block_flags(spark):
    cases = [
        ("text", "fine", []), ("text", " ", ["empty"]), ("header", "", []), ("figure", "", []), ("figure", "x\n<<TRUNCATED>>", ["truncated"]),
        ("text", "cut <<TRUNCATED>>", ["truncated"]), ("formula", "{x", ["latex_braces"]), ("code", "$ {", []), ("table", "<table><tr><td>1</tr></table>", []), ("table", "x", ["table_parse"]), ("list", "- $a", ["inline_math"]), ("text", None, ["empty"]),
    ]
    df = spark.createDataFrame([(i, k, c) for i, (k, c, _) in enumerate(cases)], "i int, type string, content string")
    got = [r[0] for r in df.orderBy("i").select(V.block_flags(F.col("type"), F.col("content"))).collect()]
    assert got == [w for *_, w in cases]


def test_names(spark):
    cases = {"/a/b/My paper (v2).pdf": "My_paper_v2", "x/.hidden": ".hidden", "/ü.png": "doc", "a.tar.gz": "a.tar", "_x_.pdf": "x"}
    assert values(spark, list(cases), X.stem) == list(cases.values())
    assert values(spark, [0, 11], lambda c: X.page_name(c), "int") == ["p0001", "p0012"]


def test_replies(spark):
    cases = {"<think>a</think>\n b": "b", "a</think> c": "c", "d <think>e": "d ", "plain": "plain"}
    assert values(spark, list(cases), X.strip_thinking) == list(cases.values())
    cases = {"$$ x $$": "x", r"\[y\]": "y", "$z$": "z", "$$": "", "$": "$", r"\(a": r"\(a", "$$$": "$"}
    assert values(spark, list(cases), X.strip_math_delims) == list(cases.values())
    cases = {"```markdown\nx\n```": "x", "```\ny": "y", "```python\nz\n```": "```python\nz\n```"}
    assert values(spark, list(cases), X.outer_fence) == list(cases.values())
    got = values(spark, ["---\na: 1\nb: x: y\n---\nbody", "none"], X.front_matter)
    assert [tuple(g) for g in got] == [("body", {"a": "1", "b": "x: y"}), ("none", {})]


def test_boxes(spark):
    assert values(spark, ["0 0 500 1200", "1,2,3", "5 5 5 9", "a b c d"], X.layout_box) == [[0, 0, 0.5, 1], None, None, None]
    assert values(spark, [[50.0, 80.0, 10.0, 20.0], [1.0, 2.0, 1.0, 3.0]], lambda c: X.pixel_box(c, F.lit(100), F.lit(100)), "array<double>") == [[0.1, 0.2, 0.5, 0.8], None]
    assert [tuple(v) for v in values(spark, [1000, 20, 900], lambda c: X.resized(c, c), "int")] == [(980, 980), (56, 56), (896, 896)]
    assert values(spark, [1.6e8, 1.0, 0.0], X.cap, "double") == [0.5, 1.0, 1.0]
