"""Figures in two passes, and smaller operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.functions import text as X
from leafmill.operators import blocks as B
from leafmill.operators import figures as D
from leafmill.operators import reports as R
from leafmill.operators import review as V
from leafmill.sources import files


def test_a_bad_graph_is_sent_back_once(spark):
    good = "KIND: graph\n<description>Two</description>\n<structure>\\node (a) {A}; \\node (b) {B}; \\draw (a) -- (b);</structure>"
    bad = good.replace("(a) -- (b)", "(a) -- (c)")

    def model(request):
        return {"1": good, "2": bad, "2 again": good, "3": bad, "3 again": bad, "4": "KIND: photo\n<description>Sky</description>"}[request]

    df = spark.createDataFrame([(str(i),) for i in range(1, 5)], "request string").withColumn("id", F.col("request"))
    got = {r["id"]: r for r in D.describe(df, model, lambda request, problems: F.concat(request, F.lit(" again")), workers=1).collect()}
    assert [got[k]["attempts"] for k in "1234"] == [1, 2, 2, 1]
    assert got["1"]["description"].startswith("**Kind:** graph. Two\n\n**Graph — Markdown (simple):** 2 vertices, 1 edges (undirected)")
    assert "not available: the TikZ below failed the checks: `edges use undeclared vertices: c`" in got["3"]["description"]
    assert got["3"]["flags"] == ["tikz_undeclared"] and got["3"]["graph"] is None and got["3"]["graph_partial"] is not None
    assert got["4"]["description"] == "**Kind:** photo. Sky"


def test_work_lists(spark):
    pages = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (2, 1)], "doc_id int, page int")
    read = spark.createDataFrame([(1, 0, False), (1, 1, True), (2, 0, None)], "doc_id int, page int, failed boolean")
    rows = lambda df: sorted((r["doc_id"], r["page"]) for r in df.collect())
    assert rows(R.to_read(pages, read)) == [(2, 1)] and rows(R.to_read(pages, read, retry_failed=True)) == [(1, 1), (2, 0), (2, 1)] and len(rows(R.to_read(pages, read, force=True))) == 4
    assert rows(R.to_review(read, pages.where("page = 0"))) == [(1, 1)]
    assert rows(R.invalidate(pages, pages.where("doc_id = 1"))) == [(2, 0), (2, 1)]
    new = pages.where("page = 1").withColumn("v", F.lit("new"))
    once = R.upsert(pages.withColumn("v", F.lit("old")), new, ["doc_id", "page"])
    assert sorted(tuple(r) for r in R.upsert(once, new, ["doc_id", "page"]).collect()) == [(1, 0, "old"), (1, 1, "new"), (2, 0, "old"), (2, 1, "new")]
    flagged = pages.withColumn("failed", F.col("page") == 1).withColumn("flags", F.when(F.col("doc_id") == 2, F.array(F.lit("page_failed"))).otherwise(F.array().cast("array<string>")))
    assert rows(R.failed_pages(flagged)) == [(1, 1), (2, 0), (2, 1)]


def test_replies(spark):
    df = spark.createDataFrame([("---\nis_rotation_valid: False\nrotation_correction: 90\n---\nx",), ("---\nis_rotation_valid: true\nrotation_correction: 90\n---\nx",), ("x",)], "r string")
    assert [r[0] for r in df.select(X.rotation_asked(F.col("r"))).collect()] == [90, 0, 0]
    df = spark.createDataFrame([(r"so \( x+y \) and \(z\)",)], "r string")
    assert df.select(X.dollar_math(F.col("r"))).first()[0] == "so $x+y$ and $z$"
    assert B.lift_display("so \\[x=1\\] holds, see \\[Spi04\\]\n\\[y=2\\]") == "so \n$$\nx=1\n$$\n holds, see \\[Spi04\\]\n\\[y=2\\]"
    df = spark.createDataFrame([([0.0, 0.0, 0.5, 0.5],), (None,), ([0.5, 0.5, 0.5, 0.5],)], "b array<double>")
    assert [r[0] for r in df.select(X.crop_box(F.col("b"), F.lit(1000), F.lit(100))).collect()] == [[0, 0, 516, 57], [0, 0, 1000, 100], [484, 43, 516, 57]]


def test_escapes_in_tables(spark):
    rows = [("<td>&lt;b&gt;x</td>", "<td><b>x</td>", ["&lt;"]), ("a &lt;x", "<td>a &lt;x</td>", []), (r"a\_b", "a_b", [r"\_"])]
    df = spark.createDataFrame([(i, d, p) for i, (d, p, _) in enumerate(rows)], "i int, d string, p string").orderBy("i")
    assert [r[0] for r in df.select(V.dropped_escapes(F.col("d"), F.col("p"), F.lit("table"))).collect()] == [w for *_, w in rows]


def test_inputs(spark, tmp_path):
    for n in ("a.pdf", "b.pdf", "with space.pdf"):
        (tmp_path / n).write_text(n)
    assert files.split_inputs([f"{tmp_path}/?.pdf {tmp_path}/x*.pdf", f"{tmp_path}/with space.pdf"]) == [f"{tmp_path}/a.pdf", f"{tmp_path}/b.pdf", f"{tmp_path}/x*.pdf", f"{tmp_path}/with space.pdf"]
    (tmp_path / "p.sh").write_text("# note\nexport A_B='x/y' # why\nC=3\nd=4\n")
    assert files.read_profile(spark, f"{tmp_path}/p.sh") == {"A_B": "x/y", "C": "3"}
