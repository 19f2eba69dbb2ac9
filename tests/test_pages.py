"""Work lists, readers by name, sizes and per-document files."""

import random

import pytest
from pyspark.sql import functions as F

from leafmill.functions import text as X
from leafmill.operators import readers
from leafmill.operators import reports as R
from leafmill.operators import review as V2
from leafmill.schema import known_type
from leafmill.sources import files


def fit(w, h, most=3072 * 2048, least=1792 * 28, g=28):
    """The resize, said as a loop."""
    if w <= 0 or h <= 0:
        return w, h
    scale = (most / (w * h)) ** 0.5 if w * h > most else (least / (w * h)) ** 0.5 if w * h < least else 1.0
    a, b = (max(1, round(side * scale / g)) for side in (w, h))
    while a * b * g * g > most and a * b > 1:
        by_a = False if a == 1 else True if b == 1 else abs((a - 1) / b - w / h) < abs(a / (b - 1) - w / h)
        a, b = a - by_a, b - (not by_a)
    return a * g, b * g


def test_fitted_sizes(spark):
    rng = random.Random(3)
    sizes = [(rng.choice([rng.randint(1, 90), rng.randint(500, 5000), rng.randint(20000, 300000)]), rng.randint(1, 6000)) for _ in range(400)]
    sizes += [(0, 10), (10, 0), (-4, 9), (3072, 2048), (1, 1), (10**6, 1), (1, 10**6)]
    out = spark.createDataFrame(sizes, "w int, h int").select("w", "h", X.fitted(F.col("w"), F.col("h")).alias("s")).collect()
    assert [(r.w, r.h, r.s.w, r.s.h) for r in out] == [(w, h, *fit(w, h)) for w, h in sizes]


def test_known_types(spark):
    rows = spark.createDataFrame([("text",), ("poem",)], "t string")
    assert rows.where("t = 'text'").select(known_type(F.col("t")).alias("t")).collect()[0].t == "text"
    with pytest.raises(Exception, match="unknown block type: poem"):
        rows.select(known_type(F.col("t"))).collect()


def test_recheck(spark):
    rows = spark.createDataFrame([("formula", "x_{1", ["latex_unchecked"]), ("formula", "x_{1", []), ("formula", "x", ["latex_unchecked", "truncated"])], "type string, content string, flags array<string>")
    out = [r.f for r in rows.select(V2.recheck(F.col("flags"), F.col("type"), F.col("content")).alias("f")).collect()]
    assert out == [["latex_braces"], [], ["truncated"]]


def test_readers_by_name(spark):
    replies = spark.createDataFrame([("d", 0, "---\na: b\n---\n# T\n\nsum \\( x \\) end", False)], "doc_id string, page int, text string, cut boolean")
    blocks = lambda name: [(r.type, r.content) for r in readers.reader(name)(replies).orderBy("block_no").collect()]
    assert blocks("markdown") == [("title", "T"), ("text", "sum \\( x \\) end")]
    assert blocks("dollar-markdown")[1] == ("text", "sum $x$ end")
    readers.register("own", lambda rows: rows)
    assert readers.reader("own")(replies) is replies
    del readers.READERS["own"]
    with pytest.raises(ValueError, match="unknown reader"):
        readers.reader("own")


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def test_finished(spark):
    docs = spark.createDataFrame([("whole", 2), ("purged", 2), ("gone", None), ("read", 2), ("new", 2)], "doc_id string, n_pages int")
    outputs = spark.createDataFrame([("whole", 0), ("purged", 1), ("gone", 0), ("read", 0)], "doc_id string, failed_pages int")
    missing = spark.createDataFrame([("purged", 1), ("read", 0), ("new", 0)], "doc_id string, page int")
    read = spark.createDataFrame([("purged", 0), ("read", 0), ("read", 1)], "doc_id string, page int")
    assert ids(R.finished(docs, outputs, missing, read)) == ["gone", "purged"]
    assert ids(R.finished(docs, outputs, missing, read, retry_failed=True)) == ["gone"]
    assert ids(R.finished(docs, outputs, missing, read, force_read=True)) == []
    assert ids(R.finished(docs.limit(0), outputs, missing, read)) == []


def test_selection_shares_all_documents(spark):
    docs = spark.range(20).select(F.col("id").alias("doc_id"))
    done, failed = docs.where("doc_id < 3"), docs.where("doc_id IN (7, 8)")
    parts = [ids(R.select_documents(docs, done, failed, ["doc_id"], i, 3)) for i in range(3)]
    assert sorted(sum(parts, [])) == [x for x in range(3, 20) if x not in (7, 8)]
    assert parts[0] == [3, 6, 9, 12, 15, 18]
    assert ids(R.select_documents(docs, done, failed, ["doc_id"], 1, 3, retry_failed=True)) == [4, 7, 10, 13, 16, 19]


def test_files_by_document(spark, tmp_path):
    rows = spark.createDataFrame([("a", "# Ä\n", '{"n": 1}'), ("b", None, None)], "doc_id string, markdown string, report string")
    for _ in range(2):
        files.save_files(rows, str(tmp_path))
    assert sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*.*")) == ["a/a.md", "a/report.json", "b/b.md", "b/report.json"]
    assert (tmp_path / "a/a.md").read_text(encoding="utf-8") == "# Ä\n" and (tmp_path / "b/report.json").read_text() == "{}"
    with pytest.raises(TypeError):
        files.write_whole(str(tmp_path / "c.md"), None)
    assert not (tmp_path / "c.md").exists() and not list(tmp_path.glob(".part-*"))
