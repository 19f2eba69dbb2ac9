"""What the third round's findings were about."""

from __future__ import annotations

import difflib
import random
import re
import time

import pyarrow as pa
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the queries
from leafmill.operators import blocks, tikz
from leafmill.operators.review import matched
from leafmill.plans.queries import QUERIES
from leafmill.plans.written import rdb01_boxes


def test_boxes_fold_and_equal_lines_without_one_do_not(spark, tmp_path):
    lines = [(1, 2, 3, "N")] * 6 + [(1, 3, 4, "N"), (1, 1, 7, "R")]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber long, l_partkey long, l_returnflag string").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert sorted(map(tuple, rdb01_boxes(spark, str(tmp_path)).collect())) == [(1, 1, 2)] + [(1, 2, 1)] * 6


def test_matched_is_what_difflib_matches():
    """The same sums as difflib's, on strings of few and of many letters, moved parts and repeats."""
    rng = random.Random(3)
    for k in range(400):
        letters = ("a", "ab", "abcdefgh ")[k % 3]
        a = "".join(rng.choices(letters, k=rng.randint(0, 80)))
        b = a[k % 7 :] + a[: k % 5] if k % 2 else "".join(rng.choices(letters, k=rng.randint(0, 80)))
        assert matched(a, b) == sum(m.size for m in difflib.SequenceMatcher(None, a, b, False).get_matching_blocks())


def test_matched_looks_at_few_places():
    """A block of 20,000 characters with a letter doubled here and there, in well under the 400,000,000 pairs of places."""
    rng = random.Random(4)
    a = " ".join("".join(rng.choices("abcdefghijklmnoprstuvw", k=rng.randint(3, 12))) for _ in range(2500))
    began = time.process_time()
    assert matched(a, re.sub("([aeiou]) ", r"\1\1 ", a)) == len(a)
    assert time.process_time() - began < 20


def test_rows_are_dealt_out_though_a_file_has_one_row_group(spark, tmp_path):
    spark.range(0, 3000).select(F.col("id").alias("p_partkey"), F.lit("w").alias("p_name"), F.lit(1).alias("p_size")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    for name in ("htm_pages", "tik_drawings", "rev08_dropped_escapes"):
        rows = QUERIES[name](spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
        assert len(rows) > 1 and max(r["count"] for r in rows) < 1000


def test_orders_are_dealt_out(spark, tmp_path):
    spark.range(0, 3000).select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey")).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    for name in ("tik11_graph_markdown", "tik01_graphs"):
        rows = QUERIES[name](spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
        assert len(rows) > 1 and max(r["count"] for r in rows) < 1000


def test_a_remembered_statement_is_read_anew_where_styles_hold():
    body = r"\node (a) {A}; \node (b) {B}; \draw (a) -- (b);"
    assert [e["directed"] for o in ("", "->", "") for e in tikz.parse_graph(f"\\begin{{tikzpicture}}[{o}]{body}\\end{{tikzpicture}}")["edges"]] == [False, True, False]
    assert tikz.alone(r"\draw (a) -- (b);") is tikz.alone(r"\draw (a) -- (b);") and tikz.alone(r"\tikzset{x/.style={->}}") is None


def test_blocks_of_long_texts_are_passed_on_in_parts():
    keys = pa.array(range(6), pa.int64())
    batch = pa.RecordBatch.from_arrays([keys, pa.array([0] * 6, pa.int32()), pa.array(["# a\n\n" + "word " * 200_000] * 5 + [None]), pa.array([False] * 6)], names=["doc_id", "page", "text", "cut"])
    parts = list(blocks.block_batches(iter([batch])))
    assert len(parts) == 3 and [r for p in parts for r in p["doc_id"].to_pylist()] == [k for k in range(5) for _ in range(2)]
    assert [b.num_rows for b in parts] == [4, 4, 2] and parts[0]["type"].to_pylist() == ["title", "text"] * 2
