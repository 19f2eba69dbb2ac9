"""Operator 9: near duplicates of embeddings by random-hyperplane hashing.

Equal vectors form one class. Classes are keyed in several tables by the signs of
their products with random hyperplanes; bits and tables follow from the number of
classes and the recall wanted at the threshold. Pairs of a bucket are compared
exactly, in double precision, as blocks of a matrix product; a bucket larger than
BLOCK is split into blocks and each pair of blocks is one group. A pair counts in
the first table it shares only, so that partial counts add up, and a block gives
back sums and a spanning forest, never its pairs.

Vectors that are null or zero, or hold null, NaN or infinity, link with nothing
and are their own component. Vectors of different lengths never link. Rows that
repeat are separate vectors. A null vec_id never names a component that holds
another id. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import _common as C
from leafmill.llm._components import components, forest

COSINE, RECALL, BUCKET, BLOCK = 0.9, 0.997, 1024, 2048


def shape(classes: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Bits of a key and tables, for buckets of about BUCKET classes."""
    bits = max(4, math.ceil(math.log2(max(1, classes) / BUCKET)))
    hit = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - hit))


def sign_keys(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    planes = np.random.default_rng(1234 + vectors.shape[1]).standard_normal((vectors.shape[1], bits * tables))
    signs = (vectors @ planes > 0).reshape(len(vectors), tables, bits)
    return (signs * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)


def rows_of(column: pa.Array) -> np.ndarray:
    """Lists of one length without nulls as a matrix, from the values' buffer."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _keys(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small(batches):
            sizes = b.column("size").to_numpy()
            keys = np.zeros((b.num_rows, tables), np.int64)
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                v = rows_of(b.column("vector").take(pa.array(at)))
                keys[at] = sign_keys(v / np.abs(v).max(axis=1, keepdims=True), bits, tables)
            ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * tables)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))], names=[*b.schema.names, "keys"])

    return run


def _compare(cosine: float):
    out = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        n = t.num_rows
        x, y = t.column("x")[0].as_py(), t.column("y")[0].as_py()
        table = t.column("t")[0].as_py()
        node, own, block = (t.column(c).to_numpy() for c in ("node", "copies", "block"))
        v = rows_of(t.column("vector").combine_chunks())
        keys = rows_of(t.column("keys").combine_chunks())[:, :table]
        v = v / np.abs(v).max(axis=1, keepdims=True)
        norms = (v * v).sum(axis=1)
        links, ends = np.zeros(n, np.int64), ([], [])
        left = np.flatnonzero(block == x)
        right = np.flatnonzero(block == y)
        for s in range(0, len(left), 256):
            rows = left[s : s + 256]
            near = (v[rows] @ v[right].T) / np.sqrt(np.outer(norms[rows], norms[right])) >= cosine
            p, q = np.nonzero(near)
            p, q = rows[p], right[q]
            ok = (p < q) if x == y else np.ones(len(p), bool)
            p, q = p[ok], q[ok]
            seen = np.zeros(len(p), bool)
            for k in range(keys.shape[1]):
                seen |= keys[p, k] == keys[q, k]
            p, q = p[~seen], q[~seen]
            np.add.at(links, p, own[q])
            np.add.at(links, q, own[p])
            ends[0].append(p)
            ends[1].append(q)
        root = forest(np.concatenate(ends[0]), np.concatenate(ends[1]), n)
        some = np.flatnonzero(links)
        return pa.table([pa.array(node[some]), pa.array(links[some]), pa.array(node[root[some]])], schema=out)

    return run


def link_vectors(rows: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id) of every row of rows (vec_id, embedding)."""
    C.prepare(rows.sparkSession)
    good = "embedding IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(embedding, x -> x <> 0)"
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")).withColumn("embedding", F.col("vector"))
    rows = rows.withColumn("ok", F.coalesce(F.expr(good), F.lit(False))).drop("embedding")
    keyed = rows.withColumns({"s1": F.xxhash64("vector"), "s2": F.xxhash64(F.lit("second"), "vector"), "size": F.size("vector")})
    classes = keyed.where("ok").groupBy("s1", "s2", "size").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.any_value("vector").alias("vector"))
    classes = C.cut(classes.withColumn("node", F.monotonically_increasing_id()).withColumn("vector", F.col("vector").cast("array<double>")))
    bits, tables = shape(classes.count(), cosine, recall)
    made = "s1 long, s2 long, size int, least long, copies long, vector array<double>, node long, keys array<long>"
    slim = classes.mapInArrow(_keys(bits, tables), made).select("node", "copies", "size", F.col("vector").alias("vector"), "keys")
    spread = C.cut(slim)
    in_tables = spread.select("node", "size", F.posexplode("keys").alias("t", "k"))
    sizes = in_tables.groupBy("t", "k", "size").agg(F.count("*").alias("m")).where("m > 1").withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int")).drop("m")
    placed = in_tables.join(sizes, ["t", "k", "size"]).withColumn("block", F.pmod(F.xxhash64("node", "t"), F.col("blocks").cast("long")).cast("int"))
    # Every pair of blocks of a bucket meets once: a block goes to as many groups as the bucket has blocks.
    groups = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other"))
    full = groups.join(spread.drop("size"), "node").select("t", "k", "size", "x", "y", "block", "node", "copies", "vector", "keys")
    found = C.cut(full.groupBy("t", "k", "size", "x", "y").applyInArrow(_compare(cosine), "node long, links long, root long"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    owner = classes.select("node", "s1", "s2", "size", "least", "copies").join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    owner = C.cut(owner)
    least = owner.groupBy("root").agg(F.min("least").alias("component_id"))
    named = owner.join(least, "root").select("s1", "s2", "size", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id", F.lit(True).alias("ok"))
    return keyed.drop("vector").join(named, ["s1", "s2", "size", "ok"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))


def op9_embeddup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of every vector."""
    out = link_vectors(C.load(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return out.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
