"""Operator 10: near duplicates by MinHash with tensored banding.

Texts become sets of 5-word shingles. Equal sets form one class, combined before
the shuffle, so copies cost nothing further. Two collections of PARTS groups of
ROWS min-hashes each give PARTS * PARTS tables, keyed by a pair of groups, one of
each collection: 2 * PARTS * ROWS hashes do the work of PARTS**2 * 2 * ROWS. A
pair at the threshold shares no key with a chance of about one in a thousand.

Each bucket's classes are first compared with the bucket's least one. Classes of
buckets that still hold several components are then compared with each other in
blocks of bounded size, one task for two blocks, which give back links alone.
A pair is linked if the full sets say so. Components come from contraction.

Null, empty and wordless texts have empty sets, link with nothing and are their
own component. Long texts are hashed piece by piece and compared by their whole sets. An
empty table gives no rows. Of a group the least doc_id stands for it; of rows that share
that id the one of least hash of the text stays. Rows that share a doc_id take part each; component ids are doc
ids. A null doc_id never names a component that holds another id. Extra columns
pass through `keep_first`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import _common as C
from leafmill.llm import _words as W
from leafmill.llm._components import components, forest

SHINGLE, PERCENT = 5, 85
ROWS, PARTS = 3, 8
#: Classes and shingles of a block, where a bucket is compared pair by pair.
BLOCK_SETS, BLOCK_SHINGLES = 512, 500_000
#: Rows of an Arrow batch that carry full sets.
SET_ROWS = 64
U = np.uint64


def _family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(99)
    n = 2 * PARTS * ROWS
    return rng.integers(0, 1 << 63, n, dtype=np.uint64), rng.integers(0, 1 << 63, n, dtype=np.uint64) * U(2) + U(1)


XOR, MUL = _family()


def min_hashes(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Group hashes (texts x 2 * PARTS) of non-empty sets that lie one after another."""
    mins = np.empty((len(starts), 2 * PARTS * ROWS), np.uint64)
    for i in range(mins.shape[1]):
        mins[:, i] = np.minimum.reduceat((sets ^ XOR[i]) * MUL[i], starts)
    groups = np.zeros((len(starts), 2 * PARTS), np.uint64)
    for j in range(ROWS):
        groups = W.mix(groups + mins[:, j::ROWS] + U(j))
    return groups


def _sketch(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        long = pa.list_(pa.int64())
        for b in C.small(batches):
            data, off = C.raw_bytes(b.column("text"))
            n, s1, s2 = (np.zeros(b.num_rows, t) for t in (np.int64, np.uint64, np.uint64))
            groups: list = [None] * b.num_rows
            for lo, hi, counts, words in W.word_groups(data, off, W.SPACED):
                edges = np.concatenate([[0], np.cumsum(counts)])
                sets = [W.distinct_shingles(words[edges[i] : edges[i + 1]], k) for i in range(hi - lo)]
                sizes = np.array([len(x) for x in sets])
                n[lo:hi] = sizes
                full = np.flatnonzero(sizes)
                if len(full):
                    flat = np.concatenate([sets[i] for i in full])
                    starts = np.cumsum(sizes[full]) - sizes[full]
                    s1[lo + full] = W.mix(np.add.reduceat(W.mix(flat), starts))
                    s2[lo + full] = W.mix(np.bitwise_xor.reduceat(W.mix(flat ^ U(0x5555)), starts) + sizes[full].astype(np.uint64))
                    for i, g in zip(full, min_hashes(flat, starts).view(np.int64), strict=True):
                        groups[lo + i] = g
            flat = [g for g in groups if g is not None]
            values = pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int64))
            ends = np.concatenate([[0], np.cumsum([0 if g is None else 2 * PARTS for g in groups])]).astype(np.int32)
            sig = pa.ListArray.from_arrays(pa.array(ends), values).cast(long)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("_key"), pa.array(n), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), sig], names=["doc_id", "_key", "n", "s1", "s2", "sig"])

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small(batches):
            data, off = C.raw_bytes(b.column("text"))
            out = []
            for lo, hi, counts, words in W.word_groups(data, off, W.SPACED):
                edges = np.concatenate([[0], np.cumsum(counts)])
                out += [W.distinct_shingles(words[edges[i] : edges[i + 1]], k).tobytes() for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(out, pa.binary())], names=["node", "set"])

    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small(batches):
            ok = []
            for x, y in zip(b.column("set_a"), b.column("set_b"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                at = np.searchsorted(q, p)
                both = int((q[np.minimum(at, len(q) - 1)] == p).sum())
                ok.append(100 * both >= percent * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(ok, pa.bool_())], names=["a", "b", "linked"])

    return run


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) for pairs (a, b) of classes, by their full sets (node, set)."""
    left = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    with C.batches_of(pairs.sparkSession, SET_ROWS):
        return C.cut(pairs.join(right, "b").join(left, "a").select("a", "b", "set_a", "set_b").mapInArrow(_linked(percent), "a long, b long, linked boolean"))


def overlaps(sets: list[np.ndarray], p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Intersection sizes of the pairs (p, q) of sets: one by one, or where there are
    many pairs from products of membership matrices, some columns at a time."""
    m = len(sets)
    if len(p) <= 4 * m:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(p, q, strict=True)], np.int64)
    row = np.repeat(np.arange(m), [len(x) for x in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = count > 1
    number = np.cumsum(common) - 1
    keep = common[column]
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((m, m), np.float32)
    for lo in range(0, int(common.sum()), 1024):
        s, e = np.searchsorted(column, [lo, lo + 1024])
        x = np.zeros((m, 1024), np.float32)
        x[row[s:e], column[s:e] - lo] = 1
        both += x @ x.T
    return both[p, q].astype(np.int64)


def _across(percent: int):
    """Links between classes of two blocks of a bucket of the first collection. A pair
    counts in the first such bucket it shares, if it shares one of the second too."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        i, x, y = (t.column(c)[0].as_py() for c in ("i", "x", "y"))
        node, root, n, block = (t.column(c).to_numpy() for c in ("node", "root", "n", "block"))
        sig = np.array(t.column("sig").to_pylist(), np.int64).reshape(len(node), -1)
        sets = [np.frombuffer(v, np.uint64) for v in t.column("set").to_pylist()]
        left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
        if not len(left) or not len(right):  # few long sets don't fill all their blocks
            return out.empty_table()
        ends = []
        for s in range(0, len(left), 256):
            rows = left[s : s + 256]
            small = np.minimum(n[rows][:, None], n[right])
            ok = (root[rows][:, None] != root[right]) & (100 * small >= percent * np.maximum(n[rows][:, None], n[right]))
            if x == y:
                ok &= rows[:, None] < right
            for k in range(i):
                ok &= sig[rows, k][:, None] != sig[right, k]
            second = np.zeros_like(ok)
            for k in range(PARTS, 2 * PARTS):
                second |= sig[rows, k][:, None] == sig[right, k]
            p, q = np.nonzero(ok & second)
            ends.append((rows[p], right[q]))
        p, q = (np.concatenate(v) for v in zip(*ends, strict=True))
        if not len(p):
            return out.empty_table()
        both = overlaps(sets, p, q)
        linked = 100 * both >= percent * (n[p] + n[q] - both)
        p, q = node[p[linked]], node[q[linked]]
        if len(p) > len(node):  # a spanning forest says as much
            names, at = np.unique(np.concatenate([p, q]), return_inverse=True)
            tree = forest(at[: len(p)], at[len(p) :], len(names))
            p, q = names, names[tree]
        return pa.table([pa.array(p), pa.array(q)], schema=out)

    return run


def across(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between nodes (node, root, n, sig) of different roots that share a
    key, whatever the sizes of the buckets: large ones are compared block by block."""
    halves = nodes.select("node", "n", F.posexplode(F.slice("sig", 1, PARTS)).alias("i", "half"))
    sizes = C.cut(halves.groupBy("i", "half").agg(F.count("*").alias("m"), F.sum("n").alias("words")).where("m > 1"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK_SETS), F.ceil(F.col("words") / BLOCK_SHINGLES)).cast("int")
    placed = halves.drop("n").join(sizes.select("i", "half", blocks.alias("blocks")), ["i", "half"])
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node", "i"), F.col("blocks").cast("long")).cast("int"))
    groups = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other"))
    full = groups.select("i", "half", "x", "y", "block", "node").join(nodes.join(sets, "node"), "node")
    return full.select("i", "half", "x", "y", "block", "node", "root", "n", "sig", "set").groupBy("i", "half", "x", "y").applyInArrow(_across(percent), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, _key, n_shingles, component_id, group) of every row; group: null for empty sets."""
    C.prepare(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), C.text_key().alias("_key"), "text")
    rows = C.cut(base.mapInArrow(_sketch(shingle), "doc_id long, _key long, n long, s1 long, s2 long, sig array<long>"))
    full = rows.where("n > 0")
    classes = full.groupBy("s1", "s2", "n").agg(F.min(F.struct("doc_id", "_key")).alias("rep"), F.min("doc_id").alias("least"), F.any_value("sig").alias("sig"))
    classes = C.cut(classes.withColumn("node", F.monotonically_increasing_id()))
    # Keys whose first half is alone cannot be shared: leave those out before pairing halves.
    halves = classes.select("node", F.posexplode(F.slice("sig", 1, PARTS)).alias("i", "half"))
    # What is joined to a table by its own keys is written first: a join of two plain shuffles can
    # split a key that holds much of the data, one right behind an aggregation cannot.
    shared = C.cut(halves.groupBy("i", "half").agg(F.count("*").alias("m")).where("m > 1").drop("m"))
    alive = halves.join(shared, ["i", "half"]).join(classes.select("node", "n", F.slice("sig", PARTS + 1, PARTS).alias("other")), "node")
    keyed = alive.select("node", "n", "i", "half", F.posexplode("other").alias("j", "second")).select(F.xxhash64("i", "j", "half", "second").alias("key"), "node", "n")
    keyed = C.cut(keyed)
    hubs = C.cut(keyed.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("m")).where("m > 1").drop("m"))
    members = C.cut(keyed.join(hubs, "key"))
    close = lambda x, y: (100 * F.least(x, y) >= percent * F.greatest(x, y))  # noqa: E731  sizes that allow a link
    size = classes.select(F.col("node").alias("a"), F.col("n").alias("n_a"))
    star = members.where("a <> node").select("a", F.col("node").alias("b"), "n").distinct().join(size, "a").where(close(F.col("n"), F.col("n_a"))).select("a", "b")
    star = C.cut(star)
    # Full sets of the classes that share a bucket, made from the texts of their first rows.
    wanted = members.select("node").distinct().join(classes.select("node", "rep"), "node").select("node", F.col("rep.doc_id").alias("doc_id"), F.col("rep._key").alias("_key"))
    wanted = wanted.hint("shuffle_hash")
    texts = base.join(wanted, base["doc_id"].eqNullSafe(wanted["doc_id"]) & (base["_key"] == wanted["_key"]))
    with C.batches_of(docs.sparkSession, SET_ROWS):
        sets = C.cut(texts.select("node", "text").mapInArrow(_sets(shingle), "node long, set binary").dropDuplicates(["node"]))
    tested = verify(star, sets, percent)
    links = tested.where("linked").select("a", "b")
    roots = components(links)
    # Classes of buckets that still hold several components: compare across them in blocks.
    placed = members.select("key", "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = C.cut(placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key"))
    open_ = C.cut(placed.join(mixed, "key").select("node", "root").distinct())
    more = C.cut(across(open_.join(classes.select("node", "n", "sig"), "node"), sets, percent))
    if not more.isEmpty():
        roots = components(links.unionByName(more))
    owner = classes.select("node", "s1", "s2", "n", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    owner = C.cut(owner)
    least = owner.groupBy("root").agg(F.min("least").alias("component_id"))
    named = owner.join(least, "root").select("s1", "s2", "n", "component_id", F.col("root").alias("group"))
    every = rows.select("doc_id", "_key", "n", "s1", "s2").join(named, ["s1", "s2", "n"], "left")
    return every.select("doc_id", "_key", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "group")


def keep_first(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """The rows of docs, all columns, that are the first of their group, one row each;
    rows with empty sets stay."""
    found = near_duplicates(docs, percent, shingle)
    first = found.where(F.col("group").isNotNull()).groupBy("group").agg(F.min(F.struct("doc_id", "_key")).alias("x")).select("x.doc_id", "x._key", F.lit(True).alias("once"))
    alone = found.where(F.col("group").isNull()).select("doc_id", "_key", F.lit(False).alias("once")).distinct()
    keep = first.unionByName(alone).hint("shuffle_hash")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), C.text_key().alias("_key"))
    both = rows.join(keep, C.same_doc(rows, keep)).select("row", rows["doc_id"].alias("_id"), rows["_key"], "once")
    # Copies of one row, id and all, meet here; a number keeps rows with empty sets apart.
    mark = F.when(F.col("once"), F.lit(0).cast("long")).otherwise(F.monotonically_increasing_id())
    return both.withColumn("_mark", mark).dropDuplicates(["_id", "_key", "_mark"]).select("row.*")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of every text."""
    out = near_duplicates(C.load(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + least(5, len(w)) - 1) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)
), h AS (SELECT doc_id, md5(array_to_string(g, ' ')) AS g FROM s),
n AS (SELECT doc_id, count(*) AS n FROM h GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM h a JOIN h b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))
), reach AS (
  SELECT doc_id AS v, doc_id AS r FROM documents
  UNION SELECT links.b, reach.r FROM reach JOIN links ON links.a = reach.v
), c AS (SELECT v AS doc_id, min(r) AS component_id FROM reach GROUP BY v)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""
