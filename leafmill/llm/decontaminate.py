"""Operator 3: benchmark decontamination by winnowing.

Of every 7 consecutive 7-word grams of a text the one of least hash is kept, so
any shared run of 13 words leaves the same fingerprint on both sides. Documents'
fingerprints pass a Bloom filter of fixed size made of the benchmark's; those left
are extended to each of the (at most 7) runs of 13 words around them, known by a
second hash, and join the benchmark's so extended. A common gram alone joins
nothing, so a row that comes out of the join is an occurrence of a window. Items of
fewer than 13 words are one gram of their own length, which every document position
is compared with. Documents with equal sets of hit windows form one class, and the
items of a set are looked up once for the class: a passage that M documents and K
items hold makes M + K rows, not M times K.

Null or wordless texts have no words and are clean; null item ids count as the
empty text; items without words have no window. An empty benchmark hits nothing, an
empty table of documents gives no rows. Very long texts are hashed piece by piece and
judged whole. Repeated rows get the same result each, and so do equal texts (there
are no ties to break: every fingerprint that equals a minimum is kept). Extra columns
pass through `keep_clean`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import _common as C
from leafmill.llm import _words as W

WINDOW, GRAM = 13, 7
#: Grams of a winnowing window: its words are GRAM + SLIDE - 1 = WINDOW.
SLIDE = WINDOW - GRAM + 1
#: Bits of the Bloom filter, whatever the benchmark's size (1 MB).
BITS = 1 << 23
#: An item leaks through a document that holds so much of its windows, however long the
#: document is; shorter items, which may occur by chance, only count by the document's share.
LEAK_SHARE, LEAK_WORDS = 0.5, 8
_PRINTS = "array<struct<h:bigint,span:int,start:int,w:bigint>>"
_PRINT = pa.list_(pa.struct([("h", pa.int64()), ("span", pa.int32()), ("start", pa.int32()), ("w", pa.int64())]))


def winnow(grams: np.ndarray) -> np.ndarray:
    """Positions that are the least of some SLIDE consecutive grams (all equal ones)."""
    n = len(grams) - SLIDE + 1
    if n <= 0:
        return np.arange(len(grams))
    least = grams[:n].copy()
    for j in range(1, SLIDE):
        np.minimum(least, grams[j : j + n], out=least)
    best = np.zeros(len(grams), np.uint64)  # largest of the minima of the windows that hold a position
    for j in range(SLIDE):
        np.maximum(best[j : j + n], least, out=best[j : j + n])
    return np.flatnonzero(best == grams)


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return h & np.uint64(BITS - 1), (h >> np.uint64(32)) & np.uint64(BITS - 1)


def prints(words: np.ndarray, edges: np.ndarray, lengths: list[int], bloom: np.ndarray | None, whole: bool):
    """Fingerprints of the texts that lie one after another in words, with the windows
    around them; edges: where each text begins, and the end. whole: only grams as long as
    their text count as short ones. Yields span (0, or a short gram's length), hashes,
    first words of the windows in their texts, text numbers, hashes of the windows."""
    for span in [0, *lengths]:
        k, size = span or GRAM, span or WINDOW
        g = W.gram_hashes(words, k)
        at = np.arange(len(g)) if span else winnow(g)
        if bloom is not None and len(at):
            a, b = _bits(g[at])
            at = at[bloom[a >> np.uint64(3)] >> (a & np.uint64(7)).astype(np.uint8) & 1 & (bloom[b >> np.uint64(3)] >> (b & np.uint64(7)).astype(np.uint8)) == 1]
        text = np.searchsorted(edges, at, side="right") - 1
        ok = at + k <= edges[text + 1]
        at, text = at[ok], text[ok]
        start = (at[:, None] - np.arange(size - k + 1)).ravel()
        at, text = np.repeat(at, size - k + 1), np.repeat(text, size - k + 1)
        lo, hi = edges[text], edges[text + 1]
        ok = (start >= lo) & (start + size <= hi)
        if whole and span:
            ok &= hi - lo == span
        start, at, text = start[ok], at[ok], text[ok]
        yield span, g[at], start - edges[text], text, W.gram_hashes(words, size, 1)[start] if len(start) else g[at]


def _doc_prints(lengths: list[int], bloom: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small(batches):
            data, off = C.raw_bytes(b.column("text"))
            n_words, found = np.zeros(b.num_rows, np.int64), [[] for _ in range(b.num_rows)]
            for lo, hi, counts, words in W.word_groups(data, off, W.ALNUM):
                n_words[lo:hi] = counts
                edges = np.concatenate([[0], np.cumsum(counts)])
                for span, h, start, text, w in prints(words, edges, lengths, bloom, False):
                    for hh, s, t, ww in zip(h.view(np.int64).tolist(), start.tolist(), text.tolist(), w.view(np.int64).tolist(), strict=True):
                        found[lo + t].append({"h": hh, "span": span, "start": s, "w": ww})
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("_key"), pa.array(n_words), pa.array(found, _PRINT)], names=["doc_id", "_key", "n_words", "prints"])

    return run


def _item_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in C.small(batches):
        data, off = C.raw_bytes(b.column("text"))
        out = [[], [], [], [], []]
        ids = b.column("item").to_pylist()
        for lo, _, counts, words in W.word_groups(data, off, W.ALNUM):
            edges = np.concatenate([[0], np.cumsum(counts)])
            for i in range(len(counts)):  # each item by itself
                own = words[edges[i] : edges[i + 1]]
                short = [len(own)] if 0 < len(own) < WINDOW else []
                for span, h, _, _, w in prints(own, np.array([0, len(own)]), short, None, True):
                    for hh, ww in zip(h.view(np.int64).tolist(), w.view(np.int64).tolist(), strict=True):
                        for col, x in zip(out, (ids[lo + i], len(own), hh, span, ww), strict=True):
                            col.append(x)
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=["item", "size", "h", "span", "w"])


def find(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """(doc_id, _key, n_words, n_hit, items, leak) of every document; items: sorted ids as
    strings; leak: the greatest share of its windows that an item of LEAK_WORDS words or
    more has in the document."""
    spark = docs.sparkSession
    items = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").distinct()
    marks = C.cut(items.mapInArrow(_item_prints, "item string, size long, h long, span int, w long"))
    lengths = sorted(r["span"] for r in marks.where(F.col("span") > 0).select("span").distinct().collect())  # below WINDOW
    places = marks.selectExpr(f"explode(array(h & {BITS - 1}L, shiftrightunsigned(h, 32) & {BITS - 1}L)) AS p")
    bytes_ = places.groupBy(F.expr("p >> 3").alias("at")).agg(F.expr("bit_or(shiftleft(1, cast(p & 7 AS int)))").alias("v"))
    bloom = np.zeros(BITS // 8, np.uint8)
    for r in bytes_.toLocalIterator():  # at most BITS / 8 rows
        bloom[r["at"]] = r["v"]
    sent = spark.sparkContext.broadcast(bloom)

    def doc_prints(batches):
        yield from _doc_prints(lengths, sent.value)(batches)

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), C.text_key().alias("_key"), "text")
    read = C.cut(base.mapInArrow(doc_prints, f"doc_id long, _key long, n_words long, prints {_PRINTS}"))
    found = read.where(F.size("prints") > 0).select("doc_id", "_key", F.inline("prints"))
    hits = found.join(marks.select("h", "span", "w").distinct(), ["h", "span", "w"]).select("doc_id", "_key", "start", "span", "w").distinct()
    size = lambda s: F.when(s["span"] > 0, s["span"]).otherwise(WINDOW)
    covered = F.aggregate(
        F.array_sort("spots"),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("e")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["start"] + size(s) - F.greatest(a["e"], s["start"]))).alias("n"), F.greatest(a["e"], s["start"] + size(s)).alias("e")),
        lambda a: a["n"].cast("long"),
    )
    windows = F.array_sort(F.array_distinct(F.transform("spots", lambda s: F.struct(s["span"].alias("span"), s["w"].alias("w")))))
    spans = hits.groupBy("doc_id", "_key").agg(F.collect_list(F.struct("start", "span", "w")).alias("spots")).select("doc_id", "_key", covered.alias("n_hit"), windows.alias("windows"))
    spans = C.cut(spans.withColumns({"s1": F.xxhash64("windows"), "s2": F.xxhash64(F.lit("second"), "windows")}))
    sets = spans.groupBy("s1", "s2").agg(F.any_value("windows").alias("windows")).select("s1", "s2", F.inline("windows"))
    of_items = marks.groupBy("item").agg(F.max("size").alias("size"), F.count_distinct("span", "w").alias("total"))
    held = sets.join(marks.select("span", "w", "item").distinct(), ["span", "w"]).groupBy("s1", "s2", "item").agg(F.count("*").alias("held")).join(of_items, "item")
    leak = F.max(F.when(F.col("size") >= LEAK_WORDS, F.col("held") / F.col("total")).otherwise(0.0))
    named = held.groupBy("s1", "s2").agg(F.array_sort(F.collect_list("item")).alias("items"), leak.alias("leak"))
    result = spans.select("doc_id", "_key", "n_hit", "s1", "s2").join(named, ["s1", "s2"])
    own = read.select("doc_id", "_key", "n_words")
    return own.join(result, C.same_doc(own, result), "left").select(
        own["doc_id"], own["_key"], "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("leak", F.lit(0.0)).alias("leak"),
    )


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def leaked() -> Column:
    """Contaminated, or LEAK_SHARE of an item's windows stand in the document."""
    return contaminated() | (F.col("leak") >= LEAK_SHARE)


def keep_clean(docs: DataFrame, bench: DataFrame, drop: Column | None = None) -> DataFrame:
    """The rows of docs, all columns, that are not contaminated, or that don't meet `drop`,
    a condition on the columns of `find`."""
    bad = find(docs, bench).where(contaminated() if drop is None else drop).select("doc_id", "_key").distinct().hint("shuffle_hash")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), C.text_key().alias("_key"))
    return rows.join(bad, C.same_doc(rows, bad), "left_anti").select("row.*")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of every document against the whole benchmark."""
    out = find(C.load(spark, sf_dir, "documents"), C.load(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, n, list_slice(w, s, s + n - 1) AS g
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM b WHERE len(w) > 0)
), lens AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, s, list_slice(w, s, s + n - 1) AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens)
), hits AS (
  SELECT doc_id, item_id, dw.n, s FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
