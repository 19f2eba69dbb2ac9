"""Operator 2: line deduplication with keep bitmaps.

Every line's 128-bit key hash is range-partitioned by (hash, document) and
sorted by hash, document (largest first) and position, so each hash is one run
whose first document keeps it. One pass streams the runs: a run inside one
partition is settled there; runs at a partition's edge, where a common line that
spans many partitions shows up, are settled through a table of two summaries a
partition at most. What comes back to the documents is a compressed bitmap of
the lines each keeps, never text.

A null text is one empty line, as an empty text is. Long texts have as many lines as
others have, each by itself. Of documents that hold a line the one of largest id keeps all
its occurrences, so ids that tie keep it together. An empty table gives no rows. Rows that share a doc_id
count as one document; a null doc_id counts as one document smaller than all
others. Extra columns pass through `dedup_lines` untouched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import _common as C

MIN_CHARS, MIN_DOCS = 20, 3
SPACE = b" \t\n\x0b\x0c\r"
BLOCK = 50_000
DROP, PENDING, SUMMARY = 0, 1, 2
_RUN = "kind int, h1 long, h2 long, d long, k long, pos int, n long"


def line_key(line: bytes, least: int) -> bytes | None:
    """The stripped line with A-Z lower-cased, if it has enough code points."""
    line = line.strip(SPACE)
    if len(line) < least or (len(line) < 4 * least and len(line.decode("utf-8", "replace")) < least):
        return None
    return line.lower()  # bytes.lower touches A-Z only


def _occurrences(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small(batches):
            digests, counts, pos = [], [], []
            for text in b.column("text").to_pylist():
                before = len(pos)
                for i, line in enumerate((text or b"").split(b"\n")):
                    key = line_key(line, least)
                    if key is not None:
                        digests.append(xxhash.xxh3_128_digest(key))
                        pos.append(i)
                counts.append(len(pos) - before)
            h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            d, k = (np.repeat(b.column(c).to_numpy(), counts) for c in ("d", "k"))
            yield pa.RecordBatch.from_arrays([pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array(d), pa.array(k), pa.array(pos, pa.int32())], names=["h1", "h2", "d", "k", "pos"])

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """int64 columns h1, h2, d, k, pos, many rows at a time."""
    held, n = [], 0
    for b in C.small(batches):
        held.append(np.stack([b.column(i).to_numpy().astype(np.int64) for i in range(5)]))
        n += b.num_rows
        if n >= BLOCK:
            yield np.concatenate(held, axis=1)
            held, n = [], 0
    if n:
        yield np.concatenate(held, axis=1)


def _stream(least_docs: int):
    """Sorted occurrences to lines to drop, lines that wait for a summary, and summaries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((5, 0), np.int64)  # the open run, while it has too few documents
        state = None  # the open run, once its rows are out: [h1, h2, documents, keeper, last document, first of the partition]
        leading = True  # the partition's first run has not ended yet

        def out(rows: np.ndarray, kind: int) -> pa.RecordBatch:
            m = rows.shape[1]
            return pa.RecordBatch.from_arrays([pa.array(np.full(m, kind, np.int32)), *(pa.array(rows[i]) for i in range(4)), pa.array(rows[4].astype(np.int32)), pa.nulls(m, pa.int64())], names=["kind", "h1", "h2", "d", "k", "pos", "n"])

        def summary(h1, h2, n, keeper) -> pa.RecordBatch:
            a = lambda x, t=None: pa.array([x], t or pa.int64())
            return pa.RecordBatch.from_arrays([a(SUMMARY, pa.int32()), a(int(h1)), a(int(h2)), a(int(keeper)), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), a(int(n))], names=["kind", "h1", "h2", "d", "k", "pos", "n"])

        for block in _blocks(batches):
            rows = np.concatenate([held, block], axis=1)
            h1, h2, d = rows[0], rows[1], rows[2]
            new_run = np.ones(len(d), bool)
            new_run[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            new_doc = new_run.copy()
            new_doc[1:] |= d[1:] != d[:-1]
            joined = state is not None and (h1[0], h2[0]) == (state[0], state[1])
            if joined and d[0] == state[4]:
                new_doc[0] = False
            starts = np.flatnonzero(new_run)
            docs = np.add.reduceat(new_doc.astype(np.int64), starts)
            keeper = d[starts].copy()
            first = np.zeros(len(starts), bool)
            if joined:
                docs[0] += state[2]
                keeper[0], first[0] = state[3], state[5]
            else:
                if state is not None and state[5]:
                    yield summary(state[0], state[1], state[2], state[3])
                first[0] = leading
            leading = False
            state = None
            if first[0] and len(starts) > 1:
                yield summary(h1[0], h2[0], docs[0], keeper[0])
            open_at = starts[-1]
            ready = docs[-1] >= least_docs or first[-1]
            end = len(d) if ready else open_at
            run_no = np.cumsum(new_run)[:end] - 1
            body = rows[:, :end]
            waits = first[run_no]
            if waits.any():
                yield out(body[:, waits], PENDING)
            gone = ~waits & (docs[run_no] >= least_docs) & (body[2] != keeper[run_no])
            if gone.any():
                yield out(body[:, gone], DROP)
            if ready:
                state = [h1[-1], h2[-1], docs[-1], keeper[-1], d[-1], bool(first[-1])]
                held = rows[:, :0]
            else:
                held = rows[:, open_at:]
        if held.shape[1]:
            yield out(held, PENDING)
            yield summary(held[0, 0], held[1, 0], len(np.unique(held[2])), held[2, 0])
        if state is not None:
            yield summary(*state[:4])

    return run


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in C.small(batches):
        maps = []
        for pos in b.column("pos").to_pylist():
            keep = np.ones((max(pos) // 8 + 1) * 8, bool)
            keep[pos] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays([b.column("d"), b.column("k"), pa.array([len(p) for p in b.column("pos").to_pylist()], pa.int64()), pa.array(maps, pa.binary())], names=["d", "k", "n_dropped", "keep_bitmap"])


def _ids():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"), C.text_key().alias("k")


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(d, k, n_dropped, keep_bitmap) of the documents that lose lines: zlib over packed
    bits, 1 for a kept line; lines past its end are kept."""
    C.prepare(docs.sparkSession)
    lines = docs.select(*_ids(), F.col("text").cast("binary").alias("text")).mapInArrow(_occurrences(min_chars), "h1 long, h2 long, d long, k long, pos int")
    by_hash = [F.col("h1"), F.col("h2"), F.col("d").desc()]
    runs = C.cut(lines.repartitionByRange(*by_hash).sortWithinPartitions(*by_hash, "pos").mapInArrow(_stream(min_docs), _RUN))
    # Two summaries a partition at most: that bounds what is broadcast.
    edges = runs.where(F.col("kind") == SUMMARY).groupBy("h1", "h2").agg(F.sum("n").alias("docs"), F.max("d").alias("keeper")).where(F.col("docs") >= min_docs)
    waiting = runs.where(F.col("kind") == PENDING).drop("n").join(F.broadcast(edges), ["h1", "h2"]).where(F.col("d") != F.col("keeper"))
    gone = runs.where(F.col("kind") == DROP).select("d", "k", "pos").unionByName(waiting.select("d", "k", "pos"))
    return gone.groupBy("d", "k").agg(F.collect_set("pos").alias("pos")).mapInArrow(_compress, "d long, k long, n_dropped long, keep_bitmap binary")


def kept_lines(text: bytes | None, bitmap: bytes | None) -> tuple[bytes, int, int]:
    """The lines that stay, lines before, lines dropped."""
    text = text or b""
    if bitmap is None:
        return text, text.count(b"\n") + 1, 0
    lines = text.split(b"\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[: len(lines)]
    kept = [x for x, ok in zip(lines, keep.tolist(), strict=False) if ok] + lines[len(keep) :]
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in C.small(batches):
        for s in range(0, batch.num_rows, 250):
            b = batch.slice(s, 250)
            done = [kept_lines(t, m) for t, m in zip(b.column("_text").to_pylist(), b.column("keep_bitmap").to_pylist(), strict=True)]
            others = [c for c in b.schema.names if c not in ("_text", "keep_bitmap")]
            cols = [b.column(c) for c in others] + [pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done], pa.int64()), pa.array([x[2] for x in done], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*others, "_kept", "_n_lines", "_n_dropped"])


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """docs with _kept (the remaining text as bytes), _n_lines and _n_dropped; no text column."""
    maps = keep_bitmaps(docs, min_chars, min_docs).select("d", "k", "keep_bitmap").hint("shuffle_hash")
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("row") if others else F.lit(None).alias("row"), *_ids(), F.col("text").cast("binary").alias("_text")).join(maps, ["d", "k"], "left").select("row", "_text", "keep_bitmap")
    schema = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(_apply, f"row {schema}, _kept binary, _n_lines long, _n_dropped long")


def op2_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and the digest of what each text keeps."""
    docs = C.load(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("row.doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("_kept", 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), repeated AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (keeper IS NOT NULL AND doc_id <> keeper) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (keeper IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM keyed LEFT JOIN repeated USING (k)
GROUP BY doc_id
"""
