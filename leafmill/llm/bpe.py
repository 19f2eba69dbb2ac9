"""Operator 4: byte-level BPE by overlapping chunks.

Pre-tokenisation is a left-to-right scan whose state is its position alone, so
two scans of one text that share a boundary agree from there on. Every text is cut
into chunks of CHUNK_CHARS which reach OVERLAP_CHARS into the next and are scanned
each from its own start; the first boundary that two neighbours share (after a token
that is not white space, so that no look-ahead reaches over it) is the stitch, and
what lies between two stitches is encoded. Neighbours that share none (a pre-token
longer than the overlap) become one chunk, which is scanned anew, until all meet.

A text of up to SPREAD_CHARS is cut, stitched and encoded inside its batch. A longer
one is first cut the same way into chunks of SPREAD_CHARS, which travel and are
scanned apart, so that a very long text is the work of many tasks.

Null text counts as empty; an empty text has no tokens; an empty table gives no rows.
Rows that repeat, or share an id, are encoded each. Nothing is compared between texts,
so there are no ties. Extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.llm import _common as C

RANKS = "byte_bpe_multi_50k.tiktoken"
CHUNK_CHARS, OVERLAP_CHARS = 1 << 12, 1 << 8
SPREAD_CHARS, SPREAD_OVERLAP = 1 << 18, 1 << 11


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANKS)


@cache
def encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("leafmill", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@cache
def _splitter():
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN)


def boundaries(text: str, start: int, stop: int, lo: int) -> list[int]:
    """Safe token boundaries from lo on of the scan of text from start to stop. Unless that
    is the text's end, the last two tokens don't count: more text might change them."""
    ends = [m.end() for m in _splitter().finditer(text, start, stop)]
    if stop < len(text):
        ends = ends[:-2]
    return [e for e in ends if e >= lo and not text[e - 1].isspace()]


def pieces(text: str, size: int, overlap: int) -> Iterator[str]:
    """The text between its stitches."""
    at, near, step = 0, 1, 1
    n = -(-len(text) // size)
    if n > 1:
        ends = boundaries(text, 0, min(size + overlap, len(text)), size)
    while near < n:
        start = near * size
        own = boundaries(text, start, min(start + size + overlap, len(text)), start)
        meet = set(ends).intersection(own)
        if meet:
            stitch = min(meet)
            yield text[at:stitch]
            at, ends, near, step = stitch, own, near + 1, 1
        else:  # join it with the next ones, twice as many each time
            near, step = near + step, 2 * step
            ends = boundaries(text, at, min(near * size + overlap, len(text)), near * size)
    yield text[at:]


def encode(text: str, path: str, size: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> bytes:
    """Token ids as little-endian unsigned 32-bit integers."""
    plain = encoder(path).encode_ordinary
    return b"".join(np.asarray(plain(x), "<u4").tobytes() for x in pieces(text, size, overlap))


def decode(ids: bytes, path: str) -> bytes:
    return encoder(path).decode_bytes(np.frombuffer(ids, "<u4").tolist())


_CHUNK = "doc_id long, _key long, n long, chars long, start long, stop long, body string"
_CHUNK_COLUMNS = [c.split()[0] for c in _CHUNK.split(", ")]


def _chunks(size: int, overlap: int):
    """Texts to rows of overlapping chunks; chars: the whole text's length."""
    kinds = [*([pa.int64()] * 6), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small(batches):
            for i in range(b.num_rows):
                doc, key, n, text = (b.column(c)[i].as_py() for c in ("doc_id", "_key", "_copy", "text"))
                starts = range(0, len(text), size)
                for at in range(0, len(starts), 16):
                    rows = [(doc, key, n, len(text), s, min(s + size, len(text)), text[s : s + size + overlap]) for s in starts[at : at + 16]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=_CHUNK_COLUMNS)

    return run


def _scan(overlap: int):
    """Adds the boundaries that a chunk offers to the chunk before and to the one after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small(batches):
            head, tail = [], []
            for start, stop, chars, body in zip(*(b.column(c).to_pylist() for c in ("start", "stop", "chars", "body")), strict=True):
                more = "" if start + len(body) == chars else "x"  # stands for what follows: the body's end is not the text's
                marks = [start + p for p in boundaries(body + more, 0, len(body), 0)]
                head.append([p for p in marks if p < start + overlap])
                tail.append([p for p in marks if p >= stop])
            marks = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(head, marks), pa.array(tail, marks)], names=[*b.schema.names, "head", "tail"])

    return run


def _encode_chunks(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small(batches):
            ids = [encode(body[a - start : z - start], path) for start, body, a, z in zip(*(b.column(c).to_pylist() for c in ("start", "body", "from_at", "to_at")), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "_key", "n", "start")), pa.array(ids, pa.binary())], names=["doc_id", "_key", "n", "start", "ids"])

    return run


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in C.small(batches):
        out = [b"".join(p["ids"] for p in sorted(parts, key=lambda p: p["start"])) for parts in b.column("parts").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("_key"), pa.array(out, pa.binary())], names=["doc_id", "_key", "ids"])


def _encode_texts(path: str, size: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small(batches):
            for s in range(0, b.num_rows, 200):
                part = b.slice(s, 200)
                ids = [encode(t or "", path, size, overlap) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("_key"), pa.array(ids, pa.binary())], names=["doc_id", "_key", "ids"])

    return run


def stitched(chunks: DataFrame, overlap: int) -> DataFrame:
    """Chunks with the part of each that it encodes (from_at, to_at); neighbours that share no
    boundary are joined. Every round has fewer chunks than the one before."""
    of_text = Window.partitionBy("doc_id", "_key", "n").orderBy("start")
    while True:
        scanned = chunks.repartition("doc_id", "_key", "n", "start").mapInArrow(_scan(overlap), f"{_CHUNK}, head array<long>, tail array<long>")
        meet = F.array_min(F.array_intersect(F.lag("tail").over(of_text), "head"))
        met = C.cut(scanned.withColumn("from_at", F.when(F.col("start") == 0, F.lit(0).cast("long")).otherwise(meet)).drop("head", "tail"))
        if met.where("from_at IS NULL").isEmpty():
            return met.withColumn("to_at", F.coalesce(F.lead("from_at").over(of_text), "chars"))
        run = met.withColumn("run", F.sum(F.col("from_at").isNotNull().cast("int")).over(of_text))
        own = F.substring("body", F.lit(1), (F.col("stop") - F.col("start")).cast("int"))
        parts = run.groupBy("doc_id", "_key", "n", "chars", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.array_sort(F.collect_list(F.struct("start", own.alias("own")))).alias("parts"), F.max(F.struct("start", "body"))["body"].alias("last"))
        chunks = parts.withColumn("body", F.concat(F.array_join(F.transform(F.slice("parts", 1, F.size("parts") - 1), lambda x: x["own"]), ""), "last")).select(*_CHUNK_COLUMNS)


def encode_documents(docs: DataFrame, ranks: str | None = None, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, spread: int = SPREAD_CHARS, spread_overlap: int = SPREAD_OVERLAP) -> DataFrame:
    """(doc_id, _key, ids): the token ids of every text, little-endian unsigned 32-bit."""
    path = ranks or default_ranks()
    C.prepare(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), C.text_key().alias("_key"), F.coalesce("text", F.lit("")).alias("text"))
    out = "doc_id long, _key long, ids binary"
    inside = base.where(F.length("text") <= spread).mapInArrow(_encode_texts(path, chunk, overlap), out)
    # A copy number keeps repeated rows apart while their chunks travel.
    long = C.cut(base.where(F.length("text") > spread).withColumn("_copy", F.monotonically_increasing_id()).mapInArrow(_chunks(spread, spread_overlap), _CHUNK))
    apart = stitched(long, spread_overlap).repartition("doc_id", "_key", "n", "start").mapInArrow(_encode_chunks(path), "doc_id long, _key long, n long, start long, ids binary")
    joined = apart.groupBy("doc_id", "_key", "n").agg(F.collect_list(F.struct("start", "ids")).alias("parts")).mapInArrow(_join_ids, out)
    return inside.unionByName(joined)


def decode_documents(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """Adds decoded: the raw bytes of every id, concatenated."""
    path = ranks or default_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small(batches):
            for s in range(0, b.num_rows, 200):
                part = b.slice(s, 200)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([decode(x, path) for x in part.column("ids").to_pylist()], pa.binary())], names=[*part.schema.names, "decoded"])

    return encoded.select("doc_id", "_key", "ids").mapInArrow(run, "doc_id long, _key long, ids binary, decoded binary")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes every text; counts and digests."""
    both = decode_documents(encode_documents(C.load(spark, sf_dir, "documents")))
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
