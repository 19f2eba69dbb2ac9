"""Operator 7: long repeated substrings by a logarithmic family of suffix indexes.

A full suffix array takes eight bytes a byte of text; this index is sparse. Of the
N - K + 1 grams of K bytes in an N-byte string the leftmost one of least hash is the
string's anchor, so equal strings have anchors at equal places, and consecutive
starts with one anchor make a segment (about 85 starts). A segment stands in the
index as the suffix at its anchor: first the K bytes there (`head`), then a hash of all
bytes that its starts' strings cover, with its bounds (`ctx`).

The family: each batch of documents becomes a run of suffixes in the order of their
bytes, equal ones counted before the shuffle. A new run is merge-scanned (a sort-merge
join) against every level for suffixes that begin with the same K bytes, and levels of
equal rank merge into one of the next (all that merge after a batch in one step), so each
entry is rewritten a logarithmic number of times. What merged is deleted.

Segments whose (head, ctx) repeats are wholly repeated. Segments whose head repeats
but whose bytes differ somewhere (those at the ends of repeats) are settled by two
independent hashes of every N-byte string they cover: one representative of each class,
head by head, and heads with more than GROUP classes in parts whose distinct strings
then meet by their hashes. Heads that many classes share travel in joins of two plain
tables, which can be split.

Null texts are empty. Texts under N bytes lose nothing and match nothing. Long texts are
scanned in pieces that overlap. Rows that repeat are documents of their own, so they
remove each other; there are no ties, as no copy is kept. An empty table gives no rows.
Extra columns pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import _common as C
from leafmill.llm import _words as W

LENGTH, GRAM = 200, 32
#: Texts are scanned in pieces of so many starts; the low bits of a packed minimum hold the place.
PIECE, PLACE = 1 << 18, 20
#: Batches that a table is added in; a caller with batches of its own adds those to the family.
BATCHES = 4
#: Classes of one gram that one task settles together (about 5 MB of text).
GROUP = 16_384
#: Classes whose strings are hashed at once; of each string only its place and hashes are held then.
HASHED = 512
#: Bits of the filter that tells which segments travel on; fixed, 2 MB.
BITS = 1 << 24
U = np.uint64


def rolling_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values."""
    out, have = x, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def byte_sums(data: np.ndarray, other: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums from which every substring's hash follows; other: an independent hash."""
    up, inverse = W.powers(len(data) + 1)
    codes = W.byte_codes(False)
    if other:
        codes = W.mix(codes ^ U(0x9E6C63D0876A9A47))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * up[: len(data)], out=sums[1:])
    return sums, inverse


def binaries(data: np.ndarray, size: int) -> pa.Array:
    """Values of equal size that lie one after another."""
    n = len(data) // size
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * size), pa.py_buffer(np.ascontiguousarray(data))])


def segments(data: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Segments of texts that lie one after another in data, ends[i] being where text i
    ends and ends[-1] == len(data): text, first start, anchor, last start, fp, ctx."""
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    sums, inverse = byte_sums(data)
    m = len(data) - gram + 1
    grams = W.mix((sums[gram:] - sums[:-gram]) * inverse[:m])
    low = U((1 << PLACE) - 1)
    packed = (grams & ~low) | np.arange(m, dtype=np.uint64)
    anchor = (rolling_min(packed, length - gram + 1)[:n] & low).astype(np.int64)
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[:n]
    valid = np.arange(n) + length <= ends[text]
    new = valid.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | ~valid[:-1]
    last = valid.copy()
    last[:-1] &= new[1:] | ~valid[1:]
    lo, hi = np.flatnonzero(new), np.flatnonzero(last)
    a = anchor[lo]
    body = (sums[hi + length] - sums[lo]) * inverse[lo]
    ctx = W.mix(body ^ W.mix(((a - lo).astype(np.uint64) << U(20)) + (hi - lo).astype(np.uint64)))
    return text[lo], lo, a, hi, grams[a], ctx


def pieces(data: np.ndarray, off: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first row, bytes, ends, offset of the bytes in a text that is cut): groups of
    texts, or parts of a long text that overlap by length - 1 bytes."""
    row, n = 0, len(off) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(off, off[row] + PIECE, side="right")) - 1)
        lo, hi = int(off[row]), int(off[end])
        if hi - lo <= PIECE + length:
            yield row, data[lo:hi], off[row + 1 : end + 1] - lo, 0
        else:
            for s in range(lo, hi - length + 1, PIECE):
                part = data[s : min(hi, s + PIECE + length - 1)]
                yield row, part, np.array([len(part)]), s - lo
        row = end


def _keys(length: int, gram: int):
    """Texts to the (head, ctx) of their segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small(batches):
            data, off = C.raw_bytes(b.column("text"))
            for _, part, ends, _ in pieces(data, off, length):
                _, _, a, _, _, ctx = segments(part, ends, length, gram)
                heads = part[a[:, None] + np.arange(gram)].ravel()
                yield pa.RecordBatch.from_arrays([binaries(heads, gram), pa.array(ctx.view(np.int64))], names=["head", "ctx"])

    return run


def _hashed(gram: int):
    """Adds fp: the hash of head by which texts are told if they may hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, _ = C.raw_bytes(b.column("head"))
            sums, inverse = byte_sums(data)
            at = np.arange(b.num_rows) * gram
            fp = W.mix((sums[at + gram] - sums[at]) * inverse[at])
            yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), *(b.column(c) for c in ("ctx", "n", "kinds"))], names=["fp", "ctx", "n", "kinds"])

    return run


class SuffixFamily:
    """Levels of sorted runs (head, ctx, n), and the heads found to repeat so far."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram = length, gram
        self.levels: list[tuple[int, DataFrame]] = []
        self.matches: DataFrame | None = None

    def _run(self, rows: DataFrame) -> DataFrame:
        return C.cut(rows.groupBy("head", "ctx").agg(F.sum("n").alias("n")).sortWithinPartitions("head", "ctx"))

    def add(self, texts: DataFrame) -> None:
        """Index a batch (text), and scan it against itself and every level."""
        keys = texts.mapInArrow(_keys(self.length, self.gram), "head binary, ctx long").withColumn("n", F.lit(1).cast("long"))
        run = self._run(keys)
        found = [run.groupBy("head").agg(F.sum("n").alias("n")).where("n > 1").select("head")]
        found += [run.select("head").join(level.select("head"), "head", "left_semi") for _, level in self.levels]
        if self.matches is not None:
            found.append(self.matches)
        new = found[0]
        for x in found[1:]:
            new = new.unionByName(x)
        before, self.matches = self.matches, C.cut(new.distinct())
        if before is not None:
            C.drop(before)
        # Levels whose merging would make the next one merge too are merged at once.
        rank, runs = 0, [run]
        while self.levels and self.levels[-1][0] == rank:
            runs.append(self.levels.pop()[1])
            rank += 1
        if rank:
            every = runs[0]
            for x in runs[1:]:
                every = every.unionByName(x)
            run = self._run(every)
            for x in runs:
                C.drop(x)
        self.levels.append((rank, run))

    def repeated(self) -> DataFrame:
        """(fp, ctx, n, kinds): entries of repeated heads; kinds: how many ctx the head has. The
        family ends here: its tables are deleted."""
        every = self.levels[0][1]
        for _, level in self.levels[1:]:
            every = every.unionByName(level)
        every = every.groupBy("head", "ctx").agg(F.sum("n").alias("n")) if len(self.levels) > 1 else every
        entries = C.cut(every.join(self.matches, "head", "left_semi"))
        # Written first, so that the join of a head with many classes can be split.
        kinds = C.cut(entries.groupBy("head").agg(F.count("*").alias("kinds")))
        out = C.cut(entries.join(kinds, "head").select("head", "ctx", "n", "kinds").mapInArrow(_hashed(self.gram), "fp long, ctx long, n long, kinds long"))
        for old in (entries, kinds, self.matches, *(level for _, level in self.levels)):
            C.drop(old)
        self.levels, self.matches = [], None
        return out


def gram_filter(repeated: DataFrame) -> np.ndarray:
    """BITS bits, and of those as many for grams of several kinds; built by the executors."""
    spots = repeated.selectExpr(f"fp & {BITS - 1}L AS p", "kinds > 1 AS mixed").selectExpr(f"explode(if(mixed, array(p, p + {BITS}L), array(p))) AS p")
    words = spots.groupBy(F.expr("p >> 6").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 AS int)))").alias("v"))
    got = words.toArrow()  # at most 2 * BITS / 64 rows
    bits = np.zeros(2 * BITS // 64, np.int64)
    bits[got.column("at").to_numpy()] = got.column("v").to_numpy()
    return bits.view(np.uint8)


def _probe(bits: np.ndarray, fp: np.ndarray, shift: int) -> np.ndarray:
    p = (fp & U(BITS - 1)).astype(np.int64) + shift
    return (bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1


def _entries(length: int, gram: int, sent):
    """Texts to segments of grams that may repeat, with their bytes if the gram may have several kinds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for b in C.small(batches):
            data, off = C.raw_bytes(b.column("text"))
            ids = [b.column(c).to_pylist() for c in ("doc_id", "_key")]
            for row, part, ends, shift in pieces(data, off, length):
                text, lo, a, hi, fp, ctx = segments(part, ends, length, gram)
                keep = _probe(bits, fp, 0)
                text, lo, a, hi, fp, ctx = (x[keep] for x in (text, lo, a, hi, fp, ctx))
                mixed = _probe(bits, fp, BITS)
                raw = part.tobytes()
                body = [raw[s : e + length] if m else None for s, e, m in zip(lo.tolist(), hi.tolist(), mixed.tolist(), strict=True)]
                base = np.concatenate([[0], ends[:-1]])[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[row + t] for t in text.tolist()], pa.int64()) for x in ids]
                    + [pa.array(fp.view(np.int64)), pa.array(ctx.view(np.int64)), pa.array((lo - base + shift).astype(np.int64)), pa.array((hi - lo).astype(np.int32)), pa.array(body, pa.binary())],
                    names=["doc_id", "_key", "fp", "ctx", "lo", "more", "body"],
                )

    return run


def _settle(length: int):
    """Sorted classes (fp, part, parts, ctx, n, body) to rows (kind, fp, ctx, at, to, h, g): kind
    0: starts at..to are repeated; kind 1: a string of hashes h, g of a gram in several parts, whose
    class (ctx) waits to hear if it meets an equal one; kind 2: the same, but known to repeat."""

    def hashed(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, start and two hashes of every string of these bodies."""
        data = np.frombuffer(b"".join(bodies), np.uint8)
        ends = np.cumsum([len(x) for x in bodies])
        m = len(data) - length + 1
        row = np.repeat(np.arange(len(bodies), dtype=np.int32), np.diff(ends, prepend=0))[:m]
        at = np.flatnonzero(np.arange(m) + length <= ends[row])
        row = row[at]
        out = []
        for other in (False, True):
            sums, inverse = byte_sums(data, other)
            out.append(W.mix((sums[at + length] - sums[at]) * inverse[at]))
        begins = np.concatenate([[0], ends[:-1]])
        return row, (at - begins[row]).astype(np.int32), out[0], out[1]

    def block(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        fp, part, parts, ctx, n = (np.array([r[i] for r in rows], np.int64) for i in range(5))
        found = [hashed([r[5] for r in rows[i : i + HASHED]]) for i in range(0, len(rows), HASHED)]
        row = np.concatenate([x[0] + np.int32(i * HASHED) for i, x in enumerate(found)])
        start, own, g = (np.concatenate([x[i] for x in found]) for i in (1, 2, 3))
        del found
        own ^= W.mix(fp.view(np.uint64) + U(1))[row]
        meet = own ^ W.mix(part.astype(np.uint64) + U(7))[row]
        order = np.lexsort((g, meet))
        same = np.zeros(len(order) + 1, bool)
        same[1:-1] = meet[order][1:] == meet[order][:-1]
        same[1:-1] &= g[order][1:] == g[order][:-1]
        del meet
        many = n[row] > 1
        many[order] |= same[1:] | same[:-1]
        del order
        new = many.copy()
        new[1:] &= ~many[:-1] | (row[1:] != row[:-1])
        stop = many.copy()
        stop[:-1] &= ~many[1:] | (row[1:] != row[:-1])
        i, j = np.flatnonzero(new), np.flatnonzero(stop)
        wide = parts[row] > 1
        lone = np.flatnonzero(wide & ~many)
        known = np.flatnonzero(wide & many)
        first = np.lexsort((g[known], own[known]))
        known = known[first]
        known = known[np.concatenate([[True], (own[known][1:] != own[known][:-1]) | (g[known][1:] != g[known][:-1])])[: len(known)]]
        kinds = np.concatenate([np.zeros(len(i)), np.ones(len(lone)), np.full(len(known), 2)]).astype(np.int32)
        r = np.concatenate([row[i], row[lone], row[known]])
        a = np.concatenate([start[i], start[lone], start[known]])
        z = np.concatenate([start[j], start[lone], start[known]])
        hs, gs = (np.concatenate([np.zeros(len(i), np.uint64), x[lone], x[known]]).view(np.int64) for x in (own, g))
        yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(fp[r]), pa.array(ctx[r]), pa.array(a.astype(np.int32)), pa.array(z.astype(np.int32)), pa.array(hs), pa.array(gs)], names=["kind", "fp", "ctx", "at", "to", "h", "g"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in C.small(batches):
            for r in zip(*(b.column(c).to_pylist() for c in ("fp", "part", "parts", "ctx", "n", "body")), strict=True):
                if len(held) >= 1000 and r[:2] != held[-1][:2]:
                    yield from block(held)
                    held = []
                held.append(r)
        if held:
            yield from block(held)

    return run


def repeated_starts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES, group: int = GROUP) -> DataFrame:
    """(doc_id, _key, starts): for each text with repeats, [first, last] ranges of the
    starts of strings that occur elsewhere."""
    spark = docs.sparkSession
    C.prepare(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), C.text_key().alias("_key"), F.col("text").cast("binary").alias("text"))
    family = SuffixFamily(length, gram)
    for i in range(batches):
        family.add(base.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == i).select("text"))
    repeated = family.repeated()
    sent = spark.sparkContext.broadcast(gram_filter(repeated))
    entries = base.mapInArrow(_entries(length, gram, sent), "doc_id long, _key long, fp long, ctx long, lo long, more int, body binary")
    entries = C.cut(entries.join(repeated.select("fp", "ctx", "n", "kinds"), ["fp", "ctx"]))
    whole = entries.where("n > 1").select("doc_id", "_key", "lo", (F.col("lo") + F.col("more")).alias("hi"))
    # One representative of each class of a gram that has several.
    classes = entries.where("kinds > 1").groupBy("fp", "ctx").agg(F.min(F.struct("n", "kinds", "body")).alias("x")).select("fp", "ctx", "x.n", "x.body", F.ceil(F.col("x.kinds") / group).cast("long").alias("parts"))
    classes = classes.withColumn("part", F.pmod(F.xxhash64("ctx"), "parts")).repartition("fp", "part").sortWithinPartitions("fp", "part")
    settled = C.cut(classes.select("fp", "part", "parts", "ctx", "n", "body").mapInArrow(_settle(length), "kind int, fp long, ctx long, at int, to int, h long, g long"))
    strings = settled.where("kind > 0")
    met = strings.groupBy("h", "g").agg(F.count("*").alias("m"), F.max("kind").alias("k")).where("m > 1 OR k = 2").select("h", "g")
    late = settled.where("kind = 1").join(met, ["h", "g"]).select("fp", "ctx", "at", "to")
    ranges = settled.where("kind = 0").select("fp", "ctx", "at", "to").unionByName(late)
    edge = entries.where("n = 1 AND kinds > 1").select("fp", "ctx", "doc_id", "_key", "lo").join(ranges, ["fp", "ctx"]).select("doc_id", "_key", (F.col("lo") + F.col("at")).alias("lo"), (F.col("lo") + F.col("to")).alias("hi"))
    return whole.unionByName(edge).groupBy("doc_id", "_key").agg(F.collect_set(F.struct("lo", "hi")).alias("starts"))


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small(batches):
            kept, removed, spans = [], [], []
            for text, starts in zip(b.column("text").to_pylist(), b.column("starts").to_pylist(), strict=True):
                raw = text or b""
                parts, at, gone, runs = [], 0, 0, 0
                for lo, hi in sorted((s["lo"], s["hi"] + length) for s in starts or ()):
                    if lo > at or not runs:
                        parts.append(raw[at:lo])
                        runs += 1
                        gone += hi - lo
                    else:
                        gone += max(0, hi - at)
                    at = max(at, hi)
                parts.append(raw[at:])
                kept.append(b"".join(parts))
                removed.append(gone)
                spans.append(runs)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())], names=["row", "_kept", "_n_removed", "_n_spans"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES, group: int = GROUP) -> DataFrame:
    """(row, _kept, _n_removed, _n_spans): row holds docs' columns but text."""
    starts = repeated_starts(docs, length, gram, batches, group).hint("shuffle_hash")
    base = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), C.text_key().alias("_key"), F.col("text").cast("binary").alias("text"))
    both = base.join(starts, C.same_doc(base, starts), "left").select("row", "text", "starts")
    return both.mapInArrow(_remove(length), f"row {both.schema['row'].dataType.simpleString()}, _kept binary, _n_removed long, _n_spans long")


def op7_suffixdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removes every byte that a repeated 200-byte string covers."""
    out = remove_repeats(C.load(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "row.doc_id",
        (F.octet_length("_kept") + F.col("_n_removed")).cast("long").alias("n_bytes"),
        F.col("_n_removed").alias("n_removed"),
        F.col("_n_spans").alias("n_spans"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


OP7_SQL = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
p AS (
  SELECT doc_id, i, md5(b[i:i + 199]) AS g
  FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 198)) AS i FROM d WHERE octet_length(b) >= 200)
), r AS (SELECT doc_id, i FROM p SEMI JOIN (SELECT g FROM p GROUP BY g HAVING count(*) > 1) USING (g)),
m AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM r),
s AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM m),
spans AS (SELECT doc_id, k, min(i) AS a, max(i) + 200 AS z FROM s GROUP BY doc_id, k),
gaps AS (
  SELECT doc_id, k, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY k), 1) AS prev FROM spans
), kept AS (
  SELECT g.doc_id, string_agg(hex(b[prev:a - 1]), '' ORDER BY k) || hex(any_value(b)[max(z):]) AS h,
         sum(z - a) AS n_removed, count(*) AS n_spans
  FROM gaps g JOIN d USING (doc_id) GROUP BY g.doc_id
)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(coalesce(unhex(h), b)) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
