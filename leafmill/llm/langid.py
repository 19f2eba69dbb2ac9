"""Operator 1: language identification by a byte convolutional network.

Bytes are embedded, convolved with filters of several widths, max-pooled over
fixed windows and put through a softmax; all of it is numpy, trained on the
driver on a bounded sample of labelled windows. Every window of every whole
text is scored, and a text's distribution is the mean over its windows weighted
by their bytes.

Null texts and texts without a letter get `und` and 0. Without labelled rows
every text gets `und`. Repeated rows are predicted each, equal texts alike to the last
bit, whatever batch they stand in; of languages with equal scores the first by name is given. Long texts are scored in
slices of SLICE bytes, so memory does not grow with a text. An empty table gives no
rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import _common as C

WINDOW = 256
WIDTHS = (2, 3, 5)
FILTERS = 12
EMBED = 5
#: The bound of the training sample: texts of each language, windows of each text.
TEXTS_PER_LANG, WINDOWS_PER_TEXT = 2500, 2
EPOCHS, BATCH, RATE = 5, 64, 4e-3
SPAN = max(WIDTHS)
#: Bytes of windows made at once; a whole number of windows.
SLICE = 1 << 18


def _fold_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[:128] = 32
    t[97:123] = np.arange(97, 123)
    t[65:91] = np.arange(97, 123)
    return t


FOLD = _fold_table()


def fold(data: np.ndarray) -> np.ndarray:
    """Lower case (ASCII and Latin-1 letters); other ASCII becomes a space."""
    out = FOLD[data]
    upper = np.zeros(len(data), bool)
    upper[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[upper] += 0x20
    return out


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of WINDOW + SPAN - 1 bytes (0 where a text has ended), the row's text, its bytes."""
    sizes = np.diff(offsets)
    per = np.maximum(1, -(-sizes // WINDOW))
    text = np.repeat(np.arange(len(sizes)), per)
    first = np.repeat(np.cumsum(per) - per, per)
    starts = offsets[:-1][text] + (np.arange(len(text)) - first) * WINDOW
    stops = offsets[1:][text]
    at = starts[:, None] + np.arange(WINDOW + SPAN - 1)
    inside = at < np.minimum(stops, starts + WINDOW)[:, None]
    rows = np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else 0, 0).astype(np.uint8)
    return rows, text, np.minimum(WINDOW, stops - starts)


def slices(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts at offsets, cut every SLICE bytes: where the parts begin (and the end), and whose they are."""
    per = np.maximum(1, -(-np.diff(offsets) // SLICE))
    owner = np.repeat(np.arange(len(per)), per)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    return np.append(offsets[:-1][owner] + within * SLICE, offsets[-1]), owner


@dataclass
class Network:
    langs: list[str]
    embed: np.ndarray
    filters: np.ndarray  # (SPAN * EMBED, filters); narrow filters are 0 at the end
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def pooled(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Max over the positions of each window, where it was, and the columns."""
        n, e = len(rows), self.embed[rows]
        s = e.strides
        cols = np.lib.stride_tricks.as_strided(e, (n, WINDOW, SPAN * EMBED), (s[0], s[1], s[2]))
        cols = np.ascontiguousarray(cols).reshape(n * WINDOW, -1)
        acts = (cols @ self.filters).reshape(n, WINDOW, -1)
        return acts.max(axis=1) + self.bias, acts, cols

    def steady(self) -> Network:
        """This network in double precision, embedding and filters rounded to a grid on which the sums of
        their products are exact, so that no order of adding, and so no batch, changes a window's sums."""
        params = [p.astype(np.float64) for p in (self.embed, self.filters, self.bias, self.out, self.out_bias)]
        most = np.abs(params[0]).max(initial=1) * np.abs(params[1]).sum(axis=0).max(initial=1)
        unit = 2.0 ** ((51 - np.ceil(np.log2(most))) // 2)
        params[:2] = [np.round(p * unit) / unit for p in params[:2]]
        return Network(self.langs, *params)

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        net = self.steady()
        parts = [np.zeros((0, len(self.langs)))]
        for i in range(0, len(rows), BATCH):
            top = np.maximum(net.pooled(rows[i : i + BATCH])[0], 0)
            sums = np.tile(net.out_bias, (len(top), 1))
            for column, weights in zip(top.T, net.out, strict=True):  # added in this order, whatever the batch
                sums += column[:, None] * weights
            parts.append(softmax(sums))
        return np.concatenate(parts)


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def train(texts: list[bytes], labels: list[str], seed: int = 7) -> Network:
    """Adam on softmax cross-entropy; some windows are cut short, as texts may be."""
    rng = np.random.default_rng(seed)
    langs = sorted(set(labels))
    y = np.array([langs.index(x) for x in labels])
    off = np.concatenate([[0], np.cumsum([min(len(t), WINDOW) for t in texts])]).astype(np.int64)
    rows, text, _ = windows(fold(np.frombuffer(b"".join(t[:WINDOW] for t in texts), np.uint8)), off)
    y = y[text]
    k = FILTERS * len(WIDTHS)
    mask = np.zeros((SPAN * EMBED, k), np.float32)
    for i, w in enumerate(WIDTHS):
        mask[: w * EMBED, i * FILTERS : (i + 1) * FILTERS] = 1
    draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    net = Network(langs, draw(256, EMBED, scale=0.5), draw(SPAN * EMBED, k, scale=0.3) * mask, np.zeros(k, np.float32), draw(k, len(langs), scale=0.2), np.zeros(len(langs), np.float32))
    params = [net.embed, net.filters, net.bias, net.out, net.out_bias]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        for ids in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // BATCH)):
            x = rows[ids].copy()
            short = rng.random(len(ids)) < 0.4
            keep = rng.integers(24, WINDOW, len(ids))
            x[short[:, None] & (np.arange(x.shape[1]) >= keep[:, None])] = 0
            n = len(ids)
            top, acts, cols = net.pooled(x)
            where = acts.argmax(axis=1)
            hidden = np.maximum(top, 0)
            p = softmax(hidden @ net.out + net.out_bias)
            p[np.arange(n), y[ids]] -= 1
            p /= n
            back = (p @ net.out.T) * (top > 0)
            picked = cols.reshape(n, WINDOW, -1)[np.arange(n)[:, None], where]  # n, k, SPAN*EMBED
            g_filters = np.einsum("nk,nkc->ck", back, picked) * mask
            g_cols = back[:, :, None] * net.filters.T[None]
            g_embed = np.zeros_like(net.embed)
            hit = x[np.arange(n)[:, None, None], where[:, :, None] + np.arange(SPAN)]
            np.add.at(g_embed, hit.ravel(), g_cols.reshape(-1, EMBED))
            step += 1
            for i, (q, g) in enumerate(zip(params, [g_embed, g_filters, back.sum(0), hidden.T @ p, p.sum(0)], strict=True)):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.99 * v[i] + 0.01 * g * g
                q -= RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8)
    return net


def sample_windows(docs: DataFrame) -> DataFrame:
    """(lang, piece): pieces of at most TEXTS_PER_LANG labelled texts of each language
    (in expectation), at places that a hash chooses."""
    sizes = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return docs.select("lang", F.col("text").alias("piece")).limit(0)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, TEXTS_PER_LANG / n))])
    draw = lambda salt: F.pmod(F.xxhash64(F.lit(salt), "doc_id", "text"), F.lit(1_000_003))
    some = docs.where(draw("text") / 1_000_003 < share[F.col("lang")])
    places = F.array(*[draw(f"at{i}") for i in range(WINDOWS_PER_TEXT)])
    some = some.select("lang", "text", F.explode(places).alias("at"))
    piece = f"substring(text, cast(1 + at % (greatest(length(text) - {WINDOW}, 0) + 1) as int), {WINDOW})"
    return some.select("lang", F.expr(piece).alias("piece"))


def fit(docs: DataFrame) -> Network | None:
    """Learns from docs (doc_id, text, lang), all of which count as labelled."""
    rows = sample_windows(docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))).collect()
    rows = sorted((r["lang"], r["piece"].encode()) for r in rows)
    return train([b for _, b in rows], [lang for lang, _ in rows]) if rows else None


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, lang_pred, score, windows) of every text."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.small(batches):
            for s in range(0, batch.num_rows, 250):
                b = batch.slice(s, 250)
                letters = np.array(b.column("letters").to_pylist(), bool)
                data, off = C.raw_bytes(b.column("text"))
                names, scores, counts = ["und"] * b.num_rows, np.zeros(b.num_rows), np.zeros(b.num_rows, np.int64)
                if net is not None and letters.any():
                    total = np.zeros((b.num_rows, len(net.langs)))
                    weight = np.zeros(b.num_rows)
                    data, lo = fold(data), 0
                    starts, owner = slices(off)
                    while lo < len(owner):
                        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + SLICE, side="right")) - 1)
                        rows, text, size = windows(data[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo])
                        p, at = net.probabilities(rows), owner[lo + text]
                        np.add.at(total, at, p * size[:, None])
                        np.add.at(weight, at, size)
                        np.add.at(counts, at, 1)
                        lo = hi
                    total /= np.maximum(weight, 1)[:, None]
                    best = total.argmax(axis=1)
                    names = [net.langs[k] if ok else "und" for k, ok in zip(best, letters, strict=True)]
                    scores = np.where(letters, np.clip(total[np.arange(b.num_rows), best], 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(names, pa.string()), pa.array(scores), pa.array(counts)], names=["doc_id", "lang_pred", "score", "n_windows"])

    return base.mapInArrow(run, "doc_id long, lang_pred string, score double, n_windows long")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from three folds of four and predicts every text."""
    docs = C.load(spark, sf_dir, "documents")
    net = fit(docs.where(C.crc_fold("doc_id", 4) != 2).select("doc_id", "text", "lang"))
    return predict(docs, net).select("doc_id", (C.crc_fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "n_windows")
