"""Operator 5: toxicity by a weighted lexicon.

Texts are folded (case, homoglyphs, digit and sign substitutions), one
Aho-Corasick pass finds lexicon words and exception phrases, hits inside an
exception phrase don't count, and the sum of the hits' weights is set against
the text's length. Words, weights, exception phrases (a lexicon word and a neighbour
that clean texts hold and toxic ones don't, beside a few well-known ones) and the two
coefficients of the score are learned from a bounded sample of labelled texts.

Null and empty texts have no hits and get the score of a clean text. Several
labels of one doc_id count as toxic if any of them is. Repeated rows are scored
each, equal texts alike; words of equal chance and weight enter the lexicon by name.
Without labels of both kinds every score is 0. An empty table gives no rows. A long
text is read in one pass, in time in proportion to its length. Extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import _common as C

#: Bound of the labelled sample, by label (in expectation), and of the lexicon.
SAMPLE_TOXIC, SAMPLE_CLEAN, LEXICON_SIZE = 5000, 15000, 4096
#: A lexicon word is in so many toxic sample texts at least, and that many times
#: likelier there (natural logarithm). Counts, not shares: a small language has words too.
LEAST_COUNT, LEAST_ODDS = 4, 3.0
#: Of the lexicon's words, at most so many in expectation are there by chance.
FALSE_SHARE = 0.1
#: Phrases learned beside these: so many at most.
LEARNED = 4096
#: Harmless uses of words that a lexicon may hold.
EXCEPTIONS = ("clown fish", "circus clown", "trash can", "trash bin", "sore loser", "pond scum")

# Letters of other scripts that look like Latin ones, and signs that stand for letters.
_LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ѐ": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ⅼ": "l", "ո": "n", "ս": "u",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
}


def _table() -> dict[int, str]:
    table = {ord(k): v for k, v in _LOOKALIKES.items()}
    for c in [*range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B), *range(0x1D400, 0x1D6A4)]:  # full-width and mathematical letters
        table[c] = unicodedata.normalize("NFKC", chr(c)).lower()
    for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF):  # invisible
        table[c] = ""
    table[ord("l")] = "i"  # 1, l and I stand for each other
    return {k: "i" if v == "l" else v for k, v in table.items()}


_FOLD = _table()


def fold(text: str) -> str:
    return text.lower().translate(_FOLD)


def words(folded: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in folded).split()


@dataclass
class Lexicon:
    weights: dict[str, float]
    coefficients: tuple[float, float, float] = (0.0, 0.0, 0.0)  # bias, of log(1 + hits), of hits by length
    exceptions: tuple[str, ...] = EXCEPTIONS
    _machine: object = field(default=None, repr=False)

    def machine(self):
        if self._machine is None:
            import ahocorasick

            a = ahocorasick.Automaton()
            for phrase in self.exceptions:
                a.add_word(fold(phrase), (len(fold(phrase)), 0.0))
            for w, x in self.weights.items():
                if not a.exists(w):
                    a.add_word(w, (len(w), x))
            if len(a):
                a.make_automaton()
            self._machine = a
        return self._machine

    def __getstate__(self):
        return self.__dict__ | {"_machine": None}

    def hits(self, text: str) -> tuple[float, int, int]:
        """Sum of the weights of whole-word hits outside exceptions, their number, words of the text."""
        a = self.machine()
        if not len(a) or not text:
            return 0.0, 0, 0
        t = fold(text)
        found, spared = [], []
        for end, (n, weight) in a.iter(t):
            start, stop = end - n + 1, end + 1
            if (start and t[start - 1].isalnum()) or (stop < len(t) and t[stop].isalnum()):
                continue
            (found if weight else spared).append((start, stop, weight))
        if spared:
            spared.sort()
            starts = [x[0] for x in spared]
            reach = list(accumulate((x[1] for x in spared), max))  # the furthest end of those that start so early
            found = [x for x in found if not (k := bisect_right(starts, x[0])) or reach[k - 1] < x[1]]
        return sum(x[2] for x in found), len(found), text.count(" ") + text.count("\n") + 1

    def features(self, text: str | None) -> tuple[float, float]:
        total, _, n = self.hits(text or "")
        return float(np.log1p(total)), float(np.log1p(20 * total / (n + 20)))

    def score(self, x: np.ndarray) -> np.ndarray:
        b, c, d = self.coefficients
        return 1 / (1 + np.exp(-(b + c * x[:, 0] + d * x[:, 1])))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Newton steps; the slopes are kept from being negative."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hess = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(3)
        w = w + np.linalg.solve(hess, a.T @ (y - p) - ridge * w)
        w[1:] = np.maximum(w[1:], 0)
    return tuple(map(float, w))


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic): distinct texts of a bounded sample of the labelled ids. The ids
    are at most SAMPLE_TOXIC + SAMPLE_CLEAN in expectation, so they can be broadcast."""
    lab = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in lab.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("toxic") == 1, F.lit(min(1.0, SAMPLE_TOXIC / sizes.get(1, 1)))).otherwise(F.lit(min(1.0, SAMPLE_CLEAN / sizes.get(0, 1))))
    ids = lab.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_003)) / 1_000_003 < share)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(ids), "doc_id")
    return texts.groupBy(F.xxhash64("text").alias("_key")).agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: list[Counter] = [Counter(), Counter()]

    def flush():
        names = list(seen[0].keys() | seen[1].keys())
        out = [pa.array(names, pa.string()), *(pa.array([c[w] for w in names], pa.int64()) for c in seen)]
        for c in seen:
            c.clear()
        return pa.RecordBatch.from_arrays(out, names=["word", "n_clean", "n_toxic"])

    for b in C.small(batches):
        for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
            seen[toxic].update(set(words(fold(text))))
            if len(seen[0]) + len(seen[1]) > 100_000:
                yield flush()
    yield flush()


def _count_phrases(lexicon: Lexicon):
    """Texts to the two-word phrases with a lexicon word in them, once a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small(batches):
            phrases, toxic = [], []
            for text, mark in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                t = fold(text)
                own = {f"{x} {y}" for x, y in pairwise(words(t)) if (x in lexicon.weights) != (y in lexicon.weights)}
                own = [p for p in own if p in t]  # with one space between, as the automaton looks for it
                phrases += own
                toxic += [mark] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(phrases, pa.string()), pa.array(toxic, pa.int32())], names=["phrase", "toxic"])

    return run


def learned_exceptions(sample: DataFrame, lexicon: Lexicon) -> tuple[str, ...]:
    """Phrases in LEAST_COUNT clean sample texts or more and in no toxic one; at most LEARNED."""
    counts = sample.mapInArrow(_count_phrases(lexicon), "phrase string, toxic int").groupBy("phrase").agg(F.count("*").alias("n"), F.max("toxic").alias("toxic"))
    rows = counts.where((F.col("toxic") == 0) & (F.col("n") >= LEAST_COUNT)).orderBy(F.desc("n"), "phrase").limit(LEARNED).collect()
    return tuple(r["phrase"] for r in rows)


def chance(share: float) -> Column:
    """Binomial tail: how likely a word of n_toxic + n_clean texts has n_toxic toxic ones
    or more if it is as toxic as all texts, of which share are."""
    n = (F.col("n_toxic") + F.col("n_clean")).cast("double")
    start = F.struct(F.pow(F.lit(share), n).alias("term"), F.lit(0.0).alias("sum"))
    step = lambda x, k: F.struct((x["term"] * (n - k) / (k + 1) * (1 - share) / share).alias("term"), (x["sum"] + x["term"]).alias("sum"))
    return F.aggregate(F.sequence(F.lit(0).cast("long"), "n_clean"), start, step, lambda x: x["sum"])


def fit(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """Lexicon and coefficients from the labelled rows given."""
    sample = C.cut(labelled_sample(docs, labels))
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Lexicon({}, (-60.0, 0.0, 0.0))
    counts = sample.mapInArrow(_count_words, "word string, n_clean long, n_toxic long").groupBy("word").agg(F.sum("n_clean").alias("n_clean"), F.sum("n_toxic").alias("n_toxic"))
    tested = C.cut(counts.where((F.col("n_toxic") + F.col("n_clean") >= LEAST_COUNT) & (F.length("word") >= 3)))
    odds = F.log((F.col("n_toxic") + 0.5) / (sizes[1] + 1)) - F.log((F.col("n_clean") + 0.5) / (sizes[0] + 1))
    top = (
        tested.withColumn("weight", odds)
        .where((F.col("n_toxic") >= LEAST_COUNT) & (F.col("weight") >= LEAST_ODDS))
        .select("word", "weight", chance(sizes[1] / (sizes[0] + sizes[1])).alias("chance"))
        .orderBy("chance", F.desc("weight"), "word")
        .limit(LEXICON_SIZE)
        .collect()
    )
    n = tested.count()
    held = max((i for i, r in enumerate(top, 1) if r["chance"] * n <= FALSE_SHARE * i), default=0)  # Benjamini-Hochberg
    lexicon = Lexicon({r["word"]: r["weight"] for r in top[:held]})
    lexicon.exceptions += learned_exceptions(sample, lexicon)
    x = featured(sample, lexicon, "toxic int").select("toxic", "x0", "x1").collect()
    lexicon.coefficients = logistic(np.array([[r["x0"], r["x1"]] for r in x]), np.array([r["toxic"] for r in x], float))
    return lexicon


def featured(rows: DataFrame, lexicon: Lexicon, key: str) -> DataFrame:
    """Adds hits, x0 and x1 to the key column of rows (with a text)."""
    name = key.split()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in C.small(batches):
            hits, x = [], []
            for t in b.column("text").to_pylist():
                total, n, size = lexicon.hits(t or "")
                hits.append(n)
                x.append((np.log1p(total), np.log1p(20 * total / (size + 20))))
            x = np.array(x, float).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column(name), pa.array(hits, pa.int64()), pa.array(x[:, 0].copy()), pa.array(x[:, 1].copy())], names=[name, "hits", "x0", "x1"])

    kind = key.split()[1]
    return rows.select(F.col(name).cast(kind).alias(name), "text").mapInArrow(run, f"{key}, hits long, x0 double, x1 double")


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, hits, score) of every text."""
    b, c, d = lexicon.coefficients
    z = F.lit(b) + F.lit(c) * F.col("x0") + F.lit(d) * F.col("x1")
    return featured(docs, lexicon, "doc_id long").select("doc_id", "hits", (1 / (1 + F.exp(-z))).alias("score"))


def training_rows(rows: DataFrame) -> DataFrame:
    """The rows whose id is not of the held-out fold."""
    return rows.where(C.crc_fold("doc_id", 5) != 0)


def keep_clean(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The rows of docs, all columns, whose text scores under 0.5; nothing is shuffled."""
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.small(batches):
            x = np.array([lexicon.features(t) for t in batch.column("text").to_pylist()], float).reshape(-1, 2)
            yield batch.filter(pa.array(lexicon.score(x) < 0.5)).select(names)

    return docs.mapInArrow(run, schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from four folds of five and scores every text."""
    docs = C.load(spark, sf_dir, "documents")
    lexicon = fit(docs, training_rows(C.load(spark, sf_dir, "labels")))
    return score(docs, lexicon).select("doc_id", (C.crc_fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "hits")
