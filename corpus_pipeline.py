"""A corpus from documents to tokens: toxic documents go, repeated lines go, one
document of each near-duplicate group stays, contaminated documents go, and what
is left is encoded.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before it kept, and
returns them with docs' columns, whatever those are called; the last returns the tokens. A
null text counts as empty and a null doc_id as a document of its own; rows that share an id,
or are equal altogether, are judged each, save where a stage says otherwise; an empty table
stays empty. Texts of any length are taken whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import _common as C
from leafmill.llm import bpe, decontaminate, linededup, minhash, toxicity

#: Texts whose word shingles are so similar are near duplicates here; operator 10 has a contract of its own.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go. The lexicon is learned from the labels of the training
    folds; labels that are null, or of documents that are not there, teach nothing, and without
    both kinds of labels all documents stay. Empty texts stay."""
    lexicon = toxicity.fit(docs, toxicity.training_rows(C.load(spark, sf_dir, "labels")))
    return toxicity.keep_clean(docs, lexicon)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 characters or more that three documents hold stay in the one of largest id.
    n_chars follows the text; a document that loses every line stays, empty, and so does one
    whose text was null, with the empty text."""
    names = docs.columns
    out = linededup.dedup_lines(docs).select("row.*", F.col("_kept").cast("string").alias("text"))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked, directly or over others, the one of least id stays, once even
    if its row repeats. Texts without words have no copies and stay, also repeated ones."""
    return minhash.keep_first(docs, percent=NEAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document goes if it is contaminated as operator 3 says, or holds half of an item's
    windows or more, however small a share of a long document that is. Documents without
    text or hits stay."""
    return decontaminate.keep_clean(docs, C.load(spark, sf_dir, "benchmark"), decontaminate.leaked())


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text_sha256) of every row; the digest is of the ids decoded again."""
    both = bpe.decode_documents(bpe.encode_documents(docs))
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("text_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: MinHash, a learned lexicon and BPE merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.load(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = C.cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
