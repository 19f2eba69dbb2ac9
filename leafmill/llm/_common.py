"""What the corpus operators share: loading, shared scratch tables, row keys."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a worker handles at once.
BATCH_ROWS = 400


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join(x for x in [root, *have] if x)


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of BATCH_ROWS, so that what is made of one stays small."""
    for b in batches:
        for at in range(0, b.num_rows, BATCH_ROWS):
            yield b.slice(at, BATCH_ROWS)


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """What runs inside gets Arrow batches of so many rows, for large values."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A folder that driver and executors share, one part of it for each application, so that
    an application's tables can be dropped together: the cluster's, or the warehouse where
    none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{named.rstrip('/')}/leafmill/{spark.sparkContext.applicationId}"


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it back: what follows
    neither recomputes it nor depends on the executors that made it."""
    spark = df.sparkSession
    at = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(at)
    back = spark.read.schema(df.schema).parquet(at)
    back.__dict__["_cut_at"] = at
    return back


def _delete(spark: SparkSession, at: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop(df: DataFrame) -> None:
    """Delete a table that `cut` made and that nothing reads any more."""
    if at := df.__dict__.get("_cut_at"):
        _delete(df.sparkSession, at)


def clear(spark: SparkSession) -> None:
    """Delete every table that this application has cut; for when its results have been read."""
    _delete(spark, scratch_dir(spark))


def text_key(text: str = "text") -> Column:
    """Tells apart rows that share a doc_id; rows equal in both get equal results."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull())


def same_doc(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["_key"] == b["_key"])


def crc_fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def raw_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column as one uint8 array and n+1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]
