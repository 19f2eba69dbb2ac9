"""Documents on disk, and what is already made of them."""

from __future__ import annotations

import glob
import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.text import document_id
from leafmill.operators.reports import drop_copies
from leafmill.session import ship

# Extensions of documents.
EXTENSIONS = (".pdf", ".png", ".jpg", ".jpeg", ".tif", ".tiff", ".bmp", ".webp")


def _walk(top: str):
    """Documents under a folder, hidden names left out, each real folder once."""
    waiting, seen = [top], {os.path.realpath(top)}
    while waiting:
        folder = waiting.pop()
        for e in sorted(os.scandir(folder), key=lambda e: e.name):
            if e.name.startswith("."):
                continue
            if e.is_dir():
                real = os.path.realpath(e.path)
                if real not in seen:
                    seen.add(real)
                    waiting.append(e.path)
            elif os.path.splitext(e.name)[1].lower() in EXTENSIONS:
                yield e.path


def listed(inputs: list[str]) -> list[tuple[str, str]]:
    """SRC-01: (real path, path) of files, folders and @lists, each file once under the
    spelling whose absolute path is least, in order of real paths."""
    found: dict[str, str] = {}

    def add(item: str):
        for p in _walk(item) if os.path.isdir(item) else [item]:
            real = os.path.realpath(p)
            found[real] = min(found.get(real, p), p, key=os.path.abspath)

    for item in inputs:
        if item[:1] == "@":
            with open(item[1:], encoding="utf-8") as f:
                for line in f:
                    if line.strip() and line[0] != "#":
                        add(line.strip())
        else:
            add(item)
    return sorted(found.items())


def discover(spark: SparkSession, inputs: list[str]) -> DataFrame:
    """(path, doc_id, size): documents by content, copies under one name once. Files are
    read and hashed by the executors."""
    names = [p for _, p in listed(inputs)]
    if not names:
        return spark.createDataFrame([], "path string, doc_id string, size long")
    files = spark.read.format("binaryFile").load([os.path.abspath(p) for p in names])
    path = F.regexp_replace("path", "^file:/*", "/")
    rows = files.select(path.alias("path"), document_id(path, F.sha2("content", 256)).alias("doc_id"), F.col("length").alias("size"))
    return drop_copies(rows)


def collisions(known: DataFrame, new: DataFrame) -> DataFrame:
    """SRC-12: new documents (doc_id, sha256) whose id stands for other bytes already."""
    old = known.select("doc_id", F.col("sha256").alias("_old"))
    return new.join(old, "doc_id").where(F.col("sha256") != F.col("_old")).drop("_old")


def pages(spark: SparkSession, path: str, schema) -> DataFrame:
    """SRC-14: page files, one JSON object each."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def save_pages(rows: DataFrame, path: str, by: list[str]) -> None:
    """SNK-02: pages by document, replacing those documents alone."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def save_documents(rows: DataFrame, path: str) -> None:
    """SNK-03: one row a document; the table's commit is the mark of completion."""
    rows.write.mode("overwrite").parquet(path)


def write_whole(path: str, text: str) -> None:
    """SNK-01: a file that is there in whole or not at all: written beside its place under a
    name of its own, then moved there. It gets the rights that a plain new file would."""
    fd, temp = tempfile.mkstemp(dir=os.path.dirname(path) or ".", prefix=".part-")
    try:
        mask = os.umask(0)
        os.umask(mask)
        with os.fdopen(fd, "w", encoding="utf-8", newline="") as f:
            f.write(text)
        os.chmod(temp, 0o666 & ~mask)
        os.replace(temp, path)
    except BaseException:
        os.unlink(temp)
        raise


def save_files(rows: DataFrame, folder: str) -> None:
    """SNK-03 as files: rows (doc_id, markdown, report as JSON text) to a folder a document,
    in a file system that every executor mounts. The Markdown goes last: it marks completion,
    and a task that is run again writes the same files."""
    ship(rows.sparkSession)

    def write(part):
        for r in part:
            at = os.path.join(folder, str(r["doc_id"]))
            os.makedirs(at, exist_ok=True)
            write_whole(os.path.join(at, "report.json"), r["report"] or "{}")
            write_whole(os.path.join(at, f"{r['doc_id']}.md"), r["markdown"] or "")

    rows.select("doc_id", "markdown", "report").foreachPartition(write)


def split_inputs(given: list[str]) -> list[str]:
    """SRC-17: words of each input that is no path, patterns replaced by what they match."""
    out: list[str] = []
    for item in given:
        if os.path.exists(item.removeprefix("@")):
            out.append(item)
            continue
        for word in item.split():
            out += sorted(glob.glob(word)) if re.search(r"[*?\[]", word) and glob.glob(word) else [word]
    return out


def read_profile(spark: SparkSession, path: str) -> dict[str, str]:
    """SRC-16: KEY=value lines of a small settings file."""
    line = r"^\s*(?:export\s+)?([A-Z_]+)=[\"']?([^\"'\s#(]*)[\"']?\s*(#.*)?$"
    rows = spark.read.text(path).where(F.col("value").rlike(line)).select(F.regexp_extract("value", line, 1).alias("k"), F.regexp_extract("value", line, 2).alias("v"))
    return {r["k"]: r["v"] for r in rows.collect()}
