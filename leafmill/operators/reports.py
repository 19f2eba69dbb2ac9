"""Per-document reports, status tables and the relational shapes around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.session import settled


def tally(values: Column) -> Column:
    """How often each value of an array stands in it, as a map, keys in order."""
    kinds = F.array_sort(F.array_distinct(values))
    return F.map_from_entries(F.transform(kinds, lambda k: F.struct(k.alias("key"), F.size(F.filter(values, lambda v: v == k)).cast("long").alias("value"))))


def report(blocks: DataFrame) -> DataFrame:
    """AGG-01: per document pages, blocks, counts by type and by open flag, and the flagged
    blocks in order. blocks: doc_id, page, block_no, type, flags. One pass: what a block adds
    is a few words, and a document's words come together once."""
    flagged = F.when(F.size("flags") > 0, F.struct((F.col("page") + 1).alias("page"), F.col("block_no").alias("block"), "type", "flags"))
    base = blocks.groupBy("doc_id").agg(
        F.size(F.collect_set("page")).cast("long").alias("n_pages"),
        F.count("*").alias("n_blocks"),
        F.collect_list("type").alias("types"),
        F.array_sort(F.collect_list(flagged)).alias("flagged_blocks"),
    )
    flags = F.flatten(F.transform("flagged_blocks", lambda x: x["flags"]))
    return base.select("doc_id", "n_pages", "n_blocks", "flagged_blocks", tally(F.col("types")).alias("block_types"), tally(flags).alias("open_flags"))


def spans(rows: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-05, SNK-11: pages, read and reviewed pages of each document; rows: keys, is_read, is_reviewed."""
    return rows.groupBy(*keys).agg(F.count("*").alias("pages"), F.count_if("is_read").alias("read"), F.count_if("is_reviewed").alias("review"))


def work_left(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """JOIN-01: what has no result yet."""
    return wanted.join(done, keys, "left_anti")


def ready(wanted: DataFrame, needed: DataFrame, keys: list[str]) -> DataFrame:
    """JOIN-02: what has the result that the next stage needs."""
    return wanted.join(needed, keys, "left_semi")


def latest_pages(read: DataFrame, review: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """SRC-15, JOIN-03: a page's review where there is one, else its reading."""
    r = review.select(*keys, F.lit(True).alias("_r"), *[F.col(c).alias(f"_{c}") for c in columns])
    return read.join(r, keys, "left").select(*keys, *[F.when(F.col("_r"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in columns], F.when(F.col("_r"), "review").otherwise("read").alias("stage"))


def document_status(docs: DataFrame, outputs: DataFrame, failures: DataFrame) -> DataFrame:
    """JOIN-04: done, with failed pages, failed or todo. docs: doc_id; outputs: doc_id,
    failed_pages (a count); failures: doc_id."""
    state = F.when(F.col("failed_pages") > 0, "with failed pages").when(F.col("_done"), "done").when(F.col("_failed"), "failed").otherwise("todo")
    out = docs.join(outputs.select("doc_id", "failed_pages", F.lit(True).alias("_done")), "doc_id", "left").join(failures.select("doc_id", F.lit(True).alias("_failed")).distinct(), "doc_id", "left")
    return out.select(*docs.columns, state.alias("status"))


def missing_pages(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """SRC-13: page numbers of 0..n_pages-1 without a page. docs: doc_id, n_pages."""
    every = docs.where("n_pages > 0").select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_pages").cast("long") - 1)).alias("page"))
    return every.join(pages, ["doc_id", "page"], "left_anti")


def complete_pages(items: DataFrame, keys: list[str], good: str) -> DataFrame:
    """AGG-04: pages none of whose items failed for now."""
    return items.groupBy(*keys).agg(F.bool_and(good).alias("complete"), F.count("*").alias("n_items"))


def islands(rows: DataFrame, keys: list[str], of: str) -> DataFrame:
    """WIN-03: whole numbers as ranges, "0-2,5,7-8"."""
    order = Window.partitionBy(*keys).orderBy(of)
    runs = rows.select(*keys, of).distinct().withColumn("_g", F.col(of) - F.row_number().over(order)).groupBy(*keys, "_g").agg(F.min(of).alias("a"), F.max(of).alias("b"))
    name = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat_ws("-", "a", "b"))
    return runs.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("a", name.alias("s")))), lambda x: x["s"]), ",").alias("ranges"))


def first_of(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """WIN-01: the first row of each key; combined before the shuffle, unlike a window."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    return rows.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_x")).select(*keys, *[F.col(f"_x.{c}").alias(c) for c in [*order, *rest]]).select(rows.columns)


def drop_copies(files: DataFrame) -> DataFrame:
    """SRC-02 on (path, doc_id): of files with one document id the first by path."""
    return first_of(files, ["doc_id"], ["path"])


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds n, from 0 in order of all rows, without one task that holds them: rows are
    range-partitioned, and each partition starts where the counts before it end. The ranges
    must be drawn once for both, so the rows are settled in between."""
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    spread = spread.withColumns({"_part": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_id")
    spread = settled(spread)
    counts = spread.groupBy("_part").agg(F.count("*").alias("_n"))  # a row a partition
    start = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return spread.join(F.broadcast(counts.select("_part", start.alias("_start"))), "_part").withColumn("n", F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")


def shards(rows: DataFrame, order: list[str], count: int) -> DataFrame:
    """WIN-06, LIM-02: shard i holds rows i, i + count, ... in order."""
    return numbered(rows, order).withColumn("shard", F.pmod("n", F.lit(count)).cast("int")).drop("n")


def captions(blocks: DataFrame) -> DataFrame:
    """FIG-01, JOIN-06: of each figure the nearest caption, two blocks after it at most,
    else two before."""
    order = Window.partitionBy("doc_id", "page").orderBy("block_no")
    text = F.when(F.col("type") == "caption", F.col("content"))
    near = [F.lead(text, 1).over(order), F.lead(text, 2).over(order), F.lag(text, 1).over(order), F.lag(text, 2).over(order)]
    return blocks.withColumn("caption", F.trim(F.coalesce(*near, F.lit("")))).where(F.col("type") == "figure").select("doc_id", "page", "block_no", "caption")


def undeclared(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """JOIN-07: ends of edges that are no node. nodes: graph, id; edges: graph, u, v."""
    ends = edges.select("graph", F.explode(F.array("u", "v")).alias("id")).distinct()
    return ends.join(nodes, ["graph", "id"], "left_anti")


def to_read(pages: DataFrame, read: DataFrame, force: bool = False, retry_failed: bool = False) -> DataFrame:
    """VAL-21, VAL-22: pages (doc_id, page) to read: without a reading, or with a failed one
    that is to be tried again. read: doc_id, page, failed (null: unreadable)."""
    if force:
        return pages
    done = read.where(~F.coalesce("failed", F.lit(True))) if retry_failed else read
    return work_left(pages, done.select("doc_id", "page"), ["doc_id", "page"])


def to_review(read: DataFrame, review: DataFrame, force: bool = False) -> DataFrame:
    """VAL-21: pages that are read and, unless forced, not reviewed."""
    return read if force else work_left(read, review, ["doc_id", "page"])


def failed_pages(blocks: DataFrame) -> DataFrame:
    """VAL-24: pages that failed, by their mark or a block's. blocks: doc_id, page, failed, flags."""
    bad = F.coalesce("failed", F.lit(False)) | F.array_contains("flags", "page_failed")
    return blocks.groupBy("doc_id", "page").agg(F.bool_or(bad).alias("failed")).where("failed").drop("failed")


def placeholder_pages(failed: DataFrame) -> DataFrame:
    """RDB-07: a block that stands for each page (doc_id, page, error) that failed."""
    return failed.select("doc_id", "page", F.lit(0).alias("block_no"), F.lit("other").alias("type"), F.lit("").alias("content"), F.array(F.lit("page_failed")).alias("flags"), F.left("error", F.lit(300)).alias("error"), F.lit(True).alias("failed"))


def invalidate(review: DataFrame, reread: DataFrame) -> DataFrame:
    """STR-03: reviews that stand, once some pages have been read again."""
    return review.join(reread, ["doc_id", "page"], "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """STR-02: new rows in place of old ones with their keys; doing it twice changes nothing."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def still_to_do(pages: DataFrame, read: DataFrame, review: DataFrame) -> DataFrame:
    """AGG-06: one row, how many pages (doc_id, page) are to be read and to be reviewed."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    every = to_read(pages, read).select(one.alias("r"), none.alias("v")).unionByName(to_review(read, review).select(none.alias("r"), one.alias("v")))
    return every.agg(F.coalesce(F.sum("r"), none).alias("to_read"), F.coalesce(F.sum("v"), none).alias("to_review"))


def finished(docs: DataFrame, outputs: DataFrame, missing: DataFrame, read: DataFrame, force_read: bool = False, retry_failed: bool = False) -> DataFrame:
    """STR-05: documents (doc_id, n_pages; null: no manifest) that stay finished though their
    work is gone or has lost page images. outputs: doc_id, failed_pages; missing: doc_id, page
    images that are lost; read: doc_id, page. A forced reading, or failed pages that are to be
    tried again, start them over; so do lost images when every page still has its reading."""
    if force_read:
        return docs.where(F.lit(False))
    made = outputs.where("coalesce(failed_pages, 0) = 0") if retry_failed else outputs
    lost = missing.select("doc_id", F.lit(True).alias("_lost")).distinct()
    kept = read.groupBy("doc_id").agg(F.countDistinct("page").alias("_kept"))
    rows = docs.join(made.select("doc_id").distinct(), "doc_id", "left_semi").join(lost, "doc_id", "left").join(kept, "doc_id", "left")
    purged = F.col("n_pages").isNull() | (F.coalesce("_lost", F.lit(False)) & (F.coalesce("_kept", F.lit(0)) < F.col("n_pages")))
    return rows.where(purged).select(docs.columns)


def select_documents(found: DataFrame, finished_: DataFrame, failures: DataFrame, order: list[str], shard: int = 0, count: int = 1, retry_failed: bool = False) -> DataFrame:
    """Documents for one task: the shard's part of what was found, in order, less what is
    finished or, unless tried again, has failed for good. The shard is taken before anything is
    left out, so that tasks started at different times share the work in the same way."""
    mine = shards(found, order, count).where(F.col("shard") == shard).drop("shard")
    mine = work_left(mine, finished_.select("doc_id"), ["doc_id"])
    return mine if retry_failed else work_left(mine, failures.select("doc_id"), ["doc_id"])
