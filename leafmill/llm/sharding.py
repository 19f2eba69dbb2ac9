"""Operator 6: sharding by vector bin packing.

Rows of equal text form a group with a vector of bytes, tokens and rows. Tokens are
estimated: one, one more for each space, tab or line feed, and one for every two bytes
that characters take beyond their first, so that scripts written without spaces count
too. Groups that matter one by one (over one
part in ITEM of the total in some dimension; there are at most 3 * ITEM of those) and
BUNDLES bundles of the rest, formed by a hash of the text, are packed on the driver,
largest first: each goes where the dot product of its vector with the shards' residual
capacity is highest among the shards it fits. A group larger than a shard's share is
split by a hash of its rows. Only this bounded list of items is ever collected. At the
end `level` moves or swaps items while that evens the bytes, the law, and leaves tokens
and rows no worse than TOLERANCE from even, or than they were.

Slots are numbered within sub-buckets of a shard, with offsets from a table of
16 * SUB counts, so no task numbers a whole shard; which of its rows a sub-bucket
holds goes by a number that the first table gave each row, so rows that share an id,
or are equal altogether, spread too.

Null texts have size 1 and crc 0, and form a group with the empty texts' key
apart. Rows that repeat get slots each. Ties between shards go to the lowest number,
between items to the first by hash. Long texts are sizes like others. Extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.llm import _common as C

SHARDS, ITEM, BUNDLES, SUB = 16, 4096, 1 << 15, 64
#: How far levelling the bytes may take the other dimensions from even.
TOLERANCE = 0.01


def place(vectors: np.ndarray, shards: int = SHARDS) -> np.ndarray:
    """The shard of each vector. Dimensions are scaled to a total of one a shard."""
    total = np.maximum(vectors.sum(axis=0), 1)
    v = vectors / total * shards
    free = np.ones((shards, v.shape[1]))
    where = np.zeros(len(v), np.int32)
    for i in np.argsort(-v.max(axis=1), kind="stable"):
        fits = (free >= v[i] - 1e-9).all(axis=1)
        if not fits.any():  # the first dimension is the law: where it overflows least
            fits = free[:, 0] >= free[:, 0].max() - 1e-12
        scores = np.where(fits, np.maximum(free, 0) @ v[i], -np.inf)
        where[i] = scores.argmax()
        free[where[i]] -= v[i]
    return where


def level(vectors: np.ndarray, where: np.ndarray, shards: int = SHARDS, rounds: int = 4000) -> np.ndarray:
    """Moves or swaps items between the fullest and emptiest shard while that evens the
    bytes and spares the other dimensions."""
    where, v = where.copy(), vectors / np.maximum(vectors.sum(axis=0), 1) * shards
    load = np.stack([np.bincount(where, v[:, k], shards) for k in range(v.shape[1])], axis=1)
    for _ in range(rounds):
        hi, lo = int(load[:, 0].argmax()), int(load[:, 0].argmin())
        gap = load[hi, 0] - load[lo, 0]
        a, b = np.flatnonzero(where == hi), np.flatnonzero(where == lo)
        b = b[np.argsort(v[b, 0], kind="stable")]
        give, take = v[a], np.zeros_like(v[a])
        partner = np.full(len(a), -1)
        if len(b):
            spot = np.searchsorted(v[b, 0], give[:, 0] - gap / 2).clip(0, len(b) - 1)
            partner, take = np.concatenate([partner, b[spot]]), np.concatenate([take, v[b[spot]]])
            a, give = np.concatenate([a, a]), np.concatenate([give, give])
        shift = give - take
        gain = np.minimum(shift[:, 0], gap - shift[:, 0])
        off = lambda x: np.abs(x[..., 1:] - 1).max(axis=-1)
        worst = np.maximum(off(load[hi] - shift), off(load[lo] + shift))
        gain[worst > max(TOLERANCE, off(load[hi]), off(load[lo]))] = 0
        i = int(gain.argmax()) if len(gain) else 0
        if not len(gain) or gain[i] <= 1e-12:
            break
        where[a[i]] = lo
        if partner[i] >= 0:
            where[partner[i]] = hi
        load[hi] -= shift[i]
        load[lo] += shift[i]
    return where


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, tokens, text_crc32, group, shard, slot) of every row."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    solid = text
    for c in " \n\t":
        solid = F.replace(solid, F.lit(c), F.lit(""))
    rows = C.cut(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            (F.lit(1) + F.length(text) - F.length(solid) + F.shiftright(F.octet_length(text) - F.length(text), 1)).cast("long").alias("tokens"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            C.text_key().alias("group"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    total = rows.agg(*sums).first()
    if not total["rows"]:
        return rows.drop("row").select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    dims = ("size", "tokens", "rows")
    share = lambda n: F.greatest(*[F.col(c) / F.lit(total[c] / n) for c in dims])
    big = rows.groupBy("group").agg(*sums).where(share(ITEM) > 1).withColumn("parts", F.when(share(shards) > 1, F.ceil(share(shards) * 64)).otherwise(1).cast("int"))
    listed = {r["group"]: r["parts"] for r in big.collect()}  # at most 3 * ITEM
    names = spark.createDataFrame(sorted(listed.items()) or [(0, 1)], "group long, parts int").where(F.lit(bool(listed)))
    keyed = (
        rows.join(F.broadcast(names), "group", "left")
        .withColumn("part", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("row"), F.col("parts").cast("long"))).otherwise(0).cast("int"))
        .withColumn("item", F.when(F.col("parts").isNull(), F.pmod(F.col("group"), F.lit(BUNDLES))).otherwise(F.col("group")))
        .withColumn("alone", F.col("parts").isNotNull())
    )
    items = sorted(keyed.groupBy("alone", "item", "part").agg(*sums).collect(), key=lambda r: (r["alone"], r["item"], r["part"]))
    vectors = np.array([[r[c] for c in dims] for r in items], float)
    where = level(vectors, place(vectors, shards), shards)
    table = spark.createDataFrame([(r["alone"], r["item"], r["part"], int(w)) for r, w in zip(items, where, strict=True)], "alone boolean, item long, part int, shard int")
    placed = keyed.join(F.broadcast(table), ["alone", "item", "part"]).withColumn("sub", F.pmod(F.xxhash64("row", "group"), F.lit(SUB)))
    counts = placed.groupBy("shard", "sub").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")  # 16 * SUB rows
    number = F.row_number().over(Window.partitionBy("shard", "sub").orderBy("row"))
    slotted = placed.withColumn("local", number).join(F.broadcast(offsets), ["shard", "sub"])
    return slotted.select("doc_id", "size", "tokens", "text_crc32", "group", "shard", (F.col("offset") + F.col("local") - 1).cast("long").alias("slot"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The law is `bytes`: the shards' sizes are near equal."""
    out = assign(C.load(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "tokens")
