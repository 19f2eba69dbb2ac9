"""Connected components of a large edge table, by contraction in rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm import _common as C


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Roots of the graph with edges i-j on n nodes."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b). In each round a node points at the
    neighbour, or itself, of least hash, and edges move to what their ends point at;
    hashes break up chains, so rounds grow with the logarithm of the longest path.
    All tables are written to the shared folder; only an emptiness test reaches the
    driver. A hub's minimum is combined before the shuffle."""
    edges = C.cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    steps = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
        step = C.cut(both.groupBy("a").agg(F.min(rank("b")).alias("m")).select(F.col("a").alias("node"), F.least("m", rank("a"))["v"].alias("parent")))
        steps.append(step)
        up = lambda end: step.select(F.col("node").alias(end), F.col("parent").alias(f"p{end}"))  # noqa: E731, B023
        moved = edges.join(up("a"), "a").join(up("b"), "b").where("pa <> pb")
        edges = C.cut(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = steps[0].select("node", F.col("parent").alias("root"))
    for step in steps[1:]:
        hop = step.select(F.col("node").alias("root"), F.col("parent").alias("_next"))
        out = out.join(hop, "root", "left").select("node", F.coalesce("_next", "root").alias("root"))
    return C.cut(out)
