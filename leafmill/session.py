"""Lets Python workers import this package, wherever the session was started."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> SparkSession:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join(x for x in [root, *have] if x)
    return spark


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer splits than there are cores (a small table in one row group), dealt out
    to all cores before costly expressions. A larger scan has splits enough and stays as it is,
    without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame) -> DataFrame:
    """df dealt out to all cores, whatever its splits: for narrow rows before work that costs far more
    than their shuffle. A file's splits may be as many as the cores and its rows all in one of them
    (one row group), which the number of splits does not tell."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def settled(df: DataFrame) -> DataFrame:
    """df computed once, for plans that read it more than once and must get the same rows: what a
    model said, what range a row fell in. Written under the session's checkpoint folder, which
    outlives executors; where none is named (as in tests) kept by the executors."""
    return df.checkpoint() if df.sparkSession.conf.get("spark.checkpoint.dir", None) else df.persist()
