"""Graph components by min-label propagation over joins, for graphs of units and their heads; checkpoints, dealing rows by their number."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one partition where a step deals them by their number.
ROWS = 250_000


def dealt(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """``df`` by its keys over as many partitions as ``n`` rows need, so that a task holds no more of a large input than of a small one.

    Partitions by number are not merged; merged ones are up to 64 MB as compressed, of which narrow rows take many times that as they are sorted.
    """
    return df.repartition(max(1, -(-n // ROWS)), *keys)


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, set for the session; a local run without one gets a temporary folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-checkpoint-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed once, and later plans start from it."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def min_label_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(u, v) pairs -> (node, component): the smallest node reachable. Each round also follows the labels' own labels."""
    one = edges.where("u is not null and v is not null").select("u", "v").distinct()
    both = cut_lineage(one.unionAll(one.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = cut_lineage(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("l")))
    for _ in range(max_rounds):
        near = both.join(labels.select(F.col("u").alias("v"), "l"), "v").groupBy("u").agg(F.min("l").alias("n"))
        down = labels.join(near, "u").select("u", "l", F.least("l", "n").alias("n"))
        jump = labels.select(F.col("u").alias("n"), F.col("l").alias("j"))
        new = cut_lineage(down.join(jump, "n", "left").select("u", "l", F.least("n", F.coalesce("j", "n")).alias("m")))
        if not new.where("m <> l").limit(1).count():
            return labels.select(F.col("u").alias("node"), F.col("l").alias("component"))
        labels = new.select("u", F.col("m").alias("l"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
