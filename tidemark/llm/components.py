"""Connected components by alternating star contraction, as joins and aggregates.

Edges never reach the driver. Each round a node's edges are re-pointed at its
smallest neighbour; hubs are met by partial aggregates and by joins that
adaptive execution can split, never by collecting a node's neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to its smallest neighbour (or itself)."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours, and itself, to the smallest of them. Edges run from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, v) long pairs -> (node, component): the smallest node reachable, for each node of a pair u <> v.

    Null ends and loops are ignored, repeated and reversed pairs count once; no pairs give no rows.
    Raises if the contraction has not settled after ``max_rounds`` (it takes about log2 of the longest chain).
    """
    now = materialize(
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    before = _digest(now)
    if before[0]:
        for _ in range(max_rounds):
            now = materialize(_small_star(_large_star(now)))
            after = _digest(now)
            if after == before:
                break
            before = after
        else:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
