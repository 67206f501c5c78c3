"""Redundant columns: rank correlations of all pairs of columns from one block Gram sum, and clusters above a threshold."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import min_label_components
from .order_stats import value_ranks


def centred_ranks(rows: DataFrame, row_id: str, columns: list[str]) -> DataFrame:
    """(row_id, ranks): average ranks of the columns less their mean, null where a column is null; all columns are ranked in one go."""
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("column"), F.col(c).cast("double").alias("value")) for i, c in enumerate(columns)])).alias("_c")
    long_ = rows.select(row_id, cells).select(row_id, "_c.*").where("value is not null")
    r = value_ranks(long_, ["column"], "value").select(F.col("column").alias("_k"), F.col("value").alias("_v"), (F.col("n_less") + (F.col("n_equal") - F.col("n")) / 2).alias("rank"))
    ranked = long_.join(r, (F.col("column") == F.col("_k")) & (F.col("value") == F.col("_v")))
    return ranked.groupBy(row_id).agg(F.array(*[F.max(F.when(F.col("column") == i, F.col("rank"))) for i in range(len(columns))]).alias("ranks"))


def rank_correlations(rows: DataFrame, row_id: str, columns: list[str]) -> DataFrame:
    """(a, b, n, rho) for each pair of columns, a before b in ``columns``: correlation of their ranks over the rows that have both.

    Each task adds up products of its rows as matrices over all pairs; the sums are as many as pairs. Null without variance.
    """
    k = len(columns)
    names = ["n", "sa", "sb", "saa", "sbb", "sab"]

    def gram(batches):
        sums = np.zeros((6, k, k))
        for batch in batches:
            flat = batch.column("ranks").flatten()
            x = np.where(flat.is_null().to_numpy(zero_copy_only=False), np.nan, flat.fill_null(0.0).to_numpy(zero_copy_only=False)).reshape(-1, k)
            have = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            for at, (left, right) in enumerate(((have, have), (x, have), (have, x), (x * x, have), (have, x * x), (x, x))):
                sums[at] += left.T @ right
        i, j = np.triu_indices(k, 1)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *[pa.array(s[i, j]) for s in sums]], names=["i", "j", *names])

    parts = centred_ranks(rows, row_id, columns).select("ranks").mapInArrow(gram, "i int, j int, " + ", ".join(f"{c} double" for c in names))
    s = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in names])
    n = F.col("n")
    va, vb = n * F.col("saa") - F.col("sa") * F.col("sa"), n * F.col("sbb") - F.col("sb") * F.col("sb")
    rho = F.when((va > 0) & (vb > 0), (n * F.col("sab") - F.col("sa") * F.col("sb")) / F.sqrt(va) / F.sqrt(vb))
    name = F.array(*map(F.lit, columns))
    return s.select(F.element_at(name, F.col("i") + 1).alias("a"), F.element_at(name, F.col("j") + 1).alias("b"), n.cast("long").alias("n"), rho.alias("rho"))


def redundant_clusters(pairs: DataFrame, signals: DataFrame, threshold: float) -> DataFrame:
    """(keep, could_drop, size) of groups of columns linked by |rho| >= threshold: (a, b, rho) and (column, signal).

    The column with the greatest signal stays, of equal ones the first by name; a missing signal counts as 0.
    """
    links = pairs.where(F.abs("rho") >= threshold).select(F.col("a").alias("u"), F.col("b").alias("v"))
    members = min_label_components(links).join(signals.select(F.col("column").alias("node"), "signal"), "node", "left")
    order = Window.partitionBy("component").orderBy(F.coalesce("signal", F.lit(0.0)).desc(), "node")
    ranked = members.withColumn("_r", F.row_number().over(order))
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_r", "node"))), lambda s: s["node"]), ", ")
    return ranked.groupBy("component").agg(F.min_by("node", "_r").alias("keep"), listed.alias("_all"), F.count("*").alias("size")).select(
        "keep", F.expr("substring(_all, length(keep) + 3)").alias("could_drop"), "size"
    )
