"""Profiles of number columns from counts of their values, and what a file's past says of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import order_stats, pit

DAY = 86_400


def feature_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, filled, kind, n_distinct, top_share, zero_share, median, p99, skew) of each column.

    Shares of top value and zero are of the rows that have a value; ``kind``: empty, constant, binary, whole or real; skew is
    corrected for bias, null with fewer than three rows or without spread. All columns are one relation of counts by value,
    so no column is sorted whole in one task.
    """
    total = df.count()
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])).alias("_c")).select("_c.*")
    counts = cells.where("value is not null").groupBy("column", "value").agg(F.count("*").alias("c"))
    c, x = F.col("c"), F.col("value")
    basic = counts.groupBy("column").agg(
        F.sum("c").alias("n"), F.count("*").alias("n_distinct"), F.max("c").alias("top"), F.sum(F.when(x == 0, c).otherwise(0)).alias("zeros"),
        F.bool_and(x == F.floor(x)).alias("whole"), (F.sum(c * x) / F.sum("c")).alias("mean"),
    )
    d = x - F.col("mean")
    moments = counts.join(basic.select(F.col("column").alias("_k"), "mean"), F.col("column") == F.col("_k")).groupBy("column").agg(F.sum(c * d * d).alias("m2"), F.sum(c * d * d * d).alias("m3"))
    edges = order_stats.quantiles(cells.where("value is not null"), ["column"], "value", [0.5, 0.99])
    n = F.col("n")
    skew = F.when((n > 2) & (F.col("m2") > 0), F.sqrt(n * (n - 1.0)) / (n - 2) * (F.col("m3") / n) / F.pow(F.col("m2") / n, F.lit(1.5)))
    kind = F.when(F.col("n_distinct") == 1, "constant").when(F.col("n_distinct") == 2, "binary").when(F.col("whole"), "whole").otherwise("real")
    told = basic.join(moments, "column").join(edges, "column").select(
        F.col("column").alias("_name"), (n / F.lit(float(max(total, 1)))).alias("filled"), kind.alias("kind"), "n_distinct", (F.col("top") / n).alias("top_share"), (F.col("zeros") / n).alias("zero_share"),
        F.col("edges")[0].alias("median"), F.col("edges")[1].alias("p99"), skew.alias("skew"),
    )
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "column string").join(told, F.col("column") == F.col("_name"), "left").drop("_name")
    return every.withColumns({"filled": F.coalesce("filled", F.lit(0.0)), "kind": F.coalesce("kind", F.lit("empty")), "n_distinct": F.coalesce("n_distinct", F.lit(0))})


def file_history(changes: DataFrame, path: str, at: str, churn: Column, failed: Column) -> DataFrame:
    """``changes`` with n_before, churn_7d, churn_90d, fail_rate and age_days from the path's changes strictly before.

    ``fail_rate``: of earlier changes whose ``failed`` is known, null without any; ``age_days``: since the latest one, null without.
    """
    sums = {
        "n_before": (F.lit(1), None), "churn_7d": (churn, 7 * DAY), "churn_90d": (churn, 90 * DAY), "_known": (failed.isNotNull().cast("int"), None), "_failed": (failed.cast("int"), None),
    }
    got = pit.prior(changes, [path], at, at, sums, last="_gap")
    made = {"fail_rate": F.when(F.col("_known") > 0, F.col("_failed") / F.col("_known")), "age_days": F.col("_gap") / DAY}
    return got.withColumns(made).drop("_known", "_failed", "_gap")
