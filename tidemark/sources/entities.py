"""The engine's entities over the star-schema test tables: pull requests, file changes, timelines, predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = 86_400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seconds(column: str):
    """Whole epoch seconds (UTC) of a timestamp with or without zone."""
    return F.unix_seconds(F.col(column).cast("timestamp"))


def pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: repository (nation), author (customer, every tenth unknown), times in seconds, outcome."""
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    people = customer.select("c_custkey", "c_nationkey").join(nation.select("n_nationkey", F.lower("n_name").alias("repo")), F.col("c_nationkey") == F.col("n_nationkey"))
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    opened = seconds("o_orderdate") + k % DAY
    return orders.join(people, F.col("o_custkey") == F.col("c_custkey")).select(
        "repo",
        k.alias("pr_number"),
        F.when(c % 10 != 0, c).alias("author_key"),
        opened.alias("t_open"),
        F.when(k % 13 != 0, opened + ((k * 7919) % 120) * DAY + c).alias("t_close"),
        F.when(F.col("o_orderstatus") == "F", "clean").when(F.col("o_orderstatus") == "O", "rework").otherwise("nowhere").alias("y"),
        F.floor(F.col("o_totalprice").cast("double") / 100).cast("long").alias("la"),
        (k % 400).cast("long").alias("ld"),
        F.when(k % 10 == 0, "final").when(k % 10 <= 2, "recovered").otherwise("exact").alias("open_snapshot"),
        (c % 17 == 0).alias("is_bot"),
        F.col("o_orderpriority").alias("priority"),
        F.when(k % 5 != 0, k % 7 == 0).alias("label_bad"),
        (k % 3 != 0).alias("label_bad_observed"),
    )


PR_SQL = """
pr as (
  select lower(n_name) as repo, o_orderkey as pr_number, case when o_custkey % 10 <> 0 then o_custkey end as author_key,
    cast(floor(epoch(o_orderdate)) as bigint) + o_orderkey % 86400 as t_open,
    case when o_orderkey % 13 <> 0 then cast(floor(epoch(o_orderdate)) as bigint) + o_orderkey % 86400 + ((o_orderkey * 7919) % 120) * 86400 + o_custkey end as t_close,
    case o_orderstatus when 'F' then 'clean' when 'O' then 'rework' else 'nowhere' end as y,
    cast(floor(cast(o_totalprice as double) / 100) as bigint) as la, o_orderkey % 400 as ld,
    case when o_orderkey % 10 = 0 then 'final' when o_orderkey % 10 <= 2 then 'recovered' else 'exact' end as open_snapshot,
    o_custkey % 17 = 0 as is_bot, o_orderpriority as priority,
    case when o_orderkey % 5 <> 0 then o_orderkey % 7 = 0 end as label_bad, o_orderkey % 3 <> 0 as label_bad_observed
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
)"""


def file_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed files by pull request, repeated lines of a part added up."""
    lines = table(spark, sf_dir, "lineitem")
    return (
        lines.select(F.col("l_orderkey").alias("pr_number"), F.col("l_partkey").alias("path_id"), F.col("l_quantity").cast("long").alias("added"), F.round(F.col("l_tax").cast("double") * 100).cast("long").alias("deleted"))
        .groupBy("pr_number", "path_id").agg(F.sum("added").alias("added"), F.sum("deleted").alias("deleted"))
    )


FILES_SQL = """
fc as (
  select l_orderkey as pr_number, l_partkey as path_id, cast(sum(cast(l_quantity as bigint)) as bigint) as added,
    cast(sum(cast(round(cast(l_tax as double) * 100) as bigint)) as bigint) as deleted
  from lineitem group by 1, 2
)"""


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a timeline: pr (user), kind, t in seconds, amount."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("pr"), F.col("event_type").alias("kind"), seconds("ts").alias("t"), F.col("value").alias("amount"))


TIMELINE_SQL = "tl as (select user_id as pr, event_type as kind, cast(floor(epoch(ts)) as bigint) as t, value as amount from events)"


def predictions(spark: SparkSession, sf_dir: str, *also: str) -> DataFrame:
    """Three-class probabilities made by arithmetic on the key; true class as 0 clean, 1 rework, 2 nowhere; ``also`` further columns of the pull requests."""
    k = F.col("pr_number")
    w = [(1 + (k * 7919 + (i + 1) * 104729) % 1000).cast("double") for i in range(3)]
    total = w[0] + w[1] + w[2]
    y = F.when(F.col("y") == "clean", 0).when(F.col("y") == "rework", 1).otherwise(2)
    return pull_requests(spark, sf_dir).select("repo", "pr_number", "la", "ld", y.alias("y"), *[(w[i] / total).alias(f"p{i}") for i in range(3)], *also)


PREDICTION_SQL = f"""{PR_SQL}, w as (
  select *, cast(1 + (pr_number * 7919 + 104729) % 1000 as double) as w0, cast(1 + (pr_number * 7919 + 209458) % 1000 as double) as w1,
    cast(1 + (pr_number * 7919 + 314187) % 1000 as double) as w2 from pr
), pred as (
  select repo, pr_number, la, ld, case y when 'clean' then 0 when 'rework' then 1 else 2 end as y,
    w0 / (w0 + w1 + w2) as p0, w1 / (w0 + w1 + w2) as p1, w2 / (w0 + w1 + w2) as p2 from w
)"""
