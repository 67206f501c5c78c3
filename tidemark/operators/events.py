"""Timelines: states at a moment, sessions with priorities, triggers, transcripts, roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def state_at(moments: DataFrame, events: DataFrame, key: str, at: str, t: str, kinds: list[str]) -> DataFrame:
    """For each moment: n_{kind} of the events up to it, and seconds since the latest of any kind (null if none).

    One window over events and moments together; repeated moments of a key are judged alike.
    """
    put = events.select(F.col(key), F.col(t).alias("_x"), F.col("kind").alias("_kind"), F.lit(None).alias("_row")).unionByName(
        moments.select(key, F.col(at).alias("_x"), F.lit(None).cast("string").alias("_kind"), F.struct(*moments.columns).alias("_row"))
    )
    w = Window.partitionBy(key).orderBy("_x").rangeBetween(Window.unboundedPreceding, 0)
    counts = {f"n_{k}": F.count_if(F.col("_kind") == k).over(w) for k in kinds}
    since = F.col("_x") - F.max(F.when(F.col("_kind").isNotNull(), F.col("_x"))).over(w)
    return put.withColumns(counts | {"idle": since}).where("_row is not null").select("_row.*", *counts, "idle")


def debounce(events: DataFrame, key: str, t: str, name: str, priority: Column, gap: int = 1800) -> DataFrame:
    """Events at most ``gap`` after the one before collapse to the last time and the most important name (lowest priority)."""
    w = Window.partitionBy(key).orderBy(t, name)
    new = F.when(F.col(t) - F.lag(t).over(w) <= gap, 0).otherwise(1)
    return (
        events.withColumn("_p", priority).withColumn("_s", new)
        .withColumn("_s", F.sum("_s").over(w))
        .groupBy(key, "_s").agg(F.max(t).alias(t), F.min_by(name, F.struct("_p", name)).alias(name), F.count("*").alias("n")).drop("_s")
    )


def keep_most_important(events: DataFrame, key: str, t: str, priority: Column, cap: int = 6) -> DataFrame:
    w = Window.partitionBy(key).orderBy(priority, t)
    return events.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= cap).drop("_r")


def deltas(events: DataFrame, key: str, t: str, columns: list[str], *tie: str) -> DataFrame:
    """``events`` with d_{column}: the change from the key's event before; those of one moment are in the order of ``tie``."""
    w = Window.partitionBy(key).orderBy(t, *tie)
    return events.withColumns({f"d_{c}": F.col(c) - F.lag(c).over(w) for c in columns})


def transcript(turns: DataFrame, key: str, order: str, role: str, text: str, budget: int) -> DataFrame:
    """(key, n_kept, transcript): the newest turns that fit ``budget`` characters, oldest first, each as role: text."""
    entry = F.concat_ws(": ", role, F.coalesce(text, F.lit("")))
    newest = Window.partitionBy(key).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    kept = turns.withColumn("_e", entry).withColumn("_run", F.sum(F.length("_e")).over(newest)).where(F.col("_run") <= budget)
    return kept.groupBy(key).agg(F.count("*").alias("n_kept"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "_e"))), lambda x: x["_e"]), "\n").alias("transcript"))


def hourly(events: DataFrame, t: str, *by: str) -> DataFrame:
    """Tumbling hours: (by, hour as epoch seconds, n, total, worst)."""
    return events.groupBy(*by, (F.floor(F.col(t) / 3600) * 3600).alias("hour")).agg(F.count("*").alias("n"), F.round(F.sum("amount"), 4).alias("total"), F.max("amount").alias("worst"))


def late_and_future(events: DataFrame, t: str, now: int, late: int = 160 * 3600, ahead: int = 60) -> DataFrame:
    """Drops events older than ``late`` seconds and takes those over ``ahead`` seconds in the future as now."""
    return events.where(F.col(t) >= now - late).withColumn(t, F.when(F.col(t) > now + ahead, F.lit(now)).otherwise(F.col(t)))


def longest_gaps(events: DataFrame, key: str, t: str, n: int) -> DataFrame:
    w = Window.partitionBy(key).orderBy(t)
    return events.withColumn("gap", F.col(t) - F.lag(t).over(w)).where("gap is not null").select(key, t, "gap").orderBy(F.desc("gap"), key, t).limit(n)
