"""Longer histories: rolling medians, sequences, reachability, keyed differences, activity spines, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import cut_lineage


def last_values(rows: DataFrame, key: str, at: str, event: str, value: Column, tie: Column, k: int, name: str, events: DataFrame | None = None) -> DataFrame:
    """``rows`` with an array of the last ``k`` strictly earlier values of the key, oldest first. Unknown keys get null.

    Events are numbered in the order of their key, and a row has the number of events before it; a frame over numbers then
    holds the last k, so lists are made beside their rows and never shuffled. A key is one task.
    """
    source = rows if events is None else events
    own = source.where(F.col(key).isNotNull() & F.col(event).isNotNull()).select(F.col(key).alias("_key"), F.lit(0).cast("long").alias("_s"), F.col(event).cast("long").alias("_x"), F.lit(1).alias("_e"), tie.alias("_t"), value.alias("_v"))
    # rows that ask nothing are dealt by their tie or time
    known = F.col(key).isNotNull() & F.col(at).isNotNull()
    hashed = [c for c, t in rows.dtypes if "map<" not in t and "variant" not in t]
    spare = F.when(known, F.lit(0).cast("long")).otherwise(1 + F.pmod(F.xxhash64(*hashed), F.lit(10_000)))
    put = own.unionByName(rows.select(F.col(key).alias("_key"), spare.alias("_s"), F.col(at).cast("long").alias("_x"), F.lit(0).alias("_e"), F.struct(*rows.columns).alias("_row")), allowMissingColumns=True)
    line = Window.partitionBy("_key", "_s")
    # at one second rows come before events, so none of these is seen
    numbered = put.withColumn("_i", F.sum("_e").over(line.orderBy("_x", "_e", "_t").rowsBetween(Window.unboundedPreceding, 0)))
    last = F.collect_list("_v").over(line.orderBy("_i").rangeBetween(-(k - 1), 0))
    return numbered.withColumn(name, F.when(F.col("_key").isNotNull(), last)).where("_row is not null").select("_row.*", name)


def middle(values: Column) -> Column:
    """Median of an array; null if it is empty."""
    s, n = F.sort_array(values), F.size(values)
    return F.when(n > 0, (F.get(s, ((n - 1) / 2).cast("int")) + F.get(s, (n / 2).cast("int"))) / 2.0)


def reachable(edges: DataFrame, seeds: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node) reached from the seeds over (u, v) edges, seeds included; a frontier of new nodes only, so cycles end."""
    e = edges.select("u", "v").where("u is not null and v is not null").distinct()
    seen = cut_lineage(seeds.select("node").where("node is not null").distinct())
    front = seen
    for _ in range(max_rounds):
        front = cut_lineage(front.join(e, F.col("node") == F.col("u")).select(F.col("v").alias("node")).distinct().join(seen, "node", "left_anti"))
        if not front.limit(1).count():
            return seen
        seen = cut_lineage(seen.unionAll(front))
    raise RuntimeError(f"the frontier still grew after {max_rounds} rounds")


def keyed_diff(base: DataFrame, head: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, change): added, removed, raised or lowered; unchanged keys are left out, an unknown value gives null."""
    b = base.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(value).alias("_was"), F.lit(1).alias("_b"))
    on = [F.col(k) == F.col(f"_{k}") for k in keys]
    j = head.select(*keys, value, F.lit(1).alias("_h")).join(b, on, "full_outer")
    change = F.when(F.col("_b").isNull(), "added").when(F.col("_h").isNull(), "removed").when(F.col(value) > F.col("_was"), "raised").when(F.col(value) < F.col("_was"), "lowered")
    same = F.col("_b").isNotNull() & F.col("_h").isNotNull() & (F.col(value) == F.col("_was"))
    return j.where(~F.coalesce(same, F.lit(False))).select(*[F.coalesce(k, f"_{k}").alias(k) for k in keys], change.alias("change"))


def activity(events: DataFrame, key: str, t: str, block: int) -> DataFrame:
    """(key, block, n) for every block between a key's first and last event; blocks without events have n = 0."""
    found = events.groupBy(key, (F.floor(F.col(t) / block) * block).alias("block")).agg(F.count("*").alias("n"))
    spine = found.groupBy(key).agg(F.min("block").alias("_a"), F.max("block").alias("_b")).select(key, F.explode(F.sequence("_a", "_b", F.lit(block).cast("long"))).alias("block"))
    return spine.join(found, [key, "block"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def stratified_sample(rows: DataFrame, stratum: str, key: Column, n: int) -> DataFrame:
    """The ``n`` rows of each stratum whose hashed key is smallest; the same rows on every run."""
    w = Window.partitionBy(stratum).orderBy(F.sha2(key.cast("string"), 256))
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def survival(rows: DataFrame, group: str, age: str, at: list[int]) -> DataFrame:
    """(group, age, alive): share of a group's rows older than each age, at least half a row."""
    counts = rows.groupBy(group).agg(F.array(*[F.struct(F.lit(a).cast("long").alias("age"), F.count_if(F.col(age) > a).alias("left"), F.count("*").alias("n")) for a in at]).alias("_g"))
    return counts.select(group, F.explode("_g").alias("_x")).select(group, "_x.age", (F.greatest(F.col("_x.left").cast("double"), F.lit(0.5)) / F.col("_x.n")).alias("alive"))


def open_segments(events: DataFrame, key: str, t: str, opens: list[str], closes: list[str]) -> DataFrame:
    """(key, start, end): from each opening that follows a closing (or nothing) to the next closing; open ends are null."""
    w = Window.partitionBy(key).orderBy(t, "kind")
    kind = F.col("kind")
    side = events.where(kind.isin(*opens, *closes)).withColumn("_open", kind.isin(*opens))
    turns = side.withColumn("_was", F.lag("_open").over(w)).where(F.col("_open") != F.coalesce("_was", F.lit(False)))
    return turns.withColumn("end", F.lead(t).over(w)).where("_open").select(key, F.col(t).alias("start"), "end")
