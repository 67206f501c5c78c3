"""Exact ranks, quantiles and bins of busy keys: two passes over ranges of (key, value), no window over a whole key.

Values are counted, dealt into ranges of (key, value) and summed up within a range; what earlier ranges of the key hold is
carried in from one row a range and key. So a key of any size is spread over tasks. Null values have no rank; keys may
be null and are then a key of their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import cut_lineage
from .profile import hash_share


def _same(keys: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys], F.lit(True))


def _carried(ranged: DataFrame, keys: list[str], order: list, amount: Column) -> DataFrame:
    """``ranged`` (rows of ranges ``_part``) with ``_less``: amounts before a row in its key, and ``_total``: of its key."""
    here = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("_part", *keys).agg(F.sum(amount).alias("_sum"))
    key = Window.partitionBy(*keys)  # one row a range
    before = F.coalesce(F.sum("_sum").over(key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    carry = parts.select(F.col("_part").alias("_p_part"), *[F.col(k).alias(f"_p_{k}") for k in keys], before.alias("_before"), F.sum("_sum").over(key).alias("_total"))
    local = ranged.withColumn("_local", F.coalesce(F.sum(amount).over(here), F.lit(0)))
    met = local.join(carry, (F.col("_part") == F.col("_p_part")) & _same(keys, "_p_"))
    return met.withColumn("_less", F.col("_before") + F.col("_local")).drop("_p_part", "_before", "_local", *[f"_p_{k}" for k in keys])


def value_ranks(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, n_less, n_equal, n): for each distinct value of a key, how many rows of the key are below it, equal it, and in all."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n_equal"))
    ranged = cut_lineage(counts.repartitionByRange(*keys, value).withColumn("_part", F.spark_partition_id()))
    return _carried(ranged, keys, [value], F.col("n_equal")).select(*keys, value, F.col("_less").alias("n_less"), "n_equal", F.col("_total").alias("n"))


def positions(rows: DataFrame, keys: list[str], order: list[str], at: str = "_at", n: str = "_n") -> DataFrame:
    """``rows`` with their place from 0 in the order of their key, and the number of its rows; ``order`` should have no ties."""
    ranged = cut_lineage(rows.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()))
    return _carried(ranged, keys, order, F.lit(1)).select(*rows.columns, F.col("_less").alias(at), F.col("_total").alias(n))


def average_ranks(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``rows`` with the mean of the places from 1 that rows with this value of the key take; null values get null."""
    ranks = value_ranks(rows, keys, value).select(*[F.col(k).alias(f"_q_{k}") for k in [*keys, value]], (F.col("n_less") + (F.col("n_equal") + 1) / 2).alias(name))
    return rows.join(ranks, _same(keys, "_q_") & (F.col(value) == F.col(f"_q_{value}")), "left").select(*rows.columns, name)


def quantiles(rows: DataFrame, keys: list[str], value: str, shares: list[float], name: str = "edges") -> DataFrame:
    """(keys, edges): quantiles of the key's values at ``shares``, with linear interpolation between neighbours."""
    ranks = value_ranks(rows, keys, value)
    at = F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(p) * (F.col("n") - 1)).alias("x")) for i, p in enumerate(shares)])

    def inside(place: Column) -> Column:
        return (place >= F.col("n_less")) & (place < F.col("n_less") + F.col("n_equal"))

    wanted = F.filter(at, lambda p: inside(F.floor(p["x"])) | inside(F.ceil(p["x"])))
    met = ranks.select(*keys, F.col(value).cast("double").alias("_v"), "n_less", "n_equal", F.explode(wanted).alias("_p"))
    low, high = (F.max(F.when(inside(f("_p.x")), F.col("_v"))) for f in (F.floor, F.ceil))
    edges = met.groupBy(*keys, "_p.i").agg(low.alias("_low"), high.alias("_high"), F.first("_p.x").alias("_x"))
    edge = F.col("_low") + (F.col("_high") - F.col("_low")) * (F.col("_x") - F.floor("_x"))
    listed = F.sort_array(F.collect_list(F.struct("i", edge.alias("e"))))  # one of each share
    return edges.groupBy(*keys).agg(F.transform(listed, lambda s: s["e"]).alias(name))


def quantile_bins(rows: DataFrame, keys: list[str], value: str, k: int, name: str) -> DataFrame:
    """``rows`` with the bin from 1 of the value between the key's quantiles at 0, 1/k, ... 1.

    Bins are closed on the right, the lowest value is in the first, and equal edges count once; a null value, or a key
    with a single value, has no bin.
    """
    edges = quantiles(rows, keys, value, [i / k for i in range(k + 1)], "_edges").select(*[F.col(c).alias(f"_q_{c}") for c in keys], F.array_distinct("_edges").alias("_edges"))
    below = F.size(F.filter("_edges", lambda e: e < F.col(value)))
    bin_ = F.when(F.col(value).isNotNull() & (F.size("_edges") > 1), F.greatest(F.lit(1), below))
    return rows.join(edges, _same(keys, "_q_"), "left").withColumn(name, bin_).select(*rows.columns, name)


def rank_quantile(rows: DataFrame, keys: list[str], order: list[str], k: int, name: str) -> DataFrame:
    """``rows`` with the quantile bucket 1..k of their place, edges as of linear interpolation on places."""
    bucket = F.greatest(F.lit(1), F.ceil(F.col("_at") * F.lit(k) / F.greatest(F.col("_n") - 1, F.lit(1)))).cast("int")
    return positions(rows, keys, order).select(*rows.columns, bucket.alias(name))


def equal_mass_bins(rows: DataFrame, keys: list[str], order: list[str], bins: int, name: str) -> DataFrame:
    """``rows`` with the bin from 1 of ``bins`` that hold equally many rows of the key, but for one more in the first ones."""
    at, size = F.col("_at"), F.floor(F.col("_n") / bins)
    many = F.col("_n") % bins  # bins with one more
    wide = many * (size + 1)
    bin_ = F.when(at < wide, F.floor(at / (size + 1))).otherwise(many + F.floor((at - wide) / F.greatest(size, F.lit(1))))
    return positions(rows, keys, order).select(*rows.columns, (bin_ + 1).cast("int").alias(name))


def snake_shards(units: DataFrame, unit: str, weight: str, n: int, name: str = "shard", seed: str | None = None) -> DataFrame:
    """(unit, shard): units in the order of their weights, dealt in rounds that run forth and back over the shards.

    Counts differ by one at most, and totals by no more than the heaviest unit. With a ``seed``, units whose weights have
    as many binary digits are shuffled by its hash. A null weight counts as 0; units are distinct.
    """
    w = F.coalesce(F.col(weight).cast("double"), F.lit(0.0))
    keys = [(-w).alias("_w"), F.lit(0.0).alias("_h")] if seed is None else [(-F.floor(F.log2(w + 1))).cast("double").alias("_w"), hash_share(seed, F.col(unit)).alias("_h")]
    ordered = positions(units.select(unit, *keys), [], ["_w", "_h", unit])
    place, back = F.col("_at") % n, F.floor(F.col("_at") / n) % 2 == 1
    return ordered.select(unit, F.when(back, n - 1 - place).otherwise(place).cast("int").alias(name))


def fold_scores(rows: DataFrame, folds: DataFrame, unit: str, loss: str, outcome: str) -> DataFrame:
    """(fold, n, brier, base_brier, skill): mean loss of each fold's rows, that of always saying the outcome shares of the other
    folds, and 1 less their quotient. One count a fold and outcome is all that meets."""
    cells = rows.join(folds, unit).groupBy("fold", outcome).agg(F.count("*").alias("c"), F.sum(loss).alias("l"))
    all_of = cells.groupBy(outcome).agg(F.sum("c").alias("all_c"))
    size = F.sum("c").over(Window.partitionBy("fold"))
    # outcomes that a fold lacks still have a share elsewhere
    grid = cells.select("fold").distinct().join(all_of.select(outcome), how="cross").join(cells, ["fold", outcome], "left").join(all_of, outcome)  # folds x outcomes
    shares = grid.fillna(0, ["c", "l"]).withColumns({"rest": F.col("all_c") - F.col("c"), "n": size}).withColumn("p", F.col("rest") / F.sum("rest").over(Window.partitionBy("fold")))
    square = F.sum(F.col("p") * F.col("p")).over(Window.partitionBy("fold"))
    base = F.sum(F.col("c") * (F.col("sq") - 2 * F.col("p") + 1)) / F.first("n")
    out = shares.withColumn("sq", square).groupBy("fold").agg(F.first("n").alias("n"), (F.sum("l") / F.first("n")).alias("brier"), base.alias("base_brier"))
    return out.withColumn("skill", 1 - F.col("brier") / F.nullif("base_brier", F.lit(0.0)))
