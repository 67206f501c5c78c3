"""Set joins: interval overlap, Jaccard neighbours, closures and consistency checks. Pairs come from equi-joins on elements."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Seconds of a bucket of time in which items of a scope meet.
BUCKET = 90 * 86_400


def _buckets(first, last, bucket: int):
    """The buckets of a span of time; none if it is empty."""
    return F.when(last >= first, F.sequence(F.floor(first / bucket), F.floor(last / bucket)))


#: Items of an element that at most so many have meet without buckets of time, in one bucket of this number.
LIGHT, ONE = 64, -(2**62)


def dealt(light, buckets):
    """The buckets in which an item meets by an element: one if the element is light."""
    return F.when(light, F.array(F.lit(ONE))).otherwise(buckets)


def overlapping(items: DataFrame, elements: DataFrame, scope: str, key: str, element: str, start: str, end: str, bucket: int = BUCKET) -> DataFrame:
    """(key, n): how many other items of the scope were open when this one started and share an element. Open ends never end.

    Items meet by scope, element and bucket of time, each in the buckets that it is open in, so an element of all items
    makes pairs of those of one time only. Rows that meet are reduced to one a pair before others are counted.
    """
    until = items.groupBy(F.col(scope).alias("_u")).agg(F.max(start).alias("_until"))
    known = items.select(scope, key, start, end).join(until, F.col(scope) == F.col("_u")).join(elements.select(key, element).distinct(), key)
    last = F.least(F.coalesce(F.col(end) - 1, F.col("_until")), F.col("_until"))
    other = known.select(F.col(scope).alias("_s"), F.col(element).alias("_e"), F.col(key).alias("_k"), F.col(start).alias("_a"), F.col(end).alias("_b"), F.explode(_buckets(F.col(start), last, bucket)).alias("_t"))
    e = known.select(scope, key, start, element, F.floor(F.col(start) / bucket).alias("_at"))
    same = (F.col(scope) == F.col("_s")) & (F.col(element) == F.col("_e")) & (F.col("_at") == F.col("_t"))
    met = e.join(other, same & (F.col(key) != F.col("_k")) & (F.col("_a") <= F.col(start)) & (F.col("_b").isNull() | (F.col(start) < F.col("_b"))))
    counts = met.select(key, "_k").distinct().groupBy(key).agg(F.count("*").alias("n"))
    return items.select(key).join(counts, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def jaccard_neighbours(items: DataFrame, elements: DataFrame, scope: str, key: str, element: str, at: str, known: str, back: int, lag: int, least: float, k: int, bucket: int = BUCKET) -> DataFrame:
    """The ``k`` most similar items of the scope known in [at - back, at - lag]: (key, neighbour, jaccard, rank).

    Items meet by scope, bucket of time and one of their rarest elements: sets with a Jaccard index of ``least`` share one of
    the first n - ceil(least n) + 1 of each, n its size, in an order by how often elements occur; sizes that are too far
    apart don't meet. So the higher ``least``, the less an element of all items matters. Only elements of more than ``LIGHT``
    items are dealt over buckets. Pairs are then measured whole.
    Ties go to the later, then smaller neighbour.
    """
    own = elements.select(key, element).distinct()
    often = own.groupBy(F.col(element).alias("_f_e")).agg(F.count("*").alias("_f"))
    listed = own.join(often, F.col(element) == F.col("_f_e")).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_f", element))).alias("_all"))  # an item's own elements
    sized = items.select(scope, key, at, known).join(listed, key).withColumns({"_set": F.transform("_all", lambda s: s[element]), "_n": F.size("_all")})
    first = F.slice("_all", F.lit(1), (F.col("_n") - F.ceil(F.lit(least) * F.col("_n") - 1e-9) + 1).cast("int"))
    head = sized.withColumn("_first", F.explode(first)).withColumns({"_e": F.col(f"_first.{element}"), "_light": F.col("_first._f") <= LIGHT})
    asked = head.withColumn("_t", F.explode(dealt(F.col("_light"), _buckets(F.col(at) - back, F.col(at) - lag, bucket)))).drop("_all", "_first", "_light")
    met_at = F.when(F.col("_light"), F.lit(ONE)).otherwise(F.floor(F.col(known) / bucket))
    other = head.where(F.col(known).isNotNull()).select(F.col(scope).alias("_s"), F.col("_e").alias("_o_e"), F.col(key).alias("neighbour"), F.col(known).alias("_known"), F.col("_n").alias("_m"), F.col("_set").alias("_o_set"), met_at.alias("_o_t"))
    same = (F.col(scope) == F.col("_s")) & (F.col("_e") == F.col("_o_e")) & (F.col("_t") == F.col("_o_t")) & (F.col(key) != F.col("neighbour"))
    near = (F.col("_known") >= F.col(at) - back) & (F.col("_known") <= F.col(at) - lag) & (F.least("_n", "_m") >= F.lit(least) * F.greatest("_n", "_m") - 1e-9)
    both = F.size(F.array_intersect("_set", "_o_set"))
    # a pair is taken at the first of the elements by which it meets
    once = F.element_at(F.filter("_set", lambda x: F.array_contains("_o_set", x)), 1) == F.col("_e")
    met = asked.join(other, same & near & once).select(key, "neighbour", "_known", (both / (F.col("_n") + F.col("_m") - both)).alias("jaccard")).where(F.col("jaccard") >= least)
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("jaccard"), F.desc("_known"), "neighbour"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select(key, "neighbour", "jaccard", "rank")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """(n_rows, n_null, n_orphans) of a foreign key."""
    known = parent.select(F.col(parent_key).alias("_p")).distinct()
    lost = child.where(F.col(child_key).isNotNull()).join(known, F.col(child_key) == F.col("_p"), "left_anti").agg(F.count("*").alias("n_orphans"))
    return child.agg(F.count("*").alias("n_rows"), F.count_if(F.col(child_key).isNull()).alias("n_null")).crossJoin(lost)


def stale_keys(copy: DataFrame, origin: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Keys of ``copy`` that ``origin`` lacks, or whose copied columns differ (null equals null)."""
    o = origin.select(*keys, *[F.col(c).alias(f"_{c}") for c in columns])
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    changed = copy.join(o, keys).where(differs).select(*keys)
    return copy.join(origin, keys, "left_anti").select(*keys).unionByName(changed).distinct()


def strong_pairs(elements: DataFrame, key: str, element: str, least: int) -> DataFrame:
    """(element, _o): elements that share at least ``least`` keys, both ways; a pair is counted once, by the smaller of the two."""
    e = elements.select(key, element).distinct()
    o = e.select(F.col(key).alias("_k"), F.col(element).alias("_o"))
    met = e.join(o, (F.col(key) == F.col("_k")) & (F.col(element) < F.col("_o"))).groupBy(element, "_o").agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    ways = F.array(F.struct(F.col(element).alias("a"), F.col("_o").alias("b")), F.struct(F.col("_o").alias("a"), F.col(element).alias("b")))
    return met.select(F.explode(ways).alias("_p")).select(F.col("_p.a").alias(element), F.col("_p.b").alias("_o"))


def co_changes(elements: DataFrame, key: str, element: str, least: int) -> DataFrame:
    """(element, partners): how many elements share at least ``least`` keys with it."""
    return strong_pairs(elements, key, element, least).groupBy(element).agg(F.count("*").alias("partners"))


def compare_inventories(expected: DataFrame, actual: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, difference): missing, unexpected, or the name of the first column that differs."""
    a = actual.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in columns])
    what = F.when(F.col("_key").isNull(), "missing").when(F.col(key).isNull(), "unexpected")
    for c in columns:
        what = what.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), c)
    joined = expected.select(key, *columns).join(a, F.col(key) == F.col("_key"), "full_outer")
    return joined.select(F.coalesce(key, "_key").alias(key), what.alias("difference")).where("difference is not null")
