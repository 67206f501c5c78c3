"""What was known at a cut: titles, labels, flaky checks; JSON by pointer; one temperature for all groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import documents, pit
from .components import cut_lineage, dealt

DAY = 86_400


def title_at(t: Column, tie: Column, old: Column, new: Column, cut: Column) -> Column:
    """Aggregate over a key's renames: what the last one up to the cut gave, or what the first one of all took away."""
    last = F.max(F.when(t <= cut, F.struct(t.alias("t"), tie.alias("tie"), new.alias("title"))))
    first = F.min(F.struct(t.alias("t"), tie.alias("tie"), old.alias("title")))
    return F.coalesce(last["title"], first["title"])


def labels_at(events: DataFrame, key: str, label: str, t: str, state: str, on: str, cut: Column) -> DataFrame:
    """(key, labels) of the labels whose last event up to the cut is ``on``, sorted and joined by commas; keys without one are absent."""
    last = events.where(F.col(t) <= cut).groupBy(key, label).agg(F.max(F.struct(t, state))[state].alias("_s"))
    return last.where(F.col("_s") == on).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(F.col(label).cast("string"))), ",").alias("labels"))


def flaky_failures(failures: DataFrame, passes: DataFrame, keys: list[str], at: str, passed_at: str, least: int = 3, days: int = 90) -> DataFrame:
    """``failures`` with ``is_flaky``: its check passed on a rerun ``least`` times in the ``days`` before, the moment itself left out."""
    got = pit.prior(failures, keys, at, passed_at, {"_passes": (F.lit(1), days * DAY)}, events=passes, bucket=pit.BUCKET)
    return got.withColumn("is_flaky", F.coalesce(F.col("_passes") >= least, F.lit(False))).drop("_passes")


def flatten_json(docs: DataFrame, keys: list[str], column: str, depth: int | None = None) -> DataFrame:
    """(keys, pointer, value) of the leaves of JSON text: scalars as text, empty objects and arrays, and, with a ``depth``,
    what lies deeper as JSON text; a JSON null has a null value. Text that is no JSON, or null, is a row without a pointer.

    Without a ``depth``, levels are taken until nothing nests. With one they are one plan, of an outer explode each.
    """
    if depth is None:
        return documents.flatten(docs, keys, column).select(*keys, "pointer", F.parse_json("json").cast("string").alias("value"))
    spark = docs.sparkSession
    root = F.try_parse_json(column)
    at = docs.select(*keys, F.when(root.isNotNull(), F.lit("")).alias("pointer"), root.alias("_v"))
    for _ in range(depth):
        part = spark.tvf.variant_explode_outer(F.col("_v").outer()).toDF("_pos", "_key", "_part")
        escaped = F.replace(F.replace("_key", F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
        deeper = F.concat("pointer", F.lit("/"), F.coalesce(escaped, F.col("_pos").cast("string")))
        at = at.lateralJoin(part).select(*keys, F.coalesce(deeper, "pointer").alias("pointer"), F.coalesce("_part", "_v").alias("_v"))
    return at.select(*keys, "pointer", F.col("_v").cast("string").alias("value"))


def best_temperature(df: DataFrame, p: list[str], y: str, group: str, grid: list[float]) -> DataFrame:
    """(temperature, brier) of the grid with the smallest mean over groups of their mean Brier loss; ties to the earlier one.

    Probabilities are raised to 1 / temperature and made to add up to 1 again. All candidates are one aggregate.
    """

    def loss(temperature: float) -> Column:
        q = [F.pow(c, F.lit(1 / temperature)) for c in p]
        total = sum(q[1:], q[0])
        each = [F.pow(v / total - (F.col(y) == i).cast("double"), F.lit(2)) for i, v in enumerate(q)]
        return sum(each[1:], each[0])

    groups = df.groupBy(group).agg(*[F.avg(loss(g)).alias(f"b{i}") for i, g in enumerate(grid)])
    means = groups.agg(*[F.avg(f"b{i}").alias(f"b{i}") for i in range(len(grid))])
    all_ = F.array(*[F.struct(F.col(f"b{i}").alias("brier"), F.lit(i).alias("i"), F.lit(g).alias("temperature")) for i, g in enumerate(grid)])
    return means.select(F.array_min(all_).alias("_b")).select("_b.temperature", "_b.brier")


def rename_closure(renames: DataFrame, starts: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(root, node): the roots themselves and all that (u, v) renames make of them; only new pairs go on, so cycles end.

    Pairs are dealt by their number, counted as they are checkpointed.
    """
    e = cut_lineage(renames.select("u", "v").where("u is not null and v is not null").distinct())
    seen = cut_lineage(starts.select(F.col("root"), F.col("root").alias("node")).where("root is not null").distinct())
    front, n = seen, seen.count()
    for _ in range(max_rounds):
        made = front.join(e, F.col("node") == F.col("u")).select("root", F.col("v").alias("node"))
        both = made.withColumn("_new", F.lit(True)).unionAll(seen.withColumn("_new", F.lit(False)))
        front = cut_lineage(dealt(both, n, "root", "node").groupBy("root", "node").agg(F.bool_and("_new").alias("_new")).where("_new").drop("_new"))
        new = front.count()
        if not new:
            return seen
        seen, n = cut_lineage(seen.unionAll(front)), n + new
    raise RuntimeError(f"chains still grew after {max_rounds} rounds")


def distinct_reached(rows: DataFrame, key: str, root: str, reached: DataFrame) -> DataFrame:
    """(key, n): how many nodes of ``reached`` (root, node) a key's ``rows`` reach in all, each once; keys that reach none are absent.

    Rows are dealt by root and then by key, by the number of rows and of nodes a root on average, so neither exchange grows a task.
    """
    n, pairs = rows.count(), reached.agg(F.count("*"), F.countDistinct("root")).first()
    wide = n * -(-pairs[0] // max(1, pairs[1]))
    met = dealt(rows.select(key, root), n, root).join(dealt(reached.select(F.col("root").alias("_root"), "node"), n, "_root"), F.col(root) == F.col("_root"))
    return dealt(met.select(key, "node"), wide, key).groupBy(key).agg(F.countDistinct("node").alias("n"))
