"""Ranks, quantiles and bins by ranges against plain Python; sharding, folds, redundancy, the stage cache."""

import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import lifecycle, order_stats, redundancy
from tidemark.sources.stage_cache import StageCache, content_digest


@pytest.fixture(scope="module")
def cells():
    r = random.Random(1)
    rows = [(i, r.choice(["a", "a", "a", "b", None]), r.choice([None, *range(12)])) for i in range(400)]
    return [*rows, (400, "one", 5), (401, "same", 7), (402, "same", 7), (403, "void", None)]


def by_key(cells):
    out = {}
    for i, k, v in cells:
        out.setdefault(k, []).append((i, v))
    return out


def test_ranks_and_bins_match_pandas(spark, cells):
    rows = spark.createDataFrame(cells, "i long, k string, v int")
    ranks = {r["i"]: r["r"] for r in order_stats.average_ranks(rows, ["k"], "v", "r").collect()}
    bins = {r["i"]: r["b"] for r in order_stats.quantile_bins(rows, ["k"], "v", 4, "b").collect()}
    edges = {r["k"]: r["edges"] for r in order_stats.quantiles(rows, ["k"], "v", [0.0, 0.1, 0.5, 0.99, 1.0]).collect()}
    known = rows.where("v is not null")
    mass = {r["i"]: r["b"] for r in order_stats.equal_mass_bins(known, ["k"], ["v", "i"], 7, "b").collect()}
    first = {r["i"]: r["b"] for r in order_stats.rank_quantile(known, ["k"], ["v", "i"], 4, "b").collect()}
    for key, own in by_key(cells).items():
        v = pd.Series({i: x for i, x in own if x is not None}, dtype=float)
        assert all(ranks[i] is None and bins[i] is None for i, x in own if x is None)
        if not len(v):
            continue
        assert {i: ranks[i] for i in v.index} == v.rank().to_dict()
        assert np.allclose(edges[key], np.quantile(v, [0, 0.1, 0.5, 0.99, 1]))
        if v.nunique() > 1:
            assert {i: bins[i] - 1 for i in v.index} == pd.qcut(v, 4, labels=False, duplicates="drop").to_dict()
            order = v.reset_index().sort_values([0, "index"])["index"].tolist()
            want = {i: b + 1 for b, part in enumerate(np.array_split(order, 7)) for i in part}
            assert {i: mass[i] for i in v.index} == want
            place = pd.Series(range(1, len(order) + 1), index=order)
            assert {i: first[i] - 1 for i in v.index} == pd.qcut(place, 4, labels=False).to_dict()
        else:
            assert all(bins[i] is None for i in v.index)
    none = rows.where("false")
    assert order_stats.average_ranks(none, ["k"], "v", "r").count() == order_stats.quantile_bins(none, ["k"], "v", 4, "b").count() == order_stats.positions(none, [], ["v", "i"]).count() == 0


def test_a_busy_key_is_spread_over_tasks(spark):
    rows = spark.range(200_000).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % 200_003).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = order_stats.positions(rows, ["k"], ["v"]).withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.count("*").alias("n"), F.min("_at").alias("a"), F.max("_at").alias("b")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["n"] for r in placed) == 200_000 and max(r["n"] for r in placed) < 150_000 and max(r["b"] for r in placed) == 199_999


def test_shards_run_forth_and_back(spark):
    units = spark.createDataFrame([("a", 90), ("b", 50), ("c", 40), ("d", None), ("e", 10), ("f", 0), ("g", 10)], "u string, w int")
    got = {r["u"]: r["shard"] for r in order_stats.snake_shards(units, "u", "w", 3).collect()}
    assert got == {"a": 0, "b": 1, "c": 2, "e": 2, "g": 1, "d": 0, "f": 0}
    many = spark.range(100).select("id", (F.col("id") * 37 % 101).alias("w"))
    for seed in (None, "x"):
        dealt = order_stats.snake_shards(many, "id", "w", 8, "shard", seed).join(many, "id").collect()
        counts, totals = Counter(r["shard"] for r in dealt), Counter()
        for r in dealt:
            totals[r["shard"]] += r["w"]
        assert max(counts.values()) - min(counts.values()) <= 1 and max(totals.values()) - min(totals.values()) <= (100 if seed is None else 260)
    assert order_stats.snake_shards(units.where("false"), "u", "w", 3).count() == 0


def test_publish_problems(spark):
    t = spark.createDataFrame([(1, None), (2, None)], "a long, b string")
    contract = spark.createDataFrame([("t", "a", "int"), ("t", "b", "string"), ("t", "c", "string")], "table string, column string, type string")
    manifest = spark.createDataFrame([("t", 3)], "table string, n_rows long")
    got = {(r["table"], r["column"], r["problem"]) for r in lifecycle.publish_problems({"t": t, "u": t.where("false")}, contract, manifest).collect()}
    assert got == {("t", "a", "type"), ("t", "b", "empty"), ("t", "c", "missing"), ("t", None, "rows"), ("u", "a", "unexpected"), ("u", "b", "unexpected"), ("u", None, "unlisted")}


def test_redundant_columns_match_pandas(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=300)
    frame = pd.DataFrame({"a": x, "b": -(x**3), "c": r.normal(size=300), "d": x + r.normal(size=300) * 0.05, "e": np.where(r.random(300) < 0.3, np.nan, np.round(x, 1)), "f": 1.0})
    rows = spark.createDataFrame(frame.reset_index()).selectExpr("index", "a", "b", "c", "d", "nanvl(e, null) as e", "f")
    columns = list("abcdef")
    got = {(r["a"], r["b"]): r["rho"] for r in redundancy.rank_correlations(rows, "index", columns).collect()}
    ranks = frame.rank()
    for i, a in enumerate(columns):
        for b in columns[i + 1 :]:
            want = ranks[a].corr(ranks[b])
            assert got[a, b] is None if np.isnan(want) else abs(got[a, b] - want) < 1e-9
    pairs = redundancy.rank_correlations(rows, "index", columns)
    signals = spark.createDataFrame([("d", 3.0), ("a", 1.0), ("b", 3.0)], "column string, signal double")
    assert [tuple(r) for r in redundancy.redundant_clusters(pairs, signals, 0.9).collect()] == [("b", "d, a, e", 4)]
    assert redundancy.redundant_clusters(pairs, signals, 1.5).count() == 0


def test_stage_cache(spark, tmp_path):
    cache = StageCache(spark, str(tmp_path / "cache"))
    one = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "a long, b string")
    calls = []

    def build(rows):
        calls.append(1)
        return rows.groupBy("a").count()

    first, was_there = cache.run("counts", {"rows": one}, build, {"k": 1})
    again, is_there = cache.run("counts", {"rows": one.repartition(3)}, build, {"k": 1})
    assert not was_there and is_there and len(calls) == 1 and sorted(map(tuple, again.collect())) == sorted(map(tuple, first.collect())) == [(1, 1), (2, 2)]
    # one row, a repeated row, a type, a name or a setting more, and it is worked out again
    others = [one.where("b is not null"), one.unionAll(one.limit(1)), one.withColumn("a", F.col("a").cast("int")), one.withColumnRenamed("b", "c"), one.withColumn("b", F.lit(None).cast("string"))]
    assert len({content_digest(df) for df in [one, *others]}) == 6
    assert not cache.run("counts", {"rows": others[0]}, build, {"k": 1})[1] and not cache.run("counts", {"rows": one}, build, {"k": 2})[1] and not cache.run("counts", {"rows": one}, build, {"k": 1}, version=2)[1]

    def fails(rows):
        return rows.select(F.raise_error(F.lit("no")).alias("x"))

    for _ in range(2):
        with pytest.raises(Exception, match="no"):
            cache.run("broken", {"rows": one}, fails)
    assert not list((tmp_path / "cache" / "broken").glob("*.json")) and not list((tmp_path / "cache" / "broken").glob("data-*"))
    entry = next((tmp_path / "cache" / "counts").glob("*.json"))
    for torn in ('{"format": 1, "key"', '[]', '{"format": 1, "key": "other", "folder": "x"}'):
        (tmp_path / "cache" / "counts" / f".{entry.name}.crc").unlink(missing_ok=True)
        entry.write_text(torn)
        assert cache.find("counts", entry.stem) is None
