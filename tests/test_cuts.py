"""Titles, labels and checks at a cut, JSON pointers, rename chains, temperatures."""

import json
import random

from pyspark.sql import functions as F

from tidemark.operators import components, cuts


def test_title_before_between_and_after_renames(spark):
    df = spark.createDataFrame([(cut, t, old, new) for cut in (5, 10, 15, 30) for t, old, new in ((10, "a", "b"), (20, "b", "c"))], "cut int, t int, old string, new string")
    got = df.groupBy("cut").agg(cuts.title_at(F.col("t"), F.col("t"), F.col("old"), F.col("new"), F.col("cut")).alias("title"))
    assert {r["cut"]: r["title"] for r in got.collect()} == {5: "a", 10: "b", 15: "b", 30: "c"}


def test_labels_are_those_set_last(spark):
    df = spark.createDataFrame([(1, "x", 1, "on"), (1, "x", 2, "off"), (1, "y", 3, "on"), (1, "z", 9, "on"), (2, "x", 1, "on"), (2, "w", 5, "on"), (3, "x", 9, "on")], "k int, label string, t int, s string")
    got = cuts.labels_at(df, "k", "label", "t", "s", "on", F.lit(5))
    assert {r["k"]: r["labels"] for r in got.collect()} == {1: "y", 2: "w,x"}


def test_flaky_needs_three_passes_strictly_before_within_the_days(spark):
    day = 86_400
    failures = spark.createDataFrame([("c", 100 * day), ("c", 101 * day), ("c", 191 * day), ("d", 100 * day), (None, 100 * day)], "name string, t long")
    passes = spark.createDataFrame([("c", 10 * day), ("c", 99 * day), ("c", 100 * day), ("d", 99 * day), ("c", 100 * day - 1)], "name string, x long")
    got = {(r["name"], r["t"] // day): r["is_flaky"] for r in cuts.flaky_failures(failures, passes, ["name"], "t", "x").collect()}
    assert got == {("c", 100): True, ("c", 101): True, ("c", 191): False, ("d", 100): False, (None, 100): False}


def leaves(node, pointer=""):
    if isinstance(node, (dict, list)) and node:
        for k, v in node.items() if isinstance(node, dict) else enumerate(node):
            yield from leaves(v, f"{pointer}/{str(k).replace('~', '~0').replace('/', '~1')}")
    else:
        yield pointer, node


def test_json_leaves_by_pointer(spark):
    r = random.Random(3)

    def node(depth):
        kind = r.randrange(4 if depth else 2)
        if kind < 2:
            return r.choice([1, -7, "text", "", '{"a": 1}', None, {}, []])
        return {r.choice(["a", "b/c", "~d", "0"]) + str(i): node(depth - 1) for i in range(2)} if kind == 2 else [node(depth - 1) for _ in range(3)]

    docs = [node(4) for _ in range(40)]
    want = sorted((i, p, json.dumps(v) if isinstance(v, (dict, list)) else v if v is None else str(v)) for i, d in enumerate(docs) for p, v in leaves(d))
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, doc string")
    key = lambda x: (x[0], x[1], x[2] is not None, x[2] or "")
    assert sorted(map(tuple, cuts.flatten_json(df, ["i"], "doc").collect()), key=key) == sorted(want, key=key)
    bad = spark.createDataFrame([(1, "{"), (2, None)], "i int, doc string")
    assert sorted(map(tuple, cuts.flatten_json(bad, ["i"], "doc").collect())) == [(1, None, None), (2, None, None)]
    deep = cuts.flatten_json(spark.createDataFrame([(1, '{"a": {"b": {"c": 1}}}')], "i int, doc string"), ["i"], "doc", 2)
    assert tuple(deep.first()) == (1, "/a/b", '{"c":1}')
    far = '{"a":' * 19 + "[7]" + "}" * 19
    assert tuple(cuts.flatten_json(spark.createDataFrame([(1, far)], "i int, doc string"), ["i"], "doc").first()) == (1, "/a" * 19 + "/0", "7")


def test_renames_close_over_chains_and_cycles(spark):
    renames = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "e"), (None, "x")], "u string, v string")
    starts = spark.createDataFrame([("a",), ("d",), ("z",), (None,)], "root string")
    got = sorted(map(tuple, cuts.rename_closure(renames, starts).collect()))
    assert got == [("a", "a"), ("a", "b"), ("a", "c"), ("d", "d"), ("d", "e"), ("z", "z")]


def test_nodes_reached_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(components, "ROWS", 10)
    r = random.Random(4)
    edges = {u: r.randrange(12) for u in range(0, 30, 2)}
    renames = spark.createDataFrame([*edges.items(), *edges.items()], "u int, v int")
    reached = cuts.rename_closure(renames, spark.range(30).select(F.col("id").cast("int").alias("root")))
    want = {}
    for root in range(30):
        nodes, at = {root}, root
        while at in edges and edges[at] not in nodes:
            nodes.add(at := edges[at])
        want[root] = nodes
    assert sorted(map(tuple, reached.collect())) == sorted((k, v) for k, nodes in want.items() for v in nodes)
    assert reached.rdd.getNumPartitions() >= 3
    rows = [(r.choice([None, *range(9)]), r.choice([None, 99, *range(30)])) for _ in range(200)]
    got = cuts.distinct_reached(spark.createDataFrame(rows + rows[:9], "k int, root int"), "k", "root", reached)
    by = {k: set().union(*(want.get(root, set()) for k2, root in rows if k2 == k)) for k, _ in rows}
    assert {x["k"]: x["n"] for x in got.collect()} == {k: len(v) for k, v in by.items() if v}
    # lines meet roots, and pairs their keys, in more partitions than the session's 4
    numbers = [int(x.split(")")[0].split(", ")[-1]) for x in got._jdf.queryExecution().executedPlan().toString().split("hashpartitioning(")[1:]]
    assert min(numbers) >= 21


def test_temperature_cools_what_is_too_sure(spark):
    rows = [(g, 0.95, 0.05, int(i % 10 >= 7)) for g in "ab" for i in range(10)]  # right 7 times of 10
    df = spark.createDataFrame(rows, "g string, p0 double, p1 double, y int")
    grid = [2 ** (k / 4) for k in range(-8, 13)]
    loss = lambda t: sum(((a := 0.95 ** (1 / t)) / (a + 0.05 ** (1 / t)) - (y == 0)) ** 2 * 2 for *_, y in rows[:10]) / 10
    got = cuts.best_temperature(df, ["p0", "p1"], "y", "g", grid).first()
    assert got["temperature"] == min(grid, key=loss) and abs(got["brier"] - loss(got["temperature"])) < 1e-9
