"""Several times of the same events on one timeline, lists of the last values, and how often chained history reads its table."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history, pit
from tidemark.plans import catalog_of_queries as core


@pytest.fixture(scope="module")
def facts(spark):
    r = random.Random(5)
    rows = [(i, r.choice(["a", "a", "b", None]), r.choice([None, *range(-40, 900)]), r.choice([None, *range(0, 1000)]), r.randrange(5)) for i in range(300)]
    return rows, spark.createDataFrame(rows, "id long, k string, t long, closed long, v long")


@pytest.mark.parametrize("bucket", [None, 100, 7])
def test_two_times_on_one_timeline_agree_with_pairs(facts, bucket):
    rows, df = facts
    closed = pit.Stream("closed", {"s": (F.col("v"), 50), "h": (F.col("v") / 2, None)}, last="since")
    opened = pit.Stream("t", {"n": (F.lit(1), F.col("closed"))}, first="age")
    got = {r["id"]: tuple(r)[1:] for r in pit.priors(df, ["k"], "t", [closed, opened], bucket=bucket).select("id", "s", "h", "since", "n", "age").collect()}
    assert len(got) == len(rows)
    for i, k, t, _, _ in rows:
        if k is None or t is None:
            assert got[i] == (None,) * 5
            continue
        c = [x for x in rows if x[1] == k and x[3] is not None and x[3] < t]
        o = [x for x in rows if x[1] == k and x[2] is not None and x[2] < t]
        # one that closed before it opened leaves when it closed, as in one timeline of a single time
        n = sum(1 for x in o) - sum(1 for x in rows if x[1] == k and x[2] is not None and x[3] is not None and x[3] < t)
        want = (sum(x[4] for x in c if x[3] >= t - 50), sum(x[4] for x in c) / 2, t - max(x[3] for x in c) if c else None, n, t - min(x[2] for x in o) if o else None)
        assert got[i] == want


def test_last_values_and_windows_of_the_last_k_agree_with_pairs(facts):
    rows, df = facts
    lists = {r["id"]: r["l"] for r in history.last_values(df, "k", "t", "closed", F.col("v"), F.col("id"), 3, "l").collect()}
    own = pit.leaving(df, ["k"], "closed", "id", [3])
    sums = {r["id"]: r["s"] for r in pit.prior(df, ["k"], "t", "closed", {"s": (F.col("v"), F.col("_end3"))}, events=own, bucket=100).collect()}
    for i, k, t, _, _ in rows:
        last = [x[4] for x in sorted((x for x in rows if x[1] == k and x[3] is not None and t is not None and x[3] < t), key=lambda x: (x[3], x[0]))][-3:]
        assert lists[i] == (None if k is None else last)
        assert sums[i] == (None if k is None or t is None else sum(last))


@pytest.mark.parametrize("name, most", [("e10_author_rolling", 3), ("e14_recent_author", 5), ("e9_repository_rolling", 4)])
def test_a_chain_of_histories_reads_its_table_a_few_times(spark, name, most):
    plan = core.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= sum(1 for line in plan.splitlines() if "Relation" in line and "o_orderkey" in line) <= most
