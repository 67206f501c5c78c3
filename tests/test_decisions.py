"""Small cases of decisions, ranks, queues and calibration: nulls, ties, unknown keys, empty tables."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import components, decisions, ranks


def test_first_true_takes_the_first_and_skips_null(spark):
    df = spark.createDataFrame([(None, True), (True, True), (False, False)], "a boolean, b boolean")
    got = [r[0] for r in df.select(decisions.first_true({"a": F.col("a"), "b": F.col("b")})).collect()]
    assert got == ["b", "a", None]


def test_worst_severity_stands_over_unobserved(spark):
    df = spark.createDataFrame([("a", 3), ("a", None), ("b", 2), ("b", None), ("c", 1), ("c", 2), ("d", None)], "k string, rank int")
    got = dict(df.groupBy("k").agg(decisions.worst_severity(F.col("rank"), 3)).collect())
    assert got == {"a": 3, "b": None, "c": 2, "d": None}


def test_null_where_listed_ignores_null_keys_and_repeats(spark):
    rows = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k int, v int")
    listed = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert sorted(map(tuple, decisions.null_where_listed(rows, listed, ["k"], ["v"]).collect()), key=str) == [(1, None), (2, 20), (None, 30)]


def test_newest_block_breaks_ties_and_adds_lead_in(spark):
    rows = spark.createDataFrame([("a", 100, 1), ("a", 100, 2), ("a", 95, 3), ("a", 80, 4), ("a", None, 5), (None, 99, 6)], "k string, t long, id long")
    got = {(r["id"], r["part"]) for r in decisions.newest_block(rows, "k", "t", "id", 1, 10).collect()}
    assert got == {(2, "block"), (1, "lead_in"), (3, "lead_in")}


def test_strong_links_beat_weak_ones(spark):
    rows = spark.createDataFrame([("m", "Merge #7"), ("w", "closes #7, closes #7 and #8"), ("n", None), ("e", "")], "id string, msg string")
    got = {(r["id"], r["number"]) for r in decisions.reference_links(rows, "msg", [r"Merge #([0-9]+)", r"closes #([0-9]+)"]).collect()}
    assert got == {("m", 7)}


def test_moments_stay_inside_a_life(spark):
    rows = spark.createDataFrame([("open", 0, None), ("short", 0, 86_400), ("long", 0, 86_401)], "k string, s long, e long")
    got = {tuple(r) for r in decisions.candidate_moments(rows, "k", "s", "e", [1]).collect()}
    assert got == {("open", "clock_1d", 86_400), ("long", "clock_1d", 86_400)}


def test_idle_moments_need_a_later_event(spark):
    rows = spark.createDataFrame([("a", 0), ("a", 10), ("a", 15)], "k string, t long")
    assert [tuple(r) for r in decisions.idle_moments(rows, "k", "t", 5).collect()] == [("a", 5)]


def test_queue_moments_include_the_start_and_not_the_end(spark):
    rows = spark.createDataFrame([("a", 10, 30), ("b", 11, 19), ("c", 20, 20), ("d", 5, None)], "k string, s long, e long")
    got = {(r["k"], r["moment"]) for r in decisions.queue_moments(rows, "s", "e", 10).collect()}
    assert got == {("a", 10), ("a", 20)}


def test_in_all_counts_a_repeated_key_once(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert [r[0] for r in decisions.in_all([a, b], ["k"]).collect()] == [2]


def test_earlier_ranks_agree_with_pairs(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), rng.randrange(40), rng.choice([None, rng.randrange(40)]), rng.choice([None, 0, 1, 5, 7, rng.randrange(128), -1, 200, 5_000_000_000])) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, k string, at long, ev long, v long")
    got = {r["id"]: tuple(r)[1:] for r in ranks.earlier_ranks(df, ["id"], "k", "at", "ev", "v").collect()}
    fits = lambda v: v is not None
    for i, k, at, _, v in rows:
        past = [w for _, k2, _, ev, w in rows if k2 == k and ev is not None and ev < at and fits(w)]
        want = (sum(w < v for w in past), sum(w == v for w in past), len(past)) if k is not None and fits(v) else (None,) * 3
        assert got[i] == want
    assert ranks.earlier_ranks(df.limit(0), ["id"], "k", "at", "ev", "v").count() == 0


@pytest.mark.parametrize("bucket", [None, 8])
@pytest.mark.parametrize("event", ["at", "ev"])
def test_earlier_ranks_by_digits_make_no_rows_a_bit(spark, bucket, event):
    rng = random.Random(5)
    rows = [(i, rng.choice("ab"), rng.choice([None, rng.randrange(-20, 40)]), rng.choice([None, rng.randrange(-20, 40)]), rng.choice([None, rng.randrange(300)]), rng.randrange(1, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, k string, at long, ev long, v long, w long")
    ranked = ranks.earlier_ranks(df, ["id"], "k", "at", event, "v", F.col("w"), seen="seen", bucket=bucket)
    assert "Generate" not in ranked._jdf.queryExecution().executedPlan().toString() or bucket
    got = {r["id"]: tuple(r)[1:] for r in ranked.collect()}
    for i, k, at, _, v, _ in rows:
        past = [(u, w) for _, k2, a, e, u, w in rows if k2 == k and u is not None and at is not None and v is not None and (a if event == "at" else e) is not None and (a if event == "at" else e) < at]
        want = (sum(w for u, w in past if u < v), sum(w for u, w in past if u == v), sum(w for _, w in past), len(past)) if at is not None and v is not None else (None,) * 4
        assert got[i] == want


def test_calibration_line_finds_a_known_fit(spark):
    df = spark.range(4000).select((F.when(F.col("id") % 2 == 0, 0.2).otherwise(0.8)).alias("p"), (F.col("id") % 20).alias("j"))
    # rates of 0.4 and 0.6 at probabilities of 0.2 and 0.8
    hit = F.when(F.col("p") < 0.5, F.col("j") < 8).otherwise(F.col("j") < 12)
    offset, slope = ranks.calibration_line(df, F.col("p"), hit)
    assert abs(offset) < 1e-6 and abs(slope - math.log(1.5) / math.log(4)) < 1e-6
    assert ranks.calibration_line(df.limit(0), F.col("p"), hit) == (0.0, 1.0)
    assert all(map(math.isnan, ranks.calibration_line(df, F.col("p"), F.lit(True))))


def test_bootstrap_weights_average_one(spark):
    got = spark.range(20_000).select(ranks.bootstrap_weight("s", F.lit(1), F.col("id")).alias("w")).agg(F.avg("w"), F.variance("w")).first()
    assert abs(got[0] - 1) < 0.03 and abs(got[1] - 1) < 0.06


def test_macro_f1_and_kappa_of_perfect_and_empty(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (None, 1)], "t int, g int")
    assert tuple(ranks.macro_f1(df, F.col("t"), F.col("g")).first()) == (1.0, 1.0)
    assert tuple(ranks.macro_f1(df.limit(0), F.col("t"), F.col("g")).first()) == (None, None)


def test_fill_keeps_blanks_without_a_pool(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", None), (3, "b", None), (4, None, None)], "id long, g string, v string")
    assert {r["id"]: r["v"] for r in ranks.fill_from_pool(df, "id", "g", "v", "s", least=1).collect()} == {1: "x", 2: "x", 3: "x", 4: "x"}
    assert ranks.fill_from_pool(df.where("id > 1"), "id", "g", "v", "s").where("v is not null").count() == 0


def test_fill_draws_every_value_of_the_right_pool(spark):
    rows = [(i, "big", i) for i in range(25)] + [(100 + i, "small", 900 + i) for i in range(3)] + [(1000 + i, g, None) for i in range(600) for g in ["big" if i % 2 else "small"]]
    got = ranks.fill_from_pool(spark.createDataFrame(rows, "id long, g string, v long"), "id", "g", "v", "s").where("id >= 1000").collect()
    assert {r["v"] for r in got if r["g"] == "big"} == set(range(25)) and {r["v"] for r in got if r["g"] == "small"} == {*range(25), 900, 901, 902}


def test_versions_sort_like_releases(spark):
    order = ["1.0.0-alpha", "1.0.0-alpha.1", "1.0.0-beta.2", "1.0.0-beta.11", "1.0.0-rc1", "1.0.0", "1.2", "1.2.3", "1.2.3.4", "1.10"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(order)], "i int, v string")
    assert [r["i"] for r in df.orderBy(text.version_key(F.col("v"))).collect()] == list(range(len(order)))
    one = spark.range(1).select((text.version_key(F.lit("1.0")) == text.version_key(F.lit("1.0.0+b"))).alias("same"), text.version_key(F.lit("none")).isNull().alias("none"), text.version_in_range(F.lit("1.5.0-rc1"), ">= 1.4, < 1.5.0").alias("inside")).first()
    assert tuple(one) == (True, True, True)


def test_durations(spark):
    df = spark.createDataFrame([(0,), (59,), (60,), (3725,), (90_000,), (None,)], "s long")
    assert [r[0] for r in df.select(text.duration(F.col("s"))).collect()] == ["0s", "59s", "1m 0s", "1h 2m", "1d 1h", None]


def test_queues_are_dealt_by_their_rows_and_ranked_by_all_scorers(spark, monkeypatch):
    monkeypatch.setattr(components, "ROWS", 50)
    rng = random.Random(8)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(12), i % 60, i % 60 % 4 == 0 if i % 60 % 7 else None, rng.choice([None, math.nan, -0.0, 0.0, 1.0, rng.random()])) for i in range(400)]
    rows = list({x[:3]: x for x in rows}.values())
    df = spark.createDataFrame(rows, "q string, moment long, i long, bad boolean, s double")
    scorers = {"s": F.col("s"), "old": -F.col("i")}
    lists, exposure = decisions.replayed_queues(df, "q", "i", scorers, F.col("bad"), 3, 4)
    # a queue's rows are exchanged once for all scorers, to as many tasks as they need
    plan = exposure._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1 and f", {-(-len(rows) // 50)}), REPARTITION_BY_NUM" in plan
    best_first = {"s": lambda x: (x[4] is None, x[4] == x[4], -x[4] if x[4] and x[4] == x[4] else 0, x[2]), "old": lambda x: x[2]}
    want, shares = {}, {}
    for q, m in {x[:2] for x in rows}:
        own = [x for x in rows if x[:2] == (q, m)]
        for name, by in best_first.items():
            ranked = sorted(own, key=by)
            if len(own) < 4:
                continue
            bad = sum(bool(x[3]) for x in own)
            gain = sum(1 / math.log2(r + 2) for r, x in enumerate(ranked[:3]) if x[3])
            ideal = sum(1 / math.log2(r + 2) for r in range(min(3, bad)))
            hits = sum(bool(x[3]) for x in ranked[:3])
            # without a known outcome there is no number of bad ones
            n_bad = bad if any(x[3] is not None for x in own) else None
            want[q, m, name] = (len(own), n_bad, hits, hits / bad if bad else None, gain / ideal if bad else None, next((r + 1 for r, x in enumerate(ranked) if x[3]), None))
            for r, x in enumerate(ranked):
                if x[3] is False:
                    shares.setdefault(name, {}).setdefault((q, x[2]), []).append(r < 3)
    got = {tuple(x)[:3]: tuple(x)[3:] for x in lists.collect()}
    assert got.keys() == want.keys() and len(want) > 40
    for k, v in want.items():
        assert got[k][:2] == v[:2]
        assert all(a == b or (a is not None and b is not None and abs(a - b) < 1e-9) for a, b in zip(got[k][3:], v[3:]))
    for x in exposure.collect():
        own = [sum(t) / len(t) for t in shares[x["scorer"]].values()]
        assert (x["n_good"], x["n_flagged"]) == (len(own), sum(v > 0 for v in own)) and abs(x["false_flag_area"] - sum(own) / len(own)) < 1e-9
    assert decisions.replayed_queues(df.limit(0), "q", "i", scorers, F.col("bad"))[1].count() == 0
