"""Point-in-time laws on small frames: strictly before, unknown keys, no leak from the future."""

import random
import statistics

import pytest

from pyspark.sql import functions as F

from tidemark.operators import components, events, pit, profile
from tidemark.streaming import rollup


def frame(spark, n=200, seed=0):
    r = random.Random(seed)
    rows = [(i, r.choice(["a", "b", None]), t := r.randrange(0, 400), None if r.random() < 0.2 else t + r.randrange(0, 60), r.randrange(0, 5)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, key string, t long, closed long, w long")


def test_prior_counts_strictly_earlier_events_within_the_window(spark):
    rows, df = frame(spark)
    got = {r["id"]: r for r in pit.prior(df, ["key"], "t", "closed", {"all": (F.col("w"), None), "near": (F.col("w"), 50)}, last="since").collect()}
    assert len(got) == len(rows)
    for i, key, t, _, _ in rows:
        before = [(c, w) for _, k, _, c, w in rows if key is not None and k == key and c is not None and c < t]
        if key is None:
            assert got[i]["all"] is None and got[i]["since"] is None
            continue
        assert got[i]["all"] == sum(w for _, w in before)
        assert got[i]["near"] == sum(w for c, w in before if c >= t - 50)
        assert got[i]["since"] == (t - max(c for c, _ in before) if before else None)


def test_buckets_and_moments_of_leaving(spark):
    rows, df = frame(spark, seed=4)
    df = df.withColumn("until", F.when(F.col("id") % 3 > 0, F.col("closed") + F.col("w") * 9))
    for bucket in (None, 7, 50, 10_000):
        got = {r["id"]: r for r in pit.prior(df, ["key"], "t", "closed", {"n": (F.lit(1), F.col("until")), "near": (F.col("w"), 30)}, last="since", first="age", bucket=bucket).collect()}
        for i, key, t, _, _ in rows:
            before = [(c, w, c + w * 9 if j % 3 else None) for j, k, _, c, w in rows if key is not None and k == key and c is not None and c < t]
            if key is not None:
                assert got[i]["n"] == sum(u is None or t <= u for _, _, u in before) and got[i]["near"] == sum(w for c, w, _ in before if c >= t - 30)
                assert (got[i]["since"], got[i]["age"]) == ((t - max(c for c, *_ in before), t - min(c for c, *_ in before)) if before else (None, None))


def test_a_hot_key_takes_time_in_proportion(spark):
    hot = spark.range(1_000_000).select(F.lit("hot").alias("key"), (F.col("id") * 60).alias("t"), F.lit(1).alias("w"))
    got = pit.prior(hot, ["key"], "t", "t", {"near": (F.col("w"), 30 * 86_400)}, bucket=pit.BUCKET).agg(F.max("near").alias("m"), F.count("*").alias("n")).first()
    assert (got["m"], got["n"]) == (43_200, 1_000_000)


def test_rows_before_a_cut_do_not_change_when_the_future_goes(spark):
    _, df = frame(spark, seed=3)
    sums = {"n": (F.lit(1), None)}
    whole = {r["id"]: r["n"] for r in pit.prior(df, ["key"], "t", "closed", sums).where("t < 200").collect()}
    cut = {r["id"]: r["n"] for r in pit.prior(df.where("t < 200"), ["key"], "t", "closed", sums).collect()}
    assert whole == cut


def test_last_k_matches_brute_force(spark):
    rows, df = frame(spark, seed=5)
    got = {r["id"]: (r["x_3"], r["n_3"]) for r in pit.prior_last_k(df, ["key"], "t", "closed", {"x": F.col("w")}, [3, 5], "id").collect()}
    for i, key, t, _, _ in rows:
        before = sorted((c, j, w) for j, k, _, c, w in rows if key is not None and k == key and c is not None and c < t)[-3:]
        assert got[i] == ((None, None) if key is None else (float(sum(w for *_, w in before)), float(len(before))))


def test_as_of_takes_the_latest_state_at_or_before(spark):
    q = spark.createDataFrame([("a", 5), ("a", 10), ("b", 1)], "key string, t long")
    s = spark.createDataFrame([("a", 5, "x"), ("a", 9, "y"), ("b", 2, "z")], "key string, at long, v string")
    got = {(r["key"], r["t"]): r["now"] for r in pit.as_of(q, s, ["key"], "t", "at", "v", "now").collect()}
    assert got == {("a", 5): "x", ("a", 10): "y", ("b", 1): None}


def test_islands_and_empty_input(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 10)], "key string, t long")
    got = {(r["first"], r["last"], r["n"]) for r in pit.islands(df, ["key"], "t", 2).collect()}
    assert got == {(1, 3, 2), (10, 10, 1)}
    assert pit.islands(df.where("false"), ["key"], "t", 2).count() == 0


def test_components_follow_chains_and_cycles(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 101), (101, 102), (102, 100)]
    got = {r["node"]: r["component"] for r in components.min_label_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert set(got.values()) == {0, 100} and got[40] == 0 and got[102] == 100


def test_tri_state_and_observation_rules(spark):
    df = spark.createDataFrame([("TRUE", True), ("0", True), ("no", None), ("maybe", True), (None, False)], "x string, seen boolean")
    t = profile.tri_state(F.col("x"))
    assert [r[0] for r in df.select(t).collect()] == [True, False, False, None, None]
    assert [bool(r[0]) for r in df.select(profile.observed_rows(t, F.col("seen"), "window")).collect()] == [True, True, False, False, False]


def test_stream_rollup_equals_batch(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    e.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = rollup.hourly_counts(rollup.read_events(spark, str(tmp_path / "in"), e.schema.simpleString()[7:-1].replace(":", " "), 1), "ts", "event_type", "value", "1000 days")
    run = stream.writeStream.format("memory").queryName("hours").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    key = lambda df: sorted((r["hour"], r["event_type"], r["n"], round(r["total"], 6)) for r in df.collect())
    assert key(spark.table("hours")) == key(rollup.hourly_counts(e, "ts", "event_type", "value"))


def test_stage_machine_resets_on_restart(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:01", "error"), (1, "2024-01-01 00:00:02", "signup"), (1, "2024-01-01 00:00:03", "error"), (2, "2024-01-01 00:00:01", "view")]
    spark.createDataFrame(rows, "k long, ts string, kind string").selectExpr("k", "cast(ts as timestamp) ts", "kind").write.parquet(str(tmp_path / "in"))
    states = rollup.run_states(rollup.read_events(spark, str(tmp_path / "in"), "k long, ts timestamp, kind string"), "k", "ts", "kind")
    run = states.writeStream.format("memory").queryName("states").outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert {(r["k"], r["stage"], r["n_events"], r["n_errors"]) for r in spark.table("states").collect()} == {(1, "error", 2, 1), (2, "view", 1, 0)}


def test_debounce_keeps_the_most_important_name(spark):
    df = spark.createDataFrame([("p", 0, "view"), ("p", 100, "buy"), ("p", 5000, "view")], "k string, t long, name string")
    got = {(r["t"], r["name"]) for r in events.debounce(df, "k", "t", "name", F.when(F.col("name") == "buy", 0).otherwise(1)).collect()}
    assert got == {(100, "buy"), (5000, "view")}


@pytest.mark.parametrize("bucket", [None, 7])
def test_odd_values_leave_with_their_window_and_null_moments_are_unknown(spark, bucket):
    inf, nan = float("inf"), float("nan")
    rows = [("a", 1, 1.0), ("a", 2, nan), ("a", 4, 2.0), ("a", 9, inf), ("a", 10, -inf), ("a", 11, 4.0), ("a", 20, 8.0), ("a", None, 16.0), (None, 5, 1.0), ("b", 3, None), ("b", 4, 1.5)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    got = {(r["k"], r["t"]): (r["s"], r["n"], r["gap"]) for r in pit.prior(df, ["k"], "t", "t", {"s": (F.col("v"), 5), "n": (F.lit(1), None)}, "gap", bucket=bucket).collect()}
    for k, t, _ in rows:
        if k is None or t is None:
            assert got[k, t] == (None, None, None)
            continue
        held = [x for j, u, x in rows if j == k and u is not None and t - 5 <= u < t and x is not None]
        want, s = sum(held), got[k, t][0]
        assert (s != s if want != want else abs(s - want) < 1e-9 or s == want), (k, t, s, want)


def test_windowed_median_is_exact_without_pairs(spark):
    """Rows and events meet on a timeline, digit by digit, not in pairs of a window."""
    r = random.Random(6)
    events = [(r.choice("ab"), t, t + r.randrange(-2, 60), r.choice([None, r.randrange(40) / 2, r.randrange(-900, 900) / 1])) for t in (r.randrange(200) for _ in range(300))]
    asked = [(i, r.choice(["a", "b", "c", None]), r.randrange(250)) for i in range(200)]
    e, q = spark.createDataFrame(events, "k string, seen long, until long, v double"), spark.createDataFrame(asked, "i int, k string, t long")
    for radix in (2, 8):
        out = pit.windowed_median(q, "i", ["k"], "t", e, "seen", "until", "v", "m", "n", bucket=37, radix=radix)
        assert "_bucket" not in out._jdf.queryExecution().optimizedPlan().toString()
        got = {x["i"]: (x["m"], x["n"]) for x in out.collect()}
        want = {}
        for i, k, t in asked:
            inside = [v for p, seen, until, v in events if p == k and seen < t <= until and v is not None]
            if inside:
                want[i] = (statistics.median(inside), len(inside))
        assert got == want and len(want) > 50
