"""Shards, folds, kept moments, slimmed diffs, resumed runs, guarded unions, and laws of history: the future changes nothing."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.operators import components, lifecycle, outcomes
from tidemark.plans import catalog_of_queries as core
from tidemark.sources import catalog


def test_changed_moments_fold_like_a_loop(spark):
    r = random.Random(5)
    rows = [(k, t, r.choice(["view", "buy", "err"]), r.randrange(2)) for k in ("a", "b") for t in sorted(r.sample(range(0, 400_000), 60))]
    rank = {"buy": 0, "err": 1, "view": 2}
    want = []
    for key in ("a", "b"):
        kept = []
        for m in (x for x in rows if x[0] == key):
            same = kept and kept[-1][3] == m[3]
            if same and m[2] != "view":
                continue
            if same and m[1] - kept[-1][1] <= 6 * 3600:
                if rank[m[2]] < rank[kept[-1][2]]:
                    kept[-1] = m
                continue
            kept.append(m)
        want += kept
    df = spark.createDataFrame(rows, "k string, t long, kind string, state int")
    got = lifecycle.changed_moments(df, "k", "t", ["state"], F.col("kind") == "view", F.when(F.col("kind") == "buy", 0).when(F.col("kind") == "err", 1).otherwise(2))
    assert sorted(map(tuple, got.collect())) == sorted(want) and lifecycle.changed_moments(df.where("false"), "k", "t", ["state"], F.lit(True), F.lit(1)).count() == 0


def test_slim_skips_what_does_not_fit_and_goes_on(spark):
    parts = spark.createDataFrame([(1, 0, "a", "x" * 40), (1, 1, "b", "y" * 80), (1, 2, "vendor", "+1\n+2\n-3\n+++ f"), (1, 3, "c", "z" * 50)], "d int, place int, name string, body string")
    got = lifecycle.slim(parts, "d", "place", F.col("name"), "body", F.col("name") == "vendor", 100).first()
    assert tuple(got) == (1, "# vendor: +2 -1", "a,c", "b")


def test_slimmed_diffs_stay_within_their_budget(spark):
    note = "# lock: lockfile, +2 -1 lines (diff omitted)\n\n"
    rows = [
        (1, 2, "lock", "lockfile", "+a\n+b\n-c\n+++ d\n--- e"), (1, 0, "x", None, "@@ 1\n"), (1, 1, "y", None, "é" * 48), (1, 3, "z", None, "1"),  # the note takes 46 of 100
        (2, 0, "big", None, "b" * 150), (2, 1, "small", None, "s"),  # the first part is cut, whatever follows is dropped
        (3, 0, "lock", "lockfile", "+a\n+b\n-c"), (3, 1, "none", None, None),
        *[(4, i, f"f{i}", None, "p" * (60 if i in (0, 1) else 30 if i == 2 else 70)) for i in range(25)],
    ]
    df = spark.createDataFrame(rows, "d int, i int, name string, why string, body string").repartition(5)
    got = {x["d"]: (x["slimmed"], x["is_cut"], x["has_code"], x["n_dropped"]) for x in lifecycle.slim_diff(df, "d", "i", F.col("name"), "body", F.col("why"), 100).collect()}
    assert got[1] == (note + "@@ 1\n" + "é" * 48 + "1", False, True, 0)
    assert got[2] == ("b" * 100 + "\n# (file truncated)\n\n# 1 more changed file(s) not shown (size cap): small\n", True, False, 1)
    assert got[3] == (note, False, False, 0)
    named = ", ".join(f"f{i}" for i in [1, *range(3, 22)])
    assert got[4] == ("p" * 90 + f"\n# 23 more changed file(s) not shown (size cap): {named}, ...\n", True, False, 23)


def test_guarded_union_names_problems(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "y")], "x int, z string")
    good = spark.createDataFrame([("s0", "p", "1", ["r1"]), ("s1", "p", "1", ["r2"])], "shard string, split string, version string, repos array<string>")
    assert lifecycle.guarded_union({"s0": a, "s1": b}, good).count() == 2
    bad = spark.createDataFrame([("s0", "p", "1", ["r1"]), ("s1", "q", "1", ["r1"])], good.schema)
    with pytest.raises(ValueError, match="mixed splits, twice: r1"):
        lifecycle.guarded_union({"s0": a, "s1": b}, bad)


def test_files_that_are_missing_torn_or_foreign(spark, tmp_path):
    schema = StructType([StructField("k", LongType()), StructField("v", StringType())])
    (tmp_path / "a.jsonl").write_text('{"k": 1, "v": "x"}\n{"k": 2, "v"\n\n{"k": 3}\n')
    assert sorted(r["k"] for r in catalog.read_rows(spark, str(tmp_path / "a.jsonl"), schema).collect()) == [1, 3]
    assert catalog.read_rows(spark, str(tmp_path / "none.parquet"), schema).columns == ["k", "v"]
    spark.createDataFrame([(1, "x")], schema).write.parquet(str(tmp_path / "t.parquet"))
    (tmp_path / "t.parquet" / "part-broken.parquet").write_bytes(b"not a parquet file")
    assert catalog.read_rows(spark, str(tmp_path / "t.parquet"), schema).count() == 1
    spark.createDataFrame([(1, "x")], schema).write.parquet(str(tmp_path / "t_snapshots.parquet"))
    assert set(catalog.siblings(spark, str(tmp_path / "t.parquet"))) == {"dataset", "snapshots"}
    done = spark.createDataFrame([('{"reason": "batch done"}',), ('{"reason": "batch done", "files_deferred": ["a"]}',), ("{",), (None,)], "s string")
    assert [r[0] for r in done.select(catalog.is_finished(F.col("s"))).collect()] == [True, False, False, False]
    with pytest.raises(ValueError):
        catalog.search(done, "s", "(a+)+b", ["s"], 1)


def test_labels_and_inputs(spark):
    df = spark.createDataFrame([(True, None, True), (False, True, True), (None, False, True), (False, True, None)], "bad boolean, seen boolean, ok boolean")
    for how, want in (("mask", [(True, 1.0), (False, 1.0), (None, 1.0), (None, 1.0)]), ("negative", [(True, 1.0), (False, 1.0), (False, 1.0), (None, 1.0)]), ("downweight", [(True, 1.0), (False, 1.0), (False, 0.5), (None, 1.0)])):
        label, weight = lifecycle.assembled_label([(F.col("bad"), F.col("seen"))], F.col("ok"), how)
        assert [tuple(r) for r in df.select(label, weight).collect()] == want
    marked = lifecycle.with_roles(df.withColumn("days_to_x", F.lit(1)), {"bad": "label", "seen": "metadata"})
    assert lifecycle.model_inputs(marked) == ["ok"] and lifecycle.model_inputs(marked.where("ok")) == ["ok"]


def pull_requests(spark, n=300, seed=1):
    r, rows = random.Random(seed), []
    for i in range(n):
        opened = r.randrange(0, 400) * 86_400 + r.randrange(86_400)
        rows.append((r.choice(["x", "y"]), i, r.choice(["a", "b", "c", None]), opened, opened + r.randrange(1, 60 * 86_400), r.choice(outcomes.CLASSES), i % 9 == 0))
    return spark.createDataFrame(rows, "repo string, pr_number long, author_key string, t_open long, t_close long, y string, is_bot boolean")


def test_history_before_a_cut_ignores_what_comes_after(spark):
    whole = pull_requests(spark)
    cut = 250 * 86_400
    # the same lives up to the cut; later ones are gone, and outcomes that came after it are others
    after = whole.where(F.col("t_open") < cut).withColumn("y", F.when(F.col("t_close") >= cut, F.when(F.col("y") == "clean", "rework").otherwise("clean")).otherwise(F.col("y"))).withColumn("t_close", F.when(F.col("t_close") >= cut, F.col("t_close") + 12_345).otherwise(F.col("t_close")))

    def features(pr):
        got = outcomes.repository_history(outcomes.author_history(outcomes.with_repository_prior(pr), pr).withColumn("is_outside", ~F.col("is_bot")), pr)
        got = outcomes.rolling_rates(got, pr, ["repo"], [3, 10], 5.0)
        names = [c for c in got.columns if c.startswith(("ah_", "rh", "clean_rate", "n_"))]
        return {r["pr_number"]: [None if v is None else round(v, 9) for v in r[1:]] for r in got.where(F.col("t_open") < cut).select("pr_number", *names).collect()}

    a, b = features(whole), features(after)
    assert a == b and len(a) > 100


def test_quota_sample_exchanges_no_whole_stratum(spark):
    rows = [(i, None if i % 7 == 0 else "ab"[i % 3 == 0], i % 11 == 0 if i % 3 else i % 2 == 0) for i in range(3000)] + [(9000, "c", True), (9001, "c", False)]
    df = spark.createDataFrame(rows, "k long, s string, p boolean").repartition(3)
    got = lifecycle.quota_sample(df, "s", F.col("p"), F.col("k"), 20, 0.3)
    # each task keeps its first rows before the exchange
    assert got._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2
    want = []
    for s in {s for _, s, _ in rows}:
        yes, no = (sorted((k for k, s2, p in rows if s2 == s and p == side), key=lambda k: hashlib.sha256(str(k).encode()).hexdigest()) for side in (True, False))
        others = min(20 - min(6, len(yes)), len(no))
        want += yes[: 20 - others] + no[:others]
    assert sorted(r["k"] for r in got.collect()) == sorted(want) and got.columns == df.columns


def test_resumed_rows_and_keys_meet_in_one_exchange(spark, monkeypatch):
    monkeypatch.setattr(components, "ROWS", 40)
    r = random.Random(9)
    rows = [(r.choice([None, *range(40)]), r.choice("xy"), None if i % 9 == 0 else float("nan") if i % 50 == 1 else i * 1.0, r.choice(["a", "b", None]), {"i": i}) for i in range(300)]
    asked = [(r.choice([None, *range(50)]), r.choice("xy")) for _ in range(90)]
    checkpoint = spark.createDataFrame(rows, "k int, p string, seq double, stamp string, m map<string,int>").repartition(3)
    wanted = spark.createDataFrame(asked, "k long, p string")
    by = lambda x: (x[2] is not None, x[2] != x[2], x[2] or 0)
    last = {}
    for x in rows:
        if None not in x[:2] and (x[:2] not in last or by(x) > by(last[x[:2]])):
            last[x[:2]] = x
    only = {x[:2] for x in rows if sum(y[:2] == x[:2] and (y[2] is None or y[2] != y[2]) for y in rows) > 1}  # ties among the last could go either way
    want = {q: last[q] for q in asked if q in last and last[q][3] in (None, "a")}
    kept, again = lifecycle.resumed(checkpoint, wanted, ["k", "p"], "seq", "stamp", "a")
    got = {tuple(x)[:2]: tuple(x) for x in kept.collect()}
    redo = [tuple(x) for x in again.collect()]
    sure = lambda q: q not in only or (q in last and by(last[q])[:2] == (True, False))
    assert kept.schema == checkpoint.schema and again.dtypes == wanted.dtypes
    assert {q for q in got if sure(q)} == {q for q in want if sure(q)} and len(want) > 10 and len(redo) == len(set(redo)) == len(set(asked)) - len(got)
    assert set(redo) | set(got) == set(asked)
    assert all(got[q][4] == want[q][4] for q in want if sure(q))
    marks = lifecycle.resume_marks(checkpoint, wanted, ["k", "p"], "seq", "stamp", "a")
    assert marks._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(k") == 1
    plan = core.QUERIES["m2_resume"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= sum(1 for line in plan.splitlines() if "Relation" in line and "o_orderkey" in line) <= 3
