"""Commit chains against walks, audited files, open intervals."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.operators import chains, decisions, outcomes, sets
from tidemark.sources import audit

ROW = StructType([StructField("a", LongType()), StructField("b", LongType())])


def test_heads_match_walks(spark):
    r = random.Random(4)
    parent, t = {}, {}
    for n in range(1, 260):
        parent[n] = None if n in (1, 200) else n - 1 if r.random() < 0.8 and n not in (1, 200) else r.randrange(max(1, n - 30), n)
        t[n] = 100 * n + r.randrange(-300, 300)
    parent[150] = 9999  # unknown

    def up(n):
        p = parent.get(n)
        return p if p in parent else None

    def line(n):
        out = []
        while n is not None and n in parent:
            out.append(n)
            n = up(n)
        return out

    requests = [(i, r.choice([*range(1, 260), 5555]), r.choice([*range(1, 260), None, 7777]), r.randrange(0, 27_000), r.random() < 0.8) for i in range(150)]
    pushes = [(i, r.randrange(0, 30_000), r.choice([*range(1, 260), None])) for i in range(150) for _ in range(r.randrange(3))]
    want = {}
    for i, final, tip, opened, known in requests:
        cut = opened + 300
        later = sorted((x for j, x, _ in pushes if j == i and x > cut))
        start, kind = final, "exact" if known else "approx"
        if known and later:
            start, kind = min(((x, b is not None, b) for j, x, b in pushes if j == i and x > cut))[2], "recovered"
        head = None
        for n in line(start):
            if n == tip:
                break
            if t[n] <= cut:
                head = n
                break
        behind = None
        if head is not None and tip in parent:
            shared = [n for n in line(tip) if n in set(line(head))]
            if shared:
                fork = shared[0]
                depth = {n: len(line(n)) for n in line(tip)}
                then = next((n for n in line(tip)[: line(tip).index(fork)] if t[n] <= cut), None)
                behind = depth[then] - depth[fork] if then else 0
        want[i] = (head, kind if head else None, behind)
    j = chains.jumps(spark.createDataFrame([(n, parent[n], t[n]) for n in parent], "node long, parent long, t long"))
    assert len(j.levels) <= 9
    got = chains.heads_at_open(spark.createDataFrame(requests, "id long, final long, base_tip long, opened long, is_known boolean"), spark.createDataFrame(pushes, "id long, t long, before long"), j)
    assert {x["id"]: (x["head"], x["kind"], x["behind"]) for x in got.collect()} == want
    with pytest.raises(ValueError, match="circle"):
        chains.jumps(spark.createDataFrame([(1, 2, 0), (2, 1, 0)], "node long, parent long, t long"), 4)


def test_heads_take_three_joins_a_level(spark, monkeypatch):
    n = 200
    j = chains.jumps(spark.createDataFrame([(i, i - 1 if i else None, i) for i in range(n)], "node long, parent long, t long"))
    taken, step = [], chains._step
    monkeypatch.setattr(chains, "_step", lambda *a: taken.append(1) or step(*a))
    rows = [(1, 150, 100, 120, True), (2, 90, 190, 70, True), (3, 90, 190, 120, False), (4, 500, 190, 120, True), (5, 90, None, 120, True), (5, 80, None, 120, True)]
    requests = spark.createDataFrame(rows, "id long, final long, base_tip long, opened long, is_known boolean")
    got = chains.heads_at_open(requests, requests.select("id", F.col("opened").alias("t"), F.col("final").alias("before")).limit(0), j, 0)
    want = [(1, 120, "exact", 0), (2, 70, "exact", 0), (3, 90, "approx", 30), (4, None, None, None), (5, 80, "exact", None), (5, 90, "exact", None)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert len(taken) <= 3 * len(j.levels) + 2


def test_audited_files(spark, tmp_path):
    lines = tmp_path / "lines"
    lines.mkdir()
    for name, text in {"good.jsonl": '{"a": 1, "b": 2}\n\n{"a": 3}\n', "torn.jsonl": '{"a": 1}\n{"a": \n', "foreign.jsonl": "nothing\nhere\n", "empty.jsonl": "", "blank.jsonl": "\n \n", "other.csv": "x"}.items():
        (lines / name).write_text(text)
    rows, outcomes = audit.read_lines_audited(spark, str(lines), ROW)
    got = {r["file"].rsplit("/", 1)[1]: (r["outcome"], r["n_rows"], r["n_bad"]) for r in outcomes.collect()}
    assert got == {"good.jsonl": ("read", 2, 0), "torn.jsonl": ("torn", 1, 1), "foreign.jsonl": ("foreign", 0, 2), "empty.jsonl": ("empty", 0, 0), "blank.jsonl": ("empty", 0, 0)}
    assert sorted((r["a"], r["b"]) for r in rows.collect() if r["b"] or r["a"] > 1) == [(1, 2), (3, None)] and rows.count() == 3
    files = tmp_path / "files"
    spark.createDataFrame([(1, 2), (3, 4)], ROW).coalesce(1).write.parquet(str(files / "a b+c"))
    spark.createDataFrame([], ROW).coalesce(1).write.parquet(str(files / "none"))
    whole = next((files / "a b+c").glob("*.parquet")).read_bytes()
    (files / "torn.parquet").write_bytes(whole[:-20])
    (files / "foreign.parquet").write_bytes(b"hello, I am no table")
    (files / "nothing.parquet").write_bytes(b"")
    rows, outcomes = audit.read_parquet_audited(spark, str(files), ROW)
    got = sorted((r["outcome"], r["n_rows"]) for r in outcomes.collect())
    assert got == [("empty", 0), ("foreign", 0), ("foreign", 0), ("read", 2), ("torn", 0)] and rows.count() == 2


def test_open_intervals_match_pairs(spark):
    r = random.Random(6)
    rows = [(i, r.choice("ab"), s := r.randrange(100), r.choice([None, s, s + r.randrange(60)])) for i in range(80)]
    moments = [(r.choice("abc"), r.randrange(-5, 160)) for _ in range(60)]
    got = decisions.open_at(spark.createDataFrame(rows, "i long, k string, s long, e long"), spark.createDataFrame(moments, "k string, moment long"), "k", "s", "e", bucket=7)
    want = sorted((i, m) for i, k, s, e in rows for q, m in set(moments) if q == k and s <= m and (e is None or m < e))
    assert sorted((x["i"], x["moment"]) for x in got.collect()) == want and want
    lists, exposure = decisions.replayed_queues(got, "k", "i", {"up": F.col("i"), "down": -F.col("i")}, F.col("i") % 3 == 0, 2, 2)
    for x in lists.collect():
        own = sorted((i for i, m in want if m == x["moment"] and rows[i][1] == x["k"]), reverse=x["scorer"] == "up")
        assert x["n_open"] == len(own) >= 2 and x["n_bad"] == sum(i % 3 == 0 for i in own) and x["hits"] == sum(i % 3 == 0 for i in own[:2])
    assert {x["scorer"]: x["n_good"] for x in exposure.collect()}.keys() == {"up", "down"}


def test_set_joins_meet_by_time_and_rare_elements(spark):
    r = random.Random(11)
    items = [(i, r.choice("ab"), s := r.randrange(400), r.choice([None, s, s + r.randrange(90)])) for i in range(150)]
    own = {i: {0, *(r.choice([1, 2, 3, *range(4, 30)]) for _ in range(r.randrange(5)))} - (set() if r.random() < 0.8 else {0}) for i, *_ in items}
    df = spark.createDataFrame(items, "i int, k string, s long, e long")
    elements = spark.createDataFrame([(i, x) for i, xs in own.items() for x in xs] * 2, "i int, x int")
    got = {x["i"]: x["n"] for x in sets.overlapping(df, elements, "k", "i", "x", "s", "e", bucket=17).collect()}
    assert got == {i: sum(j != i and q == k and a <= s and (b is None or s < b) and bool(own[i] & own[j]) for j, q, a, b in items) for i, k, s, _ in items}
    for least in (0.1, 0.5, 0.8):
        near = sets.jaccard_neighbours(df, elements, "k", "i", "x", "s", "e", 120, 5, least, 3, bucket=23).collect()
        want = []
        for i, k, s, _ in items:
            scored = [(-len(own[i] & own[j]) / len(own[i] | own[j]), -b, j) for j, q, _, b in items if j != i and q == k and b is not None and s - 120 <= b <= s - 5 and own[i] | own[j]]
            want += [(i, j, rank) for rank, (_, _, j) in enumerate(sorted(x for x in scored if -x[0] >= least and own[i])[:3], 1)]
        assert sorted((x["i"], x["neighbour"], x["rank"]) for x in near) == sorted(want) and want


def test_an_element_of_all_items_makes_pairs_of_one_time_only(spark):
    """Items are spread over time; those that meet grow with the items, not with their square."""
    made = []
    for n in (400, 1600):
        df = spark.range(n).select("id", F.lit("k").alias("k"), (F.col("id") * 100).alias("s"), (F.col("id") * 100 + 250).alias("e"))
        elements = df.select("id", F.lit(1).alias("x"))
        assert sets.overlapping(df, elements, "k", "id", "x", "s", "e", bucket=1000).agg(F.sum("n")).first()[0] == 2 * n - 3
        waiting = sets.jaccard_neighbours(df, elements, "k", "id", "x", "s", "e", 1000, 10, 0.5, 100, bucket=1000)
        made.append(waiting.count())
    assert made[1] < 4.2 * made[0]


def test_pairs_of_light_elements_are_met_once(spark, monkeypatch):
    """Items of a rare element meet in one bucket, those of a busy one by time, and both find the same pairs."""
    r = random.Random(13)
    prs = [(i, r.choice("ab"), s := r.randrange(400) * outcomes.DAY, r.choice([None, s + r.randrange(90) * outcomes.DAY]), r.choice(["clean", "rework", "nowhere"])) for i in range(150)]
    pr = spark.createDataFrame(prs, "pr_number int, repo string, t_open long, t_close long, y string")
    files = spark.createDataFrame([(i, x) for i in range(150) for x in {0, r.randrange(1, 40), r.randrange(1, 40)}], "pr_number int, path_id int")
    own = {}
    for x in files.collect():
        own.setdefault(x["pr_number"], set()).add(x["path_id"])
    back, lag = 200 * outcomes.DAY, 30 * outcomes.DAY
    want = sorted((p, q) for p, k, t, _, _ in prs for q, l, _, c, y in prs if k == l and p != q and y != "nowhere" and c is not None and t - back <= c <= t - lag for _ in own[p] & own[q])
    near = set()
    for light in (0, 64, 1000):
        monkeypatch.setattr(sets, "LIGHT", light)
        got = outcomes.shared_file_pairs(pr, files, back, lag, 20 * outcomes.DAY)
        assert sorted((x["pr_number"], x["q_pr_number"]) for x in got.collect()) == want
        near.add(str(sorted(map(tuple, sets.jaccard_neighbours(pr, files, "repo", "pr_number", "path_id", "t_open", "t_close", back, lag, 0.3, 4).collect()))))
    assert len(near) == 1
    rare = spark.range(300).select(F.col("id").alias("pr_number"), F.lit("a").alias("repo"), (F.col("id") * outcomes.DAY).alias("t_open"), (F.col("id") * outcomes.DAY).alias("t_close"), F.lit("clean").alias("y"))
    dealt = rare.select("t_open", F.explode(sets.dealt(F.lit(True), F.sequence(F.lit(0), F.lit(9)))).alias("b"))
    assert dealt.count() == 300
