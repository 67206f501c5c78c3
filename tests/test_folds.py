"""Documents to any depth, stage machines in batch and stream, line ownership, joint resampling."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import documents, lineage, ranks, stages
from tidemark.streaming import stages as stream_stages


def random_document(r, depth):
    kind = r.randrange(8) if depth else r.randrange(6)
    if kind < 6:
        return [None, True, r.randrange(100), r.random(), r.choice(['a"b', "x/y~z", "é", ""]), r.choice([{}, []])][kind]
    if kind == 6:
        return [random_document(r, depth - 1) for _ in range(r.randrange(1, 4))]
    return {r.choice(["a", "0", "1", "b/c", "d~e", 'q"', "", "*"]): random_document(r, depth - 1) for _ in range(r.randrange(1, 4))}


def test_documents_come_back_whole_at_any_depth(spark):
    r = random.Random(2)
    deep = 1
    for k in range(23):
        deep = {"0": deep} if k % 2 else [deep, k]
    docs = [deep, 5, [], {}, None, *[random_document(r, 9) for _ in range(60)]]
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)] + [(1000, None), (1001, "{torn")]
    leaves = documents.flatten(spark.createDataFrame(rows, "i int, doc string"), ["i"], "doc", 4)
    assert leaves.where("i >= 1000").select("pointer").collect() == [(None,), (None,)]
    got = {x["i"]: json.loads(x["doc"]) for x in documents.unflatten(leaves, ["i"]).collect()}
    assert got == dict(enumerate(docs))
    nothing = documents.flatten(spark.createDataFrame([], "i int, doc string"), ["i"], "doc")
    assert nothing.count() == documents.unflatten(nothing, ["i"]).count() == documents.schema_catalogue(nothing, ["i"]).count() == 0


def test_type_catalogue(spark):
    rows = [(1, '{"a": 1, "b": [1, {"c": null}]}'), (2, '{"a": 2.5, "b": []}'), (3, '{"a": "x", "b": [true, {"c": 1}, {"c": 2}]}')]
    leaves = documents.flatten(spark.createDataFrame(rows, "i int, doc string"), ["i"], "doc")
    got = {tuple(r) for r in documents.schema_catalogue(leaves, ["i"]).collect()}
    assert got == {("/a", "number|string", 3, 3), ("/b/*", "boolean|integer", 2, 2), ("/b/*/c", "null|integer", 3, 2), ("/b", "array", 1, 1)}


def plain_states(rows, now):
    out, errors = {}, {}
    for k, t, _, kind in sorted(rows, key=lambda x: (x[1], x[2])):
        stage, n, e, since, _, of = out.get(k, (None, 0, 0, t, 0, None))
        if kind == "restart":
            n, e, since = 0, 0, t
        if kind == "error":
            errors[k, of] = errors.get((k, of), 0) + 1
        else:
            of = kind
        out[k] = (kind, n + 1, e + (kind == "error"), since, t, of)
    return {k: (*v[:5], now - v[4] > 1500) for k, v in out.items()}, errors


@pytest.mark.parametrize("stretch", [1, 50, 10_000])
def test_stage_states_match_a_loop(spark, stretch):
    r = random.Random(stretch)
    rows = [(r.choice("abc"), r.randrange(300), i, r.choice(["view", "buy", "error", "restart"][: 3 if i % 2 else 4])) for i in range(200)]
    df = spark.createDataFrame([*rows, (None, 5, 1, "view"), ("a", None, 1, "view")], "k string, t long, i long, kind string")
    states, errors = plain_states(rows, 1700)
    got = {x["k"]: (x["stage"], x["n_events"], x["n_errors"], x["since"], x["last_t"], x["is_idle"]) for x in stages.run_states(df, "k", "t", "i", "kind", "error", "restart", 1700, stretch=stretch).collect()}
    assert got == states
    assert {(x["k"], x["stage"]): x["n_errors"] for x in stages.stage_errors(df, "k", "t", "i", "kind", "error", stretch=stretch).collect()} == errors


def test_stream_of_stages_equals_batch_with_late_events(spark, tmp_path):
    r = random.Random(9)
    base = 1_704_067_200
    rows = [(r.randrange(3), base + r.randrange(7200), i, r.choice(["view", "buy", "error", "restart"])) for i in range(120)]
    files = [rows[0:40], rows[40:80], rows[80:]]  # each in no order; all within the two hours that the watermark allows
    flush = [(k, base + 40_000, 1000 + k, "view") for k in range(3)]
    last = [(k, base + 80_000, 2000 + k, "view") for k in range(3)] + [(0, base + 5, 3000, "error")]  # the last one comes too late
    for n, part in enumerate([*files, flush, last]):
        frame = spark.createDataFrame(part, "k long, t long, i long, kind string").withColumn("ts", F.timestamp_seconds("t"))
        frame.coalesce(1).write.parquet(str(tmp_path / "in" / f"{n}"))
    old = {c: spark.conf.get(c, None) for c in stream_stages.ROCKS}
    for c, v in stream_stages.ROCKS.items():
        spark.conf.set(c, v)
    try:
        read = spark.readStream.schema("k long, t long, i long, kind string, ts timestamp").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        states = stream_stages.run_states(read.select("k", "ts", "i", "kind"), "k", "ts", "i", "kind", "error", "restart", "2 hours")
        run = states.writeStream.format("memory").queryName("stage_states").outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        run.awaitTermination(240)
        out = spark.table("stage_states").collect()
    finally:
        for c, v in old.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
    latest = {}
    for x in sorted(out, key=lambda x: (x["last_t"], x["n_events"])):
        if x["last_t"] < base + 30_000:
            latest[x["k"]] = (x["stage"], x["n_events"], x["n_errors"], x["since"], x["last_t"])
    batch = stages.run_states(spark.createDataFrame(rows, "k long, t long, i long, kind string"), "k", "t", "i", "kind", "error", "restart", base + 80_000)
    assert latest == {x["k"]: (x["stage"], x["n_events"], x["n_errors"], x["since"], x["last_t"]) for x in batch.collect()}


def test_line_owners_match_a_file_in_memory(spark):
    r = random.Random(3)
    changes = [(r.choice(["p", "q"]), c, t, a, a + r.randrange(-1, 6)) for c, t in ((c, r.randrange(30)) for c in range(40)) for a in (r.randrange(20), r.randrange(20))]
    owner, want = {}, {}
    when = {}
    for c, t in sorted({(c, t) for _, c, t, *_ in changes}, key=lambda x: (x[1], x[0])):
        when[c] = t
        mine = {(p, line) for p, d, _, a, b in changes if d == c for line in range(a, b + 1)}
        for cell in mine:
            if cell in owner:
                want[c, owner[cell]] = want.get((c, owner[cell]), 0) + 1
            owner[cell] = c
    df = spark.createDataFrame([*changes, ("p", 99, 5, None, 3)], "path string, change int, t int, a int, b int")
    owners = lineage.line_owners(df, "path", "change", "t", "a", "b")
    assert {(x["change"], x["owner"]): x["n_lines"] for x in owners.collect()} == want
    fixes = spark.createDataFrame([(c, when[c]) for c in when if c % 3 == 0], "change int, t int")
    landed = spark.createDataFrame([(c, when[c] + 2 if c % 4 else None) for c in when], "change int, landed int")
    expect = {}
    for (c, o) in want:
        if c % 3 == 0 and o % 4 and 0 < when[c] - when[o] - 2 <= 9:
            expect[o] = min(expect.get(o, (99, 99)), (when[c] - when[o] - 2, c))
    assert {x["change"]: (x["delay"], x["fix"]) for x in lineage.earliest_fix(owners, fixes, landed, 9).collect()} == expect and expect


def test_line_owners_go_over_batches_and_blocks(spark):
    """Ranges that a plan of lines would make a hundred times as many rows; one path is longer than a batch."""
    r = random.Random(4)
    changes = [("p", c, c // 3, a, a + r.randrange(300)) for c in range(400) for a in (r.randrange(-300, 900),)] + [(None, 1, 1, 5, 6), (None, 2, 2, 6, 7)]
    owner, want = {}, {}
    for p, c, _, a, b in changes:
        for line in range(a, b + 1):
            if (p, line) in owner:
                want[c, owner[p, line]] = want.get((c, owner[p, line]), 0) + 1
            owner[p, line] = c
    df = spark.createDataFrame(changes, "path string, change int, t int, a int, b int")
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
        owners = lineage.line_owners(df, "path", "change", "t", "a", "b")
        assert {(x["change"], x["owner"]): x["n_lines"] for x in owners.collect()} == want
        plan = owners._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "Aggregate [_path" not in plan  # lines are no rows of the plan
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_one_unit_has_no_spread(spark):
    df = spark.createDataFrame([("u", 0.2, 0.5, 0.3, 1, 1), ("u", 0.4, 0.5, 0.1, 0, 1)], "u string, m double, b double, o double, y int, g int")
    got = {r["statistic"]: (r["estimate"], r["lower"], r["upper"]) for r in ranks.joint_bootstrap(df, "u", F.col("m"), F.col("b"), F.col("o"), F.col("y"), F.col("g"), [0, 1], 30, "s").collect()}
    for name, value in (("loss", 0.3), ("skill", 0.4), ("difference", 0.1), ("macro_f1", 1 / 3)):
        assert all(abs(x - value) < 1e-9 for x in got[name])
