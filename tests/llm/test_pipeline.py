"""The pipeline's stages on their own input, with empty tables and clashing columns."""

import hashlib
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, toxicity
from tidemark.llm.queries import ORACLE_SQL, QUERIES

from .test_operators import BLANKS, best_sum, brute_print, brute_severity, lower, smallest_reachable

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_pass_on_what_they_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("_kept", F.lit(1)).withColumn("size", F.lit("x"))
    for name in ("_tm_copies", "_tm_hash", "_tm_runs", "_tm_n", "_tm_kept", "_tm_order", "judged", "document", "least", "n_lines", "runs"):
        docs = docs.withColumn(name, F.lit("clash"))
    seen = [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        docs = out
        seen.append(out.count())
    assert seen[1] < seen[0] and seen[2] == seen[1] and seen[3] < seen[2] and seen[5] == seen[4]


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(corpus_pipeline.run(spark, SF)) == key(docs)


def corpus(n=220):
    """Documents with toxic words, common lines, copies, a hot source and long texts; labels for most."""
    r = random.Random(8)
    words = [a + b for a in ("ka", "lo", "mi", "ne", "su", "ta") for b in ("ra", "du", "ne", "so", "vi")]
    common = [f"{w} " * 12 + "stands in many documents" for w in ("first", "second")]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 7 == 0
        lines = [" ".join(r.choice(words) for _ in range(r.randrange(8, 40))) for _ in range(r.randrange(1, 6))]
        if toxic:
            lines[0] += " vile scum rotten"
        if i % 3 == 0:
            lines.append(r.choice(common))
        text = rows[i - 2][1] if i % 11 == 5 else "\n".join(lines)
        rows.append((i, text, "en", r.choice(["hot", "hot", "b", "c", None]), 0))
        if i % 5:
            labels.append((i, int(i % 4 > 0), int("scum" in text)))
    rows += [(n, " ".join(r.choice(words) for _ in range(20_000)), "en", "b", 0), (n + 1, "", "en", "c", 0), (n + 2, None, "en", "hot", 0)]
    return rows, labels


def test_run_matches_plain_python(spark, tmp_path):
    rows, labels = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())

    model = toxicity.fit_model(spark.read.parquet(str(tmp_path / "documents.parquet")), spark.read.parquet(str(tmp_path / "labels.parquet")))
    docs = {i: (t, s) for i, t, _, s, _ in rows if brute_severity(model, t)[-1] <= 0.5}
    assert {i for i, t, *_ in rows if "scum" in (t or "")} == {r[0] for r in rows} - set(docs)
    holders = {}
    for i, (t, _) in docs.items():
        for line in (t or "").split("\n"):
            if len(key := lower(line.strip(BLANKS))) >= 40:
                holders.setdefault(key, set()).add(i)
    gone = lambda i, line: len(h := holders.get(lower(line.strip(BLANKS)), ())) >= 5 and max(h) != i
    docs = {i: ("\n".join(x for x in t.split("\n") if not gone(i, x)) if t else t, s) for i, (t, s) in docs.items()}
    ids = sorted(docs)
    prints = [brute_print(docs[i][0]) for i in ids]
    root = smallest_reachable(len(ids), [[j for j, q in enumerate(prints) if (p ^ q).bit_count() <= 2] for p in prints])
    docs = {i: docs[i] for k, i in enumerate(ids) if root[k] == k}
    assert len(docs) < len(ids)
    size = {i: len((t or "").encode().split()) for i, (t, _) in docs.items()}
    sources = sorted({s for _, s in docs.values() if s is not None}) + [None]
    weight, total = dict(zip(sources, (5, 2, 1, 5), strict=True)), {s: sum(size[i] for i in docs if docs[i][1] == s) for s in sources}
    target, left, open_ = {}, 1.5 * sum(total.values()), list(sources)
    while True:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] > 2 * total[s]]
        if not full:
            break
        target |= {s: 2 * total[s] for s in full}
        left, open_ = left - sum(2 * total[s] for s in full), [s for s in open_ if s not in full]
    target |= {s: level * weight[s] for s in open_}
    t = bpe.tokenizer(bpe.default_path())

    def digests(text):
        own = t.encode(text or "", add_special_tokens=False).ids
        return len(own), hashlib.sha256(",".join(map(str, own)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    copies = Counter({i: got[(i, *digests(text))] for i, (text, _) in docs.items()})
    assert sum(copies.values()) == sum(got.values())  # no row besides those of the documents that stay, with their texts
    for s in sources:
        own = [i for i in docs if docs[i][1] == s]
        passes, rest = divmod(round(target[s]), total[s])
        assert sum(size[i] * copies[i] for i in own) == passes * total[s] + best_sum([size[i] for i in own], [1] * len(own), rest)
        assert all(copies[i] - passes in (0, 1) for i in own)


def test_empty_table_stays_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_operator_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    ours, theirs = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLE_SQL[name]).df()
    text = lambda df: sorted(map(str, df[sorted(df.columns)].astype(object).where(df[sorted(df.columns)].notna(), None).map(str).values.tolist()))
    assert sorted(ours.columns) == sorted(theirs.columns) and text(ours) == text(theirs)
