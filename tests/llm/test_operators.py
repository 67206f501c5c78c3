"""The training-data operators against brute force, and on nulls, empty tables, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import bpe, cover_tree, interpolation, line_dedup, mixing, multiprobe, private_data, queries, simhash, toxicity, url_lists
from tidemark.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BLANKS = " \t\n\x0b\x0c\r"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def documents(seed=0, n=60):
    """Rows with nulls, empty and long texts, copies, repeated rows and shared lines."""
    r = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "délta", "eps", "zeta", "eta", "Theta", "iota", "kappa"]
    line = "This very common line has well over forty code points."
    rows = []
    for i in range(n):
        body = " ".join(r.choice(words) for _ in range(r.randrange(1, 60)))
        rows.append((i, body + ("\n" + r.choice([line, "  " + line.upper() + " "]) if i % 3 == 0 else "") + "\nend", "en", r.choice(["a", "b", None]), len(body)))
    rows += [(n, None, None, None, None), (n + 1, "", "en", "a", 0), (n + 2, " \n\t", "en", "b", 3), (n + 3, "wörd " * 30_000, "de", "a", 150_000)]
    rows += [rows[1], (n + 4, rows[1][1], "en", "b", 1), (None, "no id here", "en", "a", 10)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    extra = spark.createDataFrame(documents(), DOCS)
    for c in ("size", "component_id", "fingerprint", "h1", "pos", "line", "key", "copies", "block", "order", "row", "ids", "chunk", "expected_severity", "p_toxic", "n", "digest", "place",
              "document", "document_", "least", "more", "times", "doc", "text_hash", "dropped", "runs", "n_lines", "n_dropped", "judged", "_tm_kept", "_tm_order", "_tm_rank", "labelled", "tokens"):
        extra = extra.withColumn(c, F.lit("clash"))
    return extra


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_line_dedup_matches_brute_force(docs, empty):
    rows = documents()
    holders = {}
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            key = lower(line.strip(BLANKS))
            if len(key) >= 40:
                holders.setdefault(key, set()).add(i)
    expected = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        owner = lambda k: max(holders[k], key=lambda x: -1 if x is None else x)
        kept = [x for x in lines if not ((k := lower(x.strip(BLANKS))) in holders and len(holders[k]) >= 5 and owner(k) != i)]
        expected.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    got = [(str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["text"] or "") for r in out.collect()]
    assert sorted(got) == sorted(expected) and sum(x[2] for x in got) > 5
    assert line_dedup.drop_common_lines(docs).columns == docs.columns and line_dedup.drop_common_lines(empty).count() == 0


def brute_print(text):
    words = lower(text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(n, linked):
    root = list(range(n))
    while True:
        new = [min([root[i], *(root[j] for j in linked[i])]) for i in range(n)]
        if new == root:
            return root
        root = new


def test_simhash_matches_brute_force(docs, empty):
    rows = documents()
    prints = [brute_print(t) for _, t, *_ in rows]
    linked = [[j for j, q in enumerate(prints) if (p ^ q).bit_count() <= 2] for p in prints]
    root = smallest_reachable(len(rows), linked)
    best = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            best[root[i]] = min(best.get(root[i], d), d)
    expected = sorted((str(d), f"{prints[i]:016x}", str(best.get(root[i]))) for i, (d, *_) in enumerate(rows))
    found = simhash.near_duplicates(docs).withColumn("fingerprint", simhash.hex_digits(F.col("fingerprint")))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in found.collect()) == expected
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(best.values())) and ids.count(None) == 1
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one_of_each(empty).count() == 0


def test_index_lists_join_all_near_fingerprints():
    r = np.random.default_rng(1)
    base = np.uint64(0x0123456789ABCDEF)
    values = np.unique(np.array([base ^ np.uint64(int(x) << 24) for x in r.integers(0, 1 << 16, 3000)], dtype=np.uint64)).view(np.int64)
    u, v = simhash.list_links(values, (3, 4))
    root = dict(zip(u.tolist(), v.tolist(), strict=True))
    raw = values.view(np.uint64)
    near = np.bitwise_count(raw[:, None] ^ raw[None, :]) <= 2
    label = np.arange(len(values))
    while not (new := np.where(near, label[None, :], 10**9).min(1)).tolist() == label.tolist():
        label = new
    assert [root.get(x, x) for x in values.tolist()] == values[label].tolist()


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(70)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(71)} | {200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_mixing_meets_targets_reproducibly(docs, empty):
    got = mixing.mix(docs).toPandas()
    again = mixing.mix(docs.repartition(3)).toPandas()
    key = ["doc_id", "text_hash", "copies"]
    assert sorted(map(str, got[key].values.tolist())) == sorted(map(str, again[key].values.tolist()))
    assert len(got) == len(documents()) and got["copies"].max() <= 2
    sizes = {t: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in documents()}
    assert sorted(got["size"]) == sorted(sizes[t] for _, t, *_ in documents())
    for _, own in got.groupby(got["source"].fillna("~")):
        taken, target = (own["size"] * own["copies"]).sum(), own["target"].iloc[0]
        assert target <= 2 * own["source_size"].iloc[0] + 1e-6 and taken <= target + 0.5
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == got["copies"].sum()
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_targets_are_shared_again_above_the_limit(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 1000), ("zero", 0)], "source string, source_size long")
    t = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    assert t["a"] == 20 and t["zero"] == 0 and math.isclose(sum(t.values()), 1.5 * 2010) and math.isclose(t["b"], 995) and t[None] == 2000
    assert mixing.source_targets(sizes.where("false")).count() == 0
    # weights go round in code point order over many ranges, the null source last
    many = [(f"s{i:03}", 10_000) for i in range(200)] + [(None, 10_000)]
    got = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(many, "source string, source_size long").repartition(7)).collect()}
    left = {s: (5.0, 2.0, 1.0)[i % 3] for i, (s, _) in enumerate(many)}
    fives = sum(w == 5.0 for w in left.values())
    assert all(math.isclose(got[s], 20_000 if w == 5.0 else (1.5 * 2_010_000 - 20_000 * fives) * w / sum(x for x in left.values() if x < 5)) for s, w in left.items())


def test_budget_fit_is_exact_where_it_can_be():
    r = random.Random(4)
    for _ in range(200):
        sizes = np.array(sorted(r.sample(range(1, 40), r.randrange(1, 8))))
        counts = np.array([r.randrange(1, 4) for _ in sizes])
        budget = r.randrange(0, int((sizes * counts).sum()) + 5)
        sums = {0}
        for s, c in zip(sizes.tolist(), counts.tolist(), strict=True):
            sums = {x + k * s for x in sums for k in range(c + 1)}
        take = mixing.fit_budget(sizes, counts, budget)
        assert (take <= counts).all() and (take * sizes).sum() == max(s for s in sums if s <= budget)
        # a room that is too small at first grows until nothing better can exist
        assert (mixing.fit_budget(sizes, counts * 30, 17 * budget, room=1) * sizes).sum() == best_sum(sizes.tolist(), (counts * 30).tolist(), 17 * budget)
    big = mixing.fit_budget(np.arange(1, 3000), np.full(2999, 50), 100_000_000)
    assert (big * np.arange(1, 3000)).sum() == 100_000_000


def best_sum(sizes, counts, budget):
    sums = 1
    for s, c in zip(sizes, counts, strict=True):
        for _ in range(c):
            sums |= sums << s
    return (sums & ((1 << (budget + 1)) - 1)).bit_length() - 1


def test_budget_fit_is_exact_with_long_documents():
    for sizes, counts, budget, best in [([300_000, 100], [1, 1000], 390_000, 390_000), ([150_000, 140_000, 130_000, 120_000, 110_000], [1] * 5, 260_000, 260_000),
                                        ([60_000, 50_000, 45_000], [1, 1, 1], 95_000, 95_000), ([9_999, 10_001], [1000, 1000], 9_999_998, 9_999_998), ([60_000, 100], [2, 1000], 190_000, 190_000), ([60_000, 45_000, 0], [1, 1, 9], 92_767, 60_000), ([7_000_000, 5], [9, 3], 60_000_000, 56_000_015)]:
        take = mixing.fit_budget(np.array(sizes), np.array(counts), budget)
        assert (take <= counts).all() and (take * sizes).sum() == best
    r = random.Random(6)
    for _ in range(60):
        sizes = sorted(r.sample(range(50_000, 400_000), r.randrange(1, 6)) + r.sample(range(1, 900), r.randrange(0, 5)))
        counts = [r.randrange(1, 4 if s > 900 else 40) for s in sizes]
        budget = r.randrange(0, sum(s * c for s, c in zip(sizes, counts, strict=True)))
        take = mixing.fit_budget(np.array(sizes), np.array(counts), budget)
        assert (take <= counts).all() and (take >= 0).all() and (take * sizes).sum() == best_sum(sizes, counts, budget)


def test_mixing_fits_every_source(spark, docs):
    long = [(1000 + i, "w " * n, "en", "c", n) for i, n in enumerate([300_000] + [100] * 300 + [90_000, 70_001])]
    got = mixing.mix(docs.select(*[c.split()[0] for c in DOCS.split(", ")]).unionByName(spark.createDataFrame(long, DOCS))).toPandas()
    for _, own in got.groupby(got["source"].fillna("~")):
        passes, rest = divmod(round(own["target"].iloc[0]), own["source_size"].iloc[0])
        fit = best_sum(own["size"].tolist(), [1] * len(own), int(rest)) if rest else 0
        assert (own["size"] * own["copies"]).sum() == passes * own["size"].sum() + fit


def brute_severity(model, text):
    """P(grade >= k) of a text, word by word."""
    words = {w.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") for w in (text or "").lower().split()} - {""}
    z = sum(weight for f, weight in model.weights.items() if f in words or (f.endswith("*") and any(w.startswith(f[:-1]) for w in words)))
    return [1 / (1 + math.exp(-max(-40.0, min(40.0, z - b)))) for b in model.thresholds]


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    fit, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    model = toxicity.fit_model(docs, fit)
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == 2
    got = toxicity.grade(docs, model).join(held, "doc_id").toPandas()
    said, true = got["p_toxic"] > toxicity.DECISION, got["toxic"] == 1
    assert (said & true).sum() / true.sum() >= 0.9 and (said & ~true).sum() / (~true).sum() <= 0.01
    assert got["expected_severity"].between(0, 3).all() and (got["expected_severity"] >= got["p_toxic"] - 1e-9).all()
    for r in got.head(400).itertuples():
        p = brute_severity(model, r.text)
        assert math.isclose(r.expected_severity, sum(p), abs_tol=1e-9) and math.isclose(r.p_toxic, p[-1], abs_tol=1e-9)


def test_features_enter_by_their_evidence(spark):
    """All words of the sample are counted, whatever their number; a word on both sides alike weighs nothing."""
    r = random.Random(3)
    noise = [f"noise{i:05}" for i in range(3000)]
    rows = [(i, " ".join([*r.sample(noise, 20), "both", *(["badword"] if i % 4 == 0 else []), *(["finest"] if i % 4 else [])]), int(i % 4 == 0), int(i % 3 > 0)) for i in range(400)]
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, t) for i, _, t, q in rows], "doc_id long, quality int, toxic int")
    model = toxicity.fit_model(docs, labels)
    assert model.weights["badword"] > 0 > model.weights["finest"] and "both" not in model.weights and len(model.weights) < 60
    got = toxicity.grade(docs, model).toPandas()
    assert ((got["p_toxic"] > 0.5) == (got["doc_id"] % 4 == 0)).all()


def test_ordinal_fit_recovers_ordered_grades():
    r = np.random.default_rng(0)
    rows = [np.flatnonzero(r.random(6) < 0.4) for _ in range(3000)]
    true = np.array([2.0, 1.0, 0.5, 0, -1.0, -2.0])
    z = np.array([true[x].sum() for x in rows]) + r.logistic(size=3000)
    w, cut = toxicity.fit_ordinal(rows, np.ones(6), np.digitize(z, [0.0, 1.5]), 3, steps=600, least=-np.inf)
    assert np.abs(w - true).max() < 0.35 and np.abs(cut - [0, 1.5]).max() < 0.35


def test_toxicity_edge_cases(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    nulls = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, nulls):
        assert toxicity.keep_clean(docs, labels).count() == docs.count()
    assert toxicity.keep_clean(docs, nulls).columns == docs.columns and toxicity.keep_clean(empty, none).count() == 0


def test_private_data(spark, docs, empty):
    text = "Mail a.b@c.example.com, +1 (555) 123-4567; 10.0.0.256 10.0.0.1, 4111 1111 1111 1111 x@y"
    base, spans = private_data.all_spans(text)
    assert [(k, text[a:b]) for a, b, k in base] == [("email", "a.b@c.example.com"), ("phone", "+1 (555) 123-4567"), ("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111")] and base == spans
    for hidden, kind in [("é john [at] mail (dot) example.com .", "email"), ("john at mail dot example dot com", "email"), ("call plus one five five five one two three four five six seven", "phone"), ("ｊｏｅ＠ｍａｉｌ.com", "email"), ("１０.0.0.1", "ip")]:
        base, spans = private_data.all_spans(hidden)
        assert not base or hidden.startswith("１"), hidden
        assert kind in [k for *_, k in spans], hidden
    assert private_data.all_spans("look at the dot on it at noon") == ([], [])
    assert private_data.find_private_data(docs.withColumn("found", F.lit(1)).withColumn("base", F.lit(1))).columns == ["doc_id", "base", "spans"]
    out = private_data.find_private_data(docs)
    assert out.columns == ["doc_id", "base", "spans"] and out.count() == docs.count() and private_data.find_private_data(empty).count() == 0


# disguised identifiers, and prose that holds the same words
DISGUISED = [
    ("email", "jane at example.com"), ("email", "jane@example dot com"), ("email", "jane at example[.]com"), ("email", "jane @ example . com"), ("email", "jane_at_example_dot_com"),
    ("email", "jane at example dot dev"), ("email", "john dot doe at example dot com"), ("email", "juana arroba ejemplo punto es"), ("email", "jean arobase exemple point fr"),
    ("email", "hans ät beispiel punkt de"), ("email", "a{arroba}b{punto}com"), ("email", "john-at-example-dot-com"), ("ip", "10 dot 0 dot 0 dot 1"), ("ip", "10[.]0[.]0[.]1"), ("ip", "10 . 0 . 0 . 1"),
    ("ip", "one nine two dot one six eight dot zero dot one"), ("phone", "+1 555-one two three-four five six seven"), ("phone", "plus one double five five one two three four five six seven"),
    ("phone", "más uno cinco cinco cinco uno dos tres cuatro cinco seis siete"), ("phone", "plus null eins zwei drei vier fünf sechs sieben acht neun"),
    ("phone", "plus un deux trois quatre cinq six sept huit neuf zéro"), ("card", "four111 1111 1111 1111"),
]
PROSE = [
    "look at the dot on it at noon", "see the docs at example.com for more", "We met at one point two years ago at noon.", "Der Punkt ist an diesem Punkt ein Punkt", "il est un point de vue at point",
    "el punto de vista es un punto clave, dos puntos", "one two three go", "un deux trois soleil", "version 1 . 2 . 3 and so", "He looked at a dot at the point of no return.", "meet at 10 dot 30", "drei vier fünf Leute",
]


def test_disguises_are_found_whole_and_prose_is_left_alone(spark):
    for kind, text in DISGUISED:
        for before, after in (("", ""), ("é write: ", ", ok")):
            base, spans = private_data.all_spans(whole := before + text + after)
            assert (len(before), len(before) + len(text), kind) in spans and set(base) <= set(spans), whole
    for text in PROSE:
        assert private_data.all_spans(text) == ([], []), text
    clean = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text is not null").collect()]
    assert all(len(spans) == len(base) for base, spans in map(private_data.all_spans, clean))


def test_rewriting_keeps_offsets():
    for kind, text in DISGUISED:
        out = private_data.deobfuscate("x " * 50 + "１ " + text + " y" * 50)
        assert len(out.text) == len(out.starts) == len(out.ends) and all(a < b for a, b in zip(out.starts, out.ends, strict=True))
        assert list(out.starts) == sorted(out.starts) and list(out.ends) == sorted(out.ends)


def test_partly_disguised_identifiers_are_found_whole():
    for text, kind, part in [("jоhn@example.com", "email", "hn@example.com"), ("john@example.cоm", "email", "john@example.c"), ("１92.168.1.1", "ip", "92.168.1.1"), ("4111 1111 1111 1111 ０", "card", "4111 1111 1111 1111")]:
        base, spans = private_data.all_spans(f"see {text} .")
        found = [(k, f"see {text} ."[a:b]) for a, b, k in spans]
        assert [(kind, part)] == [(k, f"see {text} ."[a:b]) for a, b, k in base] and set(base) <= set(spans)
        assert ((kind, text) in found) == (kind != "card")  # with one more digit it is no card
    base, spans = private_data.all_spans("a@b.com and c [at] d [dot] com, 10.0.0.1")
    assert len(base) == 2 and len(spans) == 3


def test_base_patterns_match_plain_regular_expressions():
    r = random.Random(2)
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    ok = {
        "email": lambda s: True, "ip": lambda s: all(int(x) <= 255 for x in s.split(".")),
        "card": lambda s: 14 <= len(d := re.sub("[ -]", "", s)) <= 19 and private_data.luhn(d), "phone": lambda s: 10 <= len(re.findall("[0-9]", s)) <= 15,
    }
    for _ in range(3000):
        s = "".join(r.choice("ab@@..-+1 23(0é4111111") for _ in range(r.randrange(1, 60)))
        expected = sorted([(m.start(), list(plain).index(k), m.end(), k) for k, p in plain.items() for m in re.finditer(p, s) if ok[k](m[0])])
        assert private_data.base_spans(s) == [(a, b, k) for a, _, b, k in expected]


def test_bpe_round_trip(docs, empty):
    path = bpe.default_path()
    t = bpe.tokenizer(path)
    out = {(r["doc_id"], r["decoded"]): r["ids"] for r in bpe.encode_decode(docs, path, piece=200).collect()}
    for i, text, *_ in documents():
        assert out[(i, text or "")] == t.encode(text or "", add_special_tokens=False).ids
    assert bpe.encode_decode(docs).count() == docs.count() and bpe.encode_decode(empty).count() == 0
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")).unionByName(docs.withColumn("doc_id", F.lit("long")).where("length(text) > 1000").limit(1)).unionByName(docs.withColumn("doc_id", F.lit("long")).where("length(text) > 1000").limit(1))
    got = bpe.encode_decode(named, path, piece=200)
    assert dict(got.dtypes)["doc_id"] == "string" and got.count() == docs.count() + 2 and got.where("doc_id = 'long'").count() == 2


def test_bpe_joins_are_exact():
    path, r = bpe.default_path(), random.Random(9)
    t = bpe.tokenizer(path)
    parts = ["aaaa", "bcd", " ", "  ", "\n", "'s", "é", "日本語", "😀", "1234", "!!!", "<|endoftext|>", "'", "th"]
    for _ in range(300):
        some = r.sample(parts, r.randrange(1, 6))
        text = "".join(r.choice(some) for _ in range(r.randrange(1, 300)))
        pieces = bpe.halves(text, r.choice([3, 7, 20, 50]))
        assert "".join(pieces) == text
        assert bpe.join_all(bpe.encode_texts(pieces, path), path) == t.encode(text, add_special_tokens=False).ids
    for text in ("a" * 40_001, " " * 30_000 + "x", "é" * 9_999):
        ids = bpe.join_all(bpe.encode_texts(bpe.halves(text, 1000), path), path)
        assert ids == t.encode(text, add_special_tokens=False).ids and bpe.decode_ids([ids], path) == [text]


def vectors(seed=0):
    r = np.random.default_rng(seed)
    base = r.standard_normal((12, 8))
    rows = [(i, (base[i % 12] + r.standard_normal(8) * 0.15).tolist(), int(i % 3)) for i in range(240)]
    rows += [(240 + i, rows[i][1], rows[i][2]) for i in range(5)] + [rows[0]]
    odd = [None, [], [0.0] * 8, [1.0] * 7 + [None], [float("nan")] * 8, [float("inf")] + [0.0] * 7]
    return rows, [(300 + i, v, 1) for i, v in enumerate(odd)] + [(400, rows[3][1], None), (None, rows[3][1], 0)]


@pytest.fixture(scope="module")
def embeddings(spark):
    good, odd = vectors()
    return spark.createDataFrame(good + odd, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit(1)).withColumn("unit", F.lit("x"))


def test_cover_tree_matches_brute_force(spark, embeddings):
    good, odd = vectors()
    x = np.array([v for _, v, _ in good], dtype=np.float32).astype(float)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    label = np.array([k for *_, k in good])
    linked = (u @ u.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    ids = [i for i, *_ in good]
    root = smallest_reachable(len(good), [np.flatnonzero(row).tolist() for row in linked])
    best = {}
    for i, k in enumerate(root):
        best[k] = min(best.get(k, ids[i]), ids[i])
    expected = sorted([(ids[i], int(linked[i].sum()), best[root[i]]) for i in range(len(good))] + [(i, 0, i) for i, *_ in odd], key=str)
    for how in ({}, {"block": 16, "pivots": 64}):
        got = cover_tree.near_duplicates(embeddings, **how).collect()
        assert sorted([(r["vec_id"], r["n_links"], r["component_id"]) for r in got], key=str) == expected
    assert cover_tree.near_duplicates(embeddings.where("false")).count() == 0


def test_traversal_measures_few_pairs_of_clustered_vectors():
    r = np.random.default_rng(0)
    x, ones = np.repeat(r.standard_normal((30, 32)), 40, 0) + 0.1 * r.standard_normal((1200, 32)), np.ones(1200, dtype=int)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= 0.93
    links, _, _, evaluated = cover_tree.dual_links(x, None, ones, ones)
    assert links.tolist() == (near.sum(1) - 1).tolist() and evaluated < 0.2 * 1200 * 1199 / 2
    la, lb, _, evaluated = cover_tree.dual_links(x[:500], x[500:], ones[500:], ones[:500])
    assert la.tolist() == near[:500, 500:].sum(1).tolist() and lb.tolist() == near[500:, :500].sum(1).tolist() and evaluated < 0.25 * 500 * 700
    tree = cover_tree.CoverTree(u, 0.0)
    node, apart = tree.descend(u)
    assert np.allclose(apart, np.linalg.norm(u - u[tree.levels[-1][0][node]], axis=1), atol=1e-6) and apart.max() < 0.7
    for k, (centres, reach, _) in enumerate(tree.levels):
        assert (np.linalg.norm(u - u[centres[tree.owners[k]]], axis=1) <= reach[tree.owners[k]] + 1e-7).all()


def test_nearest_neighbours_recall_and_exact_scores(spark, embeddings):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got, all_ = multiprobe.nearest(e).toPandas(), e.toPandas()
    x, ids = np.stack(all_["embedding"]).astype(float), all_["vec_id"].to_numpy()
    hit = 0
    for q, own in got.groupby("query_id"):
        s = x @ x[ids == q][0]
        best = [ids[i] for i in np.lexsort((ids, -s)) if ids[i] != q][:20]
        hit += len(set(best) & set(own["vec_id"]))
        assert own.sort_values("rank")["score"].is_monotonic_decreasing and np.allclose(own["score"], [s[ids == v][0] for v in own["vec_id"]], atol=1e-12)
    assert hit / len(got) >= 0.9 and len(got) == 20 * (ids % 20 == 0).sum()
    odd = multiprobe.nearest(embeddings, target=1.0).toPandas()
    assert not set(odd["vec_id"]) & set(range(300, 400)) and set(odd["query_id"]) == {i for i in range(0, 245, 20)} | {400}
    good, extra = vectors()
    every = {i: np.array(v, dtype=np.float32).astype(float) for i, v, _ in good} | {400: np.array(extra[6][1], dtype=np.float32).astype(float)}
    for q, own in odd.groupby("query_id"):
        scores = sorted((-float((every[q] * v).sum()), i) for i, v in every.items() if i != q)[:20]
        assert own.sort_values("rank")["vec_id"].tolist() == [i for _, i in scores]
    assert multiprobe.nearest(embeddings.where("false")).count() == 0


def test_every_query_gets_its_rows(spark):
    """Small tables give all candidates, and outliers far from a cluster get ``top`` rows, at the default target."""
    r = np.random.default_rng(5)
    for n in (2, 13, 15, 21):
        small = [(i, r.standard_normal(8).tolist()) for i in range(n)]
        got = multiprobe.nearest(spark.createDataFrame(small, "vec_id long, embedding array<float>"), every=1).toPandas()
        assert len(got) == n * (n - 1) == len(got[["query_id", "vec_id"]].drop_duplicates())
    near = [(i, (np.eye(8)[0] + 0.01 * r.standard_normal(8)).tolist()) for i in range(1, 3000) if i % 20]
    far = [(20 * i, (-2 * np.eye(8)[0] + 0.01 * r.standard_normal(8)).tolist()) for i in range(5)]
    same = [(5, (-2 * np.eye(8)[0] + 0.01 * r.standard_normal(8)).tolist()) for _ in range(4)]  # one id, many vectors
    got = multiprobe.nearest(spark.createDataFrame(near + far + same, "vec_id long, embedding array<float>")).toPandas()
    assert got.groupby("query_id").size().to_dict() == {20 * i: 20 for i in range(5)}
    assert (got["query_id"] != got["vec_id"]).all()
    many = [(i, r.standard_normal(8).tolist()) for i in range(500)]
    got = multiprobe.nearest(spark.createDataFrame(many, "vec_id long, embedding array<float>"), every=1).toPandas()
    x = np.array([v for _, v in many], dtype=np.float32).astype(float)
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    best = {i: set(np.argsort(-s[i])[:20].tolist()) for i in range(500)}
    assert got.groupby("query_id").size().to_dict() == {i: 20 for i in range(500)}
    assert sum(v in best[q] for q, v in zip(got["query_id"], got["vec_id"], strict=True)) >= 0.9 * 10_000


def test_recall_holds_on_more_vectors_and_small_blocks(spark, monkeypatch):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = multiprobe.nearest(e)
    rows = sorted(map(tuple, got.collect()))
    all_ = e.toPandas()
    x, ids = np.stack(all_["embedding"]).astype(float), all_["vec_id"].to_numpy()
    best = {(q, v) for q in ids[ids % 20 == 0] for v in ids[np.argsort(-np.where(ids == q, -np.inf, x @ x[ids == q][0]), kind="stable")[:20]]}
    assert len(rows) == len(best) and sum((q, v) in best for q, _, v, _ in rows) >= 0.9 * len(best)
    monkeypatch.setattr(multiprobe, "QUERIES", 7)
    assert sorted(map(tuple, multiprobe.nearest(e).collect())) == rows


def test_url_lists(spark):
    changes = spark.createDataFrame(
        [("w.org/EN", True, 0), ("W.ORG./x", True, 0), ("Example.com.", True, 10), ("example.com", False, 20), ("example.com", True, 20), ("a.example.com", True, 5), ("a.example.com", False, 8), ("x.org/en", True, 0), (None, True, 1), ("y.org", None, 1), ("z.org", True, None)],
        "pattern string, active boolean, at int",
    )
    pages = [("http://b.example.com/q", 9), ("https://u@b.example.com:80/", 10), ("http://a.example.com", 7), ("http://a.example.com", 8), ("http://x.org/en?p", 1), ("http://x.org/de", 1), (None, 1), ("nonsense", 1), ("http://b.example.com/q", None), ("http://badexample.com/", 15), ("http://w.org/EN", 1), ("http://W.org/en", 1), ("http://w.org/x/", 1), ("http://w.org/X", 1), ("http://w.org/EN/" + "y" * 100_000, 1)]
    got = [(r["blocked"], r["pattern"]) for r in url_lists.filter_captures(spark.createDataFrame(pages, "url string, fetched int").coalesce(1).withColumn("pattern", F.lit(1)).withColumn("blocked", F.lit(2)).withColumn("looked", F.lit(3)).withColumn("_at", F.lit(4)), changes).orderBy(F.coalesce("url", F.lit("")), "fetched").collect()]
    assert Counter(got) == Counter([(True, "example.com"), (True, "a.example.com"), (True, "x.org/en"), (True, "w.org/EN"), (True, "w.org/EN"), (True, "w.org/x")] + [(False, None)] * 9)
    captures = spark.createDataFrame(pages, "url string, fetched int")
    assert url_lists.filter_captures(captures.where("false"), changes).count() == 0
    none = url_lists.filter_captures(captures, changes.where("false"))
    assert none.count() == len(pages) and none.where("blocked").count() == 0
    assert url_lists.filter_captures(captures.withColumn("blocked", F.lit(1)).withColumn("_url", F.lit(1)), changes).columns == ["url", "fetched", "_url", "blocked", "pattern"]


def test_interpolated_scores(docs, empty):
    got = interpolation.score_documents(docs, chunk_tokens=500).toPandas()
    rows = [(i, lower(t or "").encode().split() + [b""]) for i, t, *_ in documents()]
    train = [w for i, w in rows if zlib.crc32(b"" if i is None else str(i).encode()) % 10]
    c = Counter(x for w in train for x in w)
    n, v = sum(c.values()), len(c)
    expected = sorted((str(i), len(w), sum(c[x] > 0 for x in w), round(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 5)) for i, w in rows)
    assert sorted((str(None if r.doc_id != r.doc_id else int(r.doc_id)), r.n_tokens, r.n_known, round(r.base_score, 5)) for r in got.itertuples()) == expected
    assert set(got["train_tokens"]) == {n} and (got["score"] < 0).all()
    assert interpolation.score_documents(empty).count() == 0


def brute_mixture(train):
    """Counts of training tokens, and the mixture of each context bucket by expectation-maximisation token by token."""
    pairs = [p for w in train for p in zip([b"", *w[:-1]], w, strict=True)]
    c, c2 = Counter(x for w in train for x in w), Counter(pairs)
    n, v, told = sum(c.values()), len(c), {}
    ratio = lambda a, b: a / b if b else 0.0
    for h, w in pairs:
        told.setdefault((c[h] - 1).bit_length(), []).append((ratio(c2[h, w] - 1, c[h] - 1), ratio(c[w] - 1, n - 1), 1 / (v + 1)))
    mix = {}
    for b, own in told.items():
        p, m = np.array(own), np.full(3, 1 / 3)
        for _ in range(60):
            share = p * m
            m = (share / share.sum(1, keepdims=True)).mean(0)
        m = np.maximum(m, [0, 0, 1e-6])
        mix[b] = m / m.sum()
    zero = mix.get(0, np.full(3, 1 / 3))
    mix[0] = np.array([0, zero[0] + zero[1], zero[2]])
    return c, c2, n, v, mix


def test_interpolated_scores_match_brute_force(docs):
    got = interpolation.score_documents(docs, chunk_tokens=500).toPandas()
    rows = [(i, lower(t or "").encode().split() + [b""]) for i, t, *_ in documents()]
    c, c2, n, v, mix = brute_mixture([w for i, w in rows if zlib.crc32(b"" if i is None else str(i).encode()) % 10])

    def p(h, w):
        l2, l1, l0 = mix.get(c[h].bit_length(), np.full(3, 1 / 3))
        return l2 * (c2[h, w] / c[h] if c[h] else 0.0) + l1 * c[w] / n + l0 / (v + 1)

    expected = sorted((str(i), len(w), sum(math.log10(p(h, x)) for h, x in zip([b"", *w[:-1]], w, strict=True))) for i, w in rows)
    ours = sorted((str(None if r.doc_id != r.doc_id else int(r.doc_id)), r.n_tokens, r.score) for r in got.itertuples())
    assert [x[:2] for x in ours] == [x[:2] for x in expected]
    assert all(math.isclose(a[2], b[2], rel_tol=5e-3, abs_tol=5e-3) for a, b in zip(ours, expected, strict=True))
    # a distribution: over all words and the unknown one, the probabilities after a context sum to one
    for h in (b"", b"alpha", b"beta"):
        assert math.isclose(sum(p(h, w) for w in c) + p(h, b"never seen"), 1.0)


def test_mixture_of_cells_and_no_training_rows(spark):
    packed = interpolation.unpack(interpolation.pack(np.array([0, 5, 1 << 40], dtype=np.uint64)))
    assert packed.tolist() == [0, 5, 1 << 40] and interpolation.unpack(interpolation.pack(np.zeros(0, np.uint64))).tolist() == []
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = spark.createDataFrame([(str(held), "some words here"), (str(held), None)], "doc_id string, text string").withColumn("chunk", F.lit(1)).withColumn("tokens", F.lit(1))
    got = interpolation.score_documents(rows).toPandas()
    assert got["score"].tolist() == [0.0, 0.0] and set(got["train_tokens"]) == {0} and got["held_out"].all() and set(got["doc_id"]) == {str(held)}


def test_digest_columns(docs):
    out = {r["doc_id"]: r for r in queries.token_digests(bpe.encode_decode(docs)).collect() if r["doc_id"] is not None}
    text = documents()[0][1]
    ids = bpe.tokenizer(bpe.default_path()).encode(text, add_special_tokens=False).ids
    assert out[0]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and out[0]["n_tokens"] == len(ids)
    assert out[0]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_budgets_of_few_large_sizes_are_met():
    for sizes, counts, budget in (([70_001, 70_003], [60_000, 60_000], 4_200_155_000), ([70_001, 70_003, 90_007], [60_000, 60_000, 3], 4_200_155_000), ([500, 500_000], [10**6, 100], 123_456_500)):
        took = mixing.fit_budget(np.array(sizes), np.array(counts), budget)
        assert (took >= 0).all() and (took <= counts).all() and int((took * np.array(sizes)).sum()) == budget
    r = random.Random(4)
    for _ in range(100):  # any sum of two sizes is met
        sizes = sorted(r.sample(range(60_000, 90_000), 2))
        counts = [r.randrange(1_000, 50_000) for _ in sizes]
        budget = sum(s * r.randrange(0, c + 1) for s, c in zip(sizes, counts, strict=True))
        took = mixing.fit_budget(np.array(sizes), np.array(counts), budget)
        assert (took >= 0).all() and (took <= counts).all() and int((took * np.array(sizes)).sum()) == budget


def test_scaled_copies_of_pivots_need_few_levels(spark):
    r = np.random.default_rng(6)
    base = r.normal(size=(4, 8))
    many = np.concatenate([base * k for k in range(1, 501)])
    tree = cover_tree.CoverTree(cover_tree.unit(many), cover_tree.EPS)
    assert len(tree.levels) < 60
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(many)]
    got = {x["vec_id"]: (x["n_links"], x["component_id"]) for x in cover_tree.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), block=16).collect()}
    unit = many / np.linalg.norm(many, axis=1)[:, None]
    near = unit @ unit.T >= 0.93
    assert {i: x[0] for i, x in got.items()} == {i: int(n) - 1 for i, n in enumerate(near.sum(axis=1))}
    assert {x[1] for x in got.values()} == {min(np.flatnonzero(row)) for row in near}


def test_column_names_in_other_cases(spark, docs):
    """Names are compared as Spark does: the operators read TEXT as text and replace N_LINES and P_Toxic."""
    plain = spark.createDataFrame(documents(), DOCS)
    loud = plain.toDF("DOC_ID", "TEXT", "Lang", "SOURCE", "N_Chars").withColumns({"N_LINES": F.lit("x"), "P_Toxic": F.lit("x")})

    def rows(df, *names):
        return sorted((tuple(str(x) for x in r) for r in df.select(*names).collect()))

    kept = line_dedup.apply_bitmaps(loud, line_dedup.keep_bitmaps(loud))
    assert [c.lower() for c in kept.columns].count("n_lines") == 1 and kept.columns[1] == "TEXT"
    assert rows(kept, "doc_id", "text", "n_dropped") == rows(line_dedup.apply_bitmaps(plain, line_dedup.keep_bitmaps(plain)), "doc_id", "text", "n_dropped")
    assert kept.where("n_dropped > 0").count() > 5 and line_dedup.drop_common_lines(loud).columns == loud.columns
    model = toxicity.Model({}, np.array([1.0]))
    assert [c.lower() for c in toxicity.grade(loud, model).columns].count("p_toxic") == 1
    assert rows(mixing.mix(loud), "doc_id", "size", "target", "copies") == rows(mixing.mix(plain), "doc_id", "size", "target", "copies")
    assert mixing.mixed_documents(loud).columns == loud.columns and rows(mixing.mixed_documents(loud), "doc_id", "text") == rows(mixing.mixed_documents(plain), "doc_id", "text")
    assert rows(simhash.near_duplicates(loud), "doc_id", "fingerprint", "component_id") == rows(simhash.near_duplicates(plain), "doc_id", "fingerprint", "component_id")
    assert rows(private_data.find_private_data(loud), "doc_id", "spans") == rows(private_data.find_private_data(plain), "doc_id", "spans")
    assert rows(bpe.encode_decode(loud), "doc_id", "decoded") == rows(bpe.encode_decode(plain), "doc_id", "decoded")
    vectors = spark.createDataFrame([(i, [float(i % 3), 1.0], 1) for i in range(30)], "Vec_Id long, EMBEDDING array<double>, Label int")
    assert cover_tree.near_duplicates(vectors).where("n_links >= 9").count() == 30 and multiprobe.nearest(vectors).count() == 40
    pages = spark.createDataFrame([("http://x.org/a", 5)], "URL string, Fetched int").withColumn("BLOCKED", F.lit(1))
    changes = spark.createDataFrame([("x.org", True, 1)], "Pattern string, Active boolean, AT int")
    assert [tuple(r) for r in url_lists.filter_captures(pages, changes).collect()] == [("http://x.org/a", 5, True, "x.org")]


def test_url_entries_with_longer_paths(spark):
    changes = spark.createDataFrame([("x.org/EN/", True, 1), ("X.org./a/b", True, 1), ("y.org/a/b/c//", True, 1), ("z.org//d", True, 1)], "pattern string, active boolean, at int")
    want = {"http://x.org/EN": "x.org/EN", "http://x.org/EN/page?q": "x.org/EN", "http://x.org/en/": None, "http://x.org/a": None, "http://x.org/a/b/c#f": "x.org/a/b", "http://x.org/a/bc": None, "http://u@y.org:80/a/b/c/d": "y.org/a/b/c", "http://z.org//d/e": "z.org//d", "http://z.org/d": None}
    got = url_lists.filter_captures(spark.createDataFrame([(u, 5) for u in want], "url string, fetched int"), changes)
    assert {r["url"]: r["pattern"] for r in got.collect()} == want
