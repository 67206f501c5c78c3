"""Packing, ranked search and spelling variants against brute force, and on nulls, empty tables, ties, repeats and clashing columns."""

import math
import random
import re
import zlib
from collections import Counter, OrderedDict, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import block_max, packing, variants

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(seed=0, n=60):
    """Rows with nulls, empty and long texts, copies and repeated rows."""
    r = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "délta", "Zeta", "it's", "ÀÉ", "日本", "x1y2", "a--b", "<|endoftext|>", "theta,"]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randrange(1, 90))), "en", "a", 1) for i in range(n)]
    rows += [(n, None, None, None, None), (n + 1, "", "en", "a", 0), (n + 2, " \n\t", "en", "b", 3), (n + 3, "wörd " * 9_000, "de", "a", 45_000)]
    return [*rows, rows[1], (n + 4, rows[1][1], "en", "b", 1), (None, "no id here", "en", "a", 10)]


@pytest.fixture(scope="module")
def docs(spark):
    out = spark.createDataFrame(documents(), DOCS)
    for c in ("Start", "ids", "length", "STEP", "term", "n", "segment", "word", "Form", "key", "tf", "score", "item_id", "m"):
        out = out.withColumn(c, F.lit("clash"))
    return out


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def padding(lengths, window):
    return sum(0 if n & (n - 1) == 0 else window - n for n in lengths)


def test_packing_holds_each_id_once(docs, empty):
    path = packing.default_path()
    expected = Counter()
    for i, text, *_ in documents():
        expected[(i, (*packing.encode_texts([text or ""], path)[0], packing.END))] += 1
    rows = packing.pack(docs, window=512, least_tier=64, block=4000, step=2).collect()
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r["offset"])
        at = 0
        for r in own:
            assert r["offset"] == at and r["length"] > 0 and len(r["ids"]) == 4 * r["length"]
            at += r["length"]
        assert at <= 512 and {r["sequence_tokens"] for r in own} == {at} and len({r["step"] for r in own}) == 1
    assert padding([own[0]["sequence_tokens"] for own in sequences.values()], 512) == 0
    # pieces of rows with one doc_id and equal ids are alike, so what matters is how often each id of a document occurs
    found, wanted = Counter(), Counter()
    for r in rows:
        found.update((r["doc_id"], r["start"] + k, x, r["doc_tokens"]) for k, x in enumerate(np.frombuffer(r["ids"], "<u4").tolist()))
    for (i, ids), n in expected.items():
        for k, x in enumerate(ids):
            wanted[(i, k, x, len(ids))] += n
    assert found == wanted
    assert packing.pack(empty).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, window=1000)


def test_tiers_gaps_and_steps():
    r = random.Random(5)
    for sizes in ([1], [4096], [4097, 3], [300] * 50, [r.choice([1, 2, 300, 5_000, int(r.expovariate(1 / 1200)) + 1]) for _ in range(400)]):
        sequences = packing.pack_block(np.array(sizes))
        held = sorted((d, at, n) for s in sequences for d, at, n in s)
        ends = defaultdict(int)
        for d, at, n in held:
            assert ends[d] == at
            ends[d] = at + n
        assert [ends[d] for d in range(len(sizes))] == sizes
        lengths = [sum(n for *_, n in s) for s in sequences]
        assert padding(lengths, 4096) == 0 and max(lengths) <= 4096
        # cut at most once for each sequence, besides the cuts into windows
        assert len(held) <= len(sizes) + sum(n // 4096 for n in sizes) + len(sequences) + 13
        loads = Counter()
        for step, n in zip(packing.balanced_steps(lengths, 16_384), lengths, strict=True):
            loads[step] += n
        assert max(loads.values()) - min(loads.values()) <= max(lengths)
    # the longest documents open the longest windows, the largest that fits fills the gap, a document is cut only where none fits
    assert packing.pack_block(np.array([3000, 1000, 96, 500, 12])) == [[(0, 0, 3000), (1, 0, 1000), (2, 0, 96)], [(3, 0, 500), (4, 0, 12)]]


def test_ranks_encode_as_the_library_does():
    r = random.Random(3)
    path = packing.default_path()
    runs = ["it's", "Don'T", "naïve", "x" * 50, "日本語", "<|endoftext|>", "<|x", "ΑΣ", "İx", "ß", "×", "a\x1cb", "\x01", " \n ", "", " a b "]
    for letters in ("'sStTrReEvVmMlLdDaé0_-ÀßÿŸ×\x00\x1c Σσ<|>", "'sSabcÀé0,. "):
        runs += ["".join(r.choice(letters) for _ in range(r.randrange(1, 12))) for _ in range(2000)]
    ids, ends = packing.encode_slice(pa.array(runs), path)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == packing.encode_texts(runs, path)
    assert packing.ranks_with_word_ends(path) is not None


def brute_words(rows, one_in, min_letters=5, min_count=3):
    counts = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % one_in == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_letters and n >= min_count}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute_variants(words):
    out = {}
    near = {w: [x for x in words if abs(len(w) - len(x)) < 2 and edits(w, x) == 1] for w in words}
    form = {}
    for w, n in words.items():
        top = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = top if top is not None and words[top] >= 2 * n else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (n, len(near[w]), form[w], words.get(form[w]), root)
    return out


def misspelt(seed, n_docs, syllables):
    """Documents of words that are one or more edits from one another, some frequent."""
    r = random.Random(seed)
    stems = ["".join(r.choice(syllables) for _ in range(r.randrange(2, 6))) for _ in range(40)]
    rows = []
    for i in range(n_docs):
        words = []
        for _ in range(60):
            w = r.choice(stems[: r.randrange(1, 41)])
            for _ in range(r.choice([0, 0, 0, 1, 1, 2])):
                k, c = r.randrange(len(w)), r.choice("abeé÷")
                w = r.choice([w[:k] + w[k + 1 :], w[:k] + c + w[k + 1 :], w[:k] + c + w[k:]])
            words.append(r.choice([w, w, w.upper(), w.title()]))
        rows.append((i, r.choice([" ", "-", "9", "日", "Ā"]).join(words), "en", "a", 1))
    return rows


@pytest.mark.parametrize(("syllables", "block"), [(["ab", "ba", "aa", "bé"], 8), (["lo", "ren", "ip", "sum", "à", "st"], 4096)])
def test_spelling_variants_match_brute_force(spark, syllables, block):
    rows = [*misspelt(4, 40, syllables), (None, "Alphabet alphabet alphabat " * 3, None, None, None), (7, None, None, None, None)]
    expected = brute_words(rows, 7)
    words = variants.count_words(spark.createDataFrame(rows, DOCS), one_in=7).where("n >= 3")
    assert {r["word"]: r["n"] for r in words.collect()} == expected and len(expected) > 60
    got = variants.group_variants(words.persist(), block=block).collect()
    assert {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got} == brute_variants(expected)
    assert len(got) == len(expected) and any(r["form"] for r in got)
    if block == 8:  # the vocabulary is dense, so that groups are dealt and chains are long
        assert any(r["root"] not in (r["word"], r["form"]) for r in got) and any(r["n_near"] > 5 for r in got)


def test_variants_of_odd_tables(docs, empty):
    rows = variants.spelling_variants(docs).collect()
    assert {r["word"]: r["n"] for r in rows} == brute_words(documents(), variants.ONE_IN)
    assert variants.spelling_variants(empty).count() == 0


def test_forms_lead_to_roots(spark):
    chain = [(f"w{i}", f"w{i + 1}" if i < 37 else None) for i in range(38)] + [("alone", None)]
    got = {r["word"]: r["root"] for r in variants.with_roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {f"w{i}": "w37" for i in range(38)} | {"alone": "alone"}
    with pytest.raises(ValueError, match="circle"):
        variants.with_roots(spark.createDataFrame([("a", "b"), ("b", "a")], "word string, form string"), max_rounds=5)


def brute_terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute_ranks(rows, items, top):
    bags = [(i, Counter(brute_terms(text))) for i, text, *_ in rows]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = Counter()
    for item, text in set(items):
        scored = []
        for i, bag in bags:
            m = 25 + (75 * bag.total() * n_docs) // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in brute_terms(text) if bag[t])
            scored += [(-score, i is None, i or 0)] * (score > 0)
        out.update((item, rank, None if none else i, -less) for rank, (less, none, i) in enumerate(sorted(scored)[:top], 1))
    return out


@pytest.mark.parametrize("segment", [1, 3_000, 1 << 25])
def test_ranked_search_matches_brute_force(spark, docs, segment):
    r = random.Random(8)
    rows = [*documents(), *[(1000 + i, " ".join(f"w{int(r.expovariate(0.02))}" for _ in range(r.randrange(1, 40))), None, None, None) for i in range(900)], *documents(9, 30)[:30]]
    items = [(i, " ".join(r.choice([f"w{int(r.expovariate(0.02))}", "alpha", "DÉLTA", "beta", "日本"]) for _ in range(r.randrange(1, 12)))) for i in range(25)]
    items += [(3, "alpha alpha beta"), items[5], (None, "theta gamma"), (40, None), (41, ""), (42, "nowhere"), (43, "alpha. ALPHA! alpha?")]
    frame = spark.createDataFrame(rows, DOCS).withColumn("Segment", F.lit(0)).withColumn("term", F.lit("clash")).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("hash", F.lit("clash"))
    n, total = block_max.corpus_size(frame)
    assert (n, total) == (sum(bool(brute_terms(x[1])) for x in rows), sum(len(brute_terms(x[1])) for x in rows))
    index = block_max.build_index(frame, n, total, segment_bytes=segment, block=8)
    got = Counter(map(tuple, block_max.search(index, asked, n, item_block=7, block=8).collect()))
    assert got == brute_ranks(rows, [x for x in items if x[1] is not None], 10)


def test_ranked_search_of_odd_tables(spark, docs, empty):
    items = spark.createDataFrame([(1, "alpha theta it"), (2, None)], "item_id long, text string")
    got = Counter(map(tuple, block_max.ranked_search(docs, items).collect()))
    assert got == brute_ranks(documents(), [(1, "alpha theta it")], 10)
    assert block_max.ranked_search(empty, items).count() == 0 and block_max.ranked_search(docs, items.limit(0)).count() == 0


def test_posting_blocks_round_trip():
    r = np.random.default_rng(2)
    for most, times in ((3, 1), (200, 300), (70_000, 2), (300, 70_000)):
        sizes = r.integers(1, 20, 30)
        docs = [np.cumsum(r.integers(1, most, n)) - 1 for n in sizes]
        tfs = [r.integers(1, times + 1, n) for n in sizes]
        gaps = np.concatenate([np.diff(d, prepend=-1) - 1 for d in docs])
        raw, ends = block_max.compressed(gaps, np.concatenate(tfs), np.repeat(np.arange(30), sizes), sizes)
        at = 0
        for d, tf, end in zip(docs, tfs, ends.tolist(), strict=True):
            got = block_max.decompressed(raw[at:end].tobytes(), len(d), -1)
            assert got[0].tolist() == d.tolist() and got[1].tolist() == tf.tolist()
            at = end


def test_shallow_moves_read_few_blocks():
    """A rare term that only the first documents hold keeps the blocks of a frequent one unread."""
    m = np.full(20_000, 100, np.int64)

    def postings(docs, tfs, kept):
        docs, tfs = np.array(docs), np.array(tfs)
        sizes = np.array([min(128, len(docs) - a) for a in range(0, len(docs), 128)])
        starts = np.cumsum(sizes) - sizes
        raw, ends = block_max.compressed(np.diff(docs, prepend=-1) - 1, tfs, np.repeat(np.arange(len(sizes)), sizes), sizes)
        best = np.maximum.reduceat(block_max.impact(tfs, m[docs]), starts)
        return block_max.Postings(len(docs), docs[starts + sizes - 1].astype("<i4").tobytes(), best.astype("<i4").tobytes(), ends.astype("<i4").tobytes(), raw.tobytes(), m, kept, 128)

    kept = OrderedDict()
    common = postings(range(20_000), [5 if d < 300 or d == 19_000 else 1 for d in range(20_000)], kept)
    rare = postings(range(0, 40, 2), [1] * 20, kept)
    got = block_max.search_segment([(common, 100), (rare, 500)])
    scores = [(100 * int(block_max.impact(np.int64(5 if d < 300 or d == 19_000 else 1), m[0])) + 500 * int(block_max.impact(np.int64(1), m[0])) * (d < 40 and d % 2 == 0), -d) for d in range(20_000)]
    assert got == [(s, -d) for s, d in sorted(scores, reverse=True)[:10]]
    assert len({key for key in kept if key[0] == id(common)}) <= 4  # of 157
