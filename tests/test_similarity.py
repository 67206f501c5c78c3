"""Largest similarities match a loop over all pairs, for small and large sets."""

import random

import pyarrow as pa
import pytest

from tidemark.operators import likeness, outcomes, sets


@pytest.mark.parametrize("most", [2, 4, 8])
def test_max_similarity_matches_a_loop(spark, most):
    r = random.Random(most)
    rows = [(r.choice("ab"), i, t, r.choice([None, t + r.randrange(-20, 60), t + 30]), r.choice(["clean", "rework", "nowhere"])) for i, t in ((i, r.randrange(300)) for i in range(150))]
    sets = {x[1]: set(r.sample(range(14), r.choice([0, 1, 2, 3, 4, 5, 6, 10]))) for x in rows}
    want = {}
    for repo, i, t, *_ in rows:
        open_, recent, n = 0.0, 0.0, 0
        for p, o, u, c, y in rows:
            j = len(sets[i] & sets[o]) / max(1, len(sets[i] | sets[o]))
            was = y != "nowhere" and c is not None and t - 40 <= c < t
            n += p == repo and was
            if p == repo and o != i:
                open_ = max(open_, j) if u < t and (c is None or c > t) else open_
                recent = max(recent, j) if was else recent
        want[i] = (round(open_, 9), round(recent, 9) if n else None)
    pr = spark.createDataFrame(rows, "repo string, pr_number int, t_open long, t_close long, y string")
    tokens = spark.createDataFrame([(i, f"t{x}") for i, s in sets.items() for x in s], "pr_number int, token string")
    out = outcomes.max_similarity(pr, tokens, 40, most)
    got = {x[0]: (round(x[1], 9), None if x[2] is None else round(x[2], 9)) for x in out.collect()}
    assert got == want


def test_strong_pairs_are_counted_once_and_go_both_ways(spark):
    df = spark.createDataFrame([(1, 5), (1, 7), (1, 7), (2, 7), (2, 5), (2, 9), (3, 9)], "k long, e long")
    assert sorted(tuple(r) for r in sets.strong_pairs(df, "k", "e", 2).collect()) == [(5, 7), (7, 5)]


def test_sets_of_sixteen_make_no_pairs_by_single_tokens(spark, monkeypatch):
    """Sets of 9 to 16 tokens met all others by each token: pairs grew with the square of a repository."""
    r = random.Random(5)
    rows = [("a", i, t, r.choice([None, t + r.randrange(60)]), r.choice(["clean", "nowhere"])) for i, t in ((i, r.randrange(300)) for i in range(90))]
    own = {x[1]: set(r.sample(range(20), r.choice([1, 3, 5, 9, 12, 16]))) for x in rows}
    best = lambda i, seen: max([0.0, *[len(own[i] & own[x]) / len(own[i] | own[x]) for x in seen if x != i]])
    want = {}
    for _, i, t, *_ in rows:
        past = [o for _, o, _, c, y in rows if y != "nowhere" and c is not None and t - 40 <= c < t]
        want[i] = (round(best(i, [o for _, o, u, c, _ in rows if u < t and (c is None or c > t)]), 9), round(best(i, past), 9) if past else None)
    monkeypatch.setattr(outcomes, "_meeting", None)
    pr = spark.createDataFrame(rows, "repo string, pr_number int, t_open long, t_close long, y string")
    tokens = spark.createDataFrame([(i, f"t{x}") for i, s in own.items() for x in s], "pr_number int, token string")
    out = outcomes.max_similarity(pr, tokens, 40)
    assert {x[0]: (round(x[1], 9), None if x[2] is None else round(x[2], 9)) for x in out.collect()} == want


def test_similarity_is_the_same_group_by_group_and_with_renumbered_subsets(monkeypatch):
    r = random.Random(7)
    t = [r.randrange(-50, 500) for _ in range(300)]
    batch = pa.RecordBatch.from_pydict({
        "repo": [r.choice("ab") for _ in t], "token": [r.randrange(4) for _ in t], "rest": [sorted(r.sample(range(4, 14), r.randrange(8))) for _ in t], "pr_number": list(range(300)),
        "t_open": t, "t_close": [r.choice([None, x + r.randrange(90)]) for x in t], "merged": [r.random() < 0.8 for _ in t], "n": [9] * 300})
    found = lambda: sorted(tuple(x.values()) for b in likeness.best_of(60, "pr_number")(iter([batch])) for x in b.to_pylist())
    want = found()
    monkeypatch.setattr(likeness, "SUBSETS", 1)
    monkeypatch.setattr(likeness, "PAIRS", 1)
    monkeypatch.setattr(likeness, "LARGEST", 2**20)
    assert want == found() and len(want) > 200


def test_rows_of_no_repository_are_like_none(spark):
    """A missing repository equals no other, as in SQL; such rows found one another."""
    pr = spark.createDataFrame([(r, i, 10 * i, 10 * i + 15, "clean") for i, r in enumerate([None, None, "a", "a"])], "repo string, pr_number int, t_open long, t_close long, y string")
    tokens = spark.createDataFrame([(i, "x") for i in range(4)], "pr_number int, token string")
    assert sorted(tuple(r) for r in outcomes.max_similarity(pr, tokens, 40).collect()) == [(0, 0.0, None), (1, 0.0, None), (2, 0.0, None), (3, 1.0, None)]
