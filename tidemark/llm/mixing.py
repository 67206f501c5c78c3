"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by (source, exact size). Each source's target gives whole passes over it and a remaining
budget; a bounded-knapsack dynamic program over the size counts says how many documents of each size fill that
budget, and documents of each size are then selected in the order of a seeded hash. Only size counts meet in one
task (a source of w words has at most sqrt(2w) sizes). Source totals stay distributed: targets are found by raising
one level, from one aggregate a round.

A budget that can be met is met, at every size. An even share of the documents in the order of their sizes comes within two largest
documents of the budget; the program then seeks documents to add and documents to take back. A best choice exists
that differs from the share by at most three times the largest size in documents (otherwise, put in an order in which
running sums stay within three largest sizes, some of the changes would cancel out), so bitsets of about twice its
square in words show what comes nearest if the budget can't be met; far smaller ones do as soon as it is. Where the
first bitsets don't meet it, as with few or round sizes, each pair of the ``PAIRED`` sizes with the most documents is
asked for the rest as a linear equation in two bounded whole numbers, for each change of the other sizes that bitsets
show: so sources of two sizes are met exactly at any size, and those of more as soon as a pair and such a change can.
Only then do bitsets grow, up to ``ROOM_MOST`` words for bounded memory: a budget that takes changes of more words in at
least three sizes at once is the one that could be missed, and is nearest among all smaller changes.

Defined results: a null or empty text has size 0 and takes 0 words; a null source is a source of its own, last in
order; a source of size 0 has target 0; each row is a document, rows with equal doc_id and size are told apart at
random but reproducibly; texts of any length are counted whole, long ones in pieces; columns other than doc_id, text
and source are ignored and kept, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import count_words, free_names, materialize, other_columns

WEIGHTS, SHARE, MOST, SEED = (5.0, 2.0, 1.0), 1.5, 2.0, 7
#: Words that the program's bitsets cover at first, and at most (128 MB each).
ROOM, ROOM_MOST = 1 << 16, 1 << 30
#: Sizes of which each pair is asked to make up the rest.
PAIRED = 8
#: Each byte with its bits reversed.
REVERSED = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


@F.pandas_udf(LongType())
def size_udf(text: pd.Series) -> pd.Series:
    return pd.Series([count_words(t) for t in text], dtype="int64")


def source_targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size) -> (source, source_size, target): ``share`` of all words split by weight, none above ``most`` times its size.

    Sources are put in code point order, null last, and get the weights in turn. What a source can't take is
    shared again by weight among those below their limit, until none is above it.
    """
    spark, order = totals.sparkSession, F.col("source").asc_nulls_last()
    ranged = materialize(totals.repartitionByRange(order).withColumn("part", F.spark_partition_id()))
    counts = sorted((r["part"], r["n"]) for r in ranged.groupBy("part").agg(F.count("*").alias("n")).collect())  # one number a partition
    before = [(p, sum(n for _, n in counts[:i])) for i, (p, _) in enumerate(counts)]
    rank = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    known = materialize(ranged.join(spark.createDataFrame(before, "part int, before long"), "part").select("source", "source_size", weight.alias("weight")))
    first = known.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("open")).first()
    words, left, total, n_above = share * (first["words"] or 0), share * (first["words"] or 0), first["open"] or 1.0, 0
    limit = F.col("source_size") * most
    while True:
        target = F.lit(float(left)) * F.col("weight") / F.lit(float(total))
        above = target > limit
        sums = known.agg(F.count_if(above).alias("n"), F.sum(F.when(above, limit)).alias("taken"), F.sum(F.when(~above, F.col("weight"))).alias("open")).first()
        if sums["n"] == n_above:
            return known.select("source", "source_size", F.when(above, limit).otherwise(target).alias("target"))
        left, total, n_above = words - sums["taken"], sums["open"] or 1.0, sums["n"]


def _parts(sizes: np.ndarray, counts: np.ndarray, room: int) -> list[tuple[int, int, int]]:
    """(words, size's place, documents): up to ``counts`` documents of each size in powers of two, small sizes first."""
    out = []
    for i in np.argsort(sizes, kind="stable").tolist():
        size = int(sizes[i])
        free, chunk = (min(int(counts[i]), room // size), 1) if size > 0 else (0, 1)
        while free > 0:
            n = min(chunk, free)
            out.append((n * size, i, n))
            free, chunk = free - n, 2 * chunk
    return out


def _reach(words: list[int], room: int) -> tuple[int, int]:
    """Bit s is set if parts can sum to s <= room; and how many parts were used, as none is needed once all bits are set."""
    bits, whole = 1, (1 << (room + 1)) - 1
    for k, w in enumerate(words):
        bits |= (bits << w) & whole
        if bits == whole:
            return bits, k + 1
    return bits, len(words)


def _reversed(bits: int, n: int) -> int:
    """Bit i of ``n`` bits goes to n - 1 - i."""
    size = -(-n // 8)
    return int.from_bytes(bits.to_bytes(size, "little").translate(REVERSED)[::-1], "little") >> (8 * size - n)


def _choose(words: list[int], total: int, at: int = 0) -> list[int]:
    """Places of parts that sum to ``total``, which they can: halves are asked for sums that add up to it."""
    if not total:
        return []
    if len(words) == 1:
        return [at]
    half = len(words) // 2
    one, two = _reach(words[:half], total)[0], _reach(words[half:], total)[0]
    both = one & _reversed(two, total + 1)
    left = (both & -both).bit_length() - 1
    return _choose(words[:half], left, at) + _choose(words[half:], total - left, at + half)


def _places(bits: int) -> np.ndarray:
    raw = np.frombuffer(bits.to_bytes(bits.bit_length() // 8 + 1, "little"), np.uint8)
    at = np.flatnonzero(raw)
    row, bit = np.nonzero(np.unpackbits(raw[at], bitorder="little").reshape(-1, 8))
    return at[row] * 8 + bit


def _two_sizes(sizes: np.ndarray, counts: np.ndarray, take: np.ndarray, missing: int) -> np.ndarray | None:
    """``take`` changed by ``missing`` words: any number of two sizes, and words of the others that ``ROOM`` bits show."""
    most = [i for i in np.argsort(-counts, kind="stable")[:PAIRED].tolist() if counts[i] and sizes[i]]
    for i, j in combinations(most, 2):
        a, b = int(sizes[i]), int(sizes[j])
        others = np.arange(len(sizes))
        others = others[(others != i) & (others != j)]
        adds, backs = _parts(sizes[others], (counts - take)[others], ROOM), _parts(sizes[others], take[others], ROOM)
        (plus, n_plus), (minus, n_minus) = (_reach([w for w, *_ in parts], ROOM) for parts in (adds, backs))
        change = np.concatenate([_places(plus), -_places(minus)])
        g = math.gcd(a, b)
        p, q = a // g, b // g
        change = change[(missing - change) % g == 0]
        rest = (missing - change) // g  # = x p + y q
        x = rest % q * pow(p, -1, q) % q if q > 1 else np.zeros_like(rest)
        y = (rest - x * p) // q
        # all solutions are x + t q, y - t p
        low = np.maximum(-((x + take[i]) // q), -((counts[j] - take[j] - y) // p))
        high = np.minimum((counts[i] - take[i] - x) // q, (y + take[j]) // p)
        fits = np.flatnonzero(low <= high)
        if len(fits):
            k = fits[np.abs(change[fits]).argmin()]
            t = min(max(round(-int(x[k]) / q), int(low[k])), int(high[k]))
            out = take.copy()
            out[i] += int(x[k]) + t * q
            out[j] += int(y[k]) - t * p
            amount, parts, sign = (int(change[k]), adds[:n_plus], 1) if change[k] > 0 else (-int(change[k]), backs[:n_minus], -1)
            for c in _choose([w for w, *_ in parts], amount):
                out[others[parts[c][1]]] += sign * parts[c][2]
            return out
    return None


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, room: int = ROOM) -> np.ndarray:
    """How many documents of each size to take, at most ``counts``, so that their words come nearest ``budget`` from below."""
    counts = np.where(sizes > 0, counts, 0).astype(np.int64)
    total = sum(s * c for s, c in zip(sizes.tolist(), counts.tolist(), strict=True))
    if budget <= 0 or total <= 0:
        return np.zeros(len(sizes), dtype=np.int64)
    if budget >= total:
        return counts
    unit = int(np.gcd.reduce(sizes[counts > 0]))
    sizes, total, budget = sizes // unit, total // unit, budget // unit
    largest, order = int(sizes[counts > 0].max()), np.argsort(sizes, kind="stable")
    take = np.zeros(len(sizes), dtype=np.int64)
    take[order] = np.diff(np.cumsum(counts[order]).astype(object) * max(0, budget - largest) // total, prepend=0).astype(np.int64)
    had = sum(s * t for s, t in zip(sizes.tolist(), take.tolist(), strict=True))
    missing, enough = budget - had, min(max(had, total - had), 2 * largest * (largest + 1), ROOM_MOST)
    room, first = max(room, min(missing, ROOM_MOST)), True
    while True:
        adds, backs = _parts(sizes, counts - take, room), _parts(sizes, take, room)
        (plus, n_plus), (minus, n_minus) = (_reach([w for w, *_ in parts], room) for parts in (adds, backs))
        met = plus & (minus << missing)
        if met:
            a = (met & -met).bit_length() - 1
            b = a - missing
            break
        made = _two_sizes(sizes, counts, take, missing) if first else None
        if made is not None:
            return made
        first = False
        if room >= enough:
            up, down = _places(plus), _places(minus)
            best = up[np.searchsorted(up, down + missing, side="right") - 1]
            k = int((best - down).argmax())
            a, b = int(best[k]), int(down[k])
            break
        room = min(8 * room, max(enough, missing))
    for parts, n, amount, sign in ((adds, n_plus, a, 1), (backs, n_minus, b, -1)):
        for k in _choose([w for w, *_ in parts[:n]], amount):
            take[parts[k][1]] += sign * parts[k][2]
    return take


def _fit(counted: pd.DataFrame) -> pd.DataFrame:
    sizes, counts = counted["size"].to_numpy(np.int64), counted["n"].to_numpy(np.int64)
    total, target = int(counted["source_size"].iloc[0]), float(counted["target"].iloc[0])
    passes = int(target // total) if total else 0
    return counted.assign(passes=passes, extra=fit_budget(sizes, counts, int(round(target - passes * total))))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """(doc_id, source, text_hash, size, source_size, target, copies) for each row: how often the mix repeats it."""
    sized = materialize(
        docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), size_udf(F.col("text")).alias("size")).hint("rebalance")
    )
    counted = materialize(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    known = source_targets(counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, most)
    known = known.withColumnRenamed("source", "name")
    plan = materialize(
        counted.join(known, F.col("source").eqNullSafe(F.col("name"))).drop("name")
        .groupBy("source").applyInPandas(_fit, "source string, size long, n long, source_size long, target double, passes int, extra long")
    )
    p = plan.withColumnsRenamed({"source": "p_source", "size": "p_size"})
    order = F.xxhash64(F.lit(seed), "doc_id", "text_hash")
    # a size's documents are ranked in about sqrt(n) blocks of sqrt(n), never all in one task
    blocks = F.greatest(F.lit(1), F.ceil(F.sqrt("n"))).cast("long")
    dealt = materialize(
        sized.join(p, sized["source"].eqNullSafe(p["p_source"]) & (sized["size"] == p["p_size"]))
        .withColumn("order", order)
        .withColumn("block", F.pmod("order", blocks))
        .drop("p_source", "p_size")
    )
    within = Window.partitionBy("source", "size").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("source", "size", "block").agg(F.count("*").alias("here"))
        .select(F.col("source").alias("o_source"), F.col("size").alias("o_size"), F.col("block").alias("o_block"),
                F.coalesce(F.sum("here").over(within), F.lit(0)).alias("before"))
    )
    ranked = Window.partitionBy("source", "size", "block").orderBy("order", "doc_id")
    return (
        dealt.join(offsets, dealt["source"].eqNullSafe(offsets["o_source"]) & (dealt["size"] == offsets["o_size"]) & (dealt["block"] == offsets["o_block"]))
        .withColumn("rank", F.col("before") + F.row_number().over(ranked))
        .select("doc_id", "source", "text_hash", "size", "source_size", "target",
                (F.col("passes") + F.when(F.col("rank") <= F.col("extra"), 1).otherwise(0)).cast("int").alias("copies"))
    )


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with the same columns, each row as often as the mix takes it.

    Rows of one document (equal doc_id, text and source) have equal sizes, so the mix takes them equally often but
    for one more of some: a document's least number and how many rows get one more go back to its rows.
    """
    key, key2, least, more, times = free_names(docs.columns, "document", "document_", "least", "more", "times")
    taken = mix(docs, **how).groupBy(F.struct("doc_id", "text_hash", "source").alias(key2)).agg(
        F.min("copies").alias(least), (F.sum("copies") - F.count("*") * F.min("copies")).alias(more)
    )
    # a struct has no nulls of its own, so one exchange of the texts by it serves the join and the window
    named = docs.withColumn(key, F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("source")))
    others = other_columns(docs.columns, "doc_id", "text", "source")
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64(F.lit(0), *others)))
    return (
        named.join(taken, F.col(key) == F.col(key2))
        .withColumn(times, F.col(least) + (place <= F.col(more)).cast("int"))
        .where(F.col(times) > 0)
        .withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
        .select(*docs.columns)
    )
