"""SimHash near-dedup: byte-position inverted index with count filtering.

A text's fingerprint has 64 bits over its 3-word shingles. Fingerprints that differ in at most 2 bits differ in
at most 2 of their 8 bytes, so they share at least 6 positional bytes: the guaranteed minimum. Lists of single
positional bytes hold n/256 fingerprints each and their pairs grow with n squared, so the index keeps the
intersections of six single-byte lists instead (28 of them a fingerprint). A pair meets in such a list exactly if
its tally of shared positional bytes reaches 6, so the key stands for the count filter, and a list can't hold more than
65,536 fingerprints, whatever the input. Pairs of a list are verified by Hamming distance (in lists of up to
``SMALL_LIST`` all of them, in longer ones those that look-ups of a value's neighbours find) and contracted to a
spanning star, so that groups of copies make no more links than members. Equal fingerprints count as one node.

Defined results: null, empty and blank texts have fingerprint zero and link like any other; fewer than three words
are one shingle; a group whose doc_ids are all null has a null component; rows with equal doc_id are rows of
one document; texts of any length are read whole, their shingles a chunk at a time; columns other than doc_id and text
are ignored and kept, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import ascii_words, free_names, materialize, shuffle_partitions
from .components import connected_components

SHINGLE, SEED, MAX_BITS = 3, 42, 2
#: Shingles whose hashes are held at once.
CHUNK = 1 << 16
#: The byte positions that a list of the index leaves out.
LEFT_OUT = list(combinations(range(8), 2))
#: Lists up to this size compare all their pairs at once; longer ones look up each value's neighbours.
SMALL_LIST = 96
#: All values of two bytes that differ from zero in one or two bits.
NEAR = np.array([m for m in range(1, 1 << 16) if m.bit_count() <= MAX_BITS], dtype=np.int64)


def fingerprint(text: str | None) -> int:
    """Signed 64-bit SimHash: a bit is set if it is set in over half of the shingles' XXH64, repeats included."""
    words = ascii_words(text)
    if not words:
        return 0
    shingles = max(1, len(words) - SHINGLE + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, shingles, CHUNK):
        many = [
            xxhash.xxh64_intdigest(b" ".join(words[i : i + SHINGLE]), SEED) for i in range(at, min(at + CHUNK, shingles))
        ]
        byte = np.array(many, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(byte, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > shingles, bitorder="little")
    return int(bits.view("<i8")[0])


@F.pandas_udf(LongType())
def fingerprint_udf(text: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in text], dtype="int64")


def list_links(values: np.ndarray, two: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Star links (member, root) of the distinct int64 fingerprints of one list, which share all bytes but ``two``."""
    raw = values.view(np.uint64)
    n = len(values)
    if n <= SMALL_LIST:
        byte = raw.view(np.uint8).reshape(n, 8)
        tally = (byte[:, None, :] == byte[None, :, :]).sum(axis=2)
        a, b = np.nonzero(np.triu(tally >= 8 - MAX_BITS, 1))
        near = np.bitwise_count(raw[a] ^ raw[b]) <= MAX_BITS
        a, b = a[near], b[near]
    else:
        low = ((raw >> np.uint64(8 * two[0])) & np.uint64(255)).astype(np.int64)
        value = low | (((raw >> np.uint64(8 * two[1])) & np.uint64(255)).astype(np.int64) << 8)
        place = np.full(1 << 16, -1, dtype=np.int64)
        place[value] = np.arange(n)
        pairs = [(i, place[value[i] ^ m]) for m in NEAR for i in [np.flatnonzero(place[value ^ m] > np.arange(n))]]
        a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
    root = np.arange(n)
    while True:  # smallest label over links, with jumps
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = np.flatnonzero(root != np.arange(n))
    return values[moved], values[root[moved]]


def _links(frames):
    for frame in frames:
        found = [
            list_links(np.sort(np.asarray(f, dtype=np.int64)), LEFT_OUT[k])
            for k, f in zip(frame["left_out"], frame["fingerprints"], strict=True)
        ]
        if found:
            yield pd.DataFrame({"u": np.concatenate([a for a, _ in found]), "v": np.concatenate([b for _, b in found])})


def near_fingerprints(distinct: DataFrame) -> DataFrame:
    """Distinct ``fingerprint`` longs -> links (u, v) that join exactly the fingerprints within 2 bits of one another."""

    def mask(two: tuple[int, int]) -> int:
        return ~((255 << (8 * two[0])) | (255 << (8 * two[1])))

    def signed(x: int) -> int:
        return x - (1 << 64) if x >= 1 << 63 else x

    keys = F.array(*[F.col("fingerprint").bitwiseAND(F.lit(signed(mask(t) & (2**64 - 1)))) for t in LEFT_OUT])
    lists = (
        distinct.repartition(shuffle_partitions(distinct.sparkSession), "fingerprint")
        .select("fingerprint", F.posexplode(keys).alias("left_out", "shared"))
        .groupBy("left_out", "shared")
        .agg(F.collect_list("fingerprint").alias("fingerprints"))  # at most 65,536: two free bytes
        .where(F.size("fingerprints") > 1)
    )
    return lists.select("left_out", "fingerprints").mapInPandas(_links, "u long, v long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint long, component_id) for each row of ``docs``."""
    # rebalanced, so that this narrow table is a few files rather than one for each part of the input
    prints = materialize(docs.select("doc_id", fingerprint_udf(F.col("text")).alias("fingerprint")).hint("rebalance"))
    distinct = materialize(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    found = connected_components(near_fingerprints(distinct)).withColumnRenamed("node", "fingerprint")
    placed = distinct.join(found, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    first = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    named = placed.join(first, "component").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def hex_digits(fingerprint):
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is its component's smallest; of rows with equal doc_id one stays. Rows without doc_id stay."""
    kept_id, order, rank = free_names(docs.columns, "kept_id", "order", "rank")
    kept = near_duplicates(docs).where("doc_id = component_id").select(F.col("doc_id").alias(kept_id)).distinct()
    named = docs.where("doc_id is not null")
    one = (
        named.withColumn(order, F.xxhash64("text"))
        .join(kept, F.col("doc_id") == F.col(kept_id))
        .withColumn(rank, F.row_number().over(Window.partitionBy(kept_id).orderBy(order))).where(f"{rank} = 1").select(*docs.columns)
    )
    return one.unionByName(docs.where("doc_id is null"))
