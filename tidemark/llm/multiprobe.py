"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing with exact reranking.

Largest inner product becomes smallest distance when each vector, scaled by the largest norm, gets one more component
that brings it to norm one, and a query a zero. ``TABLES`` tables hash vectors by ``k`` Gaussian projections cut into
cells; a query visits the cells of each table in the order of their estimated success (the sum of squared distances
from its projections to the cells), ``probes`` of them, and all candidates are reranked by exact inner products. A
query whose cells hold fewer than 1 + top ids in each table goes on to four times as many, and again, up to all.

k follows the number of vectors; probes is fitted to reach ``TARGET`` recall on a bounded sample (``SAMPLE`` vectors
with the smallest hashes, ``SAMPLE_QUERIES`` of them as queries). A sample is sparser than the table, so its
neighbours are farther and the fit errs to more probes. All vectors are indexed.

Equal vectors are one entry with their 1 + top smallest ids: no other copy can be in a result. Cells are dealt into
units of about ``UNIT`` entries, larger cells into several. Queries are put into blocks with those that start in
neighbouring cells, so that a block's visits overlap; an entry goes to the blocks that visit its cell, and to no others.
A unit returns its best for each query.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, or have a null vec_id, take
no part, as queries or candidates; only vectors of the most common length do; with fewer candidates than ``top`` a
query gets all of them; ties go to the smaller vec_id; of rows with equal vec_id and vector one is returned;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kind_of, materialize, stack, valid_vector

TOP, EVERY = 20, 20
TABLES, WIDTH, SEED = 2, 1.2, 11
#: Cells that a projection is cut into; the outer two are open.
CELLS = 4
TARGET, SAMPLE, SAMPLE_QUERIES = 0.97, 4096, 256
#: Entries of a cell that k aims at, entries of a unit, queries of a block.
PER_CELL, UNIT, QUERIES = 1024, 8192, 4096
#: Visits that are worked out at a time.
VISITS = 1 << 20


class Tables:
    """Projections of all tables, and the order in which a query visits their cells."""

    def __init__(self, dim: int, k: int, largest: float, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.k, self.largest = k, largest
        self.project = rng.standard_normal((TABLES, k, dim + 1))
        self.shift = rng.uniform(-WIDTH / 2, WIDTH / 2, (TABLES, k))
        self.probes = CELLS**k

    def entries(self, v: np.ndarray) -> np.ndarray:
        scaled = v / self.largest
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", scaled, scaled)))
        return np.concatenate([scaled, rest[:, None]], axis=1)

    @staticmethod
    def queries(v: np.ndarray) -> np.ndarray:
        return np.concatenate([v / np.linalg.norm(v, axis=1, keepdims=True), np.zeros((len(v), 1))], axis=1)

    def projected(self, x: np.ndarray, table: int) -> np.ndarray:
        """In cell widths, so that cell c of a projection is [c, c + 1), the first and last open."""
        return (x @ self.project[table].T + self.shift[table]) / WIDTH + CELLS / 2

    def cells(self, x: np.ndarray, table: int) -> np.ndarray:
        digits = np.clip(np.floor(self.projected(x, table)), 0, CELLS - 1).astype(np.int64)
        return digits @ (CELLS ** np.arange(self.k))

    def visits(self, x: np.ndarray, table: int, probes: int) -> np.ndarray:
        """The ``probes`` likeliest cells of each row, best first: partial sums keep their best, coordinate by coordinate."""
        f = self.projected(x, table)
        low = np.arange(CELLS, dtype=float)
        low[0], high = -np.inf, np.append(np.arange(1.0, CELLS), np.inf)
        score, cell = np.zeros((len(x), 1)), np.zeros((len(x), 1), dtype=np.int64)
        for c in range(self.k):
            away = np.maximum(0, np.maximum(low - f[:, c : c + 1], f[:, c : c + 1] - high)) ** 2
            score = (score[:, :, None] + away[:, None, :]).reshape(len(x), -1)
            cell = (cell[:, :, None] + (np.arange(CELLS) * CELLS**c)[None, None, :]).reshape(len(x), -1)
            best = np.argsort(score, axis=1, kind="stable")[:, :probes]
            score, cell = np.take_along_axis(score, best, 1), np.take_along_axis(cell, best, 1)
        return cell

    def fit_probes(self, v: np.ndarray, top: int, target: float) -> int:
        """Fewest probes by which ``target`` of the sample's true neighbours are in a visited cell of some table."""
        q = v[:SAMPLE_QUERIES]
        scores = q @ v.T
        scores[np.arange(len(q)), np.arange(len(q))] = -np.inf
        near = np.argsort(-scores, axis=1)[:, : min(top, len(v) - 1)]
        if not near.size:
            return self.probes
        most = CELLS**self.k
        place = np.full(near.shape, most)
        for t in range(TABLES):
            order = self.visits(self.queries(q), t, most)
            at = np.empty_like(order)
            np.put_along_axis(at, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), 1)
            own = self.cells(self.entries(v), t)
            place = np.minimum(place, np.take_along_axis(at, own[near], 1))
        return int(np.quantile(place, target, method="higher")) + 1


def best_of_unit(queries: pd.DataFrame, entries: pd.DataFrame, top: int) -> pd.DataFrame:
    """For each query the entries with the top + 1 best ids of the cells that it visits here, and what ties with the last of them."""
    out = {"query_id": [], "score": [], "ids": []}
    if len(queries) and len(entries):
        x = stack(entries["embedding"])
        cells, of = np.unique(entries["cell"].to_numpy(), return_inverse=True)
        ids = entries["ids"].to_numpy()
        every = np.concatenate(ids)
        repeats = len(every) - len(np.unique(every))  # an id with several vectors is in several entries
        for at in range(0, len(queries), 128):
            some = queries.iloc[at : at + 128]
            q = stack(some["embedding"])
            allowed = np.stack([np.isin(cells, np.asarray(c)) for c in some["cells"]])[:, of]
            scores = np.where(allowed, q @ x.T, -np.inf)
            n = min(top + 1 + repeats, len(x))
            last = np.partition(scores, -n, axis=1)[:, -n]
            for r, query_id in enumerate(some["query_id"]):
                hit = np.flatnonzero(allowed[r] & (scores[r] >= last[r] - 1e-9 * max(1.0, abs(last[r]) if np.isfinite(last[r]) else 1.0)))
                out["query_id"] += [query_id] * len(hit)
                out["score"] += (x[hit] * q[r]).sum(axis=1).tolist()  # the same sum for equal pairs wherever they meet
                out["ids"] += list(ids[hit])
    return pd.DataFrame({"query_id": pd.Series(out["query_id"], dtype="int64"), "score": pd.Series(out["score"], dtype="float64"), "ids": out["ids"]})


def nearest(vectors: DataFrame, every: int = EVERY, top: int = TOP, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` best found for each row whose vec_id is divisible by ``every``."""
    spark = vectors.sparkSession
    array = kind_of(vectors, "embedding").simpleString()
    valid = vectors.where(valid_vector("embedding") & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    lengths = valid.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    dim = int(lengths["dim"])
    valid = valid.where(F.size("embedding") == dim)
    # a group limit runs before the shuffle, so a very common vector sends a few rows a task
    first = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    index = materialize(
        valid.withColumn("_n", first).where(F.col("_n") <= top + 1).groupBy("embedding").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    )
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    facts = index.agg(F.count("*").alias("n"), F.max(norm).alias("largest")).first()
    n = int(facts["n"])
    k = int(np.clip(round(math.log(max(1.0, n / PER_CELL)) / math.log(CELLS)), 1, 12))
    tables = Tables(dim, k, float(facts["largest"]))
    sample = index.select("embedding").orderBy(F.xxhash64("embedding"), "embedding").limit(SAMPLE).toPandas()
    probes = tables.fit_probes(stack(sample["embedding"]), top, target)
    shared = spark.sparkContext.broadcast(tables)  # TABLES x k x (dim + 1) numbers

    def place(frames):
        for frame in frames:
            x = shared.value.entries(stack(frame["embedding"])) if len(frame) else None
            for t in range(TABLES if len(frame) else 0):
                yield frame.assign(table=t, cell=shared.value.cells(x, t))

    def visiting(p):
        def visit(frames):
            for frame in frames:
                for at in range(0, len(frame), step := max(1, VISITS // p)):
                    some = frame.iloc[at : at + step]
                    x = shared.value.queries(stack(some["embedding"]))
                    home = shared.value.visits(x, 0, 1)[:, 0]
                    for t in range(TABLES):
                        yield pd.DataFrame({"query_id": some["vec_id"], "hash": some["hash"], "home": home, "table": t, "cell": list(shared.value.visits(x, t, p))})

        return visit

    groups = max(1, -(-n // UNIT))
    unit = F.pmod(F.xxhash64("cell"), F.lit(groups))
    placed = materialize(index.mapInPandas(place, f"embedding {array}, ids array<long>, table int, cell long"))
    # an id counts in one cell of a table, so that the cells of a table hold at least as many ids as their sum
    held = (
        placed.select("table", "cell", F.explode("ids").alias("vec_id")).groupBy("table", "vec_id").agg(F.min("cell").alias("cell"))
        .groupBy("table", "cell").agg(F.count("*").alias("held"))
    )
    directory = materialize(
        placed.groupBy("table", "cell").agg(F.ceil(F.count("*") / F.lit(UNIT)).cast("long").alias("pieces"))
        .join(held, ["table", "cell"], "left").fillna(0, ["held"])
    )
    queries = valid.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "embedding"])

    def cells_of(some, p):
        hashed = some.select("vec_id", "embedding", F.xxhash64("embedding").alias("hash"))
        cells = hashed.mapInPandas(visiting(p), "query_id long, hash long, home long, table int, cell array<long>")
        return cells.withColumn("cell", F.explode("cell")).join(directory, ["table", "cell"])

    def lacking(some, p):
        sums = cells_of(some, p).groupBy("query_id", "hash", "table").agg(F.sum("held").alias("held"))
        enough = sums.where(F.col("held") > top).select(F.col("query_id").alias("vec_id")).distinct()  # one may be its own
        return materialize(some.join(enough, "vec_id", "left_anti"))

    cells, todo, p = cells_of(queries, probes), queries, probes
    while p < CELLS**k and not (todo := lacking(todo, p)).isEmpty():
        p = min(4 * p, CELLS**k)
        cells = cells.unionByName(cells_of(todo, p))
    # queries by the leading digits of their first cell, and more than QUERIES of those by hash
    digits = min(k, math.ceil(math.log(max(1, queries.count() / QUERIES), CELLS)))
    cells = cells.withColumn("area", F.floor(F.col("home") / CELLS ** (k - digits)))
    areas = cells.select("query_id", "area").distinct().groupBy("area").agg(F.ceil(F.count("*") / F.lit(QUERIES)).cast("long").alias("parts"))
    cells = materialize(cells.join(areas, "area").withColumn("part", F.pmod(F.xxhash64("query_id"), "parts")))
    cells = cells.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    visited = (
        cells.groupBy("table", unit.alias("unit"), "piece", "area", "part", "query_id")
        .agg(F.collect_list("cell").alias("cells"))
        .join(queries.select(F.col("vec_id").alias("query_id"), "embedding"), "query_id")
    )
    # a cell's entries are dealt over its pieces, and meet the blocks that visit it
    entries = (
        placed.join(directory.select("table", "cell", "pieces"), ["table", "cell"])
        .withColumn("piece", F.pmod(F.xxhash64("ids"), "pieces"))
        .join(cells.select("table", "cell", "piece", "area", "part").distinct(), ["table", "cell", "piece"])
        .select(F.col("table").alias("e_table"), unit.alias("e_unit"), F.col("piece").alias("e_piece"), F.col("area").alias("e_area"), F.col("part").alias("e_part"), "cell", "ids", "embedding")
    )
    keys = ["table", "unit", "piece", "area", "part"]
    found = (
        visited.select(*keys, "query_id", "cells", "embedding").groupBy(*keys)
        .cogroup(entries.groupBy(*[f"e_{c}" for c in keys]))
        .applyInPandas(lambda q, e: best_of_unit(q, e, top), "query_id long, score double, ids array<long>")
    )
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("vec_id", F.explode("ids")).where("vec_id <> query_id")
        .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )
