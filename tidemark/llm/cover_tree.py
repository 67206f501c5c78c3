"""Embedding near-dedup by cover trees and dual traversal: exact pairs above a cosine, within a label.

On unit vectors cosine >= t means distance <= sqrt(2 - 2t). The top is a cover tree of its own for each label, over
random pivots whose number grows with the vectors: each vector descends it, from the root to the nearest child, to a leaf,
and leaves over ``BLOCK`` vectors are dealt into blocks of their own. Pairs of leaves, then vectors against leaves, are
pruned by covering-radius bounds. Each pair of blocks that is left is one Spark group: both blocks get cover trees with
nested levels of halving radii, and a dual traversal prunes node pairs that are too far apart, takes node pairs that
are near as a whole, and verifies the rest in double precision. Distances are worked out for the children of node
pairs that the bounds leave, and for no others; ``dual_links`` counts them.

A block pair returns link counts and a spanning star of its links, never the pairs. Equal vectors of a label count as
one with a multiplicity.

Defined results: multiples of one vector have one direction, whose pivots share a leaf; vectors of any length are read
whole, by the tasks that compare them; vectors that are null, empty, zero or hold null or non-finite components, and those with null label
or null vec_id, link with nothing and stay; vectors of different length link with nothing; each row is a vector, so
repeated rows link with one another; columns other than vec_id, embedding and label are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kind_of, materialize, stack, valid_vector
from .components import connected_components

COSINE = 0.93
#: Vectors of one block at most, and expected of one leaf.
BLOCK = 2048
#: Expected number of pivots at most; beyond, leaves are dealt into more blocks.
PIVOTS = 16_384
#: Distances are trusted to this; what lies nearer to a bound is verified.
EPS = 1e-7


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


class CoverTree:
    """Levels of nodes; each level halves the radius and keeps the centres of the level above (nested).

    ``levels[k]``: centre, covering radius of all points below, and parent of each node; ``owners[k]``: node of each
    point; ``members``: the points of the last level's nodes. A level of a node is built from its own points only,
    farthest first, with distances to the centres that are picked; ``evaluated`` counts them.
    """

    def __init__(self, points: np.ndarray, least: float):
        n = len(points)
        self.points = points
        owner, centres = np.zeros(n, dtype=np.int64), np.zeros(1, dtype=np.int64)
        apart = distances(points[:1], points)[0]  # of each point from its node's centre
        self.evaluated = n
        self.levels = [(centres, np.array([apart.max()]), np.zeros(1, dtype=np.int64))]
        self.owners = [owner]
        radius = float(apart.max()) / 2
        while len(centres) < n and radius * 2 > least:
            new_owner, new_apart = np.empty(n, dtype=np.int64), np.zeros(n)
            new_centres, parents = [], []
            order = np.argsort(owner, kind="stable")
            cuts = np.searchsorted(owner[order], np.arange(len(centres) + 1))
            for node, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                own = order[a:b]
                at, best = np.full(len(own), len(new_centres)), apart[own].copy()  # the node's centre is the first again
                new_centres.append(centres[node])
                parents.append(node)
                while len(own) > 1 and best[pick := int(best.argmax())] > radius:
                    near = distances(points[own[pick]][None], points[own])[0]
                    near[pick] = 0.0
                    self.evaluated += len(own)
                    closer = near < best
                    best[closer], at[closer] = near[closer], len(new_centres)
                    new_centres.append(own[pick])
                    parents.append(node)
                new_owner[own], new_apart[own] = at, best
            centres, owner, apart = np.array(new_centres), new_owner, new_apart
            reach = np.zeros(len(centres))
            np.maximum.at(reach, owner, apart)
            self.levels.append((centres, reach, np.array(parents)))
            self.owners.append(owner)
            radius /= 2
        order = np.argsort(owner, kind="stable")
        self.members = np.split(order, np.searchsorted(owner[order], np.arange(1, len(centres))))

    def children(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Start of each node's children at the next level (they are consecutive), and how many; at the last, the node itself."""
        if level >= len(self.levels) - 1:
            n = len(self.levels[-1][0])
            return np.arange(n), np.ones(n, dtype=np.int64)
        count = np.bincount(self.levels[level + 1][2], minlength=len(self.levels[level][0]))
        return np.concatenate([[0], np.cumsum(count)[:-1]]), count

    def descend(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A last-level node for each of ``points``, found by going to the nearest child level by level, and the distance from its centre."""
        node, apart = np.zeros(len(points), dtype=np.int64), distances(points, self.points[self.levels[0][0]])[:, 0]
        for level in range(len(self.levels) - 1):
            start, count = self.children(level)
            below = self.levels[level + 1][0]
            next_node = np.empty(len(points), dtype=np.int64)
            order = np.argsort(node, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(node[order])) + 1):
                if not len(own):
                    continue
                a, n = start[node[own[0]]], count[node[own[0]]]
                if n == 1:  # its only child has its centre
                    next_node[own] = a
                    continue
                d = distances(points[own], self.points[below[a : a + n]])
                next_node[own], apart[own] = a + d.argmin(axis=1), d.min(axis=1)
            node = next_node
        return node, apart


def _spread(a_start, a_count, b_start, b_count):
    """All pairs of children of each pair of nodes."""
    n = a_count * b_count
    pair = np.repeat(np.arange(len(n)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return a_start[pair] + k // b_count[pair], b_start[pair] + k % b_count[pair]


#: Pairs of nodes that are measured at a time.
AT_ONCE = 1 << 19


def _measured(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distance of each of the pairs (a[x], b[y]) and of no others, but where most of a block of them is wanted."""
    out = np.empty(len(x))
    for at in range(0, len(x), AT_ONCE):
        i, j = x[at : at + AT_ONCE], y[at : at + AT_ONCE]
        ui, ri = np.unique(i, return_inverse=True)
        uj, rj = np.unique(j, return_inverse=True)
        if len(ui) * len(uj) <= 2 * len(i):
            out[at : at + AT_ONCE] = distances(a[ui], b[uj])[ri, rj]
        else:
            out[at : at + AT_ONCE] = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.einsum("ij,ij->i", a[i], b[j])))
    return out


def dual_links(a: np.ndarray, b: np.ndarray | None, b_weights: np.ndarray, a_weights: np.ndarray, cosine: float = COSINE):
    """Links between the points of two blocks (b None: within one): weighted counts of both, joined pairs of places, and
    how many distances were worked out.

    Places of ``b`` follow those of ``a``. The joined pairs connect exactly what the links connect.
    """
    within = b is None
    ua = unit(a)
    ub, raw_b = (ua, a) if within else (unit(b), b)
    limit = math.sqrt(max(0.0, 2 - 2 * cosine))
    ta = CoverTree(ua, limit / 4)
    tb = ta if within else CoverTree(ub, limit / 4)
    evaluated = ta.evaluated + (0 if within else tb.evaluated)
    shift = 0 if within else len(a)
    links_a, links_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(ub), dtype=np.int64)
    joined: list[np.ndarray] = []
    depth = max(len(ta.levels), len(tb.levels)) - 1
    i, j = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    apart = _measured(ua, ta.levels[0][0], ub, tb.levels[0][0])
    for level in range(depth + 1):
        la, lb = min(level, len(ta.levels) - 1), min(level, len(tb.levels) - 1)
        (ca, ra, _), (cb, rb, _) = ta.levels[la], tb.levels[lb]
        keep = apart - ra[i] - rb[j] <= limit + EPS
        i, j, apart = i[keep], j[keep], apart[keep]
        # node pairs that are near as a whole: each member of one links with all of the other
        whole = apart + ra[i] + rb[j] <= limit - EPS
        x, y, mirrored = i[whole], j[whole], False
        i, j = i[~whole], j[~whole]
        if len(x):
            if within:  # a pair of different nodes stands for both of its orders
                x, y, mirrored = np.concatenate([x, y[x != y]]), np.concatenate([y, x[x != y]]), True
            oa, ob = ta.owners[la], tb.owners[lb]
            links_a += np.bincount(x, np.bincount(ob, b_weights, len(cb))[y], len(ca)).astype(np.int64)[oa]
            first_y, first_x = np.full(len(ca), -1), np.full(len(cb), -1)
            first_y[x], first_x[y] = cb[y], ca[x]
            mine = np.flatnonzero(first_y[oa] >= 0)
            joined.append(np.stack([mine, first_y[oa[mine]] + shift], axis=1))
            theirs = np.flatnonzero(first_x[ob] >= 0)
            joined.append(np.stack([first_x[ob[theirs]], theirs + shift], axis=1))
            joined.append(np.stack([ca[x], cb[y] + shift], axis=1))
            if mirrored:  # no point links with itself
                own = np.isin(oa, x[x == y])
                links_a[own] -= b_weights[own]
            else:
                links_b += np.bincount(y, np.bincount(oa, a_weights, len(ca))[x], len(cb)).astype(np.int64)[ob]
        if level == depth or not len(i):
            break
        both = []
        (sa, na), (sb, nb) = ta.children(la), tb.children(lb)
        (xa, xr, _), (yb, yr, _) = ta.levels[min(la + 1, len(ta.levels) - 1)], tb.levels[min(lb + 1, len(tb.levels) - 1)]
        for at in range(0, len(i), 4096):  # bounded memory for the children's pairs
            x, y = _spread(sa[i[at : at + 4096]], na[i[at : at + 4096]], sb[j[at : at + 4096]], nb[j[at : at + 4096]])
            if within:  # each pair once
                x, y = x[x <= y], y[x <= y]
            d = _measured(ua, xa[x], ub, yb[y])
            evaluated += len(x)
            near = d - xr[x] - yr[y] <= limit + EPS
            both.append((x[near], y[near], d[near]))
        i, j, apart = (np.concatenate(z) for z in zip(*both, strict=True))
    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        ma, mb = ta.members[x], tb.members[y]
        own = distances(ua[ma], ub[mb])
        evaluated += own.size
        hit = own <= limit - EPS
        for p, q in zip(*np.nonzero((own <= limit + EPS) & ~hit), strict=True):
            v, w = a[ma[p]], raw_b[mb[q]]
            hit[p, q] = v @ w / (math.sqrt(v @ v) * math.sqrt(w @ w)) >= cosine
        if within:
            hit &= ma[:, None] != mb[None, :]
        if hit.any():
            links_a[ma] += hit @ b_weights[mb]
            if not within:
                links_b[mb] += a_weights[ma] @ hit
            elif x != y:
                links_a[mb] += a_weights[ma] @ hit
            # each point to its first link, and the points that share one another through it
            rows, cols = hit.any(axis=1), hit.any(axis=0)
            joined.append(np.stack([ma[rows], mb[hit[rows].argmax(axis=1)] + shift], axis=1))
            joined.append(np.stack([ma[hit[:, cols].argmax(axis=0)], mb[cols] + shift], axis=1))
            if not (hit[np.ix_(rows, cols)].all()):
                p, q = np.nonzero(hit)
                joined.append(np.stack([ma[p], mb[q] + shift], axis=1))
    pairs = np.concatenate(joined) if joined else np.zeros((0, 2), dtype=np.int64)
    return links_a, links_b, pairs, evaluated


def roots(n: int, pairs: np.ndarray) -> np.ndarray:
    """Smallest place reachable over ``pairs`` of places."""
    root = np.arange(n)
    while len(pairs):
        new = root.copy()
        np.minimum.at(new, pairs[:, 0], root[pairs[:, 1]])
        np.minimum.at(new, pairs[:, 1], root[pairs[:, 0]])
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _traverse(group: pd.DataFrame, cosine: float) -> pd.DataFrame:
    group = group.sort_values(["side", "rep"])
    side = group["side"].to_numpy()
    reps, weights = group["rep"].to_numpy(), group["n"].to_numpy()
    v = stack(group["embedding"])
    cut = int((side == 0).sum())
    within = not bool(group["two"].iloc[0])
    out = pd.DataFrame({"rep": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"), "root": pd.Series(dtype="int64")})
    if cut == 0 or (not within and cut == len(v)):
        return out
    if within:
        links, _, pairs, _ = dual_links(v, None, weights, weights, cosine)
    else:
        la, lb, pairs, _ = dual_links(v[:cut], v[cut:], weights[cut:], weights[:cut], cosine)
        links = np.concatenate([la, lb])
    root = roots(len(v), pairs)
    hit = links > 0
    return pd.DataFrame({"rep": reps[hit], "links": links[hit], "root": reps[root[hit]]}) if hit.any() else out


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors``."""
    limit = math.sqrt(max(0.0, 2 - 2 * cosine))
    label, array = (kind_of(vectors, c).simpleString() for c in ("label", "embedding"))
    rows = vectors.select("vec_id", "label", F.size("embedding").alias("dim"), "embedding", (valid_vector("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()).alias("valid"))
    distinct = materialize(
        rows.where("valid").groupBy("label", "dim", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    )
    total = distinct.count()
    # a random sample of pivots: about one for each block, PIVOTS at most
    every = max(block, -(-total // pivots))
    sampled = distinct.where(F.pmod(F.xxhash64("embedding", F.lit(1)), F.lit(every)) == 0).select("label", "dim", "embedding").orderBy("label", "embedding").toPandas()
    top = {key: CoverTree(unit(stack(own["embedding"])), EPS) for key, own in sampled.groupby(["label", "dim"])} if len(sampled) else {}

    def assign(frames):
        for frame in frames:
            frame = frame.reset_index(drop=True)
            leaf, far = np.zeros(len(frame), dtype=np.int64), np.ones(len(frame))
            for key, own in frame.groupby(["label", "dim"]):
                if key in top:
                    leaf[own.index], far[own.index] = top[key].descend(unit(stack(own["embedding"])))
            yield frame.assign(leaf=leaf, far=far)

    placed = materialize(distinct.mapInPandas(assign, f"label {label}, dim int, embedding {array}, rep long, n long, leaf long, far double"))
    leaves = materialize(placed.groupBy("label", "dim", "leaf").agg(F.count("*").alias("size"), F.max("far").alias("radius")))

    def centres(key, leaf):
        # the root of a label without pivots has all vectors within 1 of the origin
        return top[key].points[top[key].levels[-1][0][leaf]] if key in top else np.zeros((len(leaf), key[1]))

    def near_leaves(frames):
        for frame in frames:
            frame = frame.reset_index(drop=True)
            keep = np.zeros(len(frame), dtype=bool)
            for key, own in frame.groupby(["label", "dim"]):
                d = np.linalg.norm(centres(key, own["leaf"].to_numpy()) - centres(key, own["leaf_b"].to_numpy()), axis=1)
                keep[own.index] = d - own["radius"] - own["radius_b"] <= limit + EPS
            yield frame[keep]

    a, b = leaves, leaves.select("label", "dim", F.col("leaf").alias("leaf_b"), F.col("size").alias("size_b"), F.col("radius").alias("radius_b"))
    # at most PIVOTS leaves meet here, so at most PIVOTS^2 / 2 pairs of leaves, whatever the input
    pairs = (
        a.join(b, ["label", "dim"]).where("leaf <= leaf_b")
        .mapInPandas(near_leaves, f"label {label}, dim int, leaf long, size long, radius double, leaf_b long, size_b long, radius_b double")
    )
    blocks = F.ceil(F.col("size") / F.lit(block)).cast("long")
    blocks_b = F.ceil(F.col("size_b") / F.lit(block)).cast("long")
    units = (
        pairs.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .withColumn("block_b", F.explode(F.sequence(F.lit(0).cast("long"), blocks_b - 1)))
        .where("leaf < leaf_b or block <= block_b")
        .withColumn("unit", F.concat_ws(":", "label", "dim", "leaf", "block", "leaf_b", "block_b"))
        .withColumn("two", ~((F.col("leaf") == F.col("leaf_b")) & (F.col("block") == F.col("block_b"))))
    )
    one = units.select("label", "dim", "leaf", "block", "unit", "two", F.lit(0).alias("side"), F.col("leaf_b").alias("other"), F.col("radius_b").alias("reach"))
    two = units.where("two").select("label", "dim", F.col("leaf_b").alias("leaf"), F.col("block_b").alias("block"), "unit", "two", F.lit(1).alias("side"), F.col("leaf").alias("other"), F.col("radius").alias("reach"))
    sides = one.unionAll(two)
    members = placed.join(leaves.select("label", "dim", "leaf", "size"), ["label", "dim", "leaf"]).withColumn("block", F.pmod(F.xxhash64("rep"), blocks))

    def near_members(frames):
        """Vectors that can reach the other leaf at all."""
        for frame in frames:
            frame = frame.reset_index(drop=True)
            keep = np.ones(len(frame), dtype=bool)
            for key, own in frame[frame["two"]].groupby(["label", "dim"]):
                d = np.linalg.norm(unit(stack(own["embedding"])) - centres(key, own["other"].to_numpy()), axis=1)
                keep[own.index] = d <= own["reach"].to_numpy() + limit + EPS
            yield frame.loc[keep, ["unit", "two", "side", "rep", "n", "embedding"]]

    found = materialize(
        members.join(sides, ["label", "dim", "leaf", "block"])
        .select("label", "dim", "other", "reach", "unit", "two", "side", "rep", "n", "embedding")
        .mapInPandas(near_members, f"unit string, two boolean, side int, rep long, n long, embedding {array}")
        .groupBy("unit")
        .applyInPandas(lambda g: _traverse(g, cosine), "rep long, links long, root long")
    )
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    components = connected_components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    named = (
        distinct.join(links, "rep", "left")
        .join(components, F.col("rep") == F.col("node"), "left")
        .select("label", "dim", "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
    )
    hit = rows.where("valid").join(named, ["label", "dim", "embedding"]).select("vec_id", F.col("links").cast("long").alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return hit.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
