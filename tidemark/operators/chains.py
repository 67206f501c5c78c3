"""First-parent chains of commits by pointer jumping: the commit that stood at a moment, where chains fork, how far one is behind.

Each commit gets pointers 1, 2, 4, ... commits up, with the number of commits on the way and the earliest of their times;
a level is one join of the level before with itself. A question goes up by the powers of two of its distance, from the
largest down, one join a level, so work is commits and questions times the logarithm of the longest chain.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import cut_lineage


@dataclass
class Jumps:
    """``levels[k]``: (node, up, n, least): the commit 2^k up or null, commits from node before it, their earliest time;
    ``depth``: (node, depth) with the number of a commit's ancestors."""

    levels: list[DataFrame]
    depth: DataFrame


def jumps(commits: DataFrame, max_levels: int = 40) -> Jumps:
    """For ``commits`` (node, parent, t), one row a commit. A parent that is unknown counts as none; raises on a circle."""
    known = commits.select(F.col("node").alias("_p"))
    first = commits.join(known, F.col("parent") == F.col("_p"), "left").select("node", F.col("_p").alias("up"), F.lit(1).cast("long").alias("n"), F.col("t").alias("least"))
    levels = [cut_lineage(first)]
    while levels[-1].where("up is not null").limit(1).count():
        if len(levels) > max_levels:
            raise ValueError("parents lead in a circle")
        a, b = levels[-1], levels[-1].select(F.col("node").alias("_n"), F.col("up").alias("_up"), F.col("n").alias("_m"), F.col("least").alias("_least"))
        levels.append(cut_lineage(a.join(b, F.col("up") == F.col("_n"), "left").select("node", F.col("_up").alias("up"), (F.col("n") + F.coalesce("_m", F.lit(0))).alias("n"), F.least("least", "_least").alias("least"))))
    return Jumps(levels, levels[-1].select("node", (F.col("n") - 1).alias("depth")))


def _step(rows: DataFrame, level: DataFrame, at: str) -> DataFrame:
    """``rows`` with the jump (_up, _m, _least) from their commit in ``at``, null where there is none."""
    to = level.select(F.col("node").alias("_n"), F.col("up").alias("_up"), F.col("n").alias("_m"), F.col("least").alias("_least"))
    return rows.join(to, F.col(at) == F.col("_n"), "left").drop("_n")


def _climb(rows: DataFrame, j: Jumps, at: str, goes: Column, walked: str) -> DataFrame:
    """``rows`` whose commit in ``at`` goes up by each jump for which ``goes`` holds, largest first; ``walked`` counts commits passed."""
    for k in range(len(j.levels) - 1, -1, -1):
        met = _step(rows, j.levels[k], at).withColumn("_go", F.coalesce(goes, F.lit(False)))
        rows = met.withColumns({at: F.when(F.col("_go"), F.col("_up")).otherwise(F.col(at)), walked: F.col(walked) + F.when(F.col("_go"), F.col("_m")).otherwise(0)}).drop("_up", "_m", "_least", "_go")
        if k % 8 == 0:
            rows = cut_lineage(rows)
    return rows


def with_depth(rows: DataFrame, j: Jumps, node: str, name: str) -> DataFrame:
    d = j.depth.select(F.col("node").alias("_n"), F.col("depth").alias(name))
    return rows.join(d, F.col(node) == F.col("_n"), "left").drop("_n")


def newest_before(rows: DataFrame, j: Jumps, start: str, stop: str, cut: str, name: str) -> DataFrame:
    """``rows`` with the first commit from ``start`` up that is no later than ``cut``, null if ``stop`` or the end of the chain comes first.

    A stop that is not on the chain, or null, does not stop.
    """
    own = with_depth(with_depth(rows, j, start, "_from"), j, stop, "_to").withColumns({"_at": F.col(start), "_walked": F.lit(0).cast("long")})
    # the commit of the start's chain at the depth of the stop
    climbed = _climb(own, j, "_at", F.col("_walked") + F.col("_m") <= F.col("_from") - F.col("_to"), "_walked")
    stops = F.coalesce((F.col("_at") == F.col(stop)) & (F.col("_from") >= F.col("_to")), F.lit(False))
    limited = climbed.withColumn("_most", F.when(stops, F.col("_from") - F.col("_to")).otherwise(F.col("_from") + 1)).withColumns({"_at": F.col(start), "_walked": F.lit(0).cast("long")})
    late = (F.col("_least") > F.col(cut)) & (F.col("_walked") + F.col("_m") <= F.col("_most"))
    found = _climb(limited, j, "_at", late, "_walked")
    return found.select(*rows.columns, F.when(F.col("_walked") < F.col("_most"), F.col("_at")).alias(name))


def _meet(rows: DataFrame, j: Jumps, node: str, walked: str) -> DataFrame:
    """``rows`` with ``node``: the last commit shared by the chains of ``_a`` and ``_b``, which are equally deep, and ``walked``: how far up it is."""
    own = rows.withColumn("_w", F.lit(0).cast("long"))
    for k in range(len(j.levels) - 1, -1, -1):  # both go up while they stay apart
        met = _step(_step(own, j.levels[k], "_a").withColumnRenamed("_up", "_ua").drop("_m", "_least"), j.levels[k], "_b")
        go = F.coalesce((F.col("_a") != F.col("_b")) & (F.col("_ua") != F.col("_up")), F.lit(False))
        own = met.withColumn("_go", go).withColumns({"_a": F.when(F.col("_go"), F.col("_ua")).otherwise(F.col("_a")), "_b": F.when(F.col("_go"), F.col("_up")).otherwise(F.col("_b")), "_w": F.col("_w") + F.when(F.col("_go"), F.col("_m")).otherwise(0)}).drop("_ua", "_up", "_m", "_least", "_go")
        if k % 8 == 0:
            own = cut_lineage(own)
    last = _step(_step(own, j.levels[0], "_a").withColumnRenamed("_up", "_ua").drop("_m", "_least"), j.levels[0], "_b")
    same, above = F.col("_a") == F.col("_b"), F.col("_ua") == F.col("_up")
    return last.withColumns({node: F.when(same, F.col("_a")).when(above, F.col("_ua")), walked: F.when(same, F.col("_w")).when(above, F.col("_w") + 1)}).drop("_a", "_b", "_w", "_ua", "_up", "_m", "_least")


def fork_of(rows: DataFrame, j: Jumps, one: str, two: str, name: str) -> DataFrame:
    """``rows`` with the last commit that the chains of two commits share, null if they share none."""
    own = with_depth(with_depth(rows, j, one, "_d1"), j, two, "_d2")
    deeper = F.col("_d1") >= F.col("_d2")
    # a commit that is unknown shares nothing
    own = own.withColumns({"_a": F.when(deeper, F.col(one)).when(~deeper, F.col(two)), "_b": F.when(deeper, F.col(two)).when(~deeper, F.col(one)), "_w1": F.lit(0).cast("long")})
    own = _climb(own, j, "_a", F.col("_w1") + F.col("_m") <= F.abs(F.col("_d1") - F.col("_d2")), "_w1")
    return _meet(own, j, name, "_walked").select(*rows.columns, name)


def heads_at_open(requests: DataFrame, pushes: DataFrame, j: Jumps, grace: int = 300) -> DataFrame:
    """(id, head, kind, behind) of ``requests`` (id, final, base_tip, opened, is_known): the head as it stood ``grace`` seconds after opening.

    The walk starts from the head that the first later push (id, t, before) replaced, or the final one, and ends before
    ``base_tip``. ``kind``: exact; recovered, after a push; approx, where pushes are unknown. ``behind``: base commits after the fork
    that were there by then, up to the newest such one. A request whose start is unknown, or without a commit by then, has no head.

    The walks to the newest commit from the start and from ``base_tip``, and the one of the deeper of both to the other's depth,
    are rows of one climb. A head lies on the chain of its start, so its fork is the start's, or itself if that is later.
    """
    asked = requests.withColumn("cut", F.col("opened") + grace)
    later = asked.join(pushes.select(F.col("id").alias("_i"), F.col("t").alias("_t"), "before"), (F.col("id") == F.col("_i")) & (F.col("_t") > F.col("cut")))
    first = later.groupBy(F.col("id").alias("_id")).agg(F.min(F.struct("_t", "before")).alias("_first"))
    asked = asked.join(first, F.col("id") == F.col("_id"), "left").drop("_id")
    pushed = F.col("is_known") & F.col("_first").isNotNull()
    asked = asked.select("id", "base_tip", "cut", F.when(pushed, F.col("_first.before")).otherwise(F.col("final")).alias("start"), F.when(~F.col("is_known"), "approx").when(pushed, "recovered").otherwise("exact").alias("kind"))
    own = with_depth(with_depth(asked, j, "start", "_d1"), j, "base_tip", "_d2")
    own = cut_lineage(own.withColumn("_row", F.monotonically_increasing_id()))
    deeper = F.col("_d1") >= F.col("_d2")
    ends = {"_start": F.col("start"), "_base": F.col("base_tip"), "_a": F.when(deeper, F.col("start")).when(~deeper, F.col("base_tip"))}
    walks = F.explode(F.array(*[F.struct(F.lit(n).alias("_walk"), c.alias("_at")) for n, c in ends.items()]))
    walking = own.select("_row", "cut", F.abs(F.col("_d1") - F.col("_d2")).alias("_far"), walks.alias("_p")).select("_row", "cut", "_far", "_p.*").where("_at is not null").withColumn("_walked", F.lit(0).cast("long"))
    goes = F.when(F.col("_walk") == "_a", F.col("_walked") + F.col("_m") <= F.col("_far")).otherwise(F.col("_least") > F.col("cut"))
    walked = _climb(walking, j, "_at", goes, "_walked")
    of = {n: F.max(F.when(F.col("_walk") == n, F.struct("_at", "_walked"))) for n in ends}
    found = own.join(walked.groupBy(F.col("_row").alias("_r")).agg(*[c.alias(f"_of{n}") for n, c in of.items()]), F.col("_row") == F.col("_r"), "left")
    found = found.withColumns({"_a": F.col("_of_a._at"), "_b": F.when(deeper, F.col("base_tip")).when(~deeper, F.col("start"))})
    stops = F.coalesce(deeper & (F.col("_a") == F.col("base_tip")), F.lit(False))
    most = F.when(stops, F.col("_d1") - F.col("_d2")).otherwise(F.col("_d1") + 1)
    found = found.withColumns({"head": F.when(F.col("_of_start._walked") < most, F.col("_of_start._at")), "_d_head": F.col("_d1") - F.col("_of_start._walked"), "_to_base": F.col("_of_base._walked")})
    found = _meet(found.select("id", "kind", "head", "_d_head", "_d1", "_d2", "_to_base", "_a", "_b"), j, "_fork", "_up_to")
    d_fork = F.least(F.col("_d_head"), F.least("_d1", "_d2") - F.col("_up_to"))
    behind = F.greatest(F.col("_d2") - F.col("_to_base") - d_fork, F.lit(0))
    return found.select("id", "head", F.when(F.col("head").isNotNull(), F.col("kind")).alias("kind"), F.when(F.col("head").isNotNull() & F.col("_fork").isNotNull(), behind).alias("behind"))
