"""Keyed stage machines over logs as folds of states that can be put together: a busy key is cut into buckets of time.

The state of a stretch of a key's log is whether it was restarted, what came since, and its last stage; the state of
two stretches follows from theirs, the later one's alone if it was restarted. So stretches are summed up apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of a key's log that are one stretch.
STRETCH = 86_400


def _stretches(events: DataFrame, key: str, at: str, tie: str, kind: str, stretch: int) -> DataFrame:
    known = events.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    return known.select(F.col(key), F.col(at).cast("long").alias("t"), F.col(tie).alias("tie"), F.col(kind).alias("kind"), F.floor(F.col(at) / stretch).alias("part"))


def run_states(events: DataFrame, key: str, at: str, tie: str, kind: str, error: str, restart: str, now: int, idle: int = 25 * 60, stretch: int = STRETCH) -> DataFrame:
    """(key, stage, n_events, n_errors, since, last_t, is_idle): a key's last kind of event, its events and errors since its
    last restart (or its first event), when that was, and whether nothing has come for ``idle`` seconds at ``now``.

    Events at one moment go by ``tie``; those without a key or a time don't count.
    """
    rows = _stretches(events, key, at, tie, kind, stretch)
    later = Window.partitionBy(key, "part").orderBy(F.desc("t"), F.desc("tie")).rowsBetween(Window.unboundedPreceding, -1)
    is_restart = (F.col("kind") == restart).cast("int")
    live = rows.withColumn("live", F.coalesce(F.sum(is_restart).over(later), F.lit(0)) == 0)
    per = live.groupBy(key, "part").agg(
        F.max(is_restart).alias("restarted"), F.count_if("live").alias("n"), F.count_if(F.col("live") & (F.col("kind") == error)).alias("e"),
        F.min(F.when(F.col("live"), F.col("t"))).alias("since"), F.max(F.struct("t", "tie", "kind")).alias("last"),
    )
    after = Window.partitionBy(key).orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)  # one row a stretch
    kept = per.where("true").withColumn("over", F.coalesce(F.sum("restarted").over(after), F.lit(0)) > 0).where("not over")
    out = kept.groupBy(key).agg(F.sum("n").alias("n_events"), F.sum("e").alias("n_errors"), F.min("since").alias("since"), F.max("last").alias("last"))
    return out.select(key, F.col("last.kind").alias("stage"), "n_events", "n_errors", "since", F.col("last.t").alias("last_t"), (F.lit(now) - F.col("last.t") > idle).alias("is_idle"))


def stage_errors(events: DataFrame, key: str, at: str, tie: str, kind: str, error: str, stretch: int = STRETCH) -> DataFrame:
    """(key, stage, n_errors): each error goes to the stage that its key was in, the last other event before it; null before any.

    Stretches carry in the last stage of those before.
    """
    rows = _stretches(events, key, at, tie, kind, stretch)
    stage = F.when(F.col("kind") != error, F.col("kind"))
    ends = rows.groupBy(key, "part").agg(F.max_by("kind", F.when(F.col("kind") != error, F.struct("t", "tie"))).alias("end"))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a stretch
    carried = ends.select(F.col(key).alias("_k"), F.col("part").alias("_part"), F.last("end", ignorenulls=True).over(before).alias("carried"))
    here = Window.partitionBy(key, "part").orderBy("t", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("own", F.last(stage, ignorenulls=True).over(here)).where(F.col("kind") == error)
    met = placed.join(carried, (F.col(key) == F.col("_k")) & (F.col("part") == F.col("_part")))
    return met.groupBy(key, F.coalesce("own", "carried").alias("stage")).agg(F.count("*").alias("n_errors"))
