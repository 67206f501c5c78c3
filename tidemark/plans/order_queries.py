"""Queries of ranks by ranges, redundant columns and cached stages, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import order_stats, redundancy
from ..operators.components import checkpoint_folder
from ..sources.entities import PR_SQL, pull_requests
from ..sources.stage_cache import StageCache

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(f"""with {PR_SQL}, e as (select repo, list_distinct(quantile_cont(ld, [0.0, 0.25, 0.5, 0.75, 1.0])) as e from pr group by 1)
select pr_number, case when len(e) > 1 then greatest(1, len(list_filter(e, lambda x: x < ld))) end as quartile from pr join e using (repo)""")
def e34_value_quartile(spark, sf_dir):
    """Quartile of the raw value, right-closed, equal edges once."""
    return order_stats.quantile_bins(pull_requests(spark, sf_dir).select("repo", "pr_number", "ld"), ["repo"], "ld", 4, "quartile").select("pr_number", "quartile")


#: Columns whose redundancy is asked for, in SQL that both engines read.
FEATURES = {
    "la": "la", "la_neg": "-2 * la + 1", "la_rounded": "cast(floor(la / 10) as bigint)", "ld": "ld", "ld_some": "case when ld % 5 <> 0 then ld * ld end", "t_open": "t_open",
    "t_close": "t_close", "span": "t_close - t_open", "author": "author_key", "number": "pr_number",
}
NAMES = sorted(FEATURES)
RANKS_SQL = f"""{PR_SQL}, x as (select pr_number as id, {", ".join(f"cast({sql} as double) as {name}" for name, sql in FEATURES.items())} from pr),
l as (select id, name, v from (unpivot x on {", ".join(NAMES)} into name name value v)),
r as (select id, name, rank() over (partition by name order by v) + (count(*) over (partition by name, v) - 1) / 2.0 as r from l),
p as (select a.name as a, b.name as b, count(*) as n, corr(a.r, b.r) as rho from r a join r b on a.id = b.id and a.name < b.name group by 1, 2)"""


def _features(spark, sf_dir):
    return pull_requests(spark, sf_dir).select("pr_number", *[F.expr(f"cast({sql} as double)").alias(f"f_{name}") for name, sql in FEATURES.items()])


def _pairs(spark, sf_dir):
    x = _features(spark, sf_dir).withColumnsRenamed({f"f_{c}": c for c in NAMES})
    return redundancy.rank_correlations(x, "pr_number", NAMES)


@query(f"with {RANKS_SQL} select a, b, n, round(rho, 6) as rho from p where abs(rho) >= 0.9")
def j17_redundant_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir).where(F.abs("rho") >= 0.9).withColumn("rho", F.round("rho", 6))


@query(f"""with recursive {RANKS_SQL}, e as (select a as u, b as v from p where abs(rho) >= 0.9 union select b, a from p where abs(rho) >= 0.9),
reach as (select u, v from e union select r.u, e.v from reach r join e on r.v = e.u), g as (select u as name, least(u, min(v)) as root from reach group by 1),
s as (select name, count(*) as n from l group by 1), o as (select root, name, row_number() over (partition by root order by n desc, name) as i from g join s using (name))
select max(name) filter (where i = 1) as keep, coalesce(string_agg(name, ', ' order by i) filter (where i > 1), '') as could_drop, count(*) as size from o group by root""")
def c20_redundant_clusters(spark, sf_dir):
    """Groups of columns that say nearly the same; the one that is filled most often stays."""
    filled = _features(spark, sf_dir).agg(F.array(*[F.struct(F.lit(c).alias("column"), F.count(f"f_{c}").cast("double").alias("signal")) for c in NAMES]).alias("s"))
    return redundancy.redundant_clusters(_pairs(spark, sf_dir), filled.select(F.explode("s").alias("s")).select("s.*"), 0.9)


@query(f"with {PR_SQL} select repo, count(*) as n, cast(sum(la) as bigint) as churn, true as was_kept from pr where la >= 500 group by 1")
def m1_cached_stage(spark, sf_dir):
    """A stage that is asked for twice: the second answer is read from the cache, in the folder that executors share."""
    cache = StageCache(spark, f"{checkpoint_folder(spark)}/stages")

    def build(pr):
        return pr.where("la >= 500").groupBy("repo").agg(F.count("*").alias("n"), F.sum("la").alias("churn"))

    inputs = {"pr": pull_requests(spark, sf_dir).select("repo", "pr_number", "la")}
    cache.run("repository churn", inputs, build, {"least": 500})
    result, was_there = cache.run("repository churn", inputs, build, {"least": 500})
    return result.withColumn("was_kept", F.lit(was_there))
