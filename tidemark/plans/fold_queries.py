"""Queries of nested documents, stage machines, line lineage and joint resampling, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import documents, lineage, metrics, ranks, stages
from ..sources.entities import DAY, PR_SQL, PREDICTION_SQL, predictions, pull_requests, seconds, table

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


DEEP_SQL = """'{"at":{"pair":[' || turn || ',' || (turn + 1) || '],"rest":[[],{},null]},"b/~":{"0":{"c":[{"d":{"e":{"f":[[[' || turn || ']]]}}}]}},"role":"' || coalesce(role, '?') || '"}'"""


@query(f"select conv_id, turn, {DEEP_SQL} as doc from conversations")
def h11_round_trip(spark, sf_dir):
    """Documents of ten levels taken apart into leaves and put together again."""
    doc = F.expr(DEEP_SQL)
    leaves = documents.flatten(table(spark, sf_dir, "conversations").select("conv_id", "turn", doc.alias("doc")), ["conv_id", "turn"], "doc")
    return documents.unflatten(leaves, ["conv_id", "turn"])


EVENT_DOC_SQL = """'{"k":' || event_id || ',"v":' || case event_id % 5 when 0 then 'null' when 1 then '1.5' when 2 then '"x"' when 3 then 'true' else '{"w":[]}' end || ',"tags":[' || case when event_id % 3 = 0 then '1,2.5' when event_id % 3 = 1 then '"t",{"u":1}' else '' end || ']}'"""


@query("""with e as (select event_id % 3 as t, event_id % 5 as v from events)
select '/k' as pattern, 'integer' as types, count(*) as n_values, count(*) as n_docs from e having count(*) > 0
union all select '/v', 'null|boolean|number|string', count(*) filter (where v < 4), count(*) filter (where v < 4) from e having count(*) filter (where v < 4) > 0
union all select '/v/w', 'array', count(*) filter (where v = 4), count(*) filter (where v = 4) from e having count(*) filter (where v = 4) > 0
union all select '/tags/*', 'number|string', count(*) filter (where t = 1) + 2 * count(*) filter (where t = 0), count(*) filter (where t < 2) from e having count(*) filter (where t < 2) > 0
union all select '/tags/*/u', 'integer', count(*) filter (where t = 1), count(*) filter (where t = 1) from e having count(*) filter (where t = 1) > 0
union all select '/tags', 'array', count(*) filter (where t = 2), count(*) filter (where t = 2) from e having count(*) filter (where t = 2) > 0""")
def h11_schema_catalogue(spark, sf_dir):
    """Which types occur at each place of the events' documents."""
    docs = table(spark, sf_dir, "events").select("event_id", F.expr(EVENT_DOC_SQL).alias("doc"))
    return documents.schema_catalogue(documents.flatten(docs, ["event_id"], "doc"), ["event_id"])


@query("select conv_id, turn, case when length(text) > 300 then substr(text, 1, 299) || '…' else text end as shown from conversations")
def h11_display(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", documents.short(F.col("text")).alias("shown"))


LOG_SQL = "e as (select user_id as pr, cast(floor(epoch(ts)) as bigint) as t, event_id as i, event_type as kind from events)"


def _log(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("pr"), seconds("ts").alias("t"), F.col("event_id").alias("i"), F.col("event_type").alias("kind"))


@query(f"""with {LOG_SQL}, r as (select pr, max({{'t': t, 'i': i}}) filter (where kind = 'signup') as r from e group by 1)
select pr, max({{'t': t, 'i': i, 'kind': kind}}).kind as stage, count(*) filter (where r is null or {{'t': t, 'i': i}} >= r) as n_events, count(*) filter (where kind = 'error' and (r is null or {{'t': t, 'i': i}} >= r)) as n_errors,
  min(t) filter (where r is null or {{'t': t, 'i': i}} >= r) as since, max(t) as last_t, 1706745600 - max(t) > 1500 as is_idle from e join r using (pr) group by pr""")
def k14_run_states(spark, sf_dir):
    """Each key's stage, its events and errors since the last restart; the streaming form is in tidemark.streaming.stages."""
    return stages.run_states(_log(spark, sf_dir), "pr", "t", "i", "kind", "error", "signup", 1_706_745_600)


@query(f"""with {LOG_SQL}, s as (select pr, kind, last_value(case when kind <> 'error' then kind end ignore nulls) over (partition by pr order by t, i rows between unbounded preceding and 1 preceding) as stage from e)
select pr, stage, count(*) as n_errors from s where kind = 'error' group by 1, 2""")
def k14_stage_errors(spark, sf_dir):
    return stages.stage_errors(_log(spark, sf_dir), "pr", "t", "i", "kind", "error")


RANGES_SQL = f"""{PR_SQL}, g as (select l_partkey as path, l_orderkey as change, t_open as t, (l_suppkey * 7 + l_linenumber * 13) % 200 as a, (l_suppkey * 7 + l_linenumber * 13) % 200 + cast(l_quantity as bigint) - 1 as b from lineitem join pr on pr_number = l_orderkey),
lines as (select distinct path, change, t, unnest(generate_series(a, b)) as line from g), w as (select *, lag(change) over k as owner, lag(t) over k as owner_t from lines window k as (partition by path, line order by t, change)),
own as (select change, owner, owner_t, count(*) as n_lines from w where owner is not null group by 1, 2, 3)"""


def _owners(spark, sf_dir):
    pr = pull_requests(spark, sf_dir)
    first = (F.col("l_suppkey") * 7 + F.col("l_linenumber") * 13) % 200
    g = table(spark, sf_dir, "lineitem").join(pr.select("pr_number", "t_open"), F.col("l_orderkey") == F.col("pr_number"))
    ranges = g.select(F.col("l_partkey").alias("path"), F.col("l_orderkey").alias("change"), F.col("t_open").alias("t"), first.alias("a"), (first + F.col("l_quantity").cast("long") - 1).alias("b"))
    return pr, lineage.line_owners(ranges, "path", "change", "t", "a", "b")


@query(f"""with {RANGES_SQL}, m as (select o.owner as change, f.pr_number as fix, f.t_open - l.t_close as delay from own o join pr f on f.pr_number = o.change and f.priority = '1-URGENT' join pr l on l.pr_number = o.owner)
select change, min({{'d': delay, 'f': fix}}).f as fix, min(delay) as delay from m where delay > 0 and delay <= 90 * 86400 group by 1""")
def c17_line_lineage(spark, sf_dir):
    """The earliest fix, within 90 days of a change's landing, that replaced lines which the change still owned."""
    pr, owners = _owners(spark, sf_dir)
    fixes = pr.where("priority = '1-URGENT'").select(F.col("pr_number").alias("change"), F.col("t_open").alias("t"))
    return lineage.earliest_fix(owners, fixes, pr.select(F.col("pr_number").alias("change"), F.col("t_close").alias("landed")), 90 * DAY)


@query(f"""with {RANGES_SQL}, x as (select change, t - owner_t as age, owner from w where owner is not null)
select change, count(*) as n_replaced, min(age) as least_age, median(age) as median_age, count(distinct owner) as n_owners from x group by 1""")
def d31_replaced_lines(spark, sf_dir):
    """Of the lines that a change replaced: how many, their least and median age, and how many changes had written them."""
    _, owners = _owners(spark, sf_dir)
    aged = owners.withColumn("age", F.col("t") - F.col("owner_t"))
    return aged.groupBy("change").agg(F.sum("n_lines").alias("n_replaced"), F.min("age").alias("least_age"), F.percentile("age", F.lit(0.5), F.col("n_lines")).alias("median_age"), F.countDistinct("owner").alias("n_owners"))


CELLS = [(t, g) for t in range(3) for g in range(3)]
F1_SQL = " + ".join(f"coalesce(2 * c{c}{c} / nullif({' + '.join([f'c{c}{g}' for g in range(3)] + [f'c{t}{c}' for t in range(3)])}, 0), 0)" for c in range(3))


@query(f"""with {PREDICTION_SQL}, l as (select repo, y, case when p0 >= p1 and p0 >= p2 then 0 when p1 >= p2 then 1 else 2 end as guess, pow(p0 - (y = 0)::int, 2) + pow(p1 - (y = 1)::int, 2) + pow(p2 - (y = 2)::int, 2) as m,
  pow(p1 - (y = 0)::int, 2) + pow(p2 - (y = 1)::int, 2) + pow(p0 - (y = 2)::int, 2) as o, case y when 0 then 0.5 when 1 then 0.68 else 0.88 end as b from pred),
u as (select repo, avg(m) as m, avg(b) as b, avg(o) as o, {", ".join(f"cast(count(*) filter (where y = {t} and guess = {g}) as double) as c{t}{g}" for t, g in CELLS)} from l group by 1),
d as (select draw, u.*, ('0x' || substr(sha256('joint:' || draw || ':' || repo), 1, 8))::bigint / 4294967295.0::double as x from u, range(0, 201) r(draw)),
h as (select *, case when draw = 0 then 1 else {" + ".join(f"cast(x > {p!r}::double as int)" for p in ranks.POISSON_1)} end as w from d),
s as (select draw, cast(sum(w) as double) as w, sum(w * m) as m, sum(w * b) as b, sum(w * o) as o, {", ".join(f"sum(w * c{t}{g}) as c{t}{g}" for t, g in CELLS)} from h group by draw),
v as (select draw, 'loss' as statistic, m / nullif(w, 0) as x from s union all select draw, 'skill', 1 - m / nullif(b, 0) from s union all select draw, 'difference', (m - o) / nullif(w, 0) from s union all select draw, 'macro_f1', ({F1_SQL}) / 3 from s)
select statistic, round(max(x) filter (where draw = 0), 9) as estimate, round(quantile_cont(x, 0.025) filter (where draw > 0), 9) as lower, round(quantile_cont(x, 0.975) filter (where draw > 0), 9) as upper from v group by 1""")
def j9_joint_bootstrap(spark, sf_dir):
    """Loss, skill against a base, difference to another model and macro-F1 with bounds from the same draws of repositories."""
    y, p = F.col("y"), [F.col(f"p{i}") for i in range(3)]
    guess = F.when((p[0] >= p[1]) & (p[0] >= p[2]), 0).when(p[1] >= p[2], 1).otherwise(2)
    base = F.when(y == 0, 0.5).when(y == 1, 0.68).otherwise(0.88)
    got = ranks.joint_bootstrap(predictions(spark, sf_dir), "repo", metrics.brier(y, p), base, metrics.brier(y, [p[1], p[2], p[0]]), y, guess, [0, 1, 2], 200, "joint")
    return got.select("statistic", *[F.round(c, 9).alias(c) for c in ("estimate", "lower", "upper")])
