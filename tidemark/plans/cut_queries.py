"""Queries of states at a cut, flaky checks, JSON pointers and temperatures, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import cuts
from ..sources.entities import DAY, FILES_SQL, PR_SQL, PREDICTION_SQL, TIMELINE_SQL, predictions, pull_requests, table, timeline

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(f"""with {PR_SQL}, ck as (select repo, pr.pr_number, t_open, 'check' || (l_partkey % 2) as name, l_linenumber % 3 = 1 as failed, l_suppkey % 2 = 0 as passed from lineitem join pr on pr_number = l_orderkey),
f as (select distinct repo, pr_number, t_open, name from ck where failed),
n as (select f.pr_number, f.name, count(r.name) as k from f left join ck r on r.passed and r.repo = f.repo and r.name = f.name and r.t_open < f.t_open and r.t_open >= f.t_open - 90 * 86400 group by 1, 2)
select pr_number, count(*) as n_failed, count(*) filter (where k >= 3) as n_flaky, not bool_and(k >= 3) as label from n group by 1""")
def e28_flaky_checks(spark, sf_dir):
    """Failed checks that had passed on three reruns of the 90 days before are flaky; the label falls if all failed ones are."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pr_number"), F.concat(F.lit("check"), F.col("l_partkey") % 2).alias("name"), (F.col("l_linenumber") % 3 == 1).alias("failed"), (F.col("l_suppkey") % 2 == 0).alias("passed"))
    checks = lines.join(pull_requests(spark, sf_dir).select("repo", "pr_number", "t_open"), "pr_number")
    failures = checks.where("failed").select("repo", "pr_number", "t_open", "name").distinct()
    passes = checks.where("passed").select("repo", "name", F.col("t_open").alias("passed_at"))
    got = cuts.flaky_failures(failures, passes, ["repo", "name"], "t_open", "passed_at")
    return got.groupBy("pr_number").agg(F.count("*").alias("n_failed"), F.count_if("is_flaky").alias("n_flaky"), (~F.bool_and("is_flaky")).alias("label"))


@query(f"""with {TIMELINE_SQL}, c as (select pr, min(t) + 10 * 86400 as cut from tl group by 1), n as (select pr, t, row_number() over (partition by pr order by t, amount) as i from tl where kind = 'click'),
r as (select pr, coalesce(max(i) filter (where t <= cut), 0) as k from n join c using (pr) group by 1),
l as (select pr, cast(floor(coalesce(amount, 0)) as bigint) % 3 as label, max({{'t': t, 'kind': kind}}).kind as kind from tl join c using (pr) where kind in ('purchase', 'error') and t <= cut group by 1, 2),
x as (select pr, string_agg('l' || label, ',' order by 'l' || label) as labels from l where kind = 'purchase' group by 1)
select c.pr, case when k is not null then 'title ' || k end as title, coalesce(labels, '') as labels from c left join r using (pr) left join x using (pr)""")
def e30_at_open(spark, sf_dir):
    """Ten days after a life's first event: the title by its renames (clicks), and labels set (purchases) and not taken away (errors)."""
    e = timeline(spark, sf_dir).withColumn("cut", F.min("t").over(Window.partitionBy("pr")) + 10 * DAY)
    i = F.row_number().over(Window.partitionBy("pr").orderBy("t", "amount"))
    renames = e.where("kind = 'click'").withColumn("i", i)
    named = cuts.title_at(F.col("t"), F.col("i"), F.concat(F.lit("title "), F.col("i") - 1), F.concat(F.lit("title "), "i"), F.col("cut"))
    titles = renames.groupBy("pr").agg(named.alias("title"))
    marks = e.where("kind in ('purchase', 'error')").withColumn("label", F.concat(F.lit("l"), F.floor(F.coalesce("amount", F.lit(0.0))).cast("long") % 3))
    labels = cuts.labels_at(marks, "pr", "label", "t", "kind", "purchase", F.col("cut"))
    return e.select("pr").distinct().join(titles, "pr", "left").join(labels, "pr", "left").select("pr", "title", F.coalesce("labels", F.lit("")).alias("labels"))


@query("""with c as (select conv_id, turn, coalesce(role, '?') as role from conversations), p as (select conv_id, turn, '/role' as pointer, role as value from c union all select conv_id, turn, '/at/turn', turn::varchar from c
union all select conv_id, turn, '/at/pair/0', turn::varchar from c union all select conv_id, turn, '/at/pair/1', (turn + 1)::varchar from c union all select conv_id, turn, '/at/none', '{}' from c union all select conv_id, turn, '/a~1b~0', 'true' from c)
select pointer, value, count(*) as n from p group by 1, 2""")
def h11_json_pointers(spark, sf_dir):
    turn, role = F.col("turn"), F.coalesce("role", F.lit("?"))
    at = F.concat(F.lit(', "at": {"turn": '), turn, F.lit(', "pair": ['), turn, F.lit(", "), turn + 1, F.lit('], "none": {}}, "a/b~": true}'))
    docs = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat(F.lit('{"role": "'), role, F.lit('"'), at).alias("doc"))
    return cuts.flatten_json(docs, ["conv_id", "turn"], "doc", 4).groupBy("pointer", "value").agg(F.count("*").alias("n"))


@query(f"""with {PREDICTION_SQL}, g as (select unnest(range(-6, 7)) as k), t as (select *, pow(2.0::double, k / 4.0::double) as temperature from g), q as (select repo, y, k, temperature, pow(p0, 1 / temperature) as a, pow(p1, 1 / temperature) as b, pow(p2, 1 / temperature) as c from pred, t),
l as (select repo, k, temperature, avg(pow(a / (a + b + c) - (y = 0)::int, 2) + pow(b / (a + b + c) - (y = 1)::int, 2) + pow(c / (a + b + c) - (y = 2)::int, 2)) as s from q group by 1, 2, 3), m as (select k, temperature, avg(s) as s from l group by 1, 2)
select round(temperature, 9) as temperature, round(s, 9) as brier from m order by s, k limit 1""")
def j24_temperature(spark, sf_dir):
    best = cuts.best_temperature(predictions(spark, sf_dir), ["p0", "p1", "p2"], "y", "repo", [2 ** (k / 4) for k in range(-6, 7)])
    return best.select(F.round("temperature", 9).alias("temperature"), F.round("brier", 9).alias("brier"))


@query(f"""with recursive {FILES_SQL}, e as (select p_partkey as u, (p_partkey * 7 + 4) % 1000 + 1 as v from part where p_partkey % 3 = 0), r as (select p_partkey as root, p_partkey as node from part union select r.root, e.v from r join e on r.node = e.u)
select pr_number, count(distinct node) as n_paths from fc join r on root = path_id group by 1""")
def c18_rename_closure(spark, sf_dir):
    """How many paths a pull request's files are or became, through chains of renames that may cycle."""
    k = F.col("p_partkey")
    part = table(spark, sf_dir, "part").select(k.alias("root"))
    renames = table(spark, sf_dir, "part").where(k % 3 == 0).select(k.alias("u"), ((k * 7 + 4) % 1000 + 1).alias("v"))
    reached = cuts.rename_closure(renames, part)
    # a path that a pull request names twice reaches the same nodes, so lines need not be added up first
    files = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pr_number"), F.col("l_partkey").alias("path"))
    return cuts.distinct_reached(files, "pr_number", "path", reached).withColumnRenamed("n", "n_paths")
