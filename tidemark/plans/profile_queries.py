"""Queries of pages, column and feature profiles, ownership, file history and weighted scores, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import decisions, features, metrics, profile
from ..sources.entities import DAY, FILES_SQL, PR_SQL, PREDICTION_SQL, file_changes, predictions, pull_requests, seconds, table

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(f"with {PR_SQL} select pr_number, t_close, repo, (select count(*) from pr) as total_rows from pr order by t_close desc nulls last, repo nulls last, pr_number limit 100 offset 250")
def f1_page_with_total(spark, sf_dir):
    rows = pull_requests(spark, sf_dir).select("pr_number", "t_close", "repo")
    return profile.page(rows, [("t_close", True), ("repo", False)], 250, 100, "pr_number")


@query("""select 'month' as kind, strftime(o_orderdate, '%Y-%m') as label, count(*) as n, 'o_orderdate' as "column" from orders group by 2
union all select 'value', cast(l_linenumber as varchar), count(*), 'l_linenumber' from lineitem group by 2
union all (with e as (select min(c_acctbal) as lo, max(c_acctbal) as hi from customer) select 'bin', cast(cast(least(19, floor((c_acctbal - lo) / ((hi - lo) / 20))) as bigint) as varchar), count(*), 'c_acctbal' from customer, e group by 2)""")
def d3_column_profiles(spark, sf_dir):
    """A time by month, a number of few values by value, one of many in bins."""
    parts = [profile.column_profile(table(spark, sf_dir, t), c).withColumn("column", F.lit(c)) for t, c in (("orders", "o_orderdate"), ("lineitem", "l_linenumber"), ("customer", "c_acctbal"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


FEATURES = {"la": "la", "ld": "ld", "ld_some": "case when ld % 5 <> 0 then ld * ld end", "flag": "case when is_bot then 1 else 0 end", "half": "la / 2.0", "one": "1", "none": "cast(null as double)", "span": "t_close - t_open"}


@query(f"""with {PR_SQL}, x as (select {", ".join(f"cast({sql} as double) as f_{name}" for name, sql in FEATURES.items())} from pr), t as (select count(*) as total from pr),
l as ({" union all ".join(f"select '{name}' as col, f_{name} as v from x" for name in FEATURES)}), c as (select col, v, count(*) as c from l where v is not null group by 1, 2),
m as (select col, avg(v) as mean, count(v) as n, median(v) as median, quantile_cont(v, 0.99) as p99 from l group by 1),
k as (select l.col, sum(pow(v - mean, 2)) as m2, sum(pow(v - mean, 3)) as m3 from l join m using (col) group by 1),
b as (select col, count(*) as n_distinct, max(c) as top, sum(case when v = 0 then c else 0 end) as zeros, bool_and(v = floor(v)) as whole from c group by 1)
select m.col as "column", n / cast(total as double) as filled, case when n = 0 then 'empty' when n_distinct = 1 then 'constant' when n_distinct = 2 then 'binary' when whole then 'whole' else 'real' end as kind, coalesce(n_distinct, 0) as n_distinct,
  round(top / cast(n as double), 9) as top_share, round(zeros / cast(n as double), 9) as zero_share, round(median, 4) as median, round(p99, 4) as p99,
  case when n > 2 and m2 > 0 then round(sqrt(n * (n - 1.0)) / (n - 2) * (m3 / n) / pow(m2 / n, 1.5), 4) + 0.0 end as skew from m join k using (col) left join b using (col), t""")
def d15_feature_profiles(spark, sf_dir):
    x = pull_requests(spark, sf_dir).select(*[F.expr(f"cast({sql} as double)").alias(f"f_{name}") for name, sql in FEATURES.items()])
    got = features.feature_profile(x.withColumnsRenamed({f"f_{c}": c for c in FEATURES}), list(FEATURES))
    return got.select("column", "filled", "kind", "n_distinct", *[F.round(c, 9).alias(c) for c in ("top_share", "zero_share")], *[(F.round(c, 4) + 0.0).alias(c) for c in ("median", "p99", "skew")])  # no negative zero


CHANGES_SQL = f"{PR_SQL}, {FILES_SQL}, ch as (select fc.pr_number, path_id, author_key, t_open, added + deleted as churn, case when label_bad is not null then label_bad end as failed from fc join pr using (pr_number))"


def _changes(spark, sf_dir):
    pr = pull_requests(spark, sf_dir).select("pr_number", "author_key", "t_open", "label_bad")
    return file_changes(spark, sf_dir).join(pr, "pr_number").select("pr_number", "path_id", "author_key", "t_open", (F.col("added") + F.col("deleted")).alias("churn"), F.col("label_bad").alias("failed"))


@query(f"""with {CHANGES_SQL} select a.pr_number, a.path_id, cast(count(b.pr_number) as double) as n_before, cast(coalesce(sum(b.churn) filter (where b.t_open >= a.t_open - 7 * 86400), 0) as double) as churn_7d, cast(coalesce(sum(b.churn) filter (where b.t_open >= a.t_open - 90 * 86400), 0) as double) as churn_90d,
  round(count(*) filter (where b.failed) / cast(nullif(count(b.failed), 0) as double), 9) as fail_rate, round((any_value(a.t_open) - max(b.t_open)) / 86400.0::double, 9) as age_days from ch a left join ch b on a.path_id = b.path_id and b.t_open < a.t_open group by 1, 2""")
def e25_file_columns(spark, sf_dir):
    """What a changed file's own past says: changes, churn of a week and a quarter, failures, age."""
    got = features.file_history(_changes(spark, sf_dir), "path_id", "t_open", F.col("churn"), F.col("failed"))
    return got.select("pr_number", "path_id", "n_before", "churn_7d", "churn_90d", F.round("fail_rate", 9).alias("fail_rate"), F.round("age_days", 9).alias("age_days"))


@query(f"""with {CHANGES_SQL}, k as (select * from ch where author_key is not null), la as (select author_key, max(t_open) as active from k group by 1), m as (select path_id, author_key, sum(churn) as w, max(t_open) as own from k group by 1, 2),
s as (select m.*, active, w / cast(nullif(sum(w) over (partition by path_id), 0) as double) as s, max(own) over (partition by path_id) as last from m join la using (author_key))
select path_id, count(*) as n_owners, round(max(s), 9) as top_share, count(*) filter (where s < 0.05) as n_minor, round(coalesce(sum(s) filter (where s < 0.05), 0), 9) as minor_share, round(coalesce(sum(s) filter (where active < last - 60 * 86400), 0), 9) as abandoned_share,
  round(case when count(*) > 1 then -sum(case when s > 0 then s * log2(s) else 0 end) / log2(count(*)) else 0 end, 9) as entropy from s group by 1""")
def d30_ownership_shares(spark, sf_dir):
    got = profile.ownership(_changes(spark, sf_dir), "path_id", "author_key", "t_open", "churn", 60 * DAY)
    return got.select("path_id", "n_owners", "n_minor", *[F.round(c, 9).alias(c) for c in ("top_share", "minor_share", "abandoned_share", "entropy")])


GUESS_SQL = "case when p0 >= p1 and p0 >= p2 then 0 when p1 >= p2 then 1 else 2 end"


@query(f"""with {PREDICTION_SQL}, r as (select y, p0, 1 + ld % 3 as w, pow(p0 - (y = 0)::int, 2) + pow(p1 - (y = 1)::int, 2) + pow(p2 - (y = 2)::int, 2) as b, -ln(greatest(case y when 0 then p0 when 1 then p1 else p2 end, 1e-15)) as l, ({GUESS_SQL} = y)::int as hit from pred),
t as (select sum(w * b) / sum(w) as brier, sum(w * l) / sum(w) as log_loss, sum(w * hit) / cast(sum(w) as double) as accuracy, 1 - pow(sum(w) filter (where y = 0) / cast(sum(w) as double), 2) - pow(sum(w) filter (where y = 1) / cast(sum(w) as double), 2) - pow(sum(w) filter (where y = 2) / cast(sum(w) as double), 2) as base from r),
s as (select p0, sum(case when y = 0 then w else 0 end) as p, sum(case when y = 0 then 0 else w end) as n from r group by 1), c as (select *, coalesce(sum(n) over (order by p0 rows between unbounded preceding and 1 preceding), 0) as below from s)
select round(brier, 9) as brier, round(base, 9) as base_brier, round(1 - brier / base, 9) as skill, round(log_loss, 9) as log_loss, round(accuracy, 9) as accuracy, round((select sum(p * (below + n / 2.0)) / (sum(p) * cast(sum(n) as double)) from c), 9) as auroc from t""")
def j23_weighted_scores(spark, sf_dir):
    p, w = predictions(spark, sf_dir), 1 + F.col("ld") % 3
    scores = metrics.weighted_scores(p, F.col("y"), [F.col(f"p{i}") for i in range(3)], w)
    area = metrics.weighted_auroc(p.withColumn("g", F.lit(0)), "p0", F.col("y") == 0, w, "g").select("auroc")
    return scores.crossJoin(area).select(*[F.round(c, 9).alias(c) for c in ("brier", "base_brier", "skill", "log_loss", "accuracy", "auroc")])  # one row each


@query(f"with {PREDICTION_SQL}, r as (select repo, y, avg(({GUESS_SQL} = y)::int) as r from pred group by 1, 2) select repo, round(avg(r), 9) as balanced_accuracy from r group by 1")
def j6_balanced_accuracy(spark, sf_dir):
    guess = F.when((F.col("p0") >= F.col("p1")) & (F.col("p0") >= F.col("p2")), 0).when(F.col("p1") >= F.col("p2"), 1).otherwise(2)
    return metrics.balanced_accuracy(predictions(spark, sf_dir), F.col("y"), guess, "repo").withColumn("balanced_accuracy", F.round("balanced_accuracy", 9))


@query(f"""with {PREDICTION_SQL}, l as (select repo, pr_number, 0 as k, p0 as p, (y = 0)::int as hit from pred union all select repo, pr_number, 1, p1, (y = 1)::int from pred union all select repo, pr_number, 2, p2, (y = 2)::int from pred),
b as (select *, ntile(15) over (partition by repo, k order by p, pr_number) as bin from l), g as (select repo, k, bin, count(*) as n, avg(p) as p, avg(hit) as r from b group by 1, 2, 3), e as (select repo, k, sum(n * abs(p - r)) / sum(n) as e from g group by 1, 2)
select repo, round(avg(e), 9) as ece from e group by 1""")
def j2_classwise_error(spark, sf_dir):
    return metrics.classwise_calibration_error(predictions(spark, sf_dir), F.col("y"), ["p0", "p1", "p2"], "pr_number", ["repo"]).withColumn("ece", F.round("ece", 9))


AGENTS = [("night", ["[02]7$"], ["@build"], [], ["household"]), ("day", ["3$"], [], ["^[5-9]"], ["Machinery", "automobile"]), ("any", ["#0+[0-9]*[13579]$"], [], ["^-"], [])]


@query("""with c as (select c_custkey, c_name as login, lower(c_mktsegment) || '/' || c_custkey as branch, c_custkey || '@' || c_mktsegment as email, cast(c_acctbal as varchar) as body from customer)
select c_custkey, case when regexp_matches(login, '(?i)[02]7$') or regexp_matches(email, '(?i)@build') or split_part(branch, '/', 1) = 'household' then 'night'
  when regexp_matches(login, '(?i)3$') or regexp_matches(body, '(?i)^[5-9]') or split_part(branch, '/', 1) in ('machinery', 'automobile') then 'day' when regexp_matches(login, '(?i)#0+[0-9]*[13579]$') or regexp_matches(body, '(?i)^-') then 'any' end as agent from c""")
def b17_ordered_agents(spark, sf_dir):
    """The first agent of whom a login, an address, a text or a branch tells."""
    c = table(spark, sf_dir, "customer")
    branch, email = F.concat(F.lower("c_mktsegment"), F.lit("/"), "c_custkey"), F.concat("c_custkey", F.lit("@"), "c_mktsegment")
    return c.select("c_custkey", decisions.first_agent(F.col("c_name"), branch, email, F.col("c_acctbal").cast("string"), AGENTS).alias("agent"))


@query("""with e as (select event_id as i, user_id as actor, cast(floor(epoch(ts)) as bigint) as t, event_type as kind, (event_id // 10) % 150 as author from events),
f as (select actor, min(t) as first from e where kind = 'purchase' and actor <> author group by 1)
select i, case when kind = 'view' and i % 4 = 0 then 'author' when e.actor % 17 = 0 then 'bot' when e.actor = author then 'author' when (kind = 'signup' and i % 2 = 0) or first < t then 'maintainer' else 'other' end as role from e left join f on f.actor = e.actor""")
def k6_event_roles(spark, sf_dir):
    """Whose role an event was, from associations and from requests of others that the actor had closed by then."""
    i = F.col("event_id")
    e = table(spark, sf_dir, "events").select(i.alias("i"), F.col("user_id").alias("actor"), seconds("ts").alias("t"), F.col("event_type").alias("kind"), (F.floor(i / 10) % 150).alias("author"))
    e = e.withColumns({"is_commit": (F.col("kind") == "view") & (F.col("i") % 4 == 0), "is_bot": F.col("actor") % 17 == 0, "association": F.when((F.col("kind") == "signup") & (F.col("i") % 2 == 0), "Member")})
    closes = e.where("kind = 'purchase'").select(F.col("actor").alias("closer"), "author", F.col("t").alias("at"))
    return decisions.event_roles(e, closes, ["OWNER", "MEMBER", "COLLABORATOR"]).select("i", "role")


@query(f"""with {PREDICTION_SQL}, d as (select repo, case priority when '1-URGENT' then 0 when '2-HIGH' then 1 when '3-MEDIUM' then 2 end as y, least(1, greatest(0, p0 * 1.5 - 0.1)) as a, p1 as b, p2 as c from pred join (select pr_number, priority from pr) using (pr_number)),
q as (select repo, y, a / (a + b + c) as p0, b / (a + b + c) as p1, c / (a + b + c) as p2 from d where y is not null), g as (select *, {GUESS_SQL} as guess from q),
m as (select repo, count(*) as n, avg(pow(p0 - (y = 0)::int, 2) + pow(p1 - (y = 1)::int, 2) + pow(p2 - (y = 2)::int, 2)) as brier, avg(-ln(greatest(case y when 0 then p0 when 1 then p1 else p2 end, 1e-15))) as log_loss, avg((y = guess)::int) as accuracy,
  {", ".join(f"coalesce(2 * count(*) filter (where y = {c} and guess = {c}) / cast(nullif(count(*) filter (where y = {c}) + count(*) filter (where guess = {c}), 0) as double), 0) as f{c}" for c in range(3))} from g group by 1)
select repo, n, round(brier, 9) as brier, round(log_loss, 9) as log_loss, round(accuracy, 9) as accuracy, round((f0 + f1 + f2) / 3, 9) as macro_f1 from m""")
def j13_multiclass_label(spark, sf_dir):
    """A further label of three answers; rows with another priority don't know it."""
    p = predictions(spark, sf_dir).join(pull_requests(spark, sf_dir).select("pr_number", "priority"), "pr_number")
    y = F.when(F.col("priority") == "1-URGENT", 0).when(F.col("priority") == "2-HIGH", 1).when(F.col("priority") == "3-MEDIUM", 2)
    got = metrics.multiclass_scores(p, y, [F.col("p0") * 1.5 - 0.1, F.col("p1"), F.col("p2")], "repo")
    return got.select("repo", "n", *[F.round(c, 9).alias(c) for c in ("brier", "log_loss", "accuracy", "macro_f1")])


@query(f"""with {PREDICTION_SQL}, g as (select 'merged' as prediction, abs(p0 + p1 * 0.98 - (p0 + p1)) as gap from pred union all select 'nowhere', abs(p2 * 0.7 - p2) from pred union all select 'some', abs(case when ld % 3 = 0 then p1 end - p1) from pred)
select prediction, count(gap) as n, round(avg(gap), 9) as average_gap, round(max(gap), 9) as largest_gap, case when avg(gap) > 0.05 then 'CHECK' else 'OK' end as result from g where gap is not null group by 1""")
def j13_consistency_gaps(spark, sf_dir):
    """Predictions that should agree with sums of others."""
    p0, p1, p2 = (F.col(f"p{i}") for i in range(3))
    pairs = {"merged": (p0 + p1 * 0.98, p0 + p1), "nowhere": (p2 * 0.7, p2), "some": (F.when(F.col("ld") % 3 == 0, p1), p1)}
    return metrics.consistency_gaps(predictions(spark, sf_dir), pairs).withColumns({c: F.round(c, 9) for c in ("average_gap", "largest_gap")})
