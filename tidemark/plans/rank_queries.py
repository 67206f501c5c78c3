"""Queries that rank against the past, build queues, resample and calibrate, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import decisions, history, order_stats, pit, profile, ranks
from ..sources.entities import DAY, FILES_SQL, PR_SQL, PREDICTION_SQL, TIMELINE_SQL, file_changes, predictions, pull_requests, table, timeline

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(f"""with {PR_SQL}, r as (select p.pr_number, q.y, row_number() over (partition by p.pr_number order by q.t_close desc, q.pr_number desc) as i from pr p join pr q on p.repo = q.repo and q.t_close < p.t_open)
select pr.pr_number, round((count(*) filter (where r.y = 'clean') + 2 / 3.0::double) / (count(r.i) + 2), 9) as clean, round((count(*) filter (where r.y = 'rework') + 2 / 3.0::double) / (count(r.i) + 2), 9) as rework
  from pr left join r on pr.pr_number = r.pr_number and i <= 50 group by 1""")
def e11_recent_reason_shares(spark, sf_dir):
    pr = pull_requests(spark, sf_dir).select("repo", "pr_number", "t_open", "t_close", "y")
    end = F.col("_end50")
    sums = {"n": (F.lit(1), end)} | {c: ((F.col("y") == c).cast("int"), end) for c in ("clean", "rework")}
    got = pit.prior(pr.select("repo", "pr_number", "t_open"), ["repo"], "t_open", "t_close", sums, events=pit.leaving(pr, ["repo"], "t_close", "pr_number", [50]), bucket=pit.BUCKET)
    share = {c: pit.shrunk(F.col(c), F.col("n"), F.lit(1 / 3), 2.0) for c in ("clean", "rework")}
    return got.select("pr_number", *[F.round(s, 9).alias(c) for c, s in share.items()])


@query(f"""with {PR_SQL}, s as (select p.pr_number, any_value(p.la) as la, count(q.la) as n, avg(q.la) as m, stddev_pop(q.la) as sd, count(*) filter (where q.t_close >= p.t_open - 90 * 86400) as n_90d
  from pr p left join pr q on p.repo = q.repo and q.t_close < p.t_open and q.y = 'clean' group by 1)
select pr_number, n, n_90d, case when n >= 10 and sd > 0 then round((la - m) / sd, 5) end as size_z from s""")
def e14_recent_behaviour(spark, sf_dir):
    merged, la = (F.col("y") == "clean").cast("double"), F.col("la").cast("double")
    sums = {"n": (merged, None), "s1": (merged * la, None), "s2": (merged * la * la, None), "n_90d": (merged, 90 * DAY)}
    pr = pull_requests(spark, sf_dir).select("repo", "pr_number", "t_open", "t_close", "y", "la")
    got = pit.prior(pr, ["repo"], "t_open", "t_close", sums, bucket=pit.BUCKET)
    mean = F.col("s1") / F.nullif("n", F.lit(0.0))
    sd = F.sqrt(F.greatest(F.col("s2") / F.nullif("n", F.lit(0.0)) - mean * mean, F.lit(0.0)))
    return got.select("pr_number", F.col("n").cast("long").alias("n"), F.col("n_90d").cast("long").alias("n_90d"), F.when((F.col("n") >= 10) & (sd > 0), F.round((F.col("la") - mean) / sd, 5)).alias("size_z"))


@query(f"""with {PR_SQL}, {FILES_SQL}, f as (select pr_number, path_id, added, deleted, t_open from fc join pr using (pr_number)),
s as (select a.pr_number, a.path_id, count(b.path_id) as n, coalesce(sum(b.deleted + 1), 0) as w, coalesce(sum(b.deleted + 1) filter (where b.added < a.added), 0) as less, coalesce(sum(b.deleted + 1) filter (where b.added = a.added), 0) as same
  from f a left join f b on a.path_id = b.path_id and b.t_open < a.t_open group by 1, 2)
select pr_number, path_id, cast(w as bigint) as weight, case when n >= 10 then round((less + 0.5 * same) / cast(w as double), 9) end as mid_rank from s""")
def e19_path_size_percentile(spark, sf_dir):
    f = file_changes(spark, sf_dir).join(pull_requests(spark, sf_dir).select("pr_number", "t_open"), "pr_number")
    got = ranks.earlier_ranks(f, ["pr_number", "path_id"], "path_id", "t_open", "t_open", "added", F.col("deleted") + 1, seen="seen")
    rank = F.when(F.col("seen") >= 10, F.round((F.col("n_less") + 0.5 * F.col("n_equal")) / F.col("n"), 9))
    return got.select("pr_number", "path_id", F.col("n").cast("long").alias("weight"), rank.alias("mid_rank"))


@query(f"""with {PR_SQL} select p.pr_number, count(q.pr_number) as n, round(count(*) filter (where q.la < p.la) / nullif(count(q.pr_number), 0)::double, 9) as rank
  from pr p left join pr q on p.repo = q.repo and q.t_open < p.t_open group by 1""")
def e20_strict_percentile(spark, sf_dir):
    got = ranks.earlier_ranks(pull_requests(spark, sf_dir), ["pr_number"], "repo", "t_open", "t_open", "la", bucket=pit.BUCKET)
    return got.select("pr_number", F.col("n").cast("long").alias("n"), F.round(F.col("n_less") / F.nullif("n", F.lit(0)), 9).alias("rank"))


@query(f"""with {PR_SQL}, {FILES_SQL}, f as (select fc.*, t_open, y from fc join pr using (pr_number))
select a.pr_number, a.path_id, count(b.path_id) as n, cast(coalesce(sum(b.added + b.deleted) filter (where b.t_open >= a.t_open - 7 * 86400), 0) as bigint) as churn_7d,
  cast(coalesce(sum(b.added + b.deleted) filter (where b.t_open >= a.t_open - 90 * 86400), 0) as bigint) as churn_90d, cast(coalesce(sum(b.added + b.deleted) filter (where b.t_open >= a.t_open - 365 * 86400), 0) as bigint) as churn_365d,
  count(*) filter (where b.y = 'rework') as n_reworked, a.t_open - max(b.t_open) as since_last, a.t_open - min(b.t_open) as age
  from f a left join f b on a.path_id = b.path_id and b.t_open < a.t_open group by a.pr_number, a.path_id, a.t_open""")
def e25_file_history(spark, sf_dir):
    f = file_changes(spark, sf_dir).join(pull_requests(spark, sf_dir).select("pr_number", "t_open", "y"), "pr_number")
    churn = F.col("added") + F.col("deleted")
    sums = {"n": (F.lit(1), None), "n_reworked": ((F.col("y") == "rework").cast("int"), None)} | {f"churn_{d}d": (churn, d * DAY) for d in (7, 90, 365)}
    got = pit.prior(f, ["path_id"], "t_open", "t_open", sums, last="since_last", first="age")
    return got.select("pr_number", "path_id", *[F.col(c).cast("long").alias(c) for c in [*sums, "since_last", "age"]])


@query(f"""with {PR_SQL} select p.pr_number, case when p.author_key is not null then count(q.pr_number) end as n_merged, case when p.author_key is not null then count(q.pr_number) = 0 end as is_first
  from pr p left join pr q on p.author_key = q.author_key and q.y = 'clean' and q.t_close < p.t_open group by p.pr_number, p.author_key""")
def e27_merged_before(spark, sf_dir):
    got = pit.prior(pull_requests(spark, sf_dir), ["author_key"], "t_open", "t_close", {"n": ((F.col("y") == "clean").cast("int"), None)})
    return got.select("pr_number", F.col("n").cast("long").alias("n_merged"), (F.col("n") == 0).alias("is_first"))


@query(f"""with {TIMELINE_SQL}, m as (select distinct pr, t from tl where kind = 'view')
select m.pr, m.t, count(*) filter (where kind = 'purchase') as n_approved, count(*) filter (where kind = 'error') as n_changes, arg_max(kind, tl.t) filter (where kind in ('purchase', 'error')) as state
  from m left join tl on tl.pr = m.pr and tl.t < m.t group by 1, 2""")
def e31_review_state(spark, sf_dir):
    tl = timeline(spark, sf_dir)
    moments = tl.where("kind = 'view'").select("pr", "t").distinct()
    events = tl.where("kind in ('purchase', 'error')")
    made = pit.prior(moments, ["pr"], "t", "t", {"n_approved": ((F.col("kind") == "purchase").cast("int"), None), "n_changes": ((F.col("kind") == "error").cast("int"), None)}, events=events)
    got = pit.as_of(made.withColumn("before", F.col("t") - 1), events, ["pr"], "before", "t", "kind", "state")
    return got.select("pr", "t", F.col("n_approved").cast("long").alias("n_approved"), F.col("n_changes").cast("long").alias("n_changes"), "state")


@query(f"""with {PREDICTION_SQL}, b as (select *, ntile(10) over (partition by repo order by p0, pr_number) as bin from pred) select repo, bin, count(*) as n, min(la) as lowest_la from b group by 1, 2""")
def e35_equal_mass_bins(spark, sf_dir):
    binned = order_stats.equal_mass_bins(predictions(spark, sf_dir).select("repo", "p0", "pr_number", "la"), ["repo"], ["p0", "pr_number"], 10, "bin")
    return binned.withColumn("bin", F.col("bin").cast("long")).groupBy("repo", "bin").agg(F.count("*").alias("n"), F.min("la").alias("lowest_la"))


@query(f"""with {FILES_SQL} select pr_number, path_id, added + deleted as churn from fc qualify row_number() over (partition by pr_number order by added + deleted desc, path_id) <= 3""")
def f5_largest_files(spark, sf_dir):
    churn = file_changes(spark, sf_dir).select("pr_number", "path_id", (F.col("added") + F.col("deleted")).alias("churn"))
    first = F.row_number().over(Window.partitionBy("pr_number").orderBy(F.desc("churn"), "path_id"))
    return churn.withColumn("r", first).where("r <= 3").drop("r")


@query(f"""with {PR_SQL}, p as (select pr_number, case when ld % 3 = 0 then repo else repo || (la % 7) end as unit, author_key from pr),
known as (select *, row_number() over (partition by unit order by pr_number) - 1 as i, row_number() over (order by unit, pr_number) - 1 as j from p where author_key is not null),
size as (select unit, count(*) as n from known group by 1), blank as (select p.pr_number, p.unit, coalesce(n, 0) as n, (select count(*) from known) as everyone, ('0x' || substr(sha256('fill:' || p.pr_number), 1, 8))::bigint / 4294967295.0::double as share from p left join size on p.unit = size.unit where author_key is null),
want as (select pr_number, unit, n >= 20 as own, least(case when n >= 20 then n else everyone end - 1, cast(floor(share * case when n >= 20 then n else everyone end) as bigint)) as k from blank)
select pr_number, author_key from p where author_key is not null union all select w.pr_number, known.author_key from want w join known on w.own and known.unit = w.unit and known.i = w.k
union all select w.pr_number, known.author_key from want w join known on not w.own and known.j = w.k""")
def f10_fill_from_pool(spark, sf_dir):
    unit = F.when(F.col("ld") % 3 == 0, F.col("repo")).otherwise(F.concat("repo", (F.col("la") % 7).cast("string")))
    pr = pull_requests(spark, sf_dir).select("pr_number", unit.alias("unit"), "author_key")
    return ranks.fill_from_pool(pr, "pr_number", "unit", "author_key", "fill").select("pr_number", "author_key")


@query(f"""with {FILES_SQL}, s as (select pr_number, list(distinct path_id) as paths from fc group by 1)
select a.pr_number, len(list_filter(a.paths, lambda x: not list_contains(b.paths, x))) as n_fixed, len(list_filter(b.paths, lambda x: not list_contains(a.paths, x))) as n_introduced from s a join s b on b.pr_number = a.pr_number + 1""")
def g3_introduced_and_fixed(spark, sf_dir):
    s = file_changes(spark, sf_dir).groupBy("pr_number").agg(F.collect_set("path_id").alias("paths"))
    after = s.select((F.col("pr_number") - 1).alias("pr_number"), F.col("paths").alias("next"))
    sizes = F.size(F.array_except("paths", "next")).cast("long").alias("n_fixed"), F.size(F.array_except("next", "paths")).cast("long").alias("n_introduced")
    return s.join(after, "pr_number").select("pr_number", *sizes)


@query(f"""with {PR_SQL} select pr_number, round(ln(1 + la), 9) as log_la, la is null as la_missing, round(la / cast(greatest(ld, 1) as double), 6) as ratio, cast(sign(la - 1000) as integer) as side, least(greatest(ld, 10), 300) as clipped,
  substr(sha256(repo || ':' || pr_number), 1, 12) as row_hash, md5(repo) as repo_hash, cast(floor(sqrt(la)) as bigint) as root from pr""")
def h7_h8_h14_engineered(spark, sf_dir):
    la, ld = F.col("la"), F.col("ld")
    return pull_requests(spark, sf_dir).select(
        "pr_number", F.round(F.log1p(la), 9).alias("log_la"), la.isNull().alias("la_missing"), F.round(la / F.greatest(ld, F.lit(1)), 6).alias("ratio"), F.sign(la - 1000).cast("int").alias("side"),
        F.least(F.greatest(ld, F.lit(10)), F.lit(300)).alias("clipped"), F.substring(F.sha2(F.concat("repo", F.lit(":"), "pr_number"), 256), 1, 12).alias("row_hash"), F.md5("repo").alias("repo_hash"), F.floor(F.sqrt(la)).alias("root"),
    )


@query("""with v as (select p_partkey, p_partkey % 3 as a, p_partkey % 12 as b, p_partkey % 4 as c, p_partkey % 5 as pre from part), k as (select p_partkey, a * 10000 + b * 100 + c as core, pre from v)
select p_partkey, core > 10903 or (core = 10903 and pre in (0, 1, 2, 4)) as at_least, core < 20000 and core > 100 or core = 100 and pre in (0, 1, 2) as is_in_range from k""")
def h12_version_range(spark, sf_dir):
    """Versions a.b.c, of which some are pre-releases -rc1 (3) and -rc.10 (4), or carry build data (1) and a further zero (2)."""
    k = F.col("p_partkey")
    tail = F.when(k % 5 == 1, "+b7").when(k % 5 == 2, ".0").when(k % 5 == 3, "-rc1").when(k % 5 == 4, "-rc.10").otherwise("")
    version = F.concat(F.concat_ws(".", (k % 3).cast("string"), (k % 12).cast("string"), (k % 4).cast("string")), tail)
    at_least = text.version_key(version) >= text.version_key(F.lit("1.9.3-rc.10"))
    return table(spark, sf_dir, "part").select("p_partkey", at_least.alias("at_least"), text.version_in_range(version, ">= 0.1.0, < 2.0.0-alpha").alias("is_in_range"))


@query(f"""with {PR_SQL}, d as (select pr_number, t_close - t_open as s from pr where t_close is not null) select pr_number, case when s < 60 then s || 's' when s < 3600 then (s // 60) || 'm ' || (s % 60) || 's' when s < 86400 then (s // 3600) || 'h ' || (s % 3600 // 60) || 'm' else (s // 86400) || 'd ' || (s % 86400 // 3600) || 'h' end as took from d""")
def h16_durations(spark, sf_dir):
    return pull_requests(spark, sf_dir).where("t_close is not null").select("pr_number", text.duration(F.col("t_close") - F.col("t_open")).alias("took"))


def _newton_sql(rounds: int = 8) -> str:
    steps = [f"with {PREDICTION_SQL}, z as (select ln(p0 / (1 - p0)) as z, cast(y = 0 as double) as y from pred), i0 as (select 0.0::double as o, 1.0::double as s)"]
    for i in range(rounds):
        steps.append(f"""t{i} as (select o, s, sum(y - mu) as g0, sum((y - mu) * z) as g1, sum(mu * (1 - mu)) as a, sum(mu * (1 - mu) * z) as b, sum(mu * (1 - mu) * z * z) as c
          from (select z, y, o, s, 1 / (1 + exp(-(o + s * z))) as mu from z, i{i}) group by o, s), i{i + 1} as (select o + (c * g0 - b * g1) / (a * c - b * b) as o, s + (a * g1 - b * g0) / (a * c - b * b) as s from t{i})""")
    return ", ".join(steps) + f" select round(o, 6) as calibration_offset, round(s, 6) as calibration_slope from i{rounds}"


@query(_newton_sql())
def j3_calibration_line(spark, sf_dir):
    offset, slope = ranks.calibration_line(predictions(spark, sf_dir), F.col("p0"), F.col("y") == 0)
    return spark.range(1).select(F.round(F.lit(offset), 6).alias("calibration_offset"), F.round(F.lit(slope), 6).alias("calibration_slope"))


@query(f"""with {PREDICTION_SQL}, u as (select repo, avg(abs(p0 - cast(y = 0 as double))) as m from pred group by 1),
d as (select draw, m, ('0x' || substr(sha256('boot:' || draw || ':' || repo), 1, 8))::bigint / 4294967295.0::double as x from u, range(1, 201) r(draw)),
weighed as (select draw, m, {" + ".join(f"cast(x > {p!r}::double as int)" for p in ranks.POISSON_1)} as w from d), b as (select sum(w * m) / nullif(sum(w), 0) as x from weighed group by draw)
select (select round(avg(m), 9) from u) as mean, round(quantile_cont(x, 0.025), 9) as lower, round(quantile_cont(x, 0.975), 9) as upper from b""")
def j9_cluster_bootstrap(spark, sf_dir):
    got = ranks.cluster_bootstrap(predictions(spark, sf_dir), "repo", F.abs(F.col("p0") - (F.col("y") == 0).cast("double")), 200, "boot")
    return got.select(*[F.round(c, 9).alias(c) for c in ("mean", "lower", "upper")])


@query(f"""with {PREDICTION_SQL}, o as (select pred.repo, pred.pr_number, pred.p0, pred.y, unnest(range(cast(ceil(t_open / 7776000.0::double) as bigint), cast(ceil(t_close / 7776000.0::double) as bigint))) * 7776000 as moment from pred join pr on pred.pr_number = pr.pr_number where t_close is not null),
r as (select *, row_number() over (partition by repo, moment order by p0 desc, pr_number) as i, count(*) over (partition by repo, moment) as size from o)
select repo, moment, max(size) as size, count(*) filter (where i <= 5 and y = 0) as hits from r group by 1, 2""")
def j11_queues(spark, sf_dir):
    life = pull_requests(spark, sf_dir).select("pr_number", "t_open", "t_close")
    waiting = decisions.queue_moments(predictions(spark, sf_dir).join(life, "pr_number"), "t_open", "t_close", 90 * DAY)
    ranked = waiting.withColumn("i", F.row_number().over(Window.partitionBy("repo", "moment").orderBy(F.desc("p0"), "pr_number")))
    return ranked.groupBy("repo", "moment").agg(F.count("*").alias("size"), F.count_if((F.col("i") <= 5) & (F.col("y") == 0)).alias("hits"))


@query(f"""with {PREDICTION_SQL}, g as (select 'repo' as slice, repo as value, abs(p0 - cast(y = 0 as double)) as loss from pred union all select 'size', cast(la // 1000 as varchar), abs(p0 - cast(y = 0 as double)) from pred),
s as (select slice, value, count(*) as n, round(avg(loss), 9) as loss from g group by 1, 2 having count(*) >= 20) select slice, count(*) as n_groups, arg_max(value, (loss, value)) as weakest, arg_min(value, (loss, value)) as strongest from s group by 1""")
def j12_weakest_groups(spark, sf_dir):
    p = predictions(spark, sf_dir).withColumn("loss", F.abs(F.col("p0") - (F.col("y") == 0).cast("double"))).withColumn("size", F.floor(F.col("la") / 1000).cast("string"))
    s = profile.unpivot(p, ["loss"], ["repo", "size"]).groupBy("name", "value").agg(F.count("*").alias("n"), F.round(F.avg("loss"), 9).alias("loss")).where("n >= 20")
    order = F.struct("loss", "value")
    return s.groupBy(F.col("name").alias("slice")).agg(F.count("*").alias("n_groups"), F.max_by("value", order).alias("weakest"), F.min_by("value", order).alias("strongest"))


@query(f"""with {PREDICTION_SQL}, b as (select *, ntile(8) over (partition by repo order by la, pr_number) as bin from pred) select repo, bin, count(*) as n, min(la) as lowest, max(la) as highest, round(avg(cast(y = 0 as double)), 9) as rate from b group by 1, 2""")
def j17_binned_rates(spark, sf_dir):
    got = ranks.binned_rates(predictions(spark, sf_dir), "la", "pr_number", F.col("y") == 0, 8, "repo")
    return got.withColumn("rate", F.round("rate", 9)).withColumn("bin", F.col("bin").cast("long"))


@query(f"""with {PREDICTION_SQL}, g as (select y as t, case when p0 >= p1 and p0 >= p2 then 0 when p1 >= p2 then 1 else 2 end as g from pred), k as (select unnest([0, 1, 2]) as k),
s as (select k, (select count(*) from g where t = k) as nt, (select count(*) from g where g = k) as ng, (select count(*) from g where t = k and g = k) as tp from k), a as (select sum(tp) / cast(sum(nt) as double) as agree, sum(nt * ng) / (cast(sum(nt) as double) * sum(nt)) as chance from s)
select (select round(avg(2 * tp / cast(nt + ng as double)), 9) from s where nt > 0) as macro_f1, round((agree - chance) / (1 - chance), 9) as kappa from a""")
def j18_macro_f1(spark, sf_dir):
    guess = F.when((F.col("p0") >= F.col("p1")) & (F.col("p0") >= F.col("p2")), 0).when(F.col("p1") >= F.col("p2"), 1).otherwise(2)
    return ranks.macro_f1(predictions(spark, sf_dir), F.col("y"), guess).select(F.round("macro_f1", 9).alias("macro_f1"), F.round("kappa", 9).alias("kappa"))


@query(f"""with {PREDICTION_SQL} select repo, round(quantile_cont(p0, 0.9), 9) as threshold from pred where y <> 0 group by 1""")
def j20_threshold_for_rate(spark, sf_dir):
    """The score above which a tenth of the other classes would be flagged."""
    return predictions(spark, sf_dir).where("y <> 0").groupBy("repo").agg(F.round(F.percentile("p0", F.lit(0.9)), 9).alias("threshold"))


@query(f"""with {PR_SQL}, d as (select unnest([1, 3, 7, 14, 30]) as d), c as (select pr_number, 'clock_' || d || 'd' as trigger, t_open + d * 86400 as t, t_close from pr, d) select pr_number, trigger, t, coalesce(t_close - t <= 3600, false) as is_near_decided from c where t_close is null or t < t_close""")
def k2_k5_candidate_moments(spark, sf_dir):
    pr = pull_requests(spark, sf_dir)
    got = decisions.candidate_moments(pr, "pr_number", "t_open", "t_close", [1, 3, 7, 14, 30]).join(pr.select("pr_number", "t_close"), "pr_number")
    return got.select("pr_number", "trigger", "t", F.coalesce(F.col("t_close") - F.col("t") <= 3600, F.lit(False)).alias("is_near_decided"))


@query(f"""with {TIMELINE_SQL}, g as (select pr, t, lead(t) over (partition by pr order by t) as nxt from tl) select pr, t + 43200 as t from g where nxt - t > 43200""")
def k2_idle_moments(spark, sf_dir):
    return decisions.idle_moments(timeline(spark, sf_dir), "pr", "t", 43200)


@query(f"""with {PR_SQL} select p.pr_number, case when p.is_bot then 'bot' when count(q.pr_number) >= 3 then 'maintainer' when p.author_key is not null then 'author' else 'other' end as role
  from pr p left join pr q on p.author_key = q.author_key and q.y = 'clean' and q.t_close < p.t_open group by p.pr_number, p.is_bot, p.author_key""")
def k6_roles(spark, sf_dir):
    got = pit.prior(pull_requests(spark, sf_dir), ["author_key"], "t_open", "t_close", {"n": ((F.col("y") == "clean").cast("int"), None)})
    return got.select("pr_number", decisions.first_true({"bot": F.col("is_bot"), "maintainer": F.col("n") >= 3, "author": F.col("author_key").isNotNull()}, "other").alias("role"))


@query(f"""with {TIMELINE_SQL} select pr, list_aggregate(list_sort(list(t) filter (where kind = 'click')), 'count') as n_comments, cast(min(t) filter (where kind = 'purchase') as bigint) as first_approval, cast(max(t) filter (where kind = 'error') as bigint) as last_change_request,
  bool_or(kind = 'error' and amount > 90) as is_reworked from tl group by 1""")
def k7_d39_review_signals(spark, sf_dir):
    times = {n: F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("t")))) for n, k in (("c", "click"), ("a", "purchase"), ("r", "error"))}
    got = timeline(spark, sf_dir).groupBy("pr").agg(*[v.alias(n) for n, v in times.items()], F.bool_or((F.col("kind") == "error") & (F.col("amount") > 90)).alias("is_reworked"))
    return got.select("pr", F.size("c").cast("long").alias("n_comments"), F.get("a", F.lit(0)).alias("first_approval"), F.try_element_at("r", F.lit(-1)).alias("last_change_request"), "is_reworked")
