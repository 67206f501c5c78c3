"""Review, queue, label and calibration queries, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import decisions, history
from ..sources.entities import DAY, FILES_SQL, PR_SQL, PREDICTION_SQL, TIMELINE_SQL, file_changes, predictions, pull_requests, table, timeline

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(f"with {PR_SQL} select pr_number, label_bad is true as is_bad from pr")
def b6_true_only(spark, sf_dir):
    return pull_requests(spark, sf_dir).select("pr_number", F.col("label_bad").eqNullSafe(F.lit(True)).alias("is_bad"))


@query(f"""with {PR_SQL} select pr_number, case when y <> 'nowhere' then null when ld % 11 = 0 then 'duplicate' when ld % 7 = 0 then 'unwanted' when la % 5 = 0 then 'ci'
  when t_close - t_open < 3600 then 'withdrawn_or_rejected' when t_close - t_open > 2592000 then 'abandoned' else 'other' end as reason from pr where t_close is not null""")
def b11_b12_outcome_reason(spark, sf_dir):
    age = F.col("t_close") - F.col("t_open")
    rules = {"duplicate": F.col("ld") % 11 == 0, "unwanted": F.col("ld") % 7 == 0, "ci": F.col("la") % 5 == 0, "withdrawn_or_rejected": age < 3600, "abandoned": age > 30 * DAY}
    return pull_requests(spark, sf_dir).where("t_close is not null").select("pr_number", F.when(F.col("y") == "nowhere", decisions.first_true(rules, "other")).alias("reason"))


@query(f"""with {PR_SQL} select pr_number, case when label_bad is not null then 'label' when author_key is not null then 'author' when t_close is not null then 'close' end as known_from from pr""")
def b13_status_reason(spark, sf_dir):
    known = {"label": F.col("label_bad").isNotNull(), "author": F.col("author_key").isNotNull(), "close": F.col("t_close").isNotNull()}
    return pull_requests(spark, sf_dir).select("pr_number", decisions.first_true(known).alias("known_from"))


@query(r"""select page_id, case when regexp_matches(url, '(?i)^https?://[^/]*[0-9]') then 'numbered_host' when regexp_matches(url, '[?&]') or regexp_matches(html, '(?i)<script') then 'dynamic' when url ilike 'https://%' then 'secure' end as agent from pages""")
def b17_agent(spark, sf_dir):
    rules = {"numbered_host": F.col("url").rlike(r"(?i)^https?://[^/]*[0-9]"), "dynamic": F.col("url").rlike("[?&]") | F.col("html").rlike("(?i)<script"), "secure": F.col("url").ilike("https://%")}
    return table(spark, sf_dir, "pages").select("page_id", decisions.first_true(rules).alias("agent"))


@query(f"""with {PR_SQL}, m as (select max(t_open) - 90 * 86400 as newest from pr), r as (select pr.*, row_number() over (partition by repo order by t_open desc, pr_number desc) as r from pr, m where t_open <= newest),
c as (select repo, min(t_open) as cut from r where r <= 20 group by 1)
select r.repo, pr_number, case when r <= 20 then 'block' else 'lead_in' end as part from r join c on r.repo = c.repo where r <= 20 or t_open >= cut - 30 * 86400""")
def b23_newest_block(spark, sf_dir):
    pr = pull_requests(spark, sf_dir)
    newest = F.broadcast(pr.agg((F.max("t_open") - 90 * DAY).alias("newest")))  # one row
    return decisions.newest_block(pr.join(newest, F.col("t_open") <= F.col("newest")), "repo", "t_open", "pr_number", 20, 30 * DAY).select("repo", "pr_number", "part")


@query(f"""with {PR_SQL}, bad as (select distinct user_id as author_key from events where event_type = 'error' and value > 50)
select pr_number, case when b.author_key is null then la end as la, case when b.author_key is null then ld end as ld from pr left join bad b on pr.author_key = b.author_key""")
def b24_null_where_listed(spark, sf_dir):
    bad = table(spark, sf_dir, "events").where("event_type = 'error' and value > 50").select(F.col("user_id").alias("author_key"))
    return decisions.null_where_listed(pull_requests(spark, sf_dir), bad, ["author_key"], ["la", "ld"]).select("pr_number", "la", "ld")


@query(f"""with {PR_SQL}, {FILES_SQL}, f as (select pr_number, count(*) as fc_files, cast(sum(added) as bigint) as fc_added from fc where added > 10 group by 1)
select pr.pr_number, fc_files, fc_added from pr left join f on pr.pr_number = f.pr_number where open_snapshot <> 'final'""")
def c1_c2_prefixed_columns(spark, sf_dir):
    f = file_changes(spark, sf_dir).where("added > 10").groupBy("pr_number").agg(F.count("*").alias("fc_files"), F.sum("added").alias("fc_added"))
    return pull_requests(spark, sf_dir).where("open_snapshot <> 'final'").join(f, "pr_number", "left").select("pr_number", "fc_files", "fc_added")


@query(f"with {PREDICTION_SQL} select repo, pr_number from pred where pr_number % 3 <> 0 and pr_number % 4 <> 0 and pr_number % 5 <> 0")
def c3_in_all_runs(spark, sf_dir):
    runs = [predictions(spark, sf_dir).where(F.col("pr_number") % k != 0) for k in (3, 4, 5)]
    return decisions.in_all(runs, ["repo", "pr_number"])


@query(f"""with {PR_SQL} select count(*) filter (where author_key in (select author_key from pr where ld % 5 <> 0 and author_key is not null)) as same_author,
  count(*) filter (where repo in (select repo from pr where ld % 5 <> 0)) as same_repo, count(*) as n from pr where ld % 5 = 0""")
def c5_overlap(spark, sf_dir):
    pr = pull_requests(spark, sf_dir)
    test, train = pr.where("ld % 5 = 0"), pr.where("ld % 5 <> 0")
    one = {c: test.join(train, c, "left_semi").agg(F.count("*").alias(n)) for c, n in (("author_key", "same_author"), ("repo", "same_repo"))}
    return one["author_key"].crossJoin(F.broadcast(one["repo"])).crossJoin(F.broadcast(test.agg(F.count("*").alias("n"))))  # one row each


@query(f"""with {PREDICTION_SQL}, base as (select avg(p0) as b from pred where pr_number % 4 <> 0)
select pr.pr_number, round(coalesce(q.p0, b), 9) as p0, q.p0 is null as is_filled from pr left join (select * from pred where pr_number % 4 <> 0) q on pr.pr_number = q.pr_number, base""")
def c6_aligned(spark, sf_dir):
    got = predictions(spark, sf_dir).where("pr_number % 4 <> 0").select("pr_number", "p0")
    base = F.broadcast(got.agg(F.avg("p0").alias("b")))  # one row
    return pull_requests(spark, sf_dir).select("pr_number").join(got, "pr_number", "left").crossJoin(base).select("pr_number", F.round(F.coalesce("p0", "b"), 9).alias("p0"), F.col("p0").isNull().alias("is_filled"))


@query(f"""with {PR_SQL}, up as (select lower(n_name) as repo, lower(r_name) as canonical from nation join region on n_regionkey = r_regionkey where n_nationkey % 3 = 0)
select pr_number, coalesce(canonical, pr.repo) as unit from pr left join up on pr.repo = up.repo""")
def c12_lookup_with_default(spark, sf_dir):
    up = table(spark, sf_dir, "nation").where("n_nationkey % 3 = 0").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    up = up.select(F.lower("n_name").alias("repo"), F.lower("r_name").alias("canonical"))
    return pull_requests(spark, sf_dir).join(up, "repo", "left").select("pr_number", F.coalesce("canonical", "repo").alias("unit"))


MESSAGE_SQL = """msg as (select pr_number, t_close, case when pr_number % 3 = 0 then 'Merge pull request #' || (pr_number + 1) || ' from x' when pr_number % 3 = 1 then 'Tidy the tree (#' || (pr_number - 1) || ')' else 'Closes #' || (pr_number + 2) || ', closes #' || (pr_number + 2) || ' and fixes #' || (pr_number - 2) end as message from pr where t_close is not null)"""
STRONG, TAIL, WEAK = r"Merge pull request #([0-9]+)", r"\(#([0-9]+)\)$", r"(?i)(?:close[sd]?|fix(?:e[sd])?) #([0-9]+)"


@query(f"""with {PR_SQL}, {MESSAGE_SQL}, l as (select pr_number, t_close, cast(unnest(regexp_extract_all(message, '{STRONG}', 1)) as bigint) as number, 0 as strength from msg union
  select pr_number, t_close, cast(unnest(regexp_extract_all(message, '{TAIL}', 1)) as bigint), 1 from msg union select pr_number, t_close, cast(unnest(regexp_extract_all(message, '{WEAK}', 1)) as bigint), 2 from msg),
b as (select *, min(strength) over (partition by number) as best from l)
select pr.pr_number, min(b.t_close) as first_landed, max(b.t_close) as last_landed, count(*) as n from b join pr on b.number = pr.pr_number and b.t_close > pr.t_open where strength = best group by 1""")
def c15_c27_reference_links(spark, sf_dir):
    pr, k = pull_requests(spark, sf_dir), F.col("pr_number")
    weak = F.concat(F.lit("Closes #"), k + 2, F.lit(", closes #"), k + 2, F.lit(" and fixes #"), k - 2)
    message = F.when(k % 3 == 0, F.concat(F.lit("Merge pull request #"), k + 1, F.lit(" from x"))).when(k % 3 == 1, F.concat(F.lit("Tidy the tree (#"), k - 1, F.lit(")"))).otherwise(weak)
    commits = pr.where("t_close is not null").select(message.alias("message"), F.col("t_close").alias("landed"))
    links = decisions.reference_links(commits, "message", [STRONG, TAIL, WEAK])
    return links.join(pr, (F.col("number") == k) & (F.col("landed") > F.col("t_open"))).groupBy("pr_number").agg(F.min("landed").alias("first_landed"), F.max("landed").alias("last_landed"), F.count("*").alias("n"))


@query(f"with {PR_SQL} select repo, count(*) filter (where is_bot) as n_bots, cast(coalesce(sum(la) filter (where y = 'clean'), 0) as bigint) as clean_lines, max(ld) filter (where label_bad) as worst from pr group by 1")
def d5_filtered_aggregates(spark, sf_dir):
    return pull_requests(spark, sf_dir).groupBy("repo").agg(
        F.count_if("is_bot").alias("n_bots"), F.coalesce(F.sum(F.when(F.col("y") == "clean", F.col("la"))), F.lit(0)).alias("clean_lines"), F.max(F.when(F.col("label_bad"), F.col("ld"))).alias("worst")
    )


@query(f"""with {PR_SQL}, c as (select repo, priority, count(*) as n from pr group by 1, 2), m as (select repo, string_agg(priority || '=' || n, ',' order by priority) as priorities from c group by 1),
s as (select repo, count(*) as n, avg(cast(author_key is null as int)) as unknown, avg(cast(t_close is null as int)) as unclosed from pr group by 1)
select s.repo, n, round(unknown, 9) as unknown_share, round(unclosed, 9) as unclosed_share, unknown > 0.1 or unclosed > 0.08 as is_flagged, priorities from s join m on s.repo = m.repo""")
def d7_repository_health(spark, sf_dir):
    counts = pull_requests(spark, sf_dir).groupBy("repo", "priority").agg(
        F.count("*").alias("n"), F.count_if(F.col("author_key").isNull()).alias("unknown"), F.count_if(F.col("t_close").isNull()).alias("unclosed")
    )
    named = F.array_sort(F.collect_list(F.concat("priority", F.lit("="), "n")))
    s = counts.groupBy("repo").agg(F.sum("n").alias("n"), (F.sum("unknown") / F.sum("n")).alias("u"), (F.sum("unclosed") / F.sum("n")).alias("c"), F.array_join(named, ",").alias("priorities"))
    return s.select("repo", "n", F.round("u", 9).alias("unknown_share"), F.round("c", 9).alias("unclosed_share"), ((F.col("u") > 0.1) | (F.col("c") > 0.08)).alias("is_flagged"), "priorities")


@query(f"""with {PR_SQL}, s as (select repo, avg(cast(not is_bot as int)) as human, avg(cast(t_close is not null as int)) as closed, avg(cast(y = 'clean' as int)) as merged from pr group by 1)
select repo, round(human * closed * (1 - abs(2 * merged - 1)), 9) as score from s""")
def d8_candidate_scores(spark, sf_dir):
    share = {"human": ~F.col("is_bot"), "closed": F.col("t_close").isNotNull(), "merged": F.col("y") == "clean"}
    s = pull_requests(spark, sf_dir).groupBy("repo").agg(*[F.avg(c.cast("int")).alias(n) for n, c in share.items()])
    return s.select("repo", F.round(F.col("human") * F.col("closed") * (1 - F.abs(2 * F.col("merged") - 1)), 9).alias("score"))


@query(f"""with {FILES_SQL}, w as (select pr_number, 1.0::double / count(*) over (partition by pr_number) as weight from fc), p as (select pr_number, count(*) as n, sum(weight) as total from w group by 1)
select count(*) as n_keys, round(avg(n), 9) as mean_n, median(n) as median_n, max(n) as max_n, count(*) filter (where abs(total - 1) > 1e-9) as n_wrong from p""")
def d13_snapshot_summary(spark, sf_dir):
    weight = F.lit(1.0) / F.count("*").over(Window.partitionBy("pr_number"))
    p = file_changes(spark, sf_dir).withColumn("weight", weight).groupBy("pr_number").agg(F.count("*").alias("n"), F.sum("weight").alias("total"))
    return p.agg(F.count("*").alias("n_keys"), F.round(F.avg("n"), 9).alias("mean_n"), F.median("n").alias("median_n"), F.max("n").alias("max_n"), F.count_if(F.abs(F.col("total") - 1) > 1e-9).alias("n_wrong"))


@query(f"""with {PR_SQL} select count(*) filter (where y = 'clean' and label_bad) as clean_but_bad, count(*) filter (where label_bad and not label_bad_observed) as bad_unobserved,
  count(*) filter (where t_close is null and y = 'clean') as clean_but_open, count(*) filter (where label_bad is null and label_bad_observed) as observed_but_null from pr""")
def d14_contradictions(spark, sf_dir):
    bad, seen = F.col("label_bad"), F.col("label_bad_observed")
    rules = {"clean_but_bad": (F.col("y") == "clean") & bad, "bad_unobserved": bad & ~seen, "clean_but_open": F.col("t_close").isNull() & (F.col("y") == "clean"), "observed_but_null": bad.isNull() & seen}
    return pull_requests(spark, sf_dir).agg(*[F.count_if(r).alias(n) for n, r in rules.items()])


@query(f"""with {TIMELINE_SQL}, m as (select pr, unnest([kind, 'all']) as stage, amount from tl) select pr % 25 as repo, stage, count(*) as n, round(sum(amount), 4) as seconds, round(max(amount), 6) as longest from m group by 1, 2""")
def d27_stage_totals(spark, sf_dir):
    stages = timeline(spark, sf_dir).select((F.col("pr") % 25).alias("repo"), F.explode(F.create_map("kind", "amount", F.lit("all"), "amount")).alias("stage", "s"))
    return stages.groupBy("repo", "stage").agg(F.count("*").alias("n"), F.round(F.sum("s"), 4).alias("seconds"), F.round(F.max("s"), 6).alias("longest"))


@query(f"""with {PREDICTION_SQL}, g as (select pr_number, unnest(['p0', 'p1', 'p2']) as flag, unnest([p0, p1, p2]) > 0.4 as a, unnest([p1, p2, p0]) < 0.3 as b from pred),
f as (select flag, count(*) as n, sum(cast(a = b as int)) as k from g group by 1) select round(sum(k) / cast(sum(n) as double), 9) as micro, round(avg(k / cast(n as double)), 9) as macro from f""")
def d28_agreement(spark, sf_dir):
    p = [F.col(f"p{i}") for i in range(3)]
    flags = F.array(*[F.struct(F.lit(f"p{i}").alias("flag"), ((p[i] > 0.4) == (p[(i + 1) % 3] < 0.3)).alias("same")) for i in range(3)])
    f = predictions(spark, sf_dir).select(F.explode(flags).alias("f")).groupBy("f.flag").agg(F.count("*").alias("n"), F.count_if("f.same").alias("k"))
    return f.agg(F.round(F.sum("k") / F.sum("n"), 9).alias("micro"), F.round(F.avg(F.col("k") / F.col("n")), 9).alias("macro"))


@query(f"""with {PREDICTION_SQL}, m as (select avg(p0) as mean_p0, avg(cast(y = 0 as double)) as rate, count(*) as n from pred),
g as (select 'mean gap' as gate, abs(mean_p0 - rate) as value, 0.03 as at_most from m union all select 'rows', n, null from m union all select 'rate', rate, 0.2 from m)
select gate, round(value, 9) as value, case when at_most is null then 'INFO' when value is null then 'SKIP' when value <= at_most then 'PASS' else 'FAIL' end as verdict from g""")
def d36_gates(spark, sf_dir):
    m = predictions(spark, sf_dir).agg(F.avg("p0").alias("p"), F.avg((F.col("y") == 0).cast("double")).alias("rate"), F.count("*").cast("double").alias("n"))
    gates = [("mean gap", F.abs(F.col("p") - F.col("rate")), 0.03), ("rows", F.col("n"), None), ("rate", F.col("rate"), 0.2)]
    put = m.select(F.explode(F.array(*[F.struct(F.lit(n).alias("gate"), v.alias("value"), F.lit(limit).cast("double").alias("at_most")) for n, v, limit in gates])).alias("g")).select("g.*")
    verdicts = {"INFO": F.col("at_most").isNull(), "SKIP": F.col("value").isNull(), "PASS": F.col("value") <= F.col("at_most")}
    return put.select("gate", F.round("value", 9).alias("value"), decisions.first_true(verdicts, "FAIL").alias("verdict"))


@query(f"""with {PREDICTION_SQL}, r as (select 'a' as run, avg(abs(p0 - cast(y = 0 as double))) as loss, avg(p0) * 3 as slope from pred union all select 'b', avg(abs(p1 - cast(y = 1 as double))), avg(p1) * 3 from pred
  union all select 'c', avg(abs(p2 - cast(y = 2 as double))), avg(p2) * 3 from pred) select 'loss' as metric, arg_min(run, round(loss, 9)) as best from r union all select 'slope', arg_min(run, round(abs(slope - 1), 9)) from r""")
def d37_best_run(spark, sf_dir):
    runs = [F.struct(F.lit(r).alias("run"), F.avg(F.abs(F.col(f"p{i}") - (F.col("y") == i).cast("double"))).alias("loss"), (F.avg(f"p{i}") * 3).alias("slope")) for i, r in enumerate("abc")]
    r = predictions(spark, sf_dir).agg(F.array(*runs).alias("r")).select(F.explode("r").alias("r")).select("r.*")
    badness = F.array(F.struct(F.lit("loss").alias("metric"), F.round("loss", 9).alias("b")), F.struct(F.lit("slope").alias("metric"), F.round(F.abs(F.col("slope") - 1), 9).alias("b")))
    return r.select("run", F.explode(badness).alias("m")).groupBy("m.metric").agg(F.min_by("run", "m.b").alias("best"))


@query(f"""with {FILES_SQL}, s as (select pr_number, case when path_id % 9 <> 0 then added % 4 end as rank from fc)
select pr_number, case when max(rank) = 3 then 3 when count(*) = count(rank) then max(rank) end as severity from s group by 1""")
def d40_worst_severity(spark, sf_dir):
    s = file_changes(spark, sf_dir).withColumn("rank", F.when(F.col("path_id") % 9 != 0, F.col("added") % 4))
    return s.groupBy("pr_number").agg(decisions.worst_severity(F.col("rank"), 3).cast("long").alias("severity"))


@query(f"""with {PR_SQL}, r as (select p.pr_number, p.author_key = q.author_key as same, row_number() over (partition by p.pr_number order by q.t_open desc, q.pr_number desc) as i from pr p join pr q on p.repo = q.repo and q.t_open < p.t_open)
select pr.pr_number, coalesce(2 * count(*) filter (where same) >= count(r.i) and count(r.i) > 0, false) as is_majority from pr left join r on pr.pr_number = r.pr_number and i <= 5 group by 1""")
def d41_majority_of_last(spark, sf_dir):
    got = history.last_values(pull_requests(spark, sf_dir), "repo", "t_open", "t_open", F.coalesce("author_key", F.lit(-1)), F.col("pr_number"), 5, "who")
    same = F.size(F.filter("who", lambda a: a == F.col("author_key")))
    return got.select("pr_number", ((2 * same >= F.size("who")) & (F.size("who") > 0)).alias("is_majority"))
