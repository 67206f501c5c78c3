"""Profile, label, text, set and metric queries, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import metrics, order_stats, profile, sets
from ..operators.components import min_label_components
from ..sources import catalog
from ..sources.entities import FILES_SQL, PR_SQL, PREDICTION_SQL, TIMELINE_SQL, file_changes, predictions, pull_requests, table, timeline

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query("select p_partkey, p_name from part where cast(p_name as varchar) ilike '%a_e%'")
def b1_contains_pattern(spark, sf_dir):
    return table(spark, sf_dir, "part").where(text.contains_pattern(F.col("p_name"), "a_e")).select("p_partkey", "p_name")


@query("select page_id from pages where contains(url, '_source')")
def b2_contains_literal(spark, sf_dir):
    return table(spark, sf_dir, "pages").where(text.contains_literal(F.col("url"), "_source")).select("page_id")


@query(f"with {PR_SQL} select pr_number, case when open_snapshot <> 'final' then la end as la, case when open_snapshot <> 'final' then ld end as ld from pr")
def b4_masked_columns(spark, sf_dir):
    return profile.mask(pull_requests(spark, sf_dir), ["la", "ld"], F.col("open_snapshot") == "final").select("pr_number", "la", "ld")


@query(f"""with {PR_SQL} select 1 as step, 'closed' as rule, count(*) filter (where t_close is not null) as remaining from pr
union all select 2, 'human', count(*) filter (where t_close is not null and not is_bot) from pr
union all select 3, 'observed', count(*) filter (where t_close is not null and not is_bot and label_bad is not null) from pr""")
def b5_selection_funnel(spark, sf_dir):
    return profile.funnel(pull_requests(spark, sf_dir), {"closed": F.col("t_close").isNotNull(), "human": ~F.col("is_bot"), "observed": F.col("label_bad").isNotNull()})


@query("select doc_id, case when quality = 1 then true when quality = 0 then false end as is_good from labels")
def b7_tri_state(spark, sf_dir):
    return table(spark, sf_dir, "labels").select("doc_id", profile.tri_state(F.col("quality")).alias("is_good"))


@query("""select d.doc_id, l.toxic = 1 as toxic from documents d left join labels l on d.doc_id = l.doc_id where l.toxic = 1 or (l.toxic = 0 and l.quality = 1)""")
def b8_observation_window(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    toxic = profile.tri_state(F.col("toxic"))
    return joined.where(profile.observed_rows(toxic, profile.tri_state(F.col("quality")), "window")).select("doc_id", toxic.alias("toxic"))


@query(f"""with {PR_SQL} select pr_number, label_bad or (case when ld % 4 = 0 then null else ld % 4 = 1 end) as any_bad from pr""")
def b10_any_observed_yes(spark, sf_dir):
    other = F.when(F.col("ld") % 4 != 0, F.col("ld") % 4 == 1)
    return pull_requests(spark, sf_dir).select("pr_number", profile.any_yes(F.col("label_bad"), other).alias("any_bad"))


@query(r"""with p as (select p_partkey, replace(p_name, ' ', '/') || '/' || replace(p_type, ' ', '/') || '.md' as path from part)
select p_partkey, regexp_matches(path, '(?i)(^|/)docs?(/|$)|\.(md|rst|txt)$') as is_docs, regexp_matches(path, '(?i)auth|login|permission|secur') as is_auth,
  case when len(string_split(path, '/')) >= 4 then string_split(path, '/')[1] || '/' || string_split(path, '/')[2] when len(string_split(path, '/')) >= 2 then string_split(path, '/')[1] end as subsystem from p""")
def b14_b16_path_rules(spark, sf_dir):
    path = F.concat(F.replace("p_name", F.lit(" "), F.lit("/")), F.lit("/"), F.replace("p_type", F.lit(" "), F.lit("/")), F.lit(".md"))
    p = table(spark, sf_dir, "part").select("p_partkey", path.alias("path"))
    flags = text.path_flags(F.col("path"))
    return p.select("p_partkey", flags["is_docs"].alias("is_docs"), flags["is_auth"].alias("is_auth"), text.subsystem(F.col("path")).alias("subsystem"))


@query(r"""select doc_id, coalesce(regexp_matches(lower(text), '(^|[^a-z0-9_])(the|of)([^a-z0-9_]|$)'), false) as is_english, coalesce(regexp_matches(lower(text), '(^|[^a-z0-9_])(que|de)([^a-z0-9_]|$)'), false) as is_romance from documents""")
def b15_whole_words(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", text.is_word_in(F.col("text"), "the", "of").alias("is_english"), text.is_word_in(F.col("text"), "que", "de").alias("is_romance"))


def _profile_sql(column: str, kind: str, numeric: bool) -> str:
    x = f"cast({column} as double)" if numeric else "cast(null as double)"
    return f"""select '{column}' as name, '{kind}' as type, count(*) as n, round(count(*) filter (where {column} is null) / cast(count(*) as double), 9) as null_share, count(distinct {column}) as n_distinct,
  cast(min({column}) as varchar) as lowest, cast(max({column}) as varchar) as highest, round(avg({x}), 6) as mean, round(median({x}), 6) as median from c"""


@query("with c as (select c_name, c_mktsegment, cast(c_nationkey as bigint) as c_nationkey, case when c_custkey % 7 > 0 then cast(c_custkey as bigint) - 50 end as shifted from customer) " + " union all ".join(
    _profile_sql(*x) for x in (("c_name", "string", False), ("c_mktsegment", "string", False), ("c_nationkey", "bigint", True), ("shifted", "bigint", True))))
def d2_schema_profile(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_name", "c_mktsegment", F.col("c_nationkey").cast("long").alias("c_nationkey"), F.when(F.col("c_custkey") % 7 > 0, F.col("c_custkey").cast("long") - 50).alias("shifted"))
    got = profile.schema_profile(c, c.columns)
    return got.withColumns({n: F.round(n, 9 if n == "null_share" else 6) for n in ("null_share", "mean", "median")})


@query(f"""with {PR_SQL}, e as (select cast(min(la) as double) as lo, cast(max(la) as double) as hi from pr)
select cast(least(19, floor((la - lo) / ((hi - lo) / 20))) as bigint) as bin, count(*) as n from pr, e group by 1""")
def d3_histogram(spark, sf_dir):
    return profile.histogram(pull_requests(spark, sf_dir), "la")


@query("select p_brand, count(*) as n from part group by 1 order by n desc, p_brand limit 15")
def f2_top_values(spark, sf_dir):
    return profile.top_values(table(spark, sf_dir, "part"), "p_brand")


@query(f"""with {PR_SQL}, u as (select 'priority' as slice, priority as value, * from pr union all select 'open_snapshot', open_snapshot, * from pr
  union all select 'author_key', case when author_key is null then '(null)' else cast(author_key % 3 as varchar) end, * from pr)
select slice, value, count(*) as n, round(count(*) / cast(sum(count(*)) over (partition by slice) as double), 9) as share, round(avg(case when y = 'clean' then 1.0 else 0.0 end), 9) as merged_rate,
  count(*) filter (where label_bad_observed) as n_observed, round(avg(cast(cast(label_bad as integer) as double)) filter (where label_bad_observed), 9) as bad_rate from u group by 1, 2""")
def d6_slices(spark, sf_dir):
    pr = pull_requests(spark, sf_dir).withColumn("author_key", F.col("author_key") % 3)
    got = profile.slices(pr, ["priority", "open_snapshot", "author_key"], F.col("y") == "clean", F.col("label_bad"), F.col("label_bad_observed"))
    return got.select("slice", "value", "n", F.round("share", 9).alias("share"), F.round("merged_rate", 9).alias("merged_rate"), "n_observed", F.round("bad_rate", 9).alias("bad_rate"))


@query(f"""with {FILES_SQL} select pr_number, max(added) as max_added, min(added) as min_added, cast(sum(deleted) as bigint) as sum_deleted, round(avg(added), 4) as mean_added, median(added) as median_added from fc group by 1""")
def d1_per_file_to_pr(spark, sf_dir):
    return file_changes(spark, sf_dir).groupBy("pr_number").agg(
        F.max("added").alias("max_added"), F.min("added").alias("min_added"), F.sum("deleted").alias("sum_deleted"), F.round(F.avg("added"), 4).alias("mean_added"), F.median("added").alias("median_added")
    )


@query(f"""with {FILES_SQL}, p as (select pr_number, added / cast(sum(added) over (partition by pr_number) as double) as p from fc where added > 0)
select pr_number, count(*) as n, round(case when count(*) > 1 then -sum(p * log2(p)) / log2(count(*)) else 0 end, 6) as entropy from p group by 1""")
def d29_change_entropy(spark, sf_dir):
    return profile.entropy(file_changes(spark, sf_dir), "pr_number", "added").withColumn("entropy", F.round("entropy", 6))


@query(f"""with {PR_SQL} select year(to_timestamp(t_open)) as year, count(*) as n, round(count(*) filter (where y = 'clean') / cast(count(*) as double), 9) as clean,
  round(count(*) filter (where y = 'rework') / cast(count(*) as double), 9) as rework, round(count(*) filter (where y = 'nowhere') / cast(count(*) as double), 9) as nowhere from pr group by 1""")
def d11_outcome_mix_by_year(spark, sf_dir):
    pr = pull_requests(spark, sf_dir).withColumn("year", F.year(F.timestamp_seconds("t_open")).cast("long"))
    wide = pr.groupBy("year").pivot("y", ["clean", "rework", "nowhere"]).agg(F.count(F.lit(1)))
    n = F.col("clean") + F.col("rework") + F.col("nowhere")
    return wide.na.fill(0).select("year", n.alias("n"), *[F.round(F.col(c) / n, 9).alias(c) for c in ("clean", "rework", "nowhere")])


@query(f"""with {PR_SQL} select repo, y, round(count(*) / cast(sum(count(*)) over (partition by y) as double), 9) as share from pr group by 1, 2""")
def d16_crosstab_by_column(spark, sf_dir):
    g = pull_requests(spark, sf_dir).groupBy("repo", "y").agg(F.count("*").alias("n"))
    return g.select("repo", "y", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("y")), 9).alias("share"))


@query(f"""with {PR_SQL}, r as (select repo, avg(case when y = 'clean' then 1.0 else 0.0 end) as rate from pr group by 1) select count(*) as n_repos, round(avg(rate), 9) as macro_rate from r""")
def d18_macro_average(spark, sf_dir):
    rate = pull_requests(spark, sf_dir).groupBy("repo").agg(F.avg((F.col("y") == "clean").cast("double")).alias("rate"))
    return rate.agg(F.count("*").alias("n_repos"), F.round(F.avg("rate"), 9).alias("macro_rate"))


@query(f"""with {PR_SQL} select pr_number, round(count(*) over w / cast(greatest(count(*) filter (where open_snapshot = 'exact') over w, 1) as double), 9) as weight from pr window w as (partition by repo, y)""")
def d19_stratum_weights(spark, sf_dir):
    return pull_requests(spark, sf_dir).select("pr_number", F.round(profile.stratum_weights(["repo", "y"], F.col("open_snapshot") == "exact"), 9).alias("weight"))


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def d21_duplicate_keys(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


@query(f"with {TIMELINE_SQL} select pr, max(t) as t, arg_max(kind, t) as kind from tl group by pr")
def d24_latest_by_key(spark, sf_dir):
    return catalog.last_wins(timeline(spark, sf_dir), ["pr"], "t").select("pr", "t", "kind")


@query(f"""with {TIMELINE_SQL}, s as (select pr, kind, count(*) as n from tl group by 1, 2), p as (select *, n / cast(sum(n) over (partition by kind) as double) as share from s)
select kind, round(max(share), 9) as top_share, count(*) filter (where share < 0.005) as n_minor from p group by kind""")
def d30_ownership(spark, sf_dir):
    n = timeline(spark, sf_dir).groupBy("pr", "kind").agg(F.count("*").alias("n"))
    share = n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("kind")))
    return share.groupBy("kind").agg(F.round(F.max("share"), 9).alias("top_share"), F.count_if(F.col("share") < 0.005).alias("n_minor"))


@query(f"""with {TIMELINE_SQL} select pr, t // 86400 as day, case when bool_or(kind = 'error') then 'failure' when bool_and(kind in ('click', 'purchase')) then 'success' end as conclusion from tl group by pr, t // 86400""")
def d34_conclusions(spark, sf_dir):
    k = F.col("kind")
    return timeline(spark, sf_dir).groupBy("pr", F.floor(F.col("t") / 86400).alias("day")).agg(F.when(F.bool_or(k == "error"), "failure").when(F.bool_and(k.isin("click", "purchase")), "success").alias("conclusion"))


@query(f"with {TIMELINE_SQL} select pr, min(t) filter (where kind in ('click', 'purchase') and amount > 50) as first_response from tl group by pr")
def d38_first_response(spark, sf_dir):
    k = F.col("kind").isin("click", "purchase") & (F.col("amount") > 50)
    return timeline(spark, sf_dir).groupBy("pr").agg(F.min(F.when(k, F.col("t"))).alias("first_response"))


@query("""select count(*) as n_rows, count(*) filter (where doc_id is null) as n_null, count(*) filter (where doc_id is not null and doc_id not in (select doc_id from labels)) as n_orphans from documents""")
def c4_foreign_key(spark, sf_dir):
    return sets.orphans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id", "doc_id")


@query(f"""with {PR_SQL}, c as (select repo, pr_number, case when ld % 50 = 0 then la + 1 else la end as la from pr union all select 'nowhere', -1, 0)
select c.repo, c.pr_number from c left join pr p on c.repo = p.repo and c.pr_number = p.pr_number where p.pr_number is null or c.la is distinct from p.la""")
def c13_stale_rows(spark, sf_dir):
    pr = pull_requests(spark, sf_dir)
    copy = pr.select("repo", "pr_number", F.when(F.col("ld") % 50 == 0, F.col("la") + 1).otherwise(F.col("la")).alias("la"))
    extra = spark.createDataFrame([("nowhere", -1, 0)], "repo string, pr_number long, la long")
    return sets.stale_keys(copy.unionByName(extra), pr, ["repo", "pr_number"], ["la"])


@query("""with e as (select p_partkey, p_brand, p_size from part where p_partkey % 10 <> 0), a as (select p_partkey, case when p_partkey % 7 = 0 then 'x' else p_brand end as p_brand, p_size from part where p_partkey % 9 <> 0)
select coalesce(e.p_partkey, a.p_partkey) as p_partkey, case when a.p_partkey is null then 'missing' when e.p_partkey is null then 'unexpected' when e.p_brand is distinct from a.p_brand then 'p_brand' end as difference
from e full join a on e.p_partkey = a.p_partkey where a.p_partkey is null or e.p_partkey is null or e.p_brand is distinct from a.p_brand""")
def c14_inventory_compare(spark, sf_dir):
    part, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    actual = part.where(k % 9 != 0).withColumn("p_brand", F.when(k % 7 == 0, "x").otherwise(F.col("p_brand")))
    return sets.compare_inventories(part.where(k % 10 != 0), actual, "p_partkey", ["p_brand", "p_size"])


@query("""with recursive e as (select distinct s_nationkey as u, s_suppkey + 1000000 as v from supplier), b as (select u, v from e union select v, u from e),
r as (select u as node, u as other from b union select r.node, b.v from r join b on r.other = b.u) select node, min(other) as component from r group by node""")
def c19_components(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return min_label_components(s.select(F.col("s_nationkey").cast("long").alias("u"), (F.col("s_suppkey") + 1_000_000).cast("long").alias("v")))


@query("""select l_returnflag, l_linestatus from lineitem where l_orderkey % 2 = 0 except all select l_returnflag, l_linestatus from lineitem where l_orderkey % 2 = 1""")
def c22_g4_multiset_difference(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.where("l_orderkey % 2 = 0").select("l_returnflag", "l_linestatus").exceptAll(li.where("l_orderkey % 2 = 1").select("l_returnflag", "l_linestatus"))


@query("""select distinct c_nationkey from customer where c_acctbal < 0 intersect select distinct s_nationkey from supplier""")
def g2_key_intersection(spark, sf_dir):
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    return c.where("c_acctbal < 0").select("c_nationkey").intersect(s.select(F.col("s_nationkey").alias("c_nationkey")))


@query("select c_custkey, c_name, c_acctbal from customer order by c_acctbal desc nulls last, c_custkey limit 50 offset 100")
def f1_page(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal").orderBy(F.col("c_acctbal").desc_nulls_last(), "c_custkey").offset(100).limit(50)


@query(f"""with {TIMELINE_SQL}, n as (select *, row_number() over (partition by pr order by t) - 1 as i, count(*) over (partition by pr) as n from tl)
select pr, t from n where n <= 5 or i in (0, round_even((n - 1) / 4.0, 0), round_even(2 * (n - 1) / 4.0, 0), round_even(3 * (n - 1) / 4.0, 0), n - 1)""")
def f4_evenly_spread(spark, sf_dir):
    tl = timeline(spark, sf_dir)
    return tl.withColumn("_in", profile.evenly_spread(["t"], 5, "pr")).where("_in").select("pr", "t")


@query(f"""with {PR_SQL} select pr_number, cast(greatest(1, ceil((row_number() over (partition by repo order by la, pr_number) - 1) * 4 / cast(greatest(count(*) over (partition by repo) - 1, 1) as double))) as integer) as quartile from pr""")
def e34_rank_quartile(spark, sf_dir):
    return order_stats.rank_quantile(pull_requests(spark, sf_dir).select("repo", "la", "pr_number"), ["repo"], ["la", "pr_number"], 4, "quartile").select("pr_number", "quartile")


@query(f"""with {PR_SQL} select pr_number, rank() over (partition by repo order by ld) + (count(*) over (partition by repo, ld) - 1) / 2.0 as avg_rank from pr""")
def e36_average_rank(spark, sf_dir):
    return order_stats.average_ranks(pull_requests(spark, sf_dir).select("pr_number", "repo", "ld"), ["repo"], "ld", "avg_rank").select("pr_number", "avg_rank")


@query(f"""with {PR_SQL}, r as (select repo, rank() over (partition by repo order by ld) + (count(*) over (partition by repo, ld) - 1) / 2.0 as a, rank() over (partition by repo order by la) + (count(*) over (partition by repo, la) - 1) / 2.0 as b from pr)
select repo, round(corr(a, b), 6) as spearman from r group by repo""")
def h10_spearman(spark, sf_dir):
    r = order_stats.average_ranks(pull_requests(spark, sf_dir).select("repo", "ld", "la"), ["repo"], "ld", "a")
    r = order_stats.average_ranks(r, ["repo"], "la", "b")
    return r.groupBy("repo").agg(F.round(F.corr("a", "b"), 6).alias("spearman"))


@query("""select item_id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(lower(text), '[a-z][a-z0-9_]{2,}'), lambda w: w not in ('the','and','for','with','from','this','that','into','add','fix','use','update','remove')))), ' ') as tokens from benchmark""")
def h2_tokens(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", F.array_join(text.tokens(F.col("text")), " ").alias("tokens"))


@query(r"""select page_id, len(regexp_extract_all(html, 'https?://')) as n_links, len(regexp_extract_all(html, '(?m)^#{1,6} ')) as n_headings from pages""")
def h3_body_features(spark, sf_dir):
    f = text.body_features(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", f["n_links"].cast("long").alias("n_links"), f["n_headings"].cast("long").alias("n_headings"))


@query("select event_type, cast(floor(epoch(ts)) as bigint) // 86400 as day, cast(count(*) as bigint) as n, sum(cast(json_extract(props, '$.k') as bigint))::bigint as k from events group by 1, 2")
def h5_h11_json_by_day(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    day = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 86400)
    return e.groupBy("event_type", day.alias("day")).agg(F.count("*").alias("n"), F.sum(F.get_json_object("props", "$.k").cast("long")).alias("k"))


LOSS = "pow(p0 - (y = 0)::int, 2) + pow(p1 - (y = 1)::int, 2) + pow(p2 - (y = 2)::int, 2)"


@query(f"""with {PREDICTION_SQL} select repo, round(avg({LOSS}), 9) as brier, round(avg((pow(p2 - (y = 2)::int, 2) + pow(p2 + p1 - (y in (1, 2))::int, 2)) / 2), 9) as rps,
  round(avg(-ln(greatest(case y when 0 then p0 when 1 then p1 else p2 end, 1e-15))), 9) as log_loss from pred group by repo""")
def j1_losses(spark, sf_dir):
    y, p = F.col("y"), [F.col(f"p{i}") for i in range(3)]
    return predictions(spark, sf_dir).groupBy("repo").agg(
        F.round(F.avg(metrics.brier(y, p)), 9).alias("brier"), F.round(F.avg(metrics.ranked_probability_score(y, p, [2, 1, 0])), 9).alias("rps"), F.round(F.avg(metrics.log_loss(y, p)), 9).alias("log_loss")
    )


@query(f"""with {PREDICTION_SQL}, b as (select repo, p0, (y = 0)::int as hit, ntile(15) over (partition by repo order by p0, pr_number) as bin from pred), g as (select repo, bin, count(*) as n, avg(p0) as p, avg(hit) as r from b group by 1, 2)
select repo, round(sum(n * abs(p - r)) / sum(n), 9) as ece from g group by repo""")
def j2_calibration_error(spark, sf_dir):
    bins = metrics.calibration(predictions(spark, sf_dir), "p0", F.col("y") == 0, ["p0", "pr_number"], ["repo"])
    return metrics.expected_calibration_error(bins, "repo").withColumn("ece", F.round("ece", 9))


@query(f"""with {PREDICTION_SQL}, r as (select repo, y = 0 as hit, rank() over (partition by repo order by p0) + (count(*) over (partition by repo, p0) - 1) / 2.0 as a from pred)
select repo, round((sum(a) filter (where hit) - count(*) filter (where hit) * (count(*) filter (where hit) + 1) / 2.0) / nullif(count(*) filter (where hit) * cast(count(*) filter (where not hit) as double), 0), 9) as auroc from r group by repo""")
def j4_auroc(spark, sf_dir):
    return metrics.auroc(predictions(spark, sf_dir), "p0", F.col("y") == 0, "repo").withColumn("auroc", F.round("auroc", 9))


@query(f"""with {PREDICTION_SQL}, s as (select repo, p0, sum((y = 0)::int) as p, count(*) as n from pred group by 1, 2),
c as (select *, sum(p) over w / cast(sum(n) over w as double) as pr from s window w as (partition by repo order by p0 desc rows unbounded preceding))
select repo, round(sum(p * pr) / nullif(sum(p), 0), 9) as average_precision from c group by repo""")
def j5_average_precision(spark, sf_dir):
    return metrics.average_precision(predictions(spark, sf_dir), "p0", F.col("y") == 0, "repo").withColumn("average_precision", F.round("average_precision", 9))


@query(f"""with {PREDICTION_SQL} select y, case when p0 >= p1 and p0 >= p2 then 0 when p1 >= p2 then 1 else 2 end as guess, count(*) as n from pred group by 1, 2""")
def j6_confusion(spark, sf_dir):
    guess = F.when((F.col("p0") >= F.col("p1")) & (F.col("p0") >= F.col("p2")), 0).when(F.col("p1") >= F.col("p2"), 1).otherwise(2)
    return predictions(spark, sf_dir).groupBy("y", guess.alias("guess")).agg(F.count("*").alias("n"))


@query(f"""with {PREDICTION_SQL}, r as (select repo, (y = 0)::double as g, row_number() over (partition by repo order by p0 desc, pr_number) as r, row_number() over (partition by repo order by (y = 0)::double desc, p0 desc, pr_number) as i from pred)
select repo, round(sum(g / log2(r + 1)) filter (where r <= 10) / nullif(sum(g / log2(i + 1)) filter (where i <= 10), 0), 9) as ndcg from r group by repo""")
def j7_ndcg(spark, sf_dir):
    return metrics.ndcg(predictions(spark, sf_dir), "repo", (F.col("y") == 0).cast("int"), [F.desc("p0"), F.col("pr_number")], 10).withColumn("ndcg", F.round("ndcg", 9))


@query(f"""with {PREDICTION_SQL}, r as (select repo, (y = 0)::int as h, sum(la) over (partition by repo order by p0 desc, pr_number rows unbounded preceding) <= 0.2 * sum(la) over (partition by repo) as within_share from pred)
select repo, round(coalesce(sum(h) filter (where within_share), 0) / nullif(cast(sum(h) as double), 0), 9) as recall from r group by repo""")
def j8_recall_at_effort(spark, sf_dir):
    return metrics.recall_at_effort(predictions(spark, sf_dir), "repo", [F.desc("p0"), F.col("pr_number")], "la", F.col("y") == 0).withColumn("recall", F.round("recall", 9))


@query(f"""with {PREDICTION_SQL}, c as (select quantile_cont(la, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) as e from pred where pr_number % 2 = 0),
b as (select len(list_filter(c.e, lambda x: x < pred.la)) as bin, count(*) filter (where pr_number % 2 = 0) as a, count(*) filter (where pr_number % 2 <> 0) as b from pred, c group by 1),
p as (select greatest(a / cast(sum(a) over () as double), 1e-4) as pa, greatest(b / cast(sum(b) over () as double), 1e-4) as pb from b) select round(sum((pa - pb) * ln(pa / pb)), 9) as psi from p""")
def j15_stability_index(spark, sf_dir):
    return metrics.stability_index(predictions(spark, sf_dir), "la", F.col("pr_number") % 2 == 0).withColumn("psi", F.round("psi", 9))
