"""Label, lifecycle, sampling, event and evaluation queries, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import lifecycle, metrics, order_stats
from ..sources import catalog
from ..sources.entities import DAY, FILES_SQL, PR_SQL, PREDICTION_SQL, TIMELINE_SQL, file_changes, predictions, pull_requests, table, timeline

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


KEYS_SQL = "k as (select (s_nationkey % 5) || '/' || (s_suppkey % 3) || '.' || (s_suppkey % 12) || '/split' || (s_suppkey % 2) || '/' || case when s_suppkey % 7 = 0 then 'logs' else 'data' end || '/d' || s_suppkey || case s_suppkey % 4 when 0 then '_snapshots.parquet' when 1 then '_commit_features.parquet' when 2 then '.parquet' else '.json' end as key from supplier)"


def _keys(spark, sf_dir):
    k = F.col("s_suppkey")
    ending = F.when(k % 4 == 0, "_snapshots.parquet").when(k % 4 == 1, "_commit_features.parquet").when(k % 4 == 2, ".parquet").otherwise(".json")
    parts = [F.col("s_nationkey") % 5, F.concat(k % 3, F.lit("."), k % 12), F.concat(F.lit("split"), k % 2), F.when(k % 7 == 0, "logs").otherwise("data"), F.concat(F.lit("d"), k, ending)]
    return table(spark, sf_dir, "supplier").select(F.concat_ws("/", *[p.cast("string") for p in parts]).alias("key"))


@query(f"""with {KEYS_SQL}, s as (select string_split(key, '/') as p, key from k where key like '%/data/%'), f as (select p[1] as unit, p[2] as version, p[3] as split, p[5] as file, key from s)
select unit, version, split, file, case when file like '%\\_snapshots.parquet' escape '\\' then 'snapshots' when file like '%\\_commit\\_features.parquet' escape '\\' then 'commit_features' else 'dataset' end as "table", key from f where file like '%.parquet' and unit in ('0', '2', '4')""")
def a3_a4_planned_files(spark, sf_dir):
    keys = _keys(spark, sf_dir)
    return catalog.plan(keys, keys.select(F.split("key", "/")[0].alias("unit")).distinct().where("cast(unit as int) % 2 = 0"))


@query(f"""with {KEYS_SQL}, s as (select string_split(key, '/') as p from k where key like '%/data/%' and key like '%.parquet'), v as (select distinct p[2] as version from s)
select arg_max(version, cast(split_part(version, '.', 1) as int) * 1000 + cast(split_part(version, '.', 2) as int)) as version from v""")
def a5_newest_version(spark, sf_dir):
    return catalog.newest_version(catalog.plan(_keys(spark, sf_dir)))


STATUS_SQL = """st as (select s_suppkey as unit, case when s_suppkey % 9 = 0 then '{"reason": "batch' when s_suppkey % 3 = 0 then '{"reason": "batch done", "files_failed": 0, "files_deferred": []}' when s_suppkey % 3 = 1 then '{"reason": "batch done", "files_failed": 2}' else '{"reason": "stopped"}' end as status from supplier)"""


@query(f"with {STATUS_SQL} select unit, unit % 3 = 0 and unit % 9 <> 0 as is_finished from st")
def a6_finished_runs(spark, sf_dir):
    k = F.col("s_suppkey")
    status = F.when(k % 9 == 0, '{"reason": "batch').when(k % 3 == 0, '{"reason": "batch done", "files_failed": 0, "files_deferred": []}').when(k % 3 == 1, '{"reason": "batch done", "files_failed": 2}').otherwise('{"reason": "stopped"}')
    return table(spark, sf_dir, "supplier").select(k.alias("unit"), catalog.is_finished(status).alias("is_finished"))


@query(f"""with {KEYS_SQL}, s as (select string_split(key, '/') as p, key from k where key like '%/data/%' and key like '%.parquet')
select p[2] as version, p[3] as split, count(*) as n_files, count(*) filter (where p[1] in ('0', '2', '4')) as n_finished from s group by 1, 2""")
def a8_catalogue(spark, sf_dir):
    keys = _keys(spark, sf_dir)
    return catalog.catalogue(catalog.plan(keys), keys.select(F.split("key", "/")[0].alias("unit")).distinct().where("cast(unit as int) % 2 = 0"))


@query(f"""with {PR_SQL}, n as (select repo, pr_number, la + 1 as la from pr where ld % 4 = 0 union all select 'new', pr_number + 100000000, la from pr where ld % 40 = 1)
select repo, pr_number, la from n union all select repo, pr_number, la from pr where (repo, pr_number) not in (select repo, pr_number from n)""")
def a15_upsert(spark, sf_dir):
    pr = pull_requests(spark, sf_dir).select("repo", "pr_number", "la", "ld")
    new = pr.where("ld % 4 = 0").withColumn("la", F.col("la") + 1).unionByName(pr.where("ld % 40 = 1").withColumns({"repo": F.lit("new"), "pr_number": F.col("pr_number") + 100_000_000}))
    return catalog.upsert(pr.drop("ld"), new.drop("ld"), ["repo", "pr_number"])


@query("""select event_type, count(*) as n, (sum(cast(json_extract(props, '$.k') as bigint)) filter (where user_id % 10 <> 0))::bigint as k, count(*) filter (where user_id % 10 = 0) as n_torn from events group by 1""")
def a16_torn_lines(spark, sf_dir):
    """Lines of which every tenth user's is torn: those are counted and left out of the sum, the whole ones are read by the schema."""
    whole = F.col("props")
    line = F.when(F.col("user_id") % 10 == 0, F.substring(whole, F.lit(1), F.length(whole) - 1)).otherwise(whole)
    read = catalog.read_lines(table(spark, sf_dir, "events").select("event_type", line.alias("line")), "line", "k long")
    return read.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("record.k").alias("k"), F.count_if("is_torn").alias("n_torn"))


@query(f"with {PR_SQL} select la, ld, is_bot, priority from pr")
def b3_model_inputs(spark, sf_dir):
    pr = pull_requests(spark, sf_dir).withColumn("days_to_close", F.col("t_close") - F.col("t_open"))
    roles = {"repo": "id", "pr_number": "id", "author_key": "id", "y": "label", "label_bad": "label", "label_bad_observed": "metadata", "t_open": "metadata", "t_close": "metadata", "open_snapshot": "bookkeeping"}
    marked = lifecycle.with_roles(pr, roles)
    return marked.select(*lifecycle.model_inputs(marked))


@query(f"""with {PR_SQL}, s as (select pr_number, y <> 'nowhere' and 1000000000 - coalesce(t_close, t_open) >= 60 * 86400 as ok, coalesce(label_bad, false) or coalesce(la % 11 = 0, false) as fired, (not (coalesce(label_bad, false) or label_bad_observed))::int + (not (coalesce(la % 11 = 0, false) or ld % 3 > 0))::int as missing from pr)
select pr_number, case when ok and (fired or missing = 0) then fired end as masked, case when ok then fired end as negative, case when ok and not fired then pow(0.5, missing) else 1.0::double end as weight from s""")
def b9_assembled_labels(spark, sf_dir):
    pr = pull_requests(spark, sf_dir)
    sources = [(F.col("label_bad"), F.col("label_bad_observed")), (F.col("la") % 11 == 0, F.col("ld") % 3 > 0)]
    usable = (F.col("y") != "nowhere") & (1_000_000_000 - F.coalesce("t_close", "t_open") >= 60 * DAY)
    made = {how: lifecycle.assembled_label(sources, usable, how) for how in ("mask", "negative", "downweight")}
    return pr.select("pr_number", made["mask"][0].alias("masked"), made["negative"][0].alias("negative"), made["downweight"][1].alias("weight"))


@query("select conv_id, turn from conversations where regexp_matches(text, '(?i)[aeiou]{3}') order by conv_id, turn limit 300")
def b20_log_search(spark, sf_dir):
    """At most 300 hits, the first in order; a pattern with a nested quantifier is refused."""
    return catalog.search(table(spark, sf_dir, "conversations"), "text", "(?i)[aeiou]{3}", ["conv_id", "turn"], 300).select("conv_id", "turn")


@query(f"""with {PR_SQL}, {FILES_SQL}, f as (select path_id, pr.pr_number, t_open, t_close, priority = '1-URGENT' as is_fix, lag(pr.pr_number) over w as blamed, lag(t_close) over w as landed from fc join pr using (pr_number) window w as (partition by path_id order by t_open, pr.pr_number))
select blamed as pr_number, min(t_open - landed) as delay from f where is_fix and blamed is not null and t_open > landed and t_open <= landed + 90 * 86400 group by 1""")
def c17_lineage_delay(spark, sf_dir):
    """A fix blames the pull request that changed the file last before it; the earliest fix within 90 days of its landing counts."""
    w = Window.partitionBy("path_id").orderBy("t_open", "pr_number")
    f = file_changes(spark, sf_dir).join(pull_requests(spark, sf_dir).select("pr_number", "t_open", "t_close", "priority"), "pr_number")
    blamed = f.withColumns({"blamed": F.lag("pr_number").over(w), "landed": F.lag("t_close").over(w)}).where("priority = '1-URGENT' and t_open > landed")
    return blamed.where(F.col("t_open") <= F.col("landed") + 90 * DAY).groupBy(F.col("blamed").alias("pr_number")).agg(F.min(F.col("t_open") - F.col("landed")).alias("delay"))


@query(f"""with {PR_SQL}, {FILES_SQL}, a as (select p_partkey as path_id, case when p_partkey % 13 > 0 then 788918400 + (p_size * 4000000) % 200000000 end as published, case when p_partkey % 5 = 0 then 946684800 end as withdrawn from part where p_size % 3 = 0)
select pr_number, case when not bool_or(a.path_id is not null and published is null) then count(*) filter (where published <= t_open and (withdrawn is null or withdrawn > t_open)) end as n_advisories from pr join fc using (pr_number) left join a using (path_id) group by 1""")
def c24_advisories(spark, sf_dir):
    """Advisories of the changed parts that were published by the opening and not withdrawn; null if one has no date."""
    k = F.col("p_partkey")
    a = table(spark, sf_dir, "part").where("p_size % 3 = 0").select(k.alias("path_id"), F.when(k % 13 > 0, 788_918_400 + (F.col("p_size").cast("long") * 4_000_000) % 200_000_000).alias("published"), F.when(k % 5 == 0, 946_684_800).alias("withdrawn"), F.lit(True).alias("known"))
    j = pull_requests(spark, sf_dir).join(file_changes(spark, sf_dir), "pr_number").join(a, "path_id", "left")
    active = (F.col("published") <= F.col("t_open")) & (F.col("withdrawn").isNull() | (F.col("withdrawn") > F.col("t_open")))
    undated = F.bool_or(F.coalesce(F.col("known") & F.col("published").isNull(), F.lit(False)))
    return j.groupBy("pr_number").agg(F.when(~undated, F.count_if(active)).alias("n_advisories"))


@query("""select n_name as unit, coalesce(s.n, 0) as n_done, case when s.n is null then 'pending' else 'uploaded' end as state from nation left join (select s_nationkey, count(*) as n from supplier where s_acctbal > 0 group by 1) s on s_nationkey = n_nationkey""")
def c26_planned_units(spark, sf_dir):
    done = table(spark, sf_dir, "supplier").where("s_acctbal > 0").groupBy("s_nationkey").agg(F.count("*").alias("n"))
    n = table(spark, sf_dir, "nation").join(done, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return n.select(F.col("n_name").alias("unit"), F.coalesce("n", F.lit(0)).alias("n_done"), F.when(F.col("n").isNull(), "pending").otherwise("uploaded").alias("state"))


@query(f"""with {PR_SQL}, c as (select l_orderkey as pr_number, cast(floor(epoch(l_shipdate)) as bigint) as at, l_partkey as head, l_linenumber as k from lineitem)
select pr.pr_number, max({{'at': c.at, 'k': c.k, 'head': c.head}}) filter (where c.at <= t_open + 300).head as head, case when bool_or(c.at <= t_open + 300 and c.at >= t_open - 86400) then 'exact' when bool_or(c.at <= t_open + 300) then 'recovered' else 'approx' end as kind from pr left join c using (pr_number) group by 1""")
def c28_head_at_open(spark, sf_dir):
    """The newest commit up to 300 seconds after the opening: exact if at most a day old, recovered if older, approx without one."""
    at = F.unix_seconds(F.col("l_shipdate").cast("timestamp"))
    c = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pr_number"), at.alias("at"), F.col("l_partkey").alias("head"), F.col("l_linenumber").alias("k"))
    j = pull_requests(spark, sf_dir).select("pr_number", "t_open").join(c, "pr_number", "left")
    early = F.coalesce(F.col("at") <= F.col("t_open") + 300, F.lit(False))
    kind = F.when(F.bool_or(early & (F.col("at") >= F.col("t_open") - DAY)), "exact").when(F.bool_or(early), "recovered").otherwise("approx")
    return j.groupBy("pr_number").agg(F.max(F.when(early, F.struct("at", "k", "head")))["head"].alias("head"), kind.alias("kind"))


@query(f"""with {FILES_SQL}, d as (select coalesce(h.pr_number - 1, b.pr_number) as pr_number, coalesce(h.added, 0) - coalesce(b.added, 0) as delta, h.added from fc b full join fc h on h.pr_number = b.pr_number + 1 and h.path_id = b.path_id)
select pr_number, cast(sum(delta) as bigint) as total_delta, max(case when delta <> 0 then coalesce(added, 0) end) as max_changed, count(*) filter (where delta <> 0) as n_changed from d group by 1""")
def c29_complexity_delta(spark, sf_dir):
    """Per function (here: file) head against base: absent at base counts 0, deleted ones count."""
    base = file_changes(spark, sf_dir).select("pr_number", "path_id", F.col("added").alias("was"))
    head = file_changes(spark, sf_dir).select((F.col("pr_number") - 1).alias("pr_number"), "path_id", F.col("added").alias("now"))
    d = F.coalesce("now", F.lit(0)) - F.coalesce("was", F.lit(0))
    j = base.join(head, ["pr_number", "path_id"], "full_outer").withColumn("d", d)
    return j.groupBy("pr_number").agg(F.sum("d").alias("total_delta"), F.max(F.when(F.col("d") != 0, F.coalesce("now", F.lit(0)))).alias("max_changed"), F.count_if(F.col("d") != 0).alias("n_changed"))


@query(f"""with {PR_SQL}, {FILES_SQL}, h as (select distinct path_id from fc join pr using (pr_number) where t_open < 880000000) select repo, count(distinct pr_number) as n_rows, round(count(distinct pr_number) filter (where h.path_id is not null and added > 25) / nullif(count(distinct pr_number) filter (where h.path_id is not null), 0)::double, 6) as blame_share, count(distinct open_snapshot) as n_versions
  from pr join fc using (pr_number) left join h using (path_id) group by 1""")
def d9_audit_coverage(spark, sf_dir):
    """Of the rows with history, the share with any blamed value, and how many versions a repository's rows carry."""
    pr, fc = pull_requests(spark, sf_dir), file_changes(spark, sf_dir)
    old = fc.join(pr.where("t_open < 880000000").select("pr_number"), "pr_number", "left_semi").select("path_id").distinct().withColumn("old", F.lit(True))
    per = pr.join(fc, "pr_number").join(old, "path_id", "left").groupBy("repo", "pr_number").agg(F.coalesce(F.bool_or("old"), F.lit(False)).alias("has"), F.coalesce(F.bool_or(F.col("old") & (F.col("added") > 25)), F.lit(False)).alias("blamed"), F.first("open_snapshot").alias("v"))
    return per.groupBy("repo").agg(F.count("*").alias("n_rows"), F.round(F.count_if("blamed") / F.nullif(F.count_if("has"), F.lit(0)), 6).alias("blame_share"), F.countDistinct("v").alias("n_versions"))


@query(f"""with {TIMELINE_SQL}, l as (select pr, max(t) as last, arg_max(kind, t) as kind from tl group by 1) select c_custkey as unit, case when c_custkey % 11 = 0 then 'expired' when last is null then 'never' when kind = 'purchase' then 'done' when kind = 'error' then 'stopped' when 1706500000 - last < 86400 then 'mining' else 'silent' end as state
  from customer left join l on l.pr = c_custkey""")
def d25_unit_states(spark, sf_dir):
    last = timeline(spark, sf_dir).groupBy("pr").agg(F.max("t").alias("last"), F.max_by("kind", "t").alias("kind"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("unit")).join(last, F.col("pr") == F.col("unit"), "left")
    from ..operators.decisions import first_true

    rules = {"expired": F.col("unit") % 11 == 0, "never": F.col("last").isNull(), "done": F.col("kind") == "purchase", "stopped": F.col("kind") == "error", "mining": F.lit(1_706_500_000) - F.col("last") < DAY}
    return c.select("unit", first_true(rules, "silent").alias("state"))


@query(f"""with {TIMELINE_SQL}, u as (select pr % 25 as unit, pr, count(*) filter (where kind = 'purchase') as kept, count(*) as seen from tl group by 1, 2), m as (select median(kept / seen::double) as share from u where seen >= 5)
select unit, sum(kept)::bigint as kept, sum(seen)::bigint as seen, cast(round(sum(seen) * any_value(share)) as bigint) as expected from u, m group by 1""")
def d26_progress(spark, sf_dir):
    """What is kept by unit, and what to expect of what was seen at the median kept share."""
    u = timeline(spark, sf_dir).groupBy((F.col("pr") % 25).alias("unit"), "pr").agg(F.count_if(F.col("kind") == "purchase").alias("kept"), F.count("*").alias("seen"))
    m = F.broadcast(u.where("seen >= 5").agg(F.median(F.col("kept") / F.col("seen")).alias("share")))  # one row
    return u.groupBy("unit").agg(F.sum("kept").alias("kept"), F.sum("seen").alias("seen")).crossJoin(m).select("unit", "kept", "seen", F.round(F.col("seen") * F.col("share")).cast("long").alias("expected"))


@query(f"""with {PR_SQL}, {FILES_SQL}, f as (select fc.pr_number, path_id, t_open, author_key, y, lag(t_open) over w as was, lag(author_key) over w as who, lag(y) over w as how from fc join pr using (pr_number) window w as (partition by path_id order by t_open, pr.pr_number))
select pr_number, min(t_open - was) as youngest, median(t_open - was) as median_age, count(distinct who) as n_authors, round(avg((who = author_key)::int), 6) as self_share, round(avg((how = 'rework')::int), 6) as prior_fix_share from f where was is not null group by 1""")
def d31_line_history(spark, sf_dir):
    """Ages, authors and fixes of what a pull request changes, by the change before of each of its files."""
    w = Window.partitionBy("path_id").orderBy("t_open", "pr_number")
    f = file_changes(spark, sf_dir).join(pull_requests(spark, sf_dir).select("pr_number", "t_open", "author_key", "y"), "pr_number")
    f = f.withColumns({"was": F.lag("t_open").over(w), "who": F.lag("author_key").over(w), "how": F.lag("y").over(w)}).where("was is not null")
    age = F.col("t_open") - F.col("was")
    return f.groupBy("pr_number").agg(F.min(age).alias("youngest"), F.median(age).alias("median_age"), F.countDistinct("who").alias("n_authors"), F.round(F.avg((F.col("who") == F.col("author_key")).cast("int")), 6).alias("self_share"), F.round(F.avg((F.col("how") == "rework").cast("int")), 6).alias("prior_fix_share"))


@query(r"""select page_id, len(regexp_extract_all(html, '(?i)(api[_-]?key|secret|token)\s*[:=]')) as n_secrets, len(regexp_extract_all(html, '(?i)(console\.log|print\()')) as n_prints, len(regexp_extract_all(html, '[=!]==?')) as n_compares, len(regexp_extract_all(html, '(?m)^\s*(import|from)\s')) as n_imports, regexp_matches(html, '(?i)drop\s+table') as is_destructive from pages""")
def d33_lint_counters(spark, sf_dir):
    rules = {"n_secrets": r"(?i)(api[_-]?key|secret|token)\s*[:=]", "n_prints": r"(?i)(console\.log|print\()", "n_compares": "[=!]==?", "n_imports": r"(?m)^\s*(import|from)\s"}
    return table(spark, sf_dir, "pages").select("page_id", *[F.regexp_count("html", F.lit(r)).cast("long").alias(n) for n, r in rules.items()], F.col("html").rlike(r"(?i)drop\s+table").alias("is_destructive"))


@query(f"""with {PR_SQL}, {FILES_SQL}, n as (select name, count(*) filter (where v is null) / count(*)::double as share from (select 'author_key' as name, author_key::varchar as v from pr union all select 't_close', t_close::varchar from pr union all select 'label_bad', label_bad::varchar from pr) group by 1)
select 'null share' as chart, name as x, round(share * 100, 4) as y from n union all select 'repository', * from (select repo, count(*)::double as n from pr group by 1 order by n desc, repo limit 15)
union all select 'month', strftime(to_timestamp(t_open), '%Y-%m'), count(*)::double from pr group by 2 union all select 'label', coalesce(label_bad::varchar, 'null'), count(*)::double from pr group by 2""")
def d4_default_charts(spark, sf_dir):
    pr = pull_requests(spark, sf_dir)
    shares = pr.agg(F.array(*[F.struct(F.lit(c).alias("x"), F.round(F.count_if(F.col(c).isNull()) / F.count("*") * 100, 4).alias("y")) for c in ("author_key", "t_close", "label_bad")]).alias("a")).select(F.explode("a").alias("r")).select(F.lit("null share").alias("chart"), "r.x", "r.y")
    top = pr.groupBy("repo").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "repo").limit(15).select(F.lit("repository").alias("chart"), F.col("repo").alias("x"), F.col("n").cast("double").alias("y"))
    month = pr.groupBy(F.date_format(F.timestamp_seconds("t_open"), "yyyy-MM").alias("x")).agg(F.count("*").cast("double").alias("y")).select(F.lit("month").alias("chart"), "x", "y")
    label = pr.groupBy(F.coalesce(F.col("label_bad").cast("string"), F.lit("null")).alias("x")).agg(F.count("*").cast("double").alias("y")).select(F.lit("label").alias("chart"), "x", "y")
    return shares.unionByName(top).unionByName(month).unionByName(label)


@query(f"""with {PR_SQL}, u as (select repo, count(*) as n from pr group by 1), r as (select repo, row_number() over (order by n desc, repo) - 1 as i from u)
select repo, cast(case when (i // 4) % 2 = 1 then 3 - i % 4 else i % 4 end as integer) as shard from r""")
def f6_balanced_shards(spark, sf_dir):
    units = pull_requests(spark, sf_dir).groupBy("repo").agg(F.count("*").alias("n"))
    return order_stats.snake_shards(units, "repo", "n", 4)


FOLDS_SQL = f"""{PREDICTION_SQL}, loss as (select repo, y, pow(p0 - (y = 0)::int, 2) + pow(p1 - (y = 1)::int, 2) + pow(p2 - (y = 2)::int, 2) as loss from pred), u as (select repo, count(*) as n from loss group by 1),
o as (select repo, row_number() over (order by n desc, repo) - 1 as i, row_number() over (order by floor(log2(n + 1.0)) desc, ('0x' || substr(sha256('folds:' || repo), 1, 8))::bigint, repo) - 1 as j from u),
f as (select repo, cast(case when (i // 5) % 2 = 1 then 4 - i % 5 else i % 5 end as integer) as fold, cast(case when (j // 5) % 2 = 1 then 4 - j % 5 else j % 5 end as integer) as seeded_fold from o)"""


@query(f"with {FOLDS_SQL} select repo, fold, seeded_fold, n from f join u using (repo)")
def f7_repository_folds(spark, sf_dir):
    """Folds of whole repositories by size, and seeded ones."""
    units = pull_requests(spark, sf_dir).groupBy("repo").agg(F.count("*").alias("n"))
    seeded = order_stats.snake_shards(units, "repo", "n", 5, "seeded_fold", "folds")
    return units.join(order_stats.snake_shards(units, "repo", "n", 5, "fold"), "repo").join(seeded, "repo").select("repo", "fold", "seeded_fold", "n")


@query(f"""with {FOLDS_SQL}, c as (select seeded_fold as fold, y, count(*) as c, sum(loss) as l from loss join f using (repo) group by 1, 2), a as (select y, sum(c) as a from c group by 1),
g as (select k.fold, a.y, coalesce(c.c, 0) as c, coalesce(c.l, 0) as l, a.a - coalesce(c.c, 0) as rest from (select distinct fold from c) k, a left join c on c.fold = k.fold and c.y = a.y),
p as (select *, rest / cast(sum(rest) over (partition by fold) as double) as p, sum(c) over (partition by fold) as n from g), q as (select *, sum(p * p) over (partition by fold) as sq from p),
s as (select fold, cast(any_value(n) as bigint) as n, sum(l) / any_value(n) as brier, sum(c * (sq - 2 * p + 1)) / any_value(n) as base from q group by fold)
select fold, n, round(brier, 9) as brier, round(base, 9) as base_brier, round(1 - brier / base, 9) as skill from s""")
def f13_seeded_fold_scores(spark, sf_dir):
    """Out-of-fold mean loss and skill of seeded folds of whole repositories."""
    p = predictions(spark, sf_dir).withColumn("loss", metrics.brier(F.col("y"), [F.col(f"p{i}") for i in range(3)]))
    folds = order_stats.snake_shards(p.groupBy("repo").agg(F.count("*").alias("n")), "repo", "n", 5, "fold", "folds")
    scores = order_stats.fold_scores(p.select("repo", "y", "loss"), folds, "repo", "loss", "y")
    return scores.select("fold", "n", *[F.round(c, 9).alias(c) for c in ("brier", "base_brier", "skill")])


@query(f"""with {PR_SQL}, r as (select y, pr_number, is_bot, row_number() over (partition by y, is_bot order by sha256(cast(pr_number as varchar))) as r, count(*) filter (where is_bot) over (partition by y) as bots, count(*) filter (where not is_bot) over (partition by y) as others from pr)
select y, pr_number from r where r <= case when is_bot then 200 - least(200 - least(60, bots), others) else least(200 - least(60, bots), others) end""")
def f9_quota_sample(spark, sf_dir):
    return lifecycle.quota_sample(pull_requests(spark, sf_dir), "y", F.col("is_bot"), F.col("pr_number"), 200, 0.3).select("y", "pr_number")


@query("select conv_id, turn from conversations order by conv_id desc, turn desc limit 40")
def f11_tail(spark, sf_dir):
    return table(spark, sf_dir, "conversations").orderBy(F.desc("conv_id"), F.desc("turn")).limit(40).select("conv_id", "turn")


@query("""with m as (select s_suppkey % 6 as shard, 'split' || (s_suppkey % 2) as split, '1.' || (s_suppkey % 1) as version, n_name as repo from supplier join nation on s_nationkey = n_nationkey)
select 'missing shards' as problem where (select count(distinct shard) from m) <> 7 union all select 'mixed splits' where (select count(distinct split) from m) > 1 union all select 'mixed versions' where (select count(distinct version) from m) > 1
union all select 'twice: ' || repo from m group by repo having count(distinct shard) > 1""")
def g1_shard_problems(spark, sf_dir):
    k = F.col("s_suppkey")
    m = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    m = m.groupBy((k % 6).alias("shard"), F.concat(F.lit("split"), k % 2).alias("split"), F.lit("1.0").alias("version")).agg(F.collect_set("n_name").alias("repos"))
    return lifecycle.shard_problems(m, 7)


@query("""with c as (select c_nationkey, s_nationkey from (select distinct c_nationkey from customer where c_acctbal < 0) full join (select distinct s_nationkey from supplier where s_acctbal > 5000) on c_nationkey = s_nationkey)
select coalesce(c_nationkey, s_nationkey) as key, case when s_nationkey is null then 'left' when c_nationkey is null then 'right' else 'both' end as side from c""")
def g2_key_sets(spark, sf_dir):
    """Union, with the side of each key: the intersection is 'both', the differences 'left' and 'right'."""
    a = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_nationkey").alias("key")).distinct()
    b = table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("key")).distinct()
    both, left, right = a.intersect(b), a.subtract(b), b.subtract(a)
    return both.withColumn("side", F.lit("both")).unionByName(left.withColumn("side", F.lit("left"))).unionByName(right.withColumn("side", F.lit("right")))


@query("""with p as (select conv_id, turn, case when turn % 3 = 0 then 'vendor/' else 'src/' end || role || turn as name, '+' || replace(text, ' ', chr(10) || '-') as body from conversations where text is not null),
o as (select conv_id, string_agg('# ' || name || ': +' || len(regexp_extract_all(chr(10) || body, '\\n\\+')) || ' -' || len(regexp_extract_all(chr(10) || body, '\\n-')), chr(10) order by turn) as notes from p where turn % 3 = 0 group by 1)
select distinct p.conv_id, coalesce(notes, '') as notes from p left join o using (conv_id)""")
def h18_slim_notes(spark, sf_dir):
    """Vendored parts as one line each; what the budget keeps and drops is tested against plain Python."""
    p = table(spark, sf_dir, "conversations").where("text is not null").select("conv_id", "turn", F.concat(F.when(F.col("turn") % 3 == 0, "vendor/").otherwise("src/"), "role", "turn").alias("name"), F.concat(F.lit("+"), F.replace("text", F.lit(" "), F.lit("\n-"))).alias("body"))
    return lifecycle.slim(p, "conv_id", "turn", F.col("name"), "body", F.col("name").startswith("vendor/"), 500).select("conv_id", "notes")


@query("""with recursive p as (select conv_id, turn, role || turn as name, case when turn % 3 = 0 then 'vendored file' end as why, case when turn % 4 = 1 then '@@ ' else '+' end || replace(coalesce(text, ''), ' ', chr(10) || '-') as body from conversations),
n as (select conv_id, string_agg('# ' || name || ': ' || why || ', +' || len(regexp_extract_all(chr(10) || body, '\\n\\+')) || ' -' || len(regexp_extract_all(chr(10) || body, '\\n-')) || ' lines (diff omitted)', chr(10) order by turn) || chr(10) || chr(10) as head from p where why is not null group by 1),
k as (select conv_id, row_number() over (partition by conv_id order by turn) as i, name, body from p where why is null),
r as (select c.conv_id, cast(0 as bigint) as i, cast(length(coalesce(head, '')) as bigint) as size, '' as txt, 0 as n_kept, 0 as n_dropped, '' as dropped, false as cut from (select distinct conv_id from p) c left join n on n.conv_id = c.conv_id
  union all select conv_id, i, case when fits then size + length(body) when one then 400 else size end, txt || case when fits then body when one then substr(body, 1, greatest(0, 400 - size)) || chr(10) || '# (file truncated)' || chr(10) else '' end, n_kept + (fits or one)::int,
    n_dropped + (not fits and not one)::int, dropped || case when fits or one then '' else case when n_dropped > 0 then ', ' else '' end || name end, cut or not fits
  from (select r.conv_id, k.i, size, txt, n_kept, n_dropped, dropped, cut, name, body, size + length(body) <= 400 as fits, size + length(body) > 400 and n_kept = 0 and n_dropped = 0 as one from r join k on k.conv_id = r.conv_id and k.i = r.i + 1)),
l as (select conv_id, arg_max({'t': txt, 'n': n_dropped, 'd': dropped, 'c': cut}, i) as s from r group by 1)
select l.conv_id, coalesce(head, '') || s.t || case when s.n > 0 then chr(10) || '# ' || s.n || ' more changed file(s) not shown (size cap): ' || s.d || chr(10) else '' end as slimmed, s.c as is_cut,
  exists (select 1 from p where p.conv_id = l.conv_id and why is null and body like '@@ %') as has_code, s.n as n_dropped from l left join n on n.conv_id = l.conv_id""")
def h18_slimmed_diffs(spark, sf_dir):
    """Conversations as diffs of 400 characters: every third part in one line, the rest as they fit."""
    body = F.concat(F.when(F.col("turn") % 4 == 1, "@@ ").otherwise("+"), F.replace(F.coalesce("text", F.lit("")), F.lit(" "), F.lit("\n-")))
    p = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat("role", "turn").alias("name"), F.when(F.col("turn") % 3 == 0, "vendored file").alias("why"), body.alias("body"))
    return lifecycle.slim_diff(p, "conv_id", "turn", F.col("name"), "body", F.col("why"), 400)


@query(f"""with {PREDICTION_SQL}, b as (select repo, p0, (y = 0)::int as hit, ntile(15) over (partition by repo order by p0, pr_number) as bin from pred), g as (select repo, bin, count(*) as n, avg(p0) as p, avg(hit) as r from b group by 1, 2)
select repo, round(sqrt(greatest(sum(n * (pow(p - r, 2) - r * (1 - r) / (n - 1))) filter (where n > 1) / sum(n), 0)), 7) as debiased_ce from g group by 1""")
def j2_debiased_calibration(spark, sf_dir):
    bins = metrics.calibration(predictions(spark, sf_dir), "p0", F.col("y") == 0, ["p0", "pr_number"], ["repo"])
    return lifecycle.debiased_calibration_error(bins, "repo").withColumn("debiased_ce", F.round("debiased_ce", 7))


@query(f"""with {PREDICTION_SQL}, s as (select repo, p0, sum((y = 0)::int) as p, sum((y <> 0)::int) as n from pred group by 1, 2)
select repo, p0 as threshold, round(sum(p) over w / nullif(sum(p) over (partition by repo), 0)::double, 9) as tpr, round(sum(n) over w / nullif(sum(n) over (partition by repo), 0)::double, 9) as fpr, round(sum(p) over w / (sum(p) over w + sum(n) over w)::double, 9) as precision
  from s window w as (partition by repo order by p0 desc rows unbounded preceding)""")
def j5_curve_points(spark, sf_dir):
    s = predictions(spark, sf_dir).groupBy("repo", "p0").agg(F.count_if(F.col("y") == 0).alias("p"), F.count_if(F.col("y") != 0).alias("n"))
    w, all_ = Window.partitionBy("repo").orderBy(F.desc("p0")).rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("repo")
    p, n = F.sum("p").over(w), F.sum("n").over(w)
    return s.select("repo", F.col("p0").alias("threshold"), F.round(p / F.nullif(F.sum("p").over(all_), F.lit(0)), 9).alias("tpr"), F.round(n / F.nullif(F.sum("n").over(all_), F.lit(0)), 9).alias("fpr"), F.round(p / (p + n), 9).alias("precision"))


@query(f"""with {PREDICTION_SQL}, g as (select y as t, case when p0 >= p1 and p0 >= p2 then 0 when p1 >= p2 then 1 else 2 end as g from pred), k as (select unnest([0, 1, 2]) as k)
select k as class, round((select count(*) from g where t = k and g = k) / nullif((select count(*) from g where g = k), 0)::double, 9) as precision, round((select count(*) from g where t = k and g = k) / nullif((select count(*) from g where t = k), 0)::double, 9) as recall from k""")
def j6_precision_recall(spark, sf_dir):
    guess = F.when((F.col("p0") >= F.col("p1")) & (F.col("p0") >= F.col("p2")), 0).when(F.col("p1") >= F.col("p2"), 1).otherwise(2)
    p = predictions(spark, sf_dir).select("y", guess.alias("g")).groupBy("y", "g").agg(F.count("*").alias("n"))
    sides = p.select(F.explode(F.array(F.struct(F.col("y").alias("k"), F.col("n").alias("t"), F.lit(0).cast("long").alias("g"), F.when(F.col("y") == F.col("g"), F.col("n")).otherwise(0).alias("hit")), F.struct(F.col("g").alias("k"), F.lit(0).cast("long").alias("t"), F.col("n").alias("g"), F.lit(0).cast("long").alias("hit")))).alias("s"))
    return sides.groupBy(F.col("s.k").alias("class")).agg(F.round(F.sum("s.hit") / F.nullif(F.sum("s.g"), F.lit(0)), 9).alias("precision"), F.round(F.sum("s.hit") / F.nullif(F.sum("s.t"), F.lit(0)), 9).alias("recall"))


@query(f"""with {PREDICTION_SQL}, r as (select repo, (y = 0)::int as g, row_number() over (partition by repo order by p0 desc, pr_number) as r from pred)
select repo, round(sum(g) filter (where r <= 10) / least(count(*), 10)::double, 9) as hit_rate, round(sum(g) filter (where r <= 10) / nullif(sum(g), 0)::double, 9) as recall from r group by 1""")
def j7_list_scores(spark, sf_dir):
    got = lifecycle.list_scores(predictions(spark, sf_dir), "repo", F.col("y") == 0, [F.desc("p0"), F.col("pr_number")], 10)
    return got.select("repo", F.round("hit_rate", 9).alias("hit_rate"), F.round("recall", 9).alias("recall"))


@query(f"""with {PREDICTION_SQL}, e as (select repo, la::double as e, (y = 0)::int::double as h, p0, pr_number from pred), t as (select repo, sum(e) as te, sum(h) as th, count(*) as n from e group by 1),
r as (select e.repo, e.e / te as w, h, te, th, n, sum(h) over (partition by e.repo order by p0 desc, pr_number rows unbounded preceding) as m, sum(h) over (partition by e.repo order by h desc, e.e, p0 desc, pr_number rows unbounded preceding) as o, sum(h) over (partition by e.repo order by h, e.e desc, p0 desc, pr_number rows unbounded preceding) as l from e join t on e.repo = t.repo),
a as (select repo, sum(w * (2 * m - h) / th / 2) as m, sum(w * (2 * o - h) / th / 2) as o, sum(w * (2 * l - h) / th / 2) as l from r where th > 0 and th < n group by 1) select t.repo, case when o > l then round(1 - (o - m) / (o - l), 8) end as effort_score from t left join a on t.repo = a.repo""")
def j8_effort_area(spark, sf_dir):
    got = lifecycle.effort_area(predictions(spark, sf_dir), "repo", [F.desc("p0"), F.col("pr_number")], "la", F.col("y") == 0)
    return got.withColumn("effort_score", F.round("effort_score", 8))


@query(f"""with {PREDICTION_SQL}, j as (select pred.*, pr.label_bad, pr.label_bad_observed from pred join pr using (pr_number)), o as (select * from j where label_bad or (not label_bad and label_bad_observed)), b as (select avg(label_bad::int) as m from o)
select repo, count(*) as n, round(avg(pow(p2 - label_bad::int, 2)), 9) as brier, round(1 - avg(pow(p2 - label_bad::int, 2)) / avg(pow(m - label_bad::int, 2)), 8) as skill from o, b group by 1""")
def j13_secondary_labels(spark, sf_dir):
    """A further label scored where its window rule observes it, with skill against its overall rate."""
    from ..operators.profile import observed_rows

    j = predictions(spark, sf_dir).join(pull_requests(spark, sf_dir).select("pr_number", "label_bad", "label_bad_observed"), "pr_number")
    o = j.where(observed_rows(F.col("label_bad"), F.col("label_bad_observed"), "window")).withColumn("h", F.col("label_bad").cast("double"))
    base = F.broadcast(o.agg(F.avg("h").alias("m")))  # one row
    own, ref = (F.avg(F.pow(F.col(c) - F.col("h"), F.lit(2))) for c in ("p2", "m"))
    return o.crossJoin(base).groupBy("repo").agg(F.count("*").alias("n"), F.round(own, 9).alias("brier"), F.round(1 - own / ref, 8).alias("skill"))


@query(f"""with {PREDICTION_SQL}, s as (select repo, pr_number, unnest([0, 1, 2]) as seed, unnest([[p0, p1, p2], [p1, p2, p0], [p0, p2, p1]]) as p from pred), g as (select *, case when p[1] >= p[2] and p[1] >= p[3] then 0 when p[2] >= p[3] then 1 else 2 end as top, row_number() over (partition by repo, seed order by p[1] desc, pr_number) as r from s),
c as (select avg((a.top <> b.top)::int) as change from g a join g b on a.pr_number = b.pr_number and a.seed < b.seed), t as (select a.repo, a.seed as x, b.seed as y, count(*) filter (where a.pr_number = b.pr_number) as k from g a join g b on a.repo = b.repo and a.seed < b.seed and a.r <= 10 and b.r <= 10 group by 1, 2, 3)
select (select round(change, 9) from c) as top_guess_changes, round(avg(k / (20.0::double - k)), 9) as list_overlap from t""")
def j19_seed_stability(spark, sf_dir):
    """How often top guesses change between seeds, and the mean Jaccard of the repositories' lists of ten."""
    p = predictions(spark, sf_dir)
    order = [["p0", "p1", "p2"], ["p1", "p2", "p0"], ["p0", "p2", "p1"]]
    s = p.select("repo", "pr_number", F.explode(F.array(*[F.struct(F.lit(i).alias("seed"), F.array(*o).alias("p")) for i, o in enumerate(order)])).alias("s")).select("repo", "pr_number", "s.*")
    x = [F.get("p", F.lit(i)) for i in range(3)]
    top = F.when((x[0] >= x[1]) & (x[0] >= x[2]), 0).when(x[1] >= x[2], 1).otherwise(2)
    tops = s.groupBy("pr_number").agg(F.array_sort(F.collect_list(F.struct("seed", top.alias("top")))).alias("t"))  # one a seed
    differ = sum(((F.get("t", F.lit(i))["top"] != F.get("t", F.lit(j))["top"]).cast("int") for i, j in ((0, 1), (0, 2), (1, 2))), F.lit(0)) / 3
    ten = s.withColumn("r", F.row_number().over(Window.partitionBy("repo", "seed").orderBy(F.desc(x[0]), "pr_number"))).where("r <= 10").groupBy("repo").agg(*[F.collect_set(F.when(F.col("seed") == i, F.col("pr_number"))).alias(f"l{i}") for i in range(3)])
    shared = sum((F.size(F.array_intersect(f"l{i}", f"l{j}")) / F.size(F.array_union(f"l{i}", f"l{j}")) for i, j in ((0, 1), (0, 2), (1, 2))), F.lit(0.0)) / 3
    return tops.agg(F.round(F.avg(differ), 9).alias("top_guess_changes")).crossJoin(F.broadcast(ten.agg(F.round(F.avg(shared), 9).alias("list_overlap"))))  # one row each


@query(f"""with {TIMELINE_SQL}, r as (select pr, kind, t, row_number() over (partition by pr, kind order by t) as i from tl), a as (select pr, t, lead(t) over (partition by pr order by t) as nxt from tl where kind = 'view'), m as (select pr, t from tl where kind = 'click')
select pr, kind || '_' || i as trigger, t from r where (kind = 'purchase' and i = 1) or (kind = 'error' and i <= 2) union all select pr, 'no_reply', a.t + 86400 from a where (nxt is null or a.t + 86400 < nxt) and not exists (select 1 from m where m.pr = a.pr and m.t > a.t and m.t <= a.t + 86400)""")
def k2_event_triggers(spark, sf_dir):
    """First approval, first two change requests, and a day after a view without another view or a reply."""
    tl = timeline(spark, sf_dir)
    nth = tl.withColumn("i", F.row_number().over(Window.partitionBy("pr", "kind").orderBy("t"))).where("(kind = 'purchase' and i = 1) or (kind = 'error' and i <= 2)").select("pr", F.concat_ws("_", "kind", "i").alias("trigger"), "t")
    # latest first, so frames grow; another view of the same second is the next one, a click of it is no reply
    w = Window.partitionBy("pr").orderBy(F.desc("t"))
    frames = {"view": w.rowsBetween(Window.unboundedPreceding, -1), "click": w.rangeBetween(Window.unboundedPreceding, -1)}
    after = {k: F.min(F.when(F.col("kind") == k, F.col("t"))).over(f) for k, f in frames.items()}
    a = tl.withColumns({f"next_{k}": c for k, c in after.items()}).where("kind = 'view'")
    quiet = a.where("(next_view is null or t + 86400 < next_view) and (next_click is null or next_click > t + 86400)")
    return nth.unionByName(quiet.select("pr", F.lit("no_reply").alias("trigger"), (F.col("t") + DAY).alias("t")))


@query("")
def k4_changed_moments(spark, sf_dir):
    tl = timeline(spark, sf_dir).withColumn("state", F.floor(F.col("amount") / 40))
    priority = F.when(F.col("kind") == "purchase", 0).when(F.col("kind") == "error", 1).otherwise(2)
    return lifecycle.changed_moments(tl.select("pr", "t", "kind", "state"), "pr", "t", ["state"], F.col("kind") == "view", priority)


@query(f"with {TIMELINE_SQL} select pr, kind, t from tl where t >= 1706600000 - 21 * 86400")
def k17_retention(spark, sf_dir):
    return timeline(spark, sf_dir).select("pr", "kind", "t").where(F.col("t") >= 1_706_600_000 - 21 * DAY)


@query(f"""with {PR_SQL}, c as (select pr_number, ld as seq, case ld % 3 when 0 then 'a' when 1 then 'b' end as stamp from pr), w as (select pr_number from pr where la % 2 = 0) select w.pr_number, c.stamp is null or c.stamp = 'a' as is_kept from w left join c using (pr_number)""")
def m2_resume(spark, sf_dir):
    pr = pull_requests(spark, sf_dir)
    old = pr.select("pr_number", (F.col("ld") - 1000).alias("seq"), F.lit("z").alias("stamp"))
    now = pr.select("pr_number", F.col("ld").alias("seq"), F.when(F.col("ld") % 3 == 0, "a").when(F.col("ld") % 3 == 1, "b").alias("stamp"))
    marks = lifecycle.resume_marks(old.unionByName(now), pr.where("la % 2 = 0").select("pr_number"), ["pr_number"], "seq", "stamp", "a")
    return marks.select("pr_number", "is_kept")


@query("""select 'customer' as "table", 'c_note' as "column", 'empty' as problem where (select count(*) from customer) > 0 union all select 'customer', 'c_extra', 'missing' union all select 'customer', 'c_name', 'type'
union all select 'customer', 'c_nationkey', 'unexpected' union all select 'customer', null, 'unlisted' union all select 'orders', null, 'rows' where (select count(*) from orders) <> (select count(distinct l_orderkey) from lineitem)""")
def m4_publish_problems(spark, sf_dir):
    """Tables against a contract and a manifest; the manifest's count of orders is that of the orders that have lines."""
    customer = table(spark, sf_dir, "customer").withColumn("c_note", F.lit(None).cast("string"))
    tables = {"customer": customer, "orders": table(spark, sf_dir, "orders"), "nation": table(spark, sf_dir, "nation")}
    want = [(t, f.name, "bigint" if f.name == "c_name" else f.dataType.simpleString()) for t, df in tables.items() for f in df.schema if f.name != "c_nationkey"]
    contract = spark.createDataFrame([*want, ("customer", "c_extra", "string")], "table string, column string, type string")
    lines = table(spark, sf_dir, "lineitem").agg(F.countDistinct("l_orderkey").alias("n_rows")).select(F.lit("orders").alias("table"), "n_rows")
    manifest = lines.unionByName(tables["nation"].agg(F.max("n_nationkey").cast("long").alias("n_rows")).select(F.lit("nation").alias("table"), (F.col("n_rows") + 1).alias("n_rows")))
    return lifecycle.publish_problems(tables, contract, manifest)
