"""Queries of author, repository and path history, column for column, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import history, outcomes, pit
from ..operators.components import cut_lineage
from ..sources.entities import DAY, FILES_SQL, PR_SQL, file_changes, pull_requests, table

QUERIES, ORACLE_SQL = {}, {}
CLASSES = outcomes.CLASSES


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _rounded(df, digits: int = 8, *exact: str):
    kinds = dict(df.dtypes)
    return df.select(*[F.round(c, digits).alias(c) if kinds[c] == "double" and c not in exact else F.col(c) for c in df.columns])


def _base(spark, sf_dir):
    return outcomes.with_repository_prior(pull_requests(spark, sf_dir))


PRIOR_SQL = f"""{PR_SQL}, c365 as (select p.pr_number, count(q.pr_number) as n, {", ".join(f"count(*) filter (where q.y = '{c}') as {c}" for c in CLASSES)}
  from pr p left join pr q on p.repo = q.repo and q.t_close < p.t_open and q.t_close >= p.t_open - 365 * 86400 group by 1),
prior as (select pr_number, {", ".join(f"({c} + 1.0::double) / (n + 3) as prior_{c}" for c in CLASSES)} from c365)"""
AUTHOR_SQL = f"""{PRIOR_SQL}, ac as (select p.pr_number, count(q.pr_number) as n, {", ".join(f"count(*) filter (where q.y = '{c}') as {c}" for c in CLASSES)}
  from pr p left join pr q on p.repo = q.repo and p.author_key = q.author_key and q.t_close < p.t_open group by 1),
ao as (select p.pr_number, count(q.pr_number) as opened, count(q.pr_number) filter (where q.t_close is null or q.t_close >= p.t_open) as open_now, max(q.t_open) as last, min(q.t_open) as first
  from pr p left join pr q on p.repo = q.repo and p.author_key = q.author_key and q.t_open < p.t_open group by 1)"""


@query(f"""with {AUTHOR_SQL} select pr_number, case when author_key is not null then n::double end as ah_n, case when author_key is not null then (clean + rework)::double end as ah_merged, case when author_key is not null then nowhere::double end as ah_nowhere,
  {", ".join(f"case when author_key is not null then round(({c} + 3 * prior_{c}) / (n + 3), 8) end as ah_{c}_rate" for c in CLASSES)}, case when author_key is not null then open_now::double end as ah_open_now,
  case when author_key is not null then (n = 0 and opened = 0)::int::double end as ah_first_pr, round((t_open - last) / 86400.0::double, 8) as ah_days_since_prev_pr, round((t_open - first) / 86400.0::double, 8) as ah_tenure_days
  from pr join prior using (pr_number) join ac using (pr_number) join ao using (pr_number)""")
def e6_author_history(spark, sf_dir):
    got = outcomes.author_history(_base(spark, sf_dir), pull_requests(spark, sf_dir))
    return _rounded(got.select("pr_number", *[c for c in got.columns if c.startswith("ah_")]))


@query(f"""with {AUTHOR_SQL}, e as (select pr.*, not pr.is_bot as is_outside, ac.n as an from pr join ac using (pr_number)),
r as (select p.pr_number, count(q.pr_number) filter (where q.t_close >= p.t_open - 90 * 86400) as rn, {", ".join(f"count(*) filter (where q.y = '{c}' and q.t_close >= p.t_open - 90 * 86400) as r_{c}" for c in CLASSES)},
  sum(ln(1 + (q.t_close - q.t_open) / 3600.0::double)) filter (where q.t_close >= p.t_open - 90 * 86400) as hours,
  {", ".join(f"count(q.pr_number) filter (where {m} and q.t_close >= p.t_open - 180 * 86400) as {n}_n, " + ", ".join(f"count(*) filter (where {m} and q.y = '{c}' and q.t_close >= p.t_open - 180 * 86400) as {n}_{c}" for c in ("clean", "nowhere")) for n, m in (("ft", "q.is_outside and q.an = 0"), ("out", "q.is_outside")))}
  from e p left join e q on p.repo = q.repo and q.t_close < p.t_open group by 1),
o as (select p.pr_number, count(q.pr_number) filter (where q.t_close is null or q.t_close >= p.t_open) as open_now, count(q.pr_number) filter (where q.t_open >= p.t_open - 30 * 86400) as opened from pr p left join pr q on p.repo = q.repo and q.t_open < p.t_open group by 1),
b as (select r.*, {", ".join(f"case when rn >= 5 then r_{c} / rn::double else prior_{c} end as base_{c}" for c in CLASSES)} from r join prior using (pr_number))
select pr_number, rn::double as rh90_n, {", ".join(f"case when rn >= 5 then round(r_{c} / rn::double, 8) end as rh90_{c}_rate" for c in CLASSES)}, open_now::double as rh_open_now, opened::double as rh30_opened, case when rn >= 5 then round(hours / rn, 8) end as rh90_mean_log_hours_to_close,
  {", ".join(f"{n}_n::double as rh180_{n}_n, " + ", ".join(f"round(({n}_{c} + 5 * base_{c}) / ({n}_n + 5), 8) as rh180_{n}_{c}_rate" for c in ("clean", "nowhere")) for n in ("ft", "out"))} from b join o using (pr_number)""")
def e7_repository_history(spark, sf_dir):
    pr = pull_requests(spark, sf_dir).select("repo", "author_key", "pr_number", "t_open", "t_close", "y", (~F.col("is_bot")).alias("is_outside"))
    known = pit.prior(pr, ["repo", "author_key"], "t_open", "t_close", {"ah_n": (F.lit(1), None)}, events=pr)
    got = outcomes.repository_history(cut_lineage(known.drop("author_key")))  # read three times
    return _rounded(got.select("pr_number", *[c for c in got.columns if c.startswith("rh")]))


LAST_SQL = """r as (select p.pr_number, q.y, q.t_close - q.t_open as d, row_number() over (partition by p.pr_number order by q.t_close desc, q.pr_number desc) as i from pr p join pr q on p.repo = q.repo and q.t_close < p.t_open)"""


@query(f"""with {PR_SQL}, {LAST_SQL}, latest as (select max(t_close) as m from pr), k as (select pr.pr_number, {", ".join(f"count(*) filter (where i <= {k}) as n{k}, " + ", ".join(f"count(*) filter (where i <= {k} and r.y = '{c}') as {c}{k}" for c in CLASSES) for k in (10, 50, 200))}, count(i) as n
  from pr left join r using (pr_number) group by 1), w as (select p.pr_number, coalesce(sum(exp((q.t_close - p.t_open) / (60 * 86400 / ln(2.0::double)))), 0) as w, coalesce(sum(exp((q.t_close - p.t_open) / (60 * 86400 / ln(2.0::double)))) filter (where q.y = 'nowhere'), 0) as h
  from pr p left join pr q on p.repo = q.repo and q.t_close < p.t_open group by 1), m as (select pr_number, median(d) / 86400.0::double as days from r where i <= 50 group by 1),
o as (select p.pr_number, count(q.pr_number) filter (where q.t_close is null or q.t_close >= p.t_open) as open_now, count(q.pr_number) filter (where q.t_open >= p.t_open - 30 * 86400) as opened from pr p left join pr q on p.repo = q.repo and q.t_open < p.t_open group by 1)
select pr_number, round(ln(1 + n::double), 8) as closed_before, {", ".join(f"round(({c}{k} + 5 / 3.0::double) / (n{k} + 5), 8) as {c}_rate_{k}" for k in (10, 50, 200) for c in CLASSES)}, round((h + 5 / 3.0::double) / (w + 5), 6) as nowhere_recent,
  round((nowhere10 + 5 / 3.0::double) / (n10 + 5) - (nowhere200 + 5 / 3.0::double) / (n200 + 5), 8) as nowhere_trend, case when days is not null then round(ln(1 + greatest(days, 0)), 8) end as days_to_close, round(ln(1 + open_now::double), 8) as open_now, round(ln(1 + opened::double), 8) as opened_30d
  from k join w using (pr_number) join o using (pr_number) left join m using (pr_number)""")
def e9_repository_rolling(spark, sf_dir):
    pr = pull_requests(spark, sf_dir).select("repo", "pr_number", "t_open", "t_close", "y")
    ks, decay = [10, 50, 200], outcomes.Decay.of(pr, 60.0)
    got = history.last_values(pr, "repo", "t_open", "t_close", (F.col("t_close") - F.col("t_open")).cast("double"), F.col("pr_number"), 50, "d")
    got = got.select("repo", "pr_number", "t_open", F.log1p(history.middle(F.col("d")) / DAY).alias("days_to_close"))
    closed = pit.Stream("t_close", outcomes.last_k_sums(ks) | decay.sums(F.col("y") == "nowhere") | {"closed": (F.lit(1), None)})
    opened = pit.Stream("t_open", {"now": (F.lit(1), F.col("t_close")), "opened": (F.lit(1), 30 * DAY)})
    got = pit.priors(got, ["repo"], "t_open", [closed, opened], pit.leaving(pr, ["repo"], "t_close", "pr_number", ks), pit.BUCKET)
    got = outcomes.last_k_rates(got, ks, 5.0)
    made = {"closed_before": F.log1p("closed"), "nowhere_trend": F.col("nowhere_rate_10") - F.col("nowhere_rate_200"), "open_now": F.log1p("now"), "opened_30d": F.log1p("opened"), "nowhere_recent": F.round(decay.rate(5.0), 6)}
    names = ["closed_before", *[f"{c}_rate_{k}" for k in ks for c in CLASSES], "nowhere_trend", "days_to_close", "open_now", "opened_30d", "nowhere_recent"]
    return _rounded(got.withColumns(made).select("pr_number", *names))


@query(f"""with {AUTHOR_SQL} select pr_number, case when author_key is not null then round(ln(1 + opened::double), 8) end as prev_prs, case when author_key is not null then (clean + rework)::double end as prev_merged, case when author_key is not null then nowhere::double end as prev_nowhere,
  case when author_key is not null then round((nowhere + 5 / 3.0::double) / (n + 5), 8) end as nowhere_rate, round(ln(1 + (t_open - last) / 86400.0::double), 8) as days_since_prev, case when author_key is not null then open_now::double end as open_now
  from pr join ac using (pr_number) join ao using (pr_number)""")
def e10_author_rolling(spark, sf_dir):
    plain = pull_requests(spark, sf_dir).select("repo", "author_key", "pr_number", "t_open", "t_close", "y")
    got = outcomes.author_history(outcomes.with_repository_prior(plain), plain)
    return _rounded(got.select("pr_number", F.log1p("a_opened").alias("prev_prs"), F.col("ah_merged").alias("prev_merged"), F.col("ah_nowhere").alias("prev_nowhere"), pit.shrunk(F.col("ah_nowhere"), F.col("ah_n"), F.lit(1 / 3), 5.0).alias("nowhere_rate"), F.log1p("ah_days_since_prev_pr").alias("days_since_prev"), F.col("ah_open_now").alias("open_now")))


@query(f"""with {PR_SQL}, e as (select *, case when y <> 'nowhere' then null when ld % 11 = 0 then 'duplicate' when ld % 7 = 0 then 'unwanted' when la % 5 = 0 then 'ci' when ld % 2 = 0 then 'abandoned' else 'other' end as reason from pr)
select p.pr_number, case when p.author_key is not null then count(*) filter (where q.reason = 'abandoned')::double end as abandoned, case when p.author_key is not null then count(*) filter (where q.reason in ('duplicate', 'unwanted', 'ci'))::double end as rejected
  from e p left join e q on p.repo = q.repo and p.author_key = q.author_key and q.t_close < p.t_open group by p.pr_number, p.author_key""")
def e11_author_reasons(spark, sf_dir):
    reason = F.when(F.col("ld") % 11 == 0, "duplicate").when(F.col("ld") % 7 == 0, "unwanted").when(F.col("la") % 5 == 0, "ci").when(F.col("ld") % 2 == 0, "abandoned").otherwise("other")
    pr = pull_requests(spark, sf_dir).withColumn("reason", F.when(F.col("y") == "nowhere", reason))
    counts = {"abandoned": (F.col("reason") == "abandoned", None), "rejected": (F.col("reason").isin("duplicate", "unwanted", "ci"), None)}
    got = pit.prior(pr, ["repo", "author_key"], "t_open", "t_close", {n: (F.coalesce(c, F.lit(False)).cast("int"), w) for n, (c, w) in counts.items()})
    return got.select("pr_number", "abandoned", "rejected")


@query(f"""with {PRIOR_SQL}, r as (select p.pr_number, q.y, q.t_close, p.t_open, row_number() over (partition by p.pr_number order by q.t_close desc, q.pr_number desc) as i from pr p join pr q on p.repo = q.repo and p.author_key = q.author_key and q.t_close < p.t_open),
a as (select pr.pr_number, max(r.y) filter (where i = 1) as last_outcome, {", ".join(f"count(*) filter (where i <= {k}) as n{k}, " + ", ".join(f"count(*) filter (where i <= {k} and r.y = '{c}') as {c}{k}" for c in ("clean", "nowhere")) for k in (3, 5))},
  {", ".join(f"count(*) filter (where r.t_close >= r.t_open - {d} * 86400) as d{d}, " + ", ".join(f"count(*) filter (where r.t_close >= r.t_open - {d} * 86400 and r.y = '{c}') as {c}_d{d}" for c in ("clean", "nowhere")) for d in (90, 365))} from pr left join r using (pr_number) group by 1),
s as (select p.pr_number, count(q.pr_number) as n, avg(ln(1 + q.la + q.ld)) as m, avg(pow(ln(1 + q.la + q.ld), 2)) as m2 from pr p left join pr q on p.repo = q.repo and q.y <> 'nowhere' and q.t_close < p.t_open and q.t_close >= p.t_open - 90 * 86400 group by 1),
x as (select p.pr_number, count(q.pr_number) as n, count(*) filter (where q.y <> 'nowhere') as merged, count(*) filter (where q.repo = p.repo and q.author_key = p.author_key) as here from pr p left join pr q on p.author_key % 97 = q.author_key % 97 and q.t_close < p.t_open group by 1)
select pr_number, case when author_key is not null then last_outcome end as last_outcome, {", ".join(f"case when author_key is not null then round(({c}{k} + 2 * prior_{c}) / (n{k} + 2), 8) end as last{k}_{c}_rate" for k in (3, 5) for c in ("clean", "nowhere"))},
  {", ".join(f"case when author_key is not null then d{d}::double end as n_{d}d, " + ", ".join(f"case when author_key is not null then round(({c}_d{d} + 3 * prior_{c}) / (d{d} + 3), 8) end as {c}_rate_{d}d" for c in ("clean", "nowhere")) for d in (90, 365))},
  case when s.n >= 10 then round((ln(1 + la + ld) - m) / sqrt(greatest(m2 - m * m, 1e-6)), 5) end as size_z, case when author_key is not null then (x.n - x.here)::double end as n_other_repos, case when author_key is not null then round((x.merged + 3 * (prior_clean + prior_rework)) / (x.n + 3), 8) end as cross_merged_rate
  from pr join prior using (pr_number) join a using (pr_number) join s using (pr_number) join x using (pr_number)""")
def e14_recent_author(spark, sf_dir):
    plain, key = pull_requests(spark, sf_dir).select("repo", "author_key", "pr_number", "t_open", "t_close", "y", "la", "ld", (F.col("author_key") % 97).alias("person")), ["repo", "author_key"]
    size, merged = F.log1p(F.col("la") + F.col("ld")), (F.col("y") != "nowhere").cast("int")
    got = outcomes.with_repository_prior(plain, {"s0": (merged, 90 * DAY), "s1": (merged * size, 90 * DAY), "s2": (merged * size * size, 90 * DAY)}).drop("t_close", "y")
    recent = {f"{c}_{d}d": ((F.col("y") == c).cast("int"), d * DAY) for d in (90, 365) for c in CLASSES}
    own = pit.leaving(plain.select(*key, "pr_number", "t_close", "y"), key, "t_close", "pr_number", [1, 3, 5])
    got = pit.prior(got, key, "t_open", "t_close", outcomes.last_k_sums([1, 3, 5]) | recent | {"here": (F.lit(1), None)}, events=own)
    got = outcomes.last_k_rates(got.withColumn("last_outcome", F.coalesce(*[F.when(F.col(f"{c}_1") > 0, c) for c in CLASSES])), [3, 5], 2.0, {c: F.col(f"prior_{c}") for c in CLASSES})
    got = pit.prior(got, ["person"], "t_open", "t_close", {"x": (F.lit(1), None), "x_merged": (merged, None)}, events=plain, bucket=pit.BUCKET)
    made = {"last_outcome": F.col("last_outcome")} | {f"last{k}_{c}_rate": F.col(f"{c}_rate_{k}") for k in (3, 5) for c in ("clean", "nowhere")}
    for d in (90, 365):
        n = F.col(f"clean_{d}d") + F.col(f"rework_{d}d") + F.col(f"nowhere_{d}d")
        made |= {f"n_{d}d": n} | {f"{c}_rate_{d}d": pit.shrunk(F.col(f"{c}_{d}d"), n, F.col(f"prior_{c}"), 3.0) for c in ("clean", "nowhere")}
    mean = F.col("s1") / F.nullif("s0", F.lit(0.0))
    made["size_z"] = F.when(F.col("s0") >= 10, F.round((size - mean) / F.sqrt(F.greatest(F.col("s2") / F.nullif("s0", F.lit(0.0)) - mean * mean, F.lit(1e-6))), 5))
    made["n_other_repos"] = F.col("x") - F.col("here")
    made["cross_merged_rate"] = pit.shrunk(F.col("x_merged"), F.col("x"), F.col("prior_clean") + F.col("prior_rework"), 3.0)
    return _rounded(got.select("pr_number", *[c.alias(n) for n, c in made.items()]))


@query(f"""with {PR_SQL}, {LAST_SQL} select pr.pr_number, coalesce(string_agg(r.y || '+' || r.d // 86400, ',' order by i desc) filter (where i <= 5), '') as last_5 from pr left join r using (pr_number) group by 1""")
def e15_repository_sequence(spark, sf_dir):
    """The repository's last five closed before the opening, oldest first, each with its outcome, known by then, and its days."""
    entry = F.concat("y", F.lit("+"), F.floor((F.col("t_close") - F.col("t_open")) / DAY))
    got = history.last_values(pull_requests(spark, sf_dir), "repo", "t_open", "t_close", entry, F.col("pr_number"), 5, "s")
    return got.select("pr_number", F.array_join("s", ",").alias("last_5"))


SIGNAL_SQL = f"""{PR_SQL}, g as (select *, not is_bot as outsider, case when ld % 6 = 0 then 'agent' || (la % 3) end as agent, y <> 'nowhere' as merged, case when ld % 4 > 0 then (ld % 72) end as hours from pr),
c as (select p.pr_number, count(q.pr_number) filter (where q.outsider) as outs, count(*) filter (where q.outsider and q.merged) as outs_merged, count(q.pr_number) filter (where q.agent = p.agent) as agents, count(*) filter (where q.agent = p.agent and q.merged) as agents_merged,
  count(q.hours) filter (where q.t_open + q.hours * 3600 < p.t_open) as n_replied, median(q.hours) filter (where q.t_open + q.hours * 3600 < p.t_open) as reply_hours
  from g p left join g q on p.repo = q.repo and q.t_close < p.t_open and q.t_close >= p.t_open - 365 * 86400 group by 1), l as (select p.pr_number, count(q.agent) as load from g p left join g q on p.repo = q.repo and q.t_open < p.t_open and q.t_open >= p.t_open - 30 * 86400 group by 1)"""


@query(f"""with {SIGNAL_SQL} select pr_number, outs::double as outside_closed, case when outs >= 5 then round(outs_merged / outs::double, 4) end as outside_merge_rate, case when agent is not null then agents::double end as agent_closed,
  case when agent is not null and agents >= 5 then round(agents_merged / agents::double, 4) end as agent_merge_rate, case when n_replied >= 5 then round(reply_hours, 2) end as reply_hours, load::double as agent_load_30d from g join c using (pr_number) join l using (pr_number)""")
def e16_merge_signals(spark, sf_dir):
    k = F.col("ld")
    g = pull_requests(spark, sf_dir).withColumns({"agent": F.when(k % 6 == 0, F.concat(F.lit("agent"), F.col("la") % 3)), "merged": (F.col("y") != "nowhere").cast("int"), "hours": F.when(k % 4 > 0, k % 72)})
    outsider = (~F.col("is_bot")).cast("int")
    got = pit.prior(g, ["repo"], "t_open", "t_close", {"outs": (outsider, 365 * DAY), "outs_merged": (outsider * F.col("merged"), 365 * DAY)})
    got = pit.prior(got, ["repo", "agent"], "t_open", "t_close", {"agents": (F.lit(1), 365 * DAY), "agents_merged": (F.col("merged"), 365 * DAY)}, events=g)
    got = pit.prior(got, ["repo"], "t_open", "t_open", {"load": (F.col("agent").isNotNull().cast("int"), 30 * DAY)}, events=g)
    # a reply counts from the later of itself and the close, until a year after the close
    seen = g.where("hours is not null and t_close is not null").select("repo", "hours", F.greatest(F.col("t_close"), F.col("t_open") + F.col("hours") * 3600).alias("seen"), (F.col("t_close") + 365 * DAY).alias("until"))
    got = got.join(pit.windowed_median(g, "pr_number", ["repo"], "t_open", seen, "seen", "until", "hours", "reply_hours", "n_replied"), "pr_number", "left")
    made = {"outside_closed": F.col("outs"), "outside_merge_rate": F.when(F.col("outs") >= 5, F.round(F.col("outs_merged") / F.col("outs"), 4)), "agent_closed": F.col("agents"), "agent_merge_rate": F.when(F.col("agents") >= 5, F.round(F.col("agents_merged") / F.col("agents"), 4)),
            "reply_hours": F.when(F.col("n_replied") >= 5, F.round("reply_hours", 2)), "agent_load_30d": F.col("load")}
    return got.select("pr_number", *[c.alias(n) for n, c in made.items()])


TOKEN_SQL = "own as (select distinct pr_number, 't' || (path_id % 300) as token from fc)"


@query(f"""with {PR_SQL}, {FILES_SQL}, {TOKEN_SQL}, sz as (select pr_number, count(*) as n from own group by 1),
m as (select p.pr_number, q.pr_number as o, count(*) as k, any_value(a.n) as n, any_value(b.n) as m, any_value(q.t_open < p.t_open and (q.t_close is null or q.t_close > p.t_open)) as is_open, any_value(coalesce(q.y <> 'nowhere' and q.t_close < p.t_open and q.t_close >= p.t_open - 90 * 86400, false)) as is_recent
  from pr p join own x using (pr_number) join own z on z.token = x.token join pr q on q.pr_number = z.pr_number and q.repo = p.repo and q.pr_number <> p.pr_number join sz a on a.pr_number = p.pr_number join sz b on b.pr_number = q.pr_number
  where (q.t_open < p.t_open and (q.t_close is null or q.t_close > p.t_open)) or (q.y <> 'nowhere' and q.t_close < p.t_open and q.t_close >= p.t_open - 90 * 86400) group by 1, 2),
best as (select pr_number, max(k / (n + m - k)::double) filter (where is_open) as a, max(k / (n + m - k)::double) filter (where is_recent) as b from m group by 1),
seen as (select p.pr_number, count(q.pr_number) as k from pr p left join pr q on p.repo = q.repo and q.y <> 'nowhere' and q.t_close < p.t_open and q.t_close >= p.t_open - 90 * 86400 group by 1)
select pr_number, round(coalesce(a, 0), 4) as max_sim_open, case when k > 0 then round(coalesce(b, 0), 4) end as max_sim_recent from seen left join best using (pr_number)""")
def c10_max_similarity(spark, sf_dir):
    tokens = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pr_number"), F.concat(F.lit("t"), F.col("l_partkey") % 300).alias("token"))
    return _rounded(outcomes.max_similarity(pull_requests(spark, sf_dir), tokens), 4)


@query(f"""with {PR_SQL}, {FILES_SQL}, x as (select distinct p.pr_number, p.t_open, q.pr_number as o, q.t_close, q.la, q.ld from pr p join fc f using (pr_number) join fc g on g.path_id = f.path_id and g.pr_number <> f.pr_number
  join pr q on q.pr_number = g.pr_number and q.repo = p.repo and q.y <> 'nowhere' and q.t_close between p.t_open - 730 * 86400 and p.t_open - 30 * 86400),
m as (select pr_number, unnest([case when la % 3 = 0 then {{'lag': 0.0::double, 'r': 0, 'mode': 'ci_fail'}} end, case when la % 5 = 0 and t_close + (ld % 40) * 86400 <= t_open then {{'lag': (ld % 40)::double, 'r': 1, 'mode': 'revert'}} end, case when la % 2 = 0 and t_close + (ld % 60) * 86400 <= t_open then {{'lag': (ld % 60)::double, 'r': 2, 'mode': 'hotfix'}} end]) as e, o from x),
f as (select pr_number, o, min(e) as e from m where e is not null group by 1, 2)
select pr_number, count(*) as n_bad, round(count(*) filter (where e.mode = 'revert') / count(*)::double, 4) as revert, round(count(*) filter (where e.mode = 'ci_fail') / count(*)::double, 4) as ci_fail, round(count(*) filter (where e.mode = 'hotfix') / count(*)::double, 4) as hotfix, round(median(e.lag), 2) as detection_lag_days from f group by 1 having count(*) >= 3""")
def e17_failure_modes(spark, sf_dir):
    """How merged pull requests on the same files failed, as far as that was seen when this one opened."""
    pairs = outcomes.shared_file_pairs(pull_requests(spark, sf_dir), file_changes(spark, sf_dir), 730 * DAY, 30 * DAY).dropDuplicates(["pr_number", "q_pr_number"])
    la, ld = F.col("q_la"), F.col("q_ld")
    modes = {"ci_fail": (la % 3 == 0, F.lit(0)), "revert": (la % 5 == 0, ld % 40), "hotfix": (la % 2 == 0, ld % 60)}
    found = pairs.withColumn("o", outcomes.outcome_at(modes, F.col("q_t_close"), F.col("t_open"))).where("o is not null")
    shares = [F.round(F.count_if(F.col("o.mode") == m) / F.count("*"), 4).alias(m) for m in ("revert", "ci_fail", "hotfix")]
    return found.groupBy("pr_number").agg(F.count("*").alias("n_bad"), *shares, F.round(F.median("o.lag"), 2).alias("detection_lag_days")).where("n_bad >= 3")


@query(f"""with {PR_SQL}, {FILES_SQL}, m as (select * from pr where y <> 'nowhere' and t_close is not null), v as (select pr_number, t_open + j * 43200 as at, 1 + j % 2 as w from pr, range(0, 6) r(j) where j < ld % 6),
s as (select p.pr_number, q.pr_number as o, coalesce(sum(v.w) filter (where v.at < p.t_open), 0) as score from pr p join m q on p.repo = q.repo and q.t_close < p.t_open and q.t_close >= p.t_open - 365 * 86400 left join v on v.pr_number = q.pr_number group by 1, 2),
r as (select pr_number, count(*) as n, avg(score) as mean from s group by 1), f as (select x.pr_number, x.path_id, avg(s.score) as mean from fc x join s on s.pr_number = x.pr_number join fc y on y.pr_number = s.o and y.path_id = x.path_id group by 1, 2 having count(*) >= 2)
select r.pr_number, round(avg(f.mean) / any_value(r.mean), 4) as scrutiny from r join f on f.pr_number = r.pr_number where r.n >= 2 and r.mean > 0 group by 1""")
def e18_revealed_scrutiny(spark, sf_dir):
    """Review score on the files of a pull request over the repository's: reviews before its opening, of merged ones of the last year."""
    pr, files = pull_requests(spark, sf_dir), file_changes(spark, sf_dir).select("pr_number", "path_id")
    merged = pr.where("y <> 'nowhere' and t_close is not null").select("repo", "pr_number", "t_open", "t_close", "ld")
    reviews = merged.where("ld % 6 > 0").select("repo", "pr_number", "t_close", F.explode(F.transform(F.sequence(F.lit(0), (F.col("ld") % 6 - 1).cast("int")), lambda j: F.struct((F.col("t_open") + j * 43200).alias("at"), (1 + j % 2).alias("w")))).alias("v"))
    # a review counts from the later of itself and the merge until a year after the merge
    events = reviews.select("repo", "pr_number", F.greatest("t_close", "v.at").alias("x"), F.col("v.w").alias("w"), F.lit(0).alias("n"), (F.col("t_close") + 365 * DAY).alias("until"))
    ones = merged.select("repo", "pr_number", F.col("t_close").alias("x"), F.lit(0).alias("w"), F.lit(1).alias("n"), (F.col("t_close") + 365 * DAY).alias("until"))
    both = events.unionByName(ones)
    sums = {"w": (F.col("w"), F.col("until")), "n": (F.col("n"), F.col("until"))}
    whole = pit.prior(pr.select("repo", "pr_number", "t_open"), ["repo"], "t_open", "x", sums, events=both).where("n >= 2 and w > 0").select("pr_number", (F.col("w") / F.col("n")).alias("repo_mean"))
    asked = pr.select("repo", "pr_number", "t_open").join(files, "pr_number")
    own = pit.prior(asked, ["repo", "path_id"], "t_open", "x", sums, events=both.join(files, "pr_number")).where("n >= 2")
    return own.groupBy("pr_number").agg(F.avg(F.col("w") / F.col("n")).alias("file_mean")).join(whole, "pr_number").select("pr_number", F.round(F.col("file_mean") / F.col("repo_mean"), 4).alias("scrutiny"))


@query(f"""with {PR_SQL}, {FILES_SQL}, b as (select max(t_open) as base from pr), c as (select path_id, sum(added + deleted) as churn, min(t_open) as first from fc join pr using (pr_number), b where t_open >= base - 365 * 86400 group by 1)
select path_id, cast(churn as bigint) as churn, cast(churn * p_size as bigint) as score, cast(row_number() over (order by churn * p_size desc, first, path_id) as integer) as rank from c join part on path_id = p_partkey order by rank limit 20""")
def e22_hotspots(spark, sf_dir):
    """Churn of the last 365 days times complexity (the part's size), ties by first appearance."""
    pr = pull_requests(spark, sf_dir)
    base = F.broadcast(pr.agg(F.max("t_open").alias("base")))  # one row
    recent = file_changes(spark, sf_dir).join(pr.select("pr_number", "t_open"), "pr_number").join(base, F.col("t_open") >= F.col("base") - 365 * DAY)
    churn = recent.groupBy("path_id").agg(F.sum(F.col("added") + F.col("deleted")).alias("churn"), F.min("t_open").alias("first"))
    scored = churn.join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("path_id"), "p_size"), "path_id").withColumn("score", (F.col("churn") * F.col("p_size")).cast("long"))
    top = scored.orderBy(F.desc("score"), "first", "path_id").limit(20)
    rank = F.row_number().over(history.Window.orderBy(F.desc("score"), "first", "path_id"))  # of twenty rows
    return top.select("path_id", "churn", "score", rank.alias("rank"))


@query(f"""with {PR_SQL}, {FILES_SQL}, ar as (select distinct pr_number, path_id % 8 as area from fc), h as (select p.pr_number, count(*) as e, sum(1 / ((p.t_open - q.t_open) / (365.25::double * 86400) + 1)) as r from pr p join pr q on p.author_key = q.author_key and q.t_open < p.t_open group by 1),
s as (select a.pr_number, count(*) as s from ar a join pr p on p.pr_number = a.pr_number join pr q on q.author_key = p.author_key and q.t_open < p.t_open join ar b on b.pr_number = q.pr_number and b.area = a.area group by 1)
select pr_number, coalesce(e, 0) as exp, round(coalesce(r, 0), 4) as rexp, coalesce(s, 0) as sexp from pr left join h using (pr_number) left join s using (pr_number)""")
def e23_experience(spark, sf_dir):
    areas = file_changes(spark, sf_dir).select("pr_number", (F.col("path_id") % 8).alias("area"))
    return _rounded(outcomes.experience(pull_requests(spark, sf_dir), areas), 4)


@query(f"""with {PR_SQL}, t as (select author_key, count(*) as n, count(*) filter (where y = 'rework') as k, max(t_open) as last from pr where author_key is not null group by 1), b as (select avg((y = 'rework')::int) as m from pr)
select author_key, round((k + 5 * m) / (n + 5), 4) as rework_rate, cast(floor((1000000000 - last) / 86400.0) as bigint) as days_since from t, b""")
def e23_author_rates(spark, sf_dir):
    """Rework rate shrunk to the repositories' with five of its own, and days since the last change, by author."""
    pr = pull_requests(spark, sf_dir)
    base = F.broadcast(pr.agg(F.avg((F.col("y") == "rework").cast("double")).alias("m")))  # one row
    t = pr.where("author_key is not null").groupBy("author_key").agg(F.count("*").alias("n"), F.count_if(F.col("y") == "rework").alias("k"), F.max("t_open").alias("last")).crossJoin(base)
    return t.select("author_key", F.round(pit.shrunk(F.col("k"), F.col("n"), F.col("m"), 5.0), 4).alias("rework_rate"), F.floor((F.lit(1_000_000_000) - F.col("last")) / DAY).alias("days_since"))


@query(f"""with {FILES_SQL}, s as (select a.path_id, b.path_id as o from fc a join fc b on a.pr_number = b.pr_number and a.path_id <> b.path_id group by 1, 2 having count(*) >= 3), d as (select path_id, count(*) as d from s group by 1),
h as (select fc.pr_number, fc.path_id, count(*) as k from fc join s using (path_id) join fc g on g.pr_number = fc.pr_number and g.path_id = s.o group by 1, 2)
select fc.pr_number, max(coalesce(d, 0)) as degree, max(coalesce(d, 0) - coalesce(k, 0)) as missing from fc left join d using (path_id) left join h on h.pr_number = fc.pr_number and h.path_id = fc.path_id group by 1""")
def e24_co_change_missing(spark, sf_dir):
    return outcomes.co_change(file_changes(spark, sf_dir), "pr_number", "path_id", 3)


@query(f"""with {PR_SQL}, {FILES_SQL}, f as (select fc.pr_number, path_id, t_open, y, author_key, max((path_id % 10 = 0)::int) over (partition by fc.pr_number) as has_test from fc join pr using (pr_number)),
h as (select a.pr_number, a.path_id, any_value(a.has_test) as has_test, count(b.path_id) as n, avg(b.has_test) as test_ratio, round(count(*) filter (where b.y = 'rework') / nullif(count(b.path_id), 0)::double, 6) as rework_density, count(distinct b.author_key) as ndev,
  sum(pow(0.5, (a.t_open - b.t_open) / (180 * 86400.0::double))) filter (where b.y = 'rework') as decayed from f a left join f b on b.path_id = a.path_id and b.t_open < a.t_open group by 1, 2)
select pr_number, path_id, n, round(test_ratio, 6) as test_ratio, rework_density, round(coalesce(decayed, 0), 5) as decayed_reworks, ndev, has_test = 0 and path_id % 10 <> 0 and coalesce(test_ratio, 0) >= 0.5 as is_test_missing from h""")
def e25_e26_file_densities(spark, sf_dir):
    """Densities, decayed counts, developers and test co-change of a file's past, and whether a test was to be expected and is missing."""
    w = history.Window.partitionBy("pr_number")
    f = file_changes(spark, sf_dir).select("pr_number", "path_id", F.max((F.col("path_id") % 10 == 0).cast("int")).over(w).alias("has_test")).join(pull_requests(spark, sf_dir).select("pr_number", "t_open", "y", "author_key"), "pr_number")
    tau, origin = 180 * DAY / 0.6931471805599453, 1_000_000_000
    rework = (F.col("y") == "rework").cast("int")
    up = F.exp((F.col("t_open") - origin) / tau)
    got = pit.prior(f, ["path_id"], "t_open", "t_open", {"n": (F.lit(1), None), "tests": (F.col("has_test"), None), "reworks": (rework, None), "decayed": (rework * up, None)})
    # a developer counts once, from the first change of the file
    first = f.where("author_key is not null").groupBy("path_id", "author_key").agg(F.min("t_open").alias("x"))
    got = pit.prior(got, ["path_id"], "t_open", "x", {"ndev": (F.lit(1), None)}, events=first)
    n = F.nullif("n", F.lit(0.0))
    ratio = F.col("tests") / n
    missing = (F.col("has_test") == 0) & (F.col("path_id") % 10 != 0) & (F.coalesce(ratio, F.lit(0.0)) >= 0.5)
    return got.select("pr_number", "path_id", F.col("n").cast("long").alias("n"), F.round(ratio, 6).alias("test_ratio"), F.round(F.col("reworks") / n, 6).alias("rework_density"), F.round(F.col("decayed") / up, 5).alias("decayed_reworks"), F.col("ndev").cast("long").alias("ndev"), missing.alias("is_test_missing"))
