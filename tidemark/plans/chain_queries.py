"""Queries of commit chains, audited files, table generations and replayed queues, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators import chains, decisions
from ..operators.components import checkpoint_folder, cut_lineage
from ..sources import audit, catalog
from ..sources.entities import DAY, PR_SQL, PREDICTION_SQL, predictions, pull_requests, seconds, table

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query("""with recursive e as (select user_id as u, event_id as node, cast(floor(epoch(ts)) as bigint) as t0, event_type as kind from events),
c as (select u, node, t0, kind, t0 + (node * 7919) % 7200 as t, case when kind = 'view' then last_value(case when kind = 'view' then node end ignore nulls) over k else lag(node) over (partition by u order by t0, node) end as parent,
  max(case when kind = 'view' then {'t': t0, 'n': node} end) over (partition by u order by t0 range between unbounded preceding and 86400 following).n as tip from e window k as (partition by u order by t0, node rows between unbounded preceding and 1 preceding)),
p as (select *, lag(node) over (partition by u order by t0, node) as before from c where kind = 'purchase'),
q as (select node as id, tip, t - 3600 * (node % 5) + 300 as cut, case when node % 7 = 0 then 'approx' when node % 3 = 0 and t + 1000 > t - 3600 * (node % 5) + 300 then 'recovered' else 'exact' end as kind,
  case when node % 7 <> 0 and node % 3 = 0 and t + 1000 > t - 3600 * (node % 5) + 300 then before else node end as start from p),
d as (select node, 0 as depth from c where parent is null union all select c.node, d.depth + 1 from d join c on c.parent = d.node),
w as (select q.id, c.node, c.parent, c.t, q.cut, q.tip from q join c on c.node = q.start where q.start is distinct from q.tip union all select w.id, c.node, c.parent, c.t, w.cut, w.tip from w join c on c.node = w.parent where w.t > w.cut and c.node is distinct from w.tip),
h as (select id, node as head from w where t <= cut),
a as (select id, head as node from h union all select a.id, c.parent from a join c on c.node = a.node where c.parent is not null),
b as (select h.id, q.tip as node from h join q using (id) where q.tip is not null union all select b.id, c.parent from b join c on c.node = b.node where c.parent is not null),
f as (select a.id, arg_max(a.node, d.depth) as fork, max(d.depth) as fork_depth from a join b using (id, node) join d using (node) group by 1),
v as (select f.id, c.node, c.parent, c.t, q.cut, f.fork from f join q using (id) join c on c.node = q.tip where q.tip <> f.fork union all select v.id, c.node, c.parent, c.t, v.cut, v.fork from v join c on c.node = v.parent where v.t > v.cut and c.node <> v.fork),
t as (select v.id, d.depth from v join d using (node) where v.t <= v.cut)
select q.id, h.head, case when h.head is not null then q.kind end as kind, case when f.fork is not null then coalesce(t.depth - f.fork_depth, 0) end as behind
from q left join h using (id) left join f using (id) left join t using (id)""")
def c28_heads_behind_pushes(spark, sf_dir):
    """Views are a user's main line and other events branches of it; a purchase is a request, every third of which was pushed over."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("u"), F.col("event_id").alias("node"), seconds("ts").alias("t0"), F.col("event_type").alias("kind"))
    order = Window.partitionBy("u").orderBy("t0", "node")
    is_view = F.col("kind") == "view"
    main = F.last(F.when(is_view, F.col("node")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    soon = Window.partitionBy("u").orderBy("t0").rangeBetween(Window.unboundedPreceding, DAY)
    tip = F.max(F.when(is_view, F.struct("t0", "node"))).over(soon)["node"]
    c = cut_lineage(e.withColumns({"t": F.col("t0") + (F.col("node") * 7919) % 7200, "parent": F.when(is_view, main).otherwise(F.lag("node").over(order)), "tip": tip}))
    p = c.where("kind = 'purchase'").withColumn("before", F.lag("node").over(order))
    opened = F.col("t") - 3600 * (F.col("node") % 5)
    requests = p.select(F.col("node").alias("id"), F.col("node").alias("final"), F.col("tip").alias("base_tip"), opened.alias("opened"), (F.col("node") % 7 != 0).alias("is_known"))
    pushes = p.where("node % 3 = 0").select(F.col("node").alias("id"), (F.col("t") + 1000).alias("t"), "before")
    return chains.heads_at_open(requests, pushes, chains.jumps(c.select("node", "parent", "t")))


ROW = StructType([StructField("conv_id", LongType()), StructField("turn", LongType())])


@query("""with c as (select conv_id % 6 as part, count(*) as n, count(*) filter (where turn % 2 = 1) as bad from conversations group by 1)
select 'lines' as kind, part, case when part = 5 then 'foreign' when part = 4 and bad > 0 then case when bad = n then 'foreign' else 'torn' end else 'read' end as outcome,
  cast(case when part = 5 then 0 when part = 4 then n - bad else n end as bigint) as n_rows, cast(case when part = 5 then n when part = 4 then bad else 0 end as bigint) as n_bad from c
union all select 'parquet', part, case when part = 5 then 'foreign' else 'read' end, cast(case when part = 5 then 0 else n end as bigint), 0 from c""")
def a9_a11_file_outcomes(spark, sf_dir):
    """Conversations written as files, one a part: of part 4 every second turn is a torn line, of part 5 nothing is a record; what reading says of each."""
    root = f"{checkpoint_folder(spark)}/audit-{uuid.uuid4().hex}"
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.col("conv_id") % 6).alias("part"))
    whole = F.to_json(F.struct("conv_id", "turn"))
    line = F.when(F.col("part") == 5, F.lit("# no record")).when((F.col("part") == 4) & (F.col("turn") % 2 == 1), F.substring(whole, 1, 9)).otherwise(whole)
    one_each = c.withColumn("value", line).repartition("part")
    one_each.select("part", "value").write.partitionBy("part").option("compression", "none").text(f"{root}/lines")
    one_each.where("part < 5").select("part", "conv_id", "turn").write.partitionBy("part").parquet(f"{root}/parquet")
    one_each.where("part = 5").select("value").write.text(f"{root}/parquet/part=5")
    found = []
    for kind, (_, outcomes) in (("lines", audit.read_lines_audited(spark, f"{root}/lines", ROW, "*.txt")), ("parquet", audit.read_parquet_audited(spark, f"{root}/parquet", ROW, "part-*"))):
        found.append(outcomes.select(F.lit(kind).alias("kind"), F.regexp_extract("file", "part=([0-9]+)", 1).cast("long").alias("part"), "outcome", "n_rows", "n_bad"))
    both = found[0].unionByName(found[1])
    done = both.groupBy("kind", "part", "outcome").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_bad").alias("n_bad"))
    kept = cut_lineage(done)
    fs, at = catalog.file_system(spark, root)
    fs.delete(at, True)
    return kept


@query(f"with {PR_SQL} select repo, count(*) as n, cast(sum(la) as bigint) as churn from pr where y = 'clean' group by 1")
def a10_current_tables(spark, sf_dir):
    """Two tables replaced twice; what a reader of the second generation sees, after another has taken its place within the lease."""
    root = f"{checkpoint_folder(spark)}/tables-{uuid.uuid4().hex}"
    pr = pull_requests(spark, sf_dir).select("repo", "pr_number", "la", "y")
    catalog.replace_tables({"clean": pr.where("y = 'rework'").limit(0), "other": pr.limit(0)}, root)
    catalog.replace_tables({"clean": pr.where("y = 'clean'"), "other": pr.where("y <> 'clean'")}, root)
    reader = catalog.current_table(spark, root, "clean")
    catalog.replace_tables({"other": pr.limit(0)}, root)
    return reader.groupBy("repo").agg(F.count("*").alias("n"), F.sum("la").alias("churn"))


REPLAY_SQL = f"""{PREDICTION_SQL}, mo as (select distinct repo, t_open // 2592000 * 2592000 as moment from pr), waits as (select p.repo, p.pr_number, p.y, moment, p.p2, t_open, p.la from pred p join pr using (pr_number) join mo on mo.repo = p.repo and t_open <= moment and (t_close is null or moment < t_close)),
s as (select repo, moment, pr_number, (y = 2)::int as bad, 'model' as scorer, p2 as score from waits union all select repo, moment, pr_number, (y = 2)::int, 'oldest_first', cast(moment - t_open as double) from waits union all select repo, moment, pr_number, (y = 2)::int, 'largest_first', cast(la as double) from waits),
r as (select *, count(*) over (partition by repo, moment, scorer) as n, row_number() over (partition by repo, moment, scorer order by score desc, pr_number) as r from s)"""


def _replay(spark, sf_dir):
    pr = pull_requests(spark, sf_dir)
    moments = pr.select("repo", (F.floor(F.col("t_open") / (30 * DAY)) * 30 * DAY).alias("moment")).distinct()
    waiting = decisions.open_at(predictions(spark, sf_dir, "t_open", "t_close"), moments, "repo", "t_open", "t_close")
    scorers = {"model": F.col("p2"), "oldest_first": F.col("moment") - F.col("t_open"), "largest_first": F.col("la")}
    return decisions.replayed_queues(waiting, "repo", "pr_number", scorers, F.col("y") == 2, 5, 3)


@query(f"""with {REPLAY_SQL}, l as (select repo, moment, scorer, count(*) as n_open, sum(bad) as n_bad, sum(bad) filter (where r <= 5) as hits, sum(bad / log2(r + 1.0)) filter (where r <= 5) as gain, min(r) filter (where bad = 1) as first_hit from r where n >= 3 group by 1, 2, 3)
select repo, moment, scorer, n_open, cast(n_bad as bigint) as n_bad, cast(hits as bigint) as hits, round(hits / cast(nullif(n_bad, 0) as double), 9) as recall, round(gain / case when n_bad > 0 then list_sum(list_transform(range(1, least(5, n_bad)::bigint + 1), lambda i: 1 / log2(i + 1.0))) end, 9) as ndcg, first_hit from l""")
def j11_queue_replay(spark, sf_dir):
    """At each month of a repository, the requests open then as three scorers rank them."""
    lists, _ = _replay(spark, sf_dir)
    return lists.select("repo", "moment", "scorer", "n_open", "n_bad", "hits", F.round("recall", 9).alias("recall"), F.round("ndcg", 9).alias("ndcg"), "first_hit")


@query(f"""with {REPLAY_SQL}, g as (select scorer, pr_number, avg((r <= 5)::int) as share from r where n >= 3 and bad = 0 group by 1, 2)
select scorer, count(*) as n_good, count(*) filter (where share > 0) as n_flagged, round(count(*) filter (where share > 0) / cast(count(*) as double), 9) as flagged_share, round(avg(share), 9) as false_flag_area from g group by 1""")
def j11_false_flags(spark, sf_dir):
    """How often each scorer puts good requests among the first five."""
    _, exposure = _replay(spark, sf_dir)
    return exposure.withColumns({c: F.round(c, 9) for c in ("flagged_share", "false_flag_area")})
