"""Outcome rules by precedence, partial observation, selection windows, moments worth a snapshot, links in messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import pit
from .components import cut_lineage, dealt

#: Moments that are broadcast, if they are counted to be no more.
FEW = 100_000


def first_true(rules: dict[str, Column], otherwise: str | None = None) -> Column:
    """Name of the first rule that is true; a null rule does not count."""
    out = F.lit(otherwise).cast("string")
    for name, rule in reversed(rules.items()):
        out = F.when(rule, name).otherwise(out)
    return out


def worst_severity(rank: Column, top: int) -> Column:
    """Aggregate: ``top`` if any rank reaches it, else null if any rank is unobserved (null), else the largest rank."""
    return F.when(F.coalesce(F.bool_or(rank >= top), F.lit(False)), top).when(F.count_if(rank.isNull()) == 0, F.max(rank))


def null_where_listed(rows: DataFrame, listed: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``rows`` with ``columns`` set to null where the keys are listed; keys compare as equal only if not null."""
    marked = rows.join(listed.select(*keys).distinct().withColumn("_listed", F.lit(True)), keys, "left")
    return marked.withColumns({c: F.when(F.col("_listed").isNull(), F.col(c)) for c in columns}).select(*rows.columns)


def newest_block(rows: DataFrame, key: str, at: str, tie: str, n: int, lead: int) -> DataFrame:
    """The newest ``n`` rows of a key (part 'block') and those up to ``lead`` earlier than the oldest of them ('lead_in').

    The key's threshold is an aggregate over at most ``n`` rows that comes back by an equi-join on the key.
    """
    w = Window.partitionBy(key).orderBy(F.desc(at), F.desc(tie))
    ranked = rows.where(F.col(key).isNotNull() & F.col(at).isNotNull()).withColumn("_r", F.row_number().over(w))
    cut = F.min(F.when(F.col("_r") <= n, F.col(at))).over(Window.partitionBy(key))
    part = F.when(F.col("_r") <= n, "block").when(F.col(at) >= cut - lead, "lead_in")
    return ranked.withColumn("part", part).where("part is not null").drop("_r")


def reference_links(messages: DataFrame, message: str, patterns: list[str]) -> DataFrame:
    """``messages`` by referenced number: (number, strength) for each distinct number that a pattern's first group takes.

    Earlier patterns are stronger; a number keeps only the messages of its strongest pattern.
    """

    def found_by(strength: int, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(F.col(message), F.lit(pattern), F.lit(1)), lambda x: F.struct(x.cast("long").alias("number"), F.lit(strength).alias("strength")))

    found = [found_by(i, p) for i, p in enumerate(patterns)]
    links = messages.withColumn("_l", F.explode(F.array_distinct(F.concat(*found)))).select(*messages.columns, "_l.number", "_l.strength")
    return links.withColumn("_best", F.min("strength").over(Window.partitionBy("number"))).where("strength = _best").drop("_best")


def candidate_moments(rows: DataFrame, key: str, start: str, end: str, days: list[int]) -> DataFrame:
    """(key, trigger, t): the clock moments that fall strictly inside a row's life; an open end never comes."""
    clocks = F.array(*[F.struct(F.lit(f"clock_{d}d").alias("trigger"), (F.col(start) + d * 86_400).alias("t")) for d in days])
    return rows.select(key, F.col(end).alias("_end"), F.explode(clocks).alias("_c")).where("_end is null or _c.t < _end").select(key, "_c.trigger", "_c.t")


def idle_moments(events: DataFrame, key: str, t: str, seconds: int) -> DataFrame:
    """(key, t): ``seconds`` after each event that the next one of its key does not come before."""
    gap = F.lead(t).over(Window.partitionBy(key).orderBy(t)) - F.col(t)
    return events.select(key, F.col(t), gap.alias("_g")).where(F.col("_g") > seconds).select(key, (F.col(t) + seconds).alias("t"))


def queue_moments(rows: DataFrame, start: str, end: str, step: int) -> DataFrame:
    """``rows`` once for each moment, a multiple of ``step``, at which they are open (start <= moment < end).

    A row names its own moments, so no range join is made; rows without an end have none.
    """
    first, last = F.ceil(F.col(start) / step), F.ceil(F.col(end) / step) - 1
    return rows.where(F.col(start).isNotNull() & F.col(end).isNotNull()).where(last >= first).withColumn("moment", F.explode(F.transform(F.sequence(first, last), lambda k: k * step)))


def in_all(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Keys that every frame has."""
    tagged = [f.select(*keys).distinct().withColumn("_f", F.lit(i)) for i, f in enumerate(frames)]
    put = tagged[0]
    for f in tagged[1:]:
        put = put.unionByName(f)
    return put.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") == len(frames)).drop("_n")


def open_at(rows: DataFrame, moments: DataFrame, scope: str, start: str, end: str, bucket: int = 30 * 86_400) -> DataFrame:
    """``rows`` with each ``moment`` of their scope, of (scope, moment), at which they were open: start <= moment < end; a null end never ends.

    Rows and moments meet by scope and bucket of time, each row in the buckets of its life, so hot scopes are dealt. Moments are
    counted first: a few go to the rows, which then stay where they are.
    """
    asked = cut_lineage(moments.select(F.col(scope).alias("_m_s"), "moment", F.floor(F.col("moment") / bucket).alias("_m_b")).distinct())
    few = asked.limit(FEW + 1).count() <= FEW
    last = asked.groupBy(F.col("_m_s").alias("_s")).agg(F.max("moment").alias("_until"))
    lives = rows.join(F.broadcast(last) if few else last, F.col(scope) == F.col("_s")).where(F.col(start) <= F.col("_until"))
    ends = F.greatest(F.col(start), F.least(F.coalesce(F.col(end), F.col("_until")), F.col("_until")))
    spread = lives.withColumn("_b", F.explode(F.sequence(F.floor(F.col(start) / bucket), F.floor(ends / bucket))))
    met = spread.join(F.broadcast(asked) if few else asked, (F.col(scope) == F.col("_m_s")) & (F.col("_b") == F.col("_m_b")) & (F.col(start) <= F.col("moment")) & (F.col(end).isNull() | (F.col("moment") < F.col(end))))
    return met.select(*rows.columns, "moment")


def replayed_queues(waiting: DataFrame, scope: str, key: str, scorers: dict[str, Column], bad: Column, top: int = 5, least: int = 1) -> tuple[DataFrame, DataFrame]:
    """(lists, exposure) of every scorer over queues (scope, moment) of at least ``least`` rows, from one ranking.

    lists: (scope, moment, scorer, n_open, n_bad, hits, recall, ndcg, first_hit) of the ``top`` rows by score, ties by key;
    exposure: (scorer, n_good, n_flagged, flagged_share, false_flag_area): good rows that were ever waiting, those that were ever among
    the ``top``, and the mean over good rows of the share of their moments at which they were.

    Rows are counted and dealt by queue once, scorers are columns of a row; a queue is ranked in one task.
    """
    rows = waiting.select(scope, "moment", key, bad.cast("int").alias("_bad"), *[s.cast("double").alias(f"_s{i}") for i, s in enumerate(scorers.values())])
    queue = Window.partitionBy(scope, "moment")
    places = {f"_r{i}": F.row_number().over(queue.orderBy(F.desc(f"_s{i}"), key)) for i in range(len(scorers))}
    ranked = dealt(rows, rows.count(), scope, "moment").withColumns({"_n": F.count("*").over(queue)} | places).where(F.col("_n") >= least)

    def each(**columns) -> Column:
        """A row for each scorer, of columns made from its place's name."""
        return F.explode(F.array(*[F.struct(F.lit(n).alias("scorer"), *[c(i).alias(k) for k, c in columns.items()]) for i, n in enumerate(scorers)])).alias("_e")

    sums = []
    for i in range(len(scorers)):
        r = F.col(f"_r{i}")
        taken = r <= top
        sums += [F.sum(F.when(taken, F.col("_bad")).otherwise(0)).alias(f"_h{i}"), F.sum(F.when(taken, F.col("_bad") / F.log2(r + 1.0)).otherwise(0.0)).alias(f"_g{i}"), F.min(F.when(F.col("_bad") == 1, r)).alias(f"_f{i}")]
    queues = ranked.groupBy(scope, "moment").agg(F.count("*").alias("n_open"), F.sum("_bad").alias("n_bad"), *sums)
    per = queues.select(scope, "moment", "n_open", "n_bad", each(hits=lambda i: F.col(f"_h{i}"), gain=lambda i: F.col(f"_g{i}"), first_hit=lambda i: F.col(f"_f{i}"))).select("*", "_e.*")
    best = F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.lit(top), F.col("n_bad").cast("int")))), F.lit(0.0), lambda a, i: a + 1 / F.log2(i + 1.0))
    lists = per.select(scope, "moment", "scorer", "n_open", "n_bad", "hits", F.when(F.col("n_bad") > 0, F.col("hits") / F.col("n_bad")).alias("recall"), F.when(F.col("n_bad") > 0, F.col("gain") / best).alias("ndcg"), "first_hit")

    good = ranked.where("_bad = 0").groupBy(scope, key).agg(F.count("*").alias("_k"), *[F.count_if(F.col(f"_r{i}") <= top).alias(f"_t{i}") for i in range(len(scorers))])
    whole = [x for i in range(len(scorers)) for x in (F.count_if(F.col(f"_t{i}") > 0).alias(f"_f{i}"), F.avg(F.col(f"_t{i}") / F.col("_k")).alias(f"_a{i}"))]
    found = good.agg(F.count("*").alias("n_good"), *whole).where("n_good > 0")
    rates = found.select("n_good", each(n_flagged=lambda i: F.col(f"_f{i}"), area=lambda i: F.col(f"_a{i}")))
    return lists, rates.select("_e.scorer", "n_good", "_e.n_flagged", (F.col("_e.n_flagged") / F.col("n_good")).alias("flagged_share"), F.col("_e.area").alias("false_flag_area"))


def first_agent(login: Column, branch: Column, email: Column, body: Column, rules: list[tuple[str, list[str], list[str], list[str], list[str]]]) -> Column:
    """Name of the first of ``rules`` (name, login, email and body patterns, branch prefixes) of which any hint is there; null for none.

    Patterns are searched for without case; a prefix is the branch's part before its first slash. Null texts hold nothing.
    """
    owner = F.lower(F.when(F.instr(branch, "/") > 1, F.substring_index(branch, "/", 1)))
    named = {}
    for name, logins, emails, bodies, prefixes in rules:
        hints = [F.coalesce(text.rlike(f"(?i){p}"), F.lit(False)) for text, patterns in ((login, logins), (email, emails), (body, bodies)) for p in patterns]
        if prefixes:
            hints.append(F.coalesce(owner.isin([p.lower() for p in prefixes]), F.lit(False)))
        hit = F.lit(False)
        for h in hints:
            hit = hit | h
        named[name] = hit
    return first_true(named)


def event_roles(events: DataFrame, closes: DataFrame, maintainers: list[str]) -> DataFrame:
    """``events`` (actor, author, t, is_commit, is_bot, association, ...) with ``role``: author for commits, then bot, author,
    maintainer, other.

    A maintainer has an association of ``maintainers``, compared without case, or had closed (closer, author, at) a request of
    someone else strictly before the event; what it did later says nothing. Null actors are other unless they commit.
    """
    others = closes.where(F.col("closer") != F.col("author")).select(F.col("closer").alias("actor"), F.col("at"))
    seen = pit.prior(events, ["actor"], "t", "at", {"_closed": (F.lit(1), None)}, events=others)
    rules = {
        "_commit": F.col("is_commit"), "bot": F.col("is_bot"), "author": F.col("actor") == F.col("author"),
        "maintainer": F.coalesce(F.upper("association").isin([m.upper() for m in maintainers]), F.lit(False)) | F.coalesce(F.col("_closed") > 0, F.lit(False)),
    }
    role = first_true(rules, "other")
    return seen.withColumn("role", F.when(role == "_commit", "author").otherwise(role)).drop("_closed")
