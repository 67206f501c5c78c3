"""What was known of a repository, an author and a path when a pull request opened.

All history is strictly earlier: an outcome counts once its pull request closed before the moment, an opening once it
happened before. Frames come from ``pit.prior``; pairs only where two pull requests must share a file or a token.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import likeness, pit, sets
from .components import cut_lineage

DAY = 86_400
CLASSES = ("clean", "rework", "nowhere")
#: Tokens, or tokens of large sets, that are broadcast once counted; and tokens of a pull request in a task of their subsets.
COUNTED, DEALT = 100_000, 50_000


def _hits(mask: Column | None = None) -> dict[str, Column]:
    """One 0/1 column a class, of rows where ``mask`` is true."""
    return {c: (F.col("y") == c if mask is None else mask & (F.col("y") == c)).cast("int") for c in CLASSES}


def _total(prefix: str) -> Column:
    return F.col(f"{prefix}_clean") + F.col(f"{prefix}_rework") + F.col(f"{prefix}_nowhere")


def _year_of_repository() -> dict:
    return {f"r365_{c}": (v, 365 * DAY) for c, v in _hits().items()}


def _with_prior(got: DataFrame) -> DataFrame:
    """``got`` with prior_{class} made from the sums of the last 365 days."""
    return got.withColumns({f"prior_{c}": (F.col(f"r365_{c}") + 1) / (_total("r365") + 3) for c in CLASSES}).drop(*[f"r365_{c}" for c in CLASSES])


def with_repository_prior(pr: DataFrame, more: dict | None = None) -> DataFrame:
    """``pr`` with prior_{class}: the repository's outcome shares of the last 365 days, one of each class added; ``more`` sums go on the same timeline."""
    return _with_prior(pit.prior(pr, ["repo"], "t_open", "t_close", _year_of_repository() | (more or {}), bucket=pit.BUCKET))


def author_history(pr: DataFrame, events: DataFrame, strength: float = 3.0) -> DataFrame:
    """``pr`` with the ten ah_ columns, and a_opened: the author's earlier outcomes in the repository, rates shrunk to its prior.

    Needs prior_{class}; all null if the author is unknown. ``events`` are the plain pull requests.
    """
    closed = pit.Stream("t_close", {f"a_{c}": (v, None) for c, v in _hits().items()})
    opened = pit.Stream("t_open", {"a_opened": (F.lit(1), None), "ah_open_now": (F.lit(1), F.col("t_close"))}, last="a_last", first="a_first")
    got = pit.priors(pr, ["repo", "author_key"], "t_open", [closed, opened], events.select("repo", "author_key", "t_open", "t_close", "y"))
    n = _total("a")
    rates = {f"ah_{c}_rate": pit.shrunk(F.col(f"a_{c}"), n, F.col(f"prior_{c}"), strength) for c in CLASSES}
    made = {"ah_n": n, "ah_merged": F.col("a_clean") + F.col("a_rework"), "ah_nowhere": F.col("a_nowhere"), **rates,
            "ah_first_pr": ((n == 0) & (F.col("a_opened") == 0)).cast("double"), "ah_days_since_prev_pr": F.col("a_last") / DAY, "ah_tenure_days": F.col("a_first") / DAY}
    return got.withColumns(made).drop("a_last", "a_first", *[f"a_{c}" for c in CLASSES])


def repository_history(pr: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """``pr`` with the thirteen rh columns, all from one timeline. Needs ah_n of author_history and is_outside.

    Rates of 90 days need five closed pull requests; without them the 180-day rates of outsiders and of their first pull
    requests fall back to prior_{class}, which is made here if ``pr`` lacks it. ``events`` are the same pull requests, plain.
    """
    outside = F.col("is_outside")
    masks = {"ft": outside & (F.coalesce("ah_n", F.lit(0.0)) == 0), "out": outside}
    hours = F.log1p((F.col("t_close") - F.col("t_open")) / 3600.0)
    sums = {f"r90_{c}": (v, 90 * DAY) for c, v in _hits().items()} | {"hours": (hours, 90 * DAY)}
    for name, mask in masks.items():
        sums |= {f"{name}_{c}": (v, 180 * DAY) for c, v in _hits(mask).items()}
    lacks = "prior_clean" not in pr.columns
    closed = pit.Stream("t_close", sums | (_year_of_repository() if lacks else {}))
    opened = pit.Stream("t_open", {"rh30_opened": (F.lit(1), 30 * DAY), "rh_open_now": (F.lit(1), F.col("t_close"))})
    got = pit.priors(pr, ["repo"], "t_open", [closed, opened], bucket=pit.BUCKET)
    got = _with_prior(got) if lacks else got
    n = _total("r90")
    made = {"rh90_n": n, **{f"rh90_{c}_rate": F.when(n >= 5, F.col(f"r90_{c}") / n) for c in CLASSES}, "rh90_mean_log_hours_to_close": F.when(n >= 5, F.col("hours") / n)}
    for name in masks:
        m = _total(name)
        made[f"rh180_{name}_n"] = m
        for c in ("clean", "nowhere"):
            base = F.when(n >= 5, F.col(f"r90_{c}") / n).otherwise(F.col(f"prior_{c}"))
            made[f"rh180_{name}_{c}_rate"] = pit.shrunk(F.col(f"{name}_{c}"), m, base, 5.0)
    return got.withColumns(made).drop("hours", *[f"{p}_{c}" for p in ("r90", *masks) for c in CLASSES])


def last_k_sums(ks: list[int]) -> dict:
    """Sums {class}_{k} and n_{k} over the last k events, for events of ``pit.leaving``."""
    ends = {k: F.col(f"_end{k}") for k in ks}
    return {f"{c}_{k}": (v, end) for k, end in ends.items() for c, v in _hits().items()} | {f"n_{k}": (F.lit(1), end) for k, end in ends.items()}


def last_k_rates(got: DataFrame, ks: list[int], smooth: float, prior: dict[str, Column] | None = None) -> DataFrame:
    """``got`` with {class}_rate_{k} made from the sums of ``last_k_sums``; ``prior`` is a third of each class by default."""
    prior = prior or {c: F.lit(1 / 3) for c in CLASSES}
    made = {f"{c}_rate_{k}": pit.shrunk(F.col(f"{c}_{k}"), F.col(f"n_{k}"), prior[c], smooth) for k in ks for c in CLASSES}
    return got.withColumns(made).drop(*[f"{c}_{k}" for k in ks for c in CLASSES])


def rolling_rates(pr: DataFrame, events: DataFrame, key: list[str], ks: list[int], smooth: float, prior: dict[str, Column] | None = None) -> DataFrame:
    """``pr`` with {class}_rate_{k} and n_{k} of the last ``k`` closed pull requests of the key; ``prior`` is a third of each class by default."""
    own = pit.leaving(events.select(*key, "t_close", "pr_number", "y"), key, "t_close", "pr_number", ks)
    return last_k_rates(pit.prior(pr, key, "t_open", "t_close", last_k_sums(ks), events=own), ks, smooth, prior)


@dataclass(frozen=True)
class Decay:
    """Closed events halved every ``half_life_days``: ``sums`` for a timeline and the rate made from them.

    e^((close - t) / tau) is e^(close / tau) over e^(t / tau), both from the table's last close, so running sums serve all rows.
    """

    latest: int
    half_life_days: float

    @classmethod
    def of(cls, events: DataFrame, half_life_days: float) -> Decay:
        return cls(events.agg(F.max("t_close")).first()[0] or 0, half_life_days)  # one number

    def weight(self, t: Column, sign: int) -> Column:
        tau = self.half_life_days * DAY / 0.6931471805599453
        return F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), sign * (t - self.latest) / tau)))

    def sums(self, hit: Column) -> dict:
        w = self.weight(F.col("t_close"), 1)
        return {"_w": (w, None), "_h": (w * hit.cast("int"), None)}

    def rate(self, smooth: float) -> Column:
        scale = self.weight(F.col("t_open"), -1)
        return (F.col("_h") * scale + smooth / 3) / (F.col("_w") * scale + smooth)


def decayed_rate(pr: DataFrame, events: DataFrame, key: list[str], hit: Column, half_life_days: float, smooth: float, name: str) -> DataFrame:
    """``pr`` with the share of ``hit`` among earlier closed ones of the key, each halved every ``half_life_days``, shrunk to a third."""
    decay = Decay.of(events, half_life_days)
    got = pit.prior(pr, key, "t_open", "t_close", decay.sums(hit), events=events)
    return got.withColumn(name, decay.rate(smooth)).drop("_w", "_h")


def shared_file_pairs(pr: DataFrame, files: DataFrame, back: int, lag: int, bucket: int = 90 * DAY) -> DataFrame:
    """(pr_number, t_open, other and the columns of ``pr`` as q_*): merged pull requests of the repository that share a
    file and closed in [t - back, t - lag].

    Pairs meet by file and by bucket of time, so a busy file's past is cut at the window and dealt over its buckets; files of
    at most ``LIGHT`` pull requests need no buckets.
    """
    own = files.select(F.col("pr_number").alias("f_pr"), "path_id").distinct()
    busy = own.groupBy(F.col("path_id").alias("f_busy")).agg(F.count("*").alias("f_n")).where(F.col("f_n") > sets.LIGHT).drop("f_n")
    own = own.join(busy, F.col("path_id") == F.col("f_busy"), "left")
    light = F.col("f_busy").isNull()
    q = pr.where("y <> 'nowhere' and t_close is not null")
    past = q.select(*[F.col(c).alias(f"q_{c}") for c in q.columns]).join(own.select(F.col("f_pr").alias("q_f"), F.col("path_id").alias("q_path"), light.alias("q_light")), F.col("q_pr_number") == F.col("q_f")).withColumn("q_b", F.when(F.col("q_light"), F.lit(sets.ONE)).otherwise(F.floor(F.col("q_t_close") / bucket)))
    asked = pr.select("repo", "pr_number", "t_open").join(own, F.col("pr_number") == F.col("f_pr")).withColumn("b", F.explode(sets.dealt(light, F.sequence(F.floor((F.col("t_open") - back) / bucket), F.floor((F.col("t_open") - lag) / bucket)))))
    near = (F.col("path_id") == F.col("q_path")) & (F.col("b") == F.col("q_b")) & (F.col("repo") == F.col("q_repo"))
    inside = F.col("q_t_close").between(F.col("t_open") - back, F.col("t_open") - lag) & (F.col("q_pr_number") != F.col("pr_number"))
    return asked.join(past, near).where(inside).drop("f_pr", "q_f", "b", "q_b", "f_busy", "q_light")


def outcome_at(modes: dict[str, tuple[Column, Column]], closed: Column, t: Column) -> Column:
    """Struct (lag, mode) of the earliest failure seen by ``t``: each mode has a flag and its days after the close; null if none."""
    seen = [F.when(flag & (closed + lag * DAY <= t), F.struct(lag.cast("double").alias("lag"), F.lit(i).alias("rank"), F.lit(m).alias("mode"))) for i, (m, (flag, lag)) in enumerate(modes.items())]
    return F.array_min(F.filter(F.array(*seen), lambda x: x.isNotNull()))


def _meeting(e: DataFrame, o: DataFrame, until: DataFrame, back: int, few_e=lambda x: x, few_o=lambda x: x) -> DataFrame:
    """Pairs of ``e`` and earlier ones of ``o`` that share tokens, open or recent when e opened: (pr_number, o_pr_number, both, n, m, open, recent); both counts shared tokens."""
    # a pull request is looked for from its opening to ``back`` after its close, in buckets of that length
    first, last = F.least("t_open", F.coalesce("t_close", "t_open")), F.least(F.coalesce(F.col("t_close") + back, F.col("until")), F.col("until"))
    seen = F.sequence(F.floor(first / back), F.floor(F.greatest(first, last) / back))
    o = o.crossJoin(F.broadcast(until)).select(*[F.col(c).alias(f"o_{c}") for c in o.columns], F.explode(seen).alias("o_at"))  # one row
    e = e.withColumn("at", F.floor(F.col("t_open") / back))
    is_open = (F.col("o_t_open") < F.col("t_open")) & (F.col("o_t_close").isNull() | (F.col("o_t_close") > F.col("t_open")))
    is_recent = F.coalesce((F.col("o_y") != "nowhere") & (F.col("o_t_close") < F.col("t_open")) & (F.col("o_t_close") >= F.col("t_open") - back), F.lit(False))
    same = [F.col(c) == F.col(f"o_{c}") for c in ("repo", "token")]
    met = few_e(e).join(few_o(o), [*same, F.col("at") == F.col("o_at"), F.col("pr_number") != F.col("o_pr_number"), is_open | is_recent])
    return met.groupBy("pr_number", "o_pr_number").agg(F.count("*").alias("both"), F.first("n").alias("n"), F.first("o_n").alias("m"), F.first(is_open).alias("open"), F.first(is_recent).alias("recent"))


def max_similarity(pr: DataFrame, tokens: DataFrame, back: int = 90 * DAY, most: int = 16) -> DataFrame:
    """(pr_number, max_sim_open, max_sim_recent): largest token Jaccard to pull requests open at the opening (0 if none),
    and to those merged in the ``back`` seconds before (null if there were none at all).

    Rows are dealt once for each of their tokens, with the tokens that occur more often beside it, so a token of all pull
    requests comes with few others; a task then holds one repository's rows of a token. Of those that share up to three
    tokens only whether there is any of a size is looked up, in one pass over time; pairs are made of those that share four,
    as many as there are. Sets of more than ``most`` tokens have too many subsets and meet all others by single tokens; so
    do rows that closed before they opened.
    """
    often = cut_lineage(tokens.where("token is not null").groupBy("token").agg(F.count("*").alias("k")).orderBy("k", "token").withColumn("id", F.monotonically_increasing_id()))
    n_tokens, n_rows, top = often.agg(F.count("*"), F.coalesce(F.sum("k"), F.lit(0)), F.coalesce(F.max("id"), F.lit(0))).first()
    numbers = often.select("token", F.col("id").cast("int" if top < 2**31 else "long").alias("id"))
    numbers = F.broadcast(numbers) if n_tokens <= COUNTED else numbers
    own = tokens.select("pr_number", "token").join(numbers, "token").select("pr_number", "id").repartition("pr_number")
    sets = own.groupBy("pr_number").agg(F.sort_array(F.collect_set("id")).alias("set"))  # a pull request's own tokens, the rarest first
    # read by several joins
    whole = cut_lineage(pr.select("repo", "pr_number", "t_open", "t_close", "y").join(sets, "pr_number", "left").withColumn("n", F.when(F.col("set").isNull(), 0).otherwise(F.size("set"))))
    simple = F.coalesce((F.col("n") <= most) & (F.coalesce("t_close", "t_open") >= F.col("t_open")) & F.col("repo").isNotNull(), F.lit(False))
    small, large = whole.where(simple & (F.col("n") > 0)), whole.where(~simple & (F.col("n") > 0))
    by_token = small.select("repo", "pr_number", "t_open", "t_close", F.coalesce(F.col("y") != "nowhere", F.lit(False)).alias("merged"), "n", "set", F.posexplode("set").alias("i", "token"))
    by_token = by_token.withColumn("rest", F.slice("set", F.col("i") + 2, F.col("n"))).drop("set", "i").repartition(max(1, -(-n_rows // DEALT)), "repo", "token")
    kind = dict(pr.dtypes)["pr_number"]
    best = by_token.mapInArrow(likeness.best_of(back, "pr_number"), f"pr_number {kind}, a double, b double")

    n_large = large.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if n_large:
        until = whole.agg(F.max("t_open").alias("until"))
        single = [x.select("repo", "pr_number", "t_open", "t_close", "y", "n", F.explode("set").alias("token")) for x in (small, large, whole)]
        few = F.broadcast if n_large <= COUNTED else lambda x: x
        pairs = _meeting(single[0], single[1], until, back, few_o=few).unionByName(_meeting(single[1], single[2], until, back, few_e=few))
        jaccard = F.col("both") / (F.col("n") + F.col("m") - F.col("both"))
        best = best.unionByName(pairs.select("pr_number", F.when(F.col("open"), jaccard).alias("a"), F.when(F.col("recent"), jaccard).alias("b")))
    best = best.groupBy("pr_number").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    # of a window as long as a bucket, the last close of the bucket before and the first of its own bucket say if it holds any
    begin = lambda c: F.col(c) - F.pmod(F.col(c), F.lit(back))
    closes = whole.where("y <> 'nowhere' and t_close is not null").groupBy("repo", begin("t_close").alias("at")).agg(F.min("t_close").alias("first"), F.max("t_close").alias("last"))
    none = F.lit(None).cast("long")
    sides = closes.select("repo", "at", "first", none.alias("last")).unionByName(closes.select("repo", (F.col("at") + back).alias("at"), none.alias("first"), "last"))
    sides = cut_lineage(sides.groupBy("repo", "at").agg(F.max("first").alias("first"), F.max("last").alias("last")))
    known = whole.select("repo", "pr_number", "t_open", begin("t_open").alias("at")).join(F.broadcast(sides) if sides.count() <= COUNTED else sides, ["repo", "at"], "left")
    there = F.coalesce(F.col("first") < F.col("t_open"), F.lit(False)) | F.coalesce(F.col("last") >= F.col("t_open") - back, F.lit(False))
    asked = known.select("pr_number", there.alias("there"))
    return asked.join(best, "pr_number", "left").select("pr_number", F.coalesce("a", F.lit(0.0)).alias("max_sim_open"), F.when(F.col("there"), F.coalesce("b", F.lit(0.0))).alias("max_sim_recent"))


def experience(pr: DataFrame, areas: DataFrame) -> DataFrame:
    """(pr_number, exp, rexp, sexp): the author's earlier pull requests, the same weighted by 1 / (age in years + 1), and
    those in the areas touched, added over the areas. Unknown authors have 0."""
    mine = pr.where("author_key is not null").select("author_key", "pr_number", "t_open")
    old = mine.select(F.col("author_key").alias("o_a"), F.col("t_open").alias("o_t"))
    seen = mine.join(old, (F.col("author_key") == F.col("o_a")) & (F.col("o_t") < F.col("t_open"))).groupBy("pr_number").agg(
        F.count("*").alias("exp"), F.sum(1 / ((F.col("t_open") - F.col("o_t")) / (365.25 * DAY) + 1)).alias("rexp")
    )
    touched = areas.select("pr_number", "area").distinct().join(mine, "pr_number")
    by_area = pit.prior(touched, ["author_key", "area"], "t_open", "t_open", {"k": (F.lit(1), None)}).groupBy("pr_number").agg(F.sum("k").alias("sexp"))
    got = pr.select("pr_number").join(seen, "pr_number", "left").join(by_area, "pr_number", "left")
    return got.select("pr_number", F.coalesce("exp", F.lit(0)).alias("exp"), F.coalesce("rexp", F.lit(0.0)).alias("rexp"), F.coalesce("sexp", F.lit(0.0)).cast("long").alias("sexp"))


def co_change(elements: DataFrame, key: str, element: str, least: int) -> DataFrame:
    """(key, degree, missing): over the key's elements, the largest number of partners (elements that share ``least`` keys
    with it), and of partners that the key lacks."""
    e = elements.select(key, element).distinct()
    o = e.select(F.col(key).alias("_k"), F.col(element).alias("_o"))
    strong = sets.strong_pairs(elements, key, element, least)
    degree = strong.groupBy(F.col(element).alias("_e")).agg(F.count("*").alias("_d"))
    there = e.join(strong, element).join(o, (F.col(key) == F.col("_k")) & (strong["_o"] == o["_o"])).groupBy(key, element).agg(F.count("*").alias("_in"))
    got = e.join(degree, F.col(element) == F.col("_e"), "left").join(there, [key, element], "left")
    d = F.coalesce("_d", F.lit(0))
    return got.groupBy(key).agg(F.max(d).alias("degree"), F.max(d - F.coalesce("_in", F.lit(0))).alias("missing"))


def first_per(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
