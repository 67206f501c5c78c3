"""Point-in-time aggregates: a row sees only events strictly before its own moment.

Events and queries are put into one relation and a growing RANGE frame over integer seconds ends one second before the
query, so ties never count and no self-join is made. Rows with a null key get null history.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import cut_lineage

#: Frames reach this many seconds back if they have no window of their own.
ALWAYS = Window.unboundedPreceding


#: Seconds of a busy key's time that make a bucket.
BUCKET = 90 * 86_400


@dataclass(frozen=True)
class Stream:
    """Events at one of their times, and what is asked of them: ``sums``, ``last`` and ``first`` as in ``prior``."""

    event: str
    sums: dict[str, tuple[Column, int | Column | None]]
    last: str | None = None
    first: str | None = None


def prior(rows: DataFrame, keys: list[str], at: str, event: str, sums: dict[str, tuple[Column, int | Column | None]] | None = None,
          last: str | None = None, first: str | None = None, events: DataFrame | None = None, bucket: int | None = None) -> DataFrame:
    """``rows`` with, for each name of ``sums``, the sum of its column over events of the same key with event < at; a
    number of seconds beside the column also wants at - window <= event, a column wants at <= its moment. ``last`` and
    ``first``: seconds since the latest and earliest such event.

    No earlier event: sums are 0, gaps null. Unknown key or null moment: all null. NaN and infinite values are counted
    apart, so a sum is NaN or infinite while its window holds one and recovers after. ``events`` defaults to ``rows`` themselves; name the
    plain table in a chain of calls, so that each call reads it and not all calls before.

    An event enters at its time and leaves, with its value taken off, when its window ends, so frames only grow and the
    work is linear. With ``bucket``, keys are cut into buckets of so many seconds, which start from the totals of those
    before: a busy key is dealt over its buckets, for one more aggregate of the events.
    """
    return priors(rows, keys, at, [Stream(event, sums or {}, last, first)], events, bucket)


def priors(rows: DataFrame, keys: list[str], at: str, streams: list[Stream], events: DataFrame | None = None, bucket: int | None = None) -> DataFrame:
    """``prior`` for several times of the same events, on one timeline and so in one exchange.

    Rows are read once and events once, or twice with ``bucket``: totals of buckets come in as entries of the second before each
    bucket, up to the one after the last event, where later rows go. Rows that ask nothing are dealt by a hash and pass through.
    """
    source = rows if events is None else events
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.lit(True))
    asked_at = known & F.col(at).isNotNull()
    parts_of, names, values, gaps, moments = {}, [], [], [], []
    number = F.col("_p._i")
    for i, stream in enumerate(streams):
        when, entry, leaves = F.col(stream.event), len(moments), {}
        moments.append(when)
        for n, (v, w) in stream.sums.items():
            x = v.cast("double")
            mine = [x]
            if source.select(v).schema[0].dataType.typeName() in ("float", "double"):
                # a sum of fractions has three counts beside it: of NaN, of infinite values above and below zero
                odd = [F.isnan(x), x == float("inf"), x == float("-inf")]
                mine = [F.when(~(odd[0] | odd[1] | odd[2]), x), *[F.when(o, 1.0) for o in odd]]
            parts_of[n] = [f"_v{len(names) + j}" for j in range(len(mine))]
            names += parts_of[n]
            mark = w if isinstance(w, int) else id(w)
            if w is not None and mark not in leaves:
                leaves[mark] = len(moments)
                moments.append(F.when(when.isNotNull(), when + w if isinstance(w, int) else w))  # an event without a time has no entry
            values += [F.when(number == entry, m) if w is None else F.when(number == entry, m).when(number == leaves[mark], -m) for m in mine]
        gaps += [(f"{c}{i}", n, entry) for c, n in (("_l", stream.last), ("_f", stream.first)) if n]
    # entries are numbered and get their values after that, which keeps the code of a row short
    numbered = F.explode(F.array(*[F.struct(m.cast("long").alias("_x"), F.lit(i).alias("_i")) for i, m in enumerate(moments)]))
    entered = source.where(known).withColumn("_p", numbered).where("_p._x is not null").select(
        *keys, F.col("_p._x").alias("_x"), *[v.cast("double").alias(n) for n, v in zip(names, values, strict=True)], *[F.when(number == e, F.col("_p._x")).alias(c) for c, _, e in gaps])
    gaps = [(c, n) for c, n, _ in gaps]
    hashed = [c for c, t in rows.dtypes if "map<" not in t and "variant" not in t]
    asked = rows.select(*[F.when(asked_at, F.col(k)).alias(k) for k in keys], F.when(asked_at, F.col(at)).cast("long").alias("_x"), F.struct(*rows.columns).alias("_row"), F.when(~asked_at, -1 - F.pmod(F.xxhash64(*hashed), F.lit(10_000))).alias("_spare"))
    b = F.lit(0).cast("long")
    if bucket is not None:
        b = F.floor(F.col("_x") / bucket)
        firsts, lasts = [F.min(c).alias(c) for c, _ in gaps if c[1] == "f"], [F.max(c).alias(c) for c, _ in gaps if c[1] == "l"]
        # one row a key and bucket
        totals = cut_lineage(entered.groupBy(*keys, b.alias("_b")).agg(*[F.sum(n).alias(n) for n in names], *firsts, *lasts))
        end = (totals.agg(F.max("_b")).first()[0] or 0) + 1  # one number
        line = Window.partitionBy(*keys).orderBy("_b")
        so_far = line.rowsBetween(ALWAYS, 0)
        sums_so_far = {n: F.sum(n).over(so_far) for n in names} | {c: (F.min(c) if c[1] == "f" else F.max(c)).over(so_far) for c, _ in gaps}
        run = totals.withColumns(sums_so_far | {"_next": F.coalesce(F.lead("_b").over(line), F.lit(end))})
        run = run.withColumn("_b", F.explode(F.sequence(F.col("_b") + 1, F.col("_next")))).drop("_next")
        entered = entered.withColumn("_b", b).unionByName(run.withColumn("_x", F.col("_b") * bucket - 1))
        b = F.least(b, F.lit(end))
    else:
        entered = entered.withColumn("_b", b)
    put = asked.withColumn("_b", F.coalesce("_spare", b)).drop("_spare").unionByName(entered, allowMissingColumns=True)
    here = Window.partitionBy(*keys, "_b").orderBy("_x").rangeBetween(ALWAYS, -1)
    total = {v: F.coalesce(F.sum(v).over(here), F.lit(0.0)) for v in names}
    made = {n: total[own[0]] for n, own in parts_of.items()}
    for n, own in parts_of.items():
        if len(own) > 1:
            finite, nans, above, below = (total[v] for v in own)
            odd = F.when((nans > 0) | ((above > 0) & (below > 0)), float("nan")).when(above > 0, float("inf")).when(below > 0, float("-inf"))
            made[n] = F.coalesce(odd, finite)
    made |= {n: F.col("_x") - (F.min(c) if c[1] == "f" else F.max(c)).over(here) for c, n in gaps}
    return put.withColumns({n: F.when(F.col("_x").isNotNull(), c) for n, c in made.items()}).where("_row is not null").select("_row.*", *made)


def leaving(events: DataFrame, keys: list[str], event: str, tie: str, ks: list[int], prefix: str = "_end") -> DataFrame:
    """``events`` of a known key with, for each k, the time of the event k places later (ties by ``tie``), null for the
    last k: until then an event is one of the last k, so sums over those are windows of ``priors``."""
    order = Window.partitionBy(*keys, F.col(event).isNull()).orderBy(event, tie)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return events.where(known).withColumns({f"{prefix}{k}": F.lead(event, k).over(order) for k in ks})


def prior_last_k(rows: DataFrame, key: list[str], at: str, event: str, values: dict[str, Column], ks: list[int], tie: str, events: DataFrame | None = None, bucket: int | None = None) -> DataFrame:
    """``rows`` with {name}_{k} for each value and n_{k}: sums over the last ``k`` strictly earlier events of the key (ties by ``tie``), and how many.

    Events are numbered within their key and carry running sums; a row looks up those of its latest event and of the
    one ``k`` before. With ``bucket``, numbers and sums are made by buckets of so many seconds, which go on from those before.
    """
    names = [f"_s{i}" for i in range(len(values))]
    source = rows if events is None else events
    known = source.where(" and ".join(f"{k} is not null" for k in key)).where(F.col(event).isNotNull())
    part = F.lit(0).cast("long") if bucket is None else F.floor(F.col(event) / bucket)
    put = known.select(*key, F.col(event).alias("_at"), F.col(tie).alias("_tie"), part.alias("_b"), *[v.cast("double").alias(n) for n, v in zip(names, values.values(), strict=True)])
    here = Window.partitionBy(*key, "_b").orderBy("_at", "_tie")
    local = put.select(*key, "_b", F.row_number().over(here).cast("double").alias("_i"), *[F.sum(n).over(here.rowsBetween(ALWAYS, 0)).alias(n) for n in names])
    if bucket is None:
        running = local.drop("_b")
    else:
        before = Window.partitionBy(*key).orderBy("_b").rowsBetween(ALWAYS, -1)  # one row a bucket
        totals = put.groupBy(*key, "_b").agg(F.count("*").alias("_i"), *[F.sum(n).alias(n) for n in names])
        carry = totals.select(*[F.col(k).alias(f"_k_{k}") for k in key], F.col("_b").alias("_k_b"), *[F.coalesce(F.sum(n).over(before), F.lit(0.0)).alias(f"_c{n}") for n in ["_i", *names]])
        same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k_{k}") for k in key], F.col("_b") == F.col("_k_b"))
        running = local.join(carry, same).select(*key, *[(F.col(f"_c{n}") + F.coalesce(n, F.lit(0.0))).alias(n) for n in ["_i", *names]])
    out = prior(rows, key, at, event, {"_n": (F.lit(1), None)}, events=source, bucket=bucket)
    for step in [0, *ks]:
        own = running.select(*[F.col(k).alias(f"_k_{k}") for k in key], F.col("_i").alias("_k_i"), *[F.col(n).alias(f"{n}_{step}") for n in names])
        same = F.col("_n") - step == F.col("_k_i")
        for k in key:
            same = same & (F.col(k) == F.col(f"_k_{k}"))
        out = out.join(own, same, "left").drop("_k_i", *[f"_k_{k}" for k in key])
    made = {}
    for k in ks:
        for n, v in zip(names, values, strict=True):
            made[f"{v}_{k}"] = F.when(F.col("_n").isNotNull(), F.coalesce(f"{n}_0", F.lit(0.0)) - F.coalesce(f"{n}_{k}", F.lit(0.0)))
        made[f"n_{k}"] = F.when(F.col("_n").isNotNull(), F.least("_n", F.lit(float(k))))
    return out.select(*rows.columns, *[c.alias(n) for n, c in made.items()])


def windowed_median(rows: DataFrame, row_id: str, keys: list[str], at: str, events: DataFrame, seen: str, until: str, value: str, name: str, count: str, bucket: int = BUCKET, radix: int = 8) -> DataFrame:
    """(row_id, name, count): exact median of ``value`` over events of the key with seen < at <= until.

    Values are ranked by key and the middle ranks are found digit by digit: each round counts the events of the window
    by their next digit, as sums of a timeline, for the prefix that a row has come to. So rows are those of rows and events
    times the digits of the ranks, whatever the windows hold; one row may ask for two ranks.
    """
    held = events.where(F.col(value).isNotNull() & (F.col(until) > F.col(seen))).select(*keys, F.col(seen).alias("_seen"), F.col(until).alias("_until"), F.col(value).alias("_value"))
    order = Window.partitionBy(*[f"_k_{k}" for k in keys]).orderBy("_value2")
    ranks = cut_lineage(held.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_value").alias("_value2")).distinct().withColumn("_rank", F.dense_rank().over(order) - 1))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k_{k}") for k in keys])
    held = cut_lineage(held.join(ranks, same & (F.col("_value") == F.col("_value2"))).select(*keys, "_seen", "_until", "_rank"))
    digits, most = 1, ranks.agg(F.max("_rank")).first()[0] or 0  # one number
    while radix**digits <= most:
        digits += 1
    asked = rows.select(F.col(row_id).alias("_id"), *keys, F.col(at).alias("_at"), F.lit(0).cast("long").alias("_prefix"))
    ends = F.col("_until")
    for i in range(digits - 1, -1, -1):
        digit = F.floor(F.col("_rank") / radix**i) % radix
        source = held.select("*", F.floor(F.col("_rank") / radix ** (i + 1)).cast("long").alias("_prefix"), digit.alias("_digit"))
        sums = {f"_d{d}": (F.when(F.col("_digit") == d, 1), ends) for d in range(radix)}
        got = prior(asked, [*keys, "_prefix"], "_at", "_seen", sums, events=source, bucket=bucket)
        counts = [F.coalesce(f"_d{d}", F.lit(0.0)) for d in range(radix)]
        if i == digits - 1:
            n = sum(counts[1:], counts[0]).cast("long")
            got = got.withColumn("_n", n).where("_n > 0").withColumn("_place", F.explode(F.array_distinct(F.array(F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)))))
        # the first digit with more events up to it than the place, which then counts from those before
        next_, passed, before = F.lit(None), F.lit(None), F.lit(0.0)
        steps = []
        for d in range(radix):
            steps.append((d, before, before + counts[d]))
            before = before + counts[d]
        for d, low, high in reversed(steps):
            next_, passed = F.when(F.col("_place") < high, d).otherwise(next_), F.when(F.col("_place") < high, low).otherwise(passed)
        got = got.select("_id", *keys, "_at", "_n", (F.col("_prefix") * radix + next_).cast("long").alias("_prefix"), (F.col("_place") - passed).cast("long").alias("_place"))
        asked = cut_lineage(got) if i else got
    found = asked.join(ranks, same & (F.col("_prefix") == F.col("_rank")))
    return found.groupBy(F.col("_id").alias(row_id)).agg(F.avg("_value2").alias(name), F.first("_n").alias(count))


def shrunk(count: Column, n: Column, prior_rate: Column, strength: float) -> Column:
    return (count + strength * prior_rate) / (n + strength)


def as_of(queries: DataFrame, states: DataFrame, keys: list[str], at: str, state_at: str, value: str, name: str) -> DataFrame:
    """``queries`` with the value of the key's latest state at or before ``at``; of states at one moment the largest value."""
    one_each = states.groupBy(*keys, F.col(state_at).cast("long").alias("_x")).agg(F.max(value).alias("_v"))
    put = queries.select(*keys, F.col(at).cast("long").alias("_x"), F.struct(*queries.columns).alias("_row"), F.lit(None).cast(states.schema[value].dataType).alias("_v")).unionByName(
        one_each.withColumn("_row", F.lit(None))
    )
    frame = Window.partitionBy(*keys).orderBy("_x").rangeBetween(ALWAYS, 0)
    return put.withColumn(name, F.last("_v", ignorenulls=True).over(frame)).where("_row is not null").select("_row.*", name)


def decayed(age_seconds: Column, half_life_days: float) -> Column:
    return F.pow(F.lit(0.5), age_seconds / (half_life_days * 86_400.0))


def islands(rows: DataFrame, keys: list[str], at: str, gap: int) -> DataFrame:
    """Gaps and islands: (keys, first, last, n) of runs whose neighbours are at most ``gap`` apart."""
    w = Window.partitionBy(*keys).orderBy(at)
    new = F.when(F.col(at) - F.lag(at).over(w) <= gap, 0).otherwise(1)
    return (
        rows.withColumn("_new", new).withColumn("_island", F.sum("_new").over(w))
        .groupBy(*keys, "_island").agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("n")).drop("_island")
    )
