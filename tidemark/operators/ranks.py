"""Order statistics against a key's past, and resampled or fitted summaries of scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import cut_lineage
from .order_stats import equal_mass_bins
from .profile import hash_share

#: Cumulative probabilities of a Poisson variable with mean 1 (fixed values).
POISSON_1 = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183, 0.9999167588507119]


def earlier_ranks(rows: DataFrame, row_id: list[str], key: str, at: str, event: str, value: str, weight: Column | None = None, seen: str | None = None, bucket: int | None = None) -> DataFrame:
    """(row_id, n_less, n_equal, n): weight (1 by default) of the events of the same key strictly before ``at``, and of
    those with a smaller or an equal value; with a name in ``seen`` also how many events those are.

    Values are any whole numbers; events without a value or a time don't count, and rows with a null key, value or time
    get nulls. Values are ranked by key and ranks are taken digit by digit: a RANGE frame sums the weights of each digit of
    those that share the digits above, and a row takes the smaller ones. Rows are read once and all digits share one exchange by key; no pairs
    are made. With ``bucket``, a busy key is dealt over buckets of so many seconds, which start from one entry a rank of those before.
    """
    good = rows.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    own = [F.col(key).alias("_k"), F.col(value).alias("_value")]
    id_ = F.struct(*row_id).alias("_id")
    held = [(F.lit(1) if weight is None else weight).cast("double").alias("_w"), F.lit(1.0).alias("_one")]
    if at == event:
        put = good.select(*own, F.col(at).cast("long").alias("_x"), id_, *held)
    else:
        put = good.select(*own, F.col(at).cast("long").alias("_x"), id_).unionByName(good.select(*own, F.col(event).cast("long").alias("_x"), *held), allowMissingColumns=True)
    put = put.where("_x is not null")
    place = (F.dense_rank().over(Window.partitionBy("_k").orderBy("_value")) - 1).cast("long").alias("_v")
    if bucket is None:
        put = put.select("*", place)
    else:
        put = cut_lineage(put)
        places = put.select("_k", "_value").distinct().select(F.col("_k").alias("_k2"), F.col("_value").alias("_value2"), place)
        put = put.join(places, (F.col("_k") == F.col("_k2")) & (F.col("_value") == F.col("_value2"))).drop("_k2", "_value2")
    known = cut_lineage(put.drop("_value"))
    bits = max(1, int(known.agg(F.max("_v")).first()[0] or 0).bit_length())
    levels = -(-bits // 4)
    step = -(-bits // levels)
    parts = ["_k"]
    if bucket is not None:
        parts = ["_k", "_b"]
        known = known.withColumn("_b", F.floor(F.col("_x") / bucket))
        line = Window.partitionBy("_k", "_v").orderBy("_b")
        last = known.agg(F.max("_b")).first()[0] or 0  # one number
        totals = known.where("_one is not null").groupBy("_k", "_v", "_b").agg(F.sum("_w").alias("_w"), F.sum("_one").alias("_one"))
        so_far = totals.withColumns({c: F.sum(c).over(line.rowsBetween(Window.unboundedPreceding, 0)) for c in ("_w", "_one")} | {"_next": F.coalesce(F.lead("_b").over(line), F.lit(last))})
        carried = so_far.where("_next > _b").withColumn("_b", F.explode(F.sequence(F.col("_b") + 1, F.col("_next")))).drop("_next")
        known = known.unionByName(carried.withColumn("_x", F.col("_b") * bucket - 1), allowMissingColumns=True)
    got = known.withColumns({"n_less": F.lit(0.0), "n": F.lit(0.0)})
    for level in range(levels - 1, -1, -1):
        digit = F.call_function("shiftright", F.col("_v"), F.lit(step * level)).bitwiseAND(F.lit(2**step - 1))
        above = [] if level == levels - 1 else [F.call_function("shiftright", F.col("_v"), F.lit(step * (level + 1)))]
        before = Window.partitionBy(*parts, *above).orderBy("_x").rangeBetween(Window.unboundedPreceding, -1)
        sums = {f"_d{d}": F.sum(F.when(digit == d, F.col("_w"))).over(before) for d in range(2**step)}
        if seen and not above:
            sums["_seen"] = F.sum("_one").over(before)
        got = got.withColumns(sums)
        each = [F.coalesce(f"_d{d}", F.lit(0.0)) for d in range(2**step)]
        less = sum((F.when(digit > d, c).otherwise(0.0) for d, c in enumerate(each[:-1])), F.col("n_less"))
        made = {"n_less": less}
        if not above:
            made["n"] = sum(each[1:], each[0])
        if level == 0:
            made["n_equal"] = sum((F.when(digit == d, c).otherwise(0.0) for d, c in enumerate(each[1:], 1)), F.when(digit == 0, each[0]).otherwise(0.0))
        got = got.withColumns(made).drop(*[f"_d{d}" for d in range(2**step)])
    names = ["n_less", "n_equal", "n"] + ([seen] if seen else [])
    found = got.where("_id is not null").withColumn(seen or "_seen", F.coalesce("_seen", F.lit(0.0)) if seen else F.lit(None)).select("_id.*", *names)
    missing = rows.where(F.col(key).isNull() | F.col(value).isNull() | F.col(at).isNull()).select(*row_id, *[F.lit(None).cast("double").alias(c) for c in names])
    return found.unionByName(missing)


def bootstrap_weight(seed: str, draw: Column, unit: Column) -> Column:
    """Poisson(1) weight of a unit in a draw, the same on every run."""
    u = hash_share(seed, F.concat_ws(":", draw, unit))
    return sum(((u > p).cast("int") for p in POISSON_1), F.lit(0))


def cluster_bootstrap(rows: DataFrame, unit: str, value: Column, draws: int, seed: str, alpha: float = 0.05) -> DataFrame:
    """(mean, lower, upper): mean over units of their mean value, with percentile bounds over Poisson draws of whole units.

    Rows are first reduced to one per unit, and each unit names its own weight in each draw.
    """
    units = rows.groupBy(unit).agg(F.avg(value).alias("_m"))
    drawn = units.select(unit, "_m", F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("_d")).withColumn("_w", bootstrap_weight(seed, F.col("_d"), F.col(unit)))
    means = drawn.groupBy("_d").agg((F.sum(F.col("_w") * F.col("_m")) / F.nullif(F.sum("_w"), F.lit(0))).alias("_x"))
    bounds = means.agg(F.percentile("_x", F.lit(alpha / 2)).alias("lower"), F.percentile("_x", F.lit(1 - alpha / 2)).alias("upper"))
    return units.agg(F.avg("_m").alias("mean")).crossJoin(F.broadcast(bounds))  # one row each


def joint_bootstrap(rows: DataFrame, unit: str, model: Column, base: Column, other: Column, truth: Column, guess: Column, classes: list, draws: int, seed: str, alpha: float = 0.05) -> DataFrame:
    """(statistic, estimate, lower, upper) of ``loss`` (mean over units of their mean loss), ``skill`` (1 less its quotient by the
    base's), ``difference`` (to another model's loss) and ``macro_f1``, with percentile bounds over Poisson draws of whole units.

    All statistics of a draw come from the same weights and from sums over units: of their mean losses, and of their
    counts by truth and guess; a draw without units has none. Rows are first reduced to one per unit; units x draws then meet in one aggregate.
    """
    cells = [(t, g) for t in classes for g in classes]
    losses = {"_m": F.avg(model), "_b": F.avg(base), "_o": F.avg(other)}
    units = rows.groupBy(unit).agg(*[c.alias(n) for n, c in losses.items()], F.array(*[F.count_if((truth == t) & (guess == g)).cast("double") for t, g in cells]).alias("_c"))

    def statistics(w: Column, grouped) -> DataFrame:
        sums = grouped.agg(F.sum(w).alias("_w"), *[F.sum(w * F.col(n)).alias(n) for n in losses], *[F.sum(w * F.col("_c")[i]).alias(f"_c{i}") for i in range(len(cells))])

        def count(keep) -> Column:
            return sum((F.col(f"_c{i}") for i, c in enumerate(cells) if keep(*c)), F.lit(0.0))

        # the F1 of a class that is in neither truth nor guesses is 0
        f1 = [F.coalesce(2 * count(lambda t, g, c=c: t == g == c) / F.nullif(count(lambda t, g, c=c: t == c) + count(lambda t, g, c=c: g == c), F.lit(0.0)), F.lit(0.0)) for c in classes]
        named = {
            "loss": F.col("_m") / F.nullif("_w", F.lit(0)), "skill": 1 - F.col("_m") / F.nullif("_b", F.lit(0.0)), "difference": (F.col("_m") - F.col("_o")) / F.nullif("_w", F.lit(0)),
            "macro_f1": F.when(F.col("_w") > 0, sum(f1[1:], f1[0]) / len(classes)),
        }
        return sums.select(F.explode(F.array(*[F.struct(F.lit(k).alias("statistic"), v.cast("double").alias("x")) for k, v in named.items()])).alias("s")).select("s.*")

    estimate = statistics(F.lit(1), units.groupBy())
    drawn = units.withColumn("_d", F.explode(F.sequence(F.lit(1), F.lit(draws)))).withColumn("_weight", bootstrap_weight(seed, F.col("_d"), F.col(unit)))
    bounds = statistics(F.col("_weight"), drawn.groupBy("_d")).groupBy("statistic").agg(F.percentile("x", F.lit(alpha / 2)).alias("lower"), F.percentile("x", F.lit(1 - alpha / 2)).alias("upper"))
    return estimate.withColumnRenamed("x", "estimate").join(bounds, "statistic")


def calibration_line(df: DataFrame, p: Column, hit: Column, rounds: int = 8) -> tuple[float, float]:
    """(offset, slope) of logit(hit) on logit(p) by Newton's method, each round one aggregate of five sums.

    (0, 1) for an empty table; one class alone has no fit, and gives (nan, nan).
    """
    at = df.select(F.log(p / (1 - p)).alias("z"), hit.cast("double").alias("y")).where("z is not null and y is not null")
    offset, slope = 0.0, 1.0
    for _ in range(rounds):
        mu = 1 / (1 + F.exp(-(offset + slope * F.col("z"))))
        r, w, z = F.col("y") - mu, mu * (1 - mu), F.col("z")
        s = at.agg(F.count("*").alias("n"), F.sum("y").alias("y"), F.sum(r).alias("g0"), F.sum(r * z).alias("g1"), F.sum(w).alias("a"), F.sum(w * z).alias("b"), F.sum(w * z * z).alias("c")).first()
        if not s["n"]:
            return 0.0, 1.0
        det = s["a"] * s["c"] - s["b"] ** 2
        if s["y"] in (0.0, float(s["n"])) or det <= 0:
            return float("nan"), float("nan")
        offset, slope = offset + (s["c"] * s["g0"] - s["b"] * s["g1"]) / det, slope + (s["a"] * s["g1"] - s["b"] * s["g0"]) / det
    return offset, slope


def macro_f1(df: DataFrame, truth: Column, guess: Column) -> DataFrame:
    """(macro_f1, kappa) over the classes that occur in truth, from one count per pair of classes."""
    cells = df.select(truth.alias("t"), guess.alias("g")).where("t is not null and g is not null").groupBy("t", "g").agg(F.count("*").alias("n"))
    sides = cells.select(F.explode(F.array(F.struct(F.col("t").alias("k"), F.col("n").alias("nt"), F.lit(0).cast("long").alias("ng")), F.struct(F.col("g").alias("k"), F.lit(0).cast("long").alias("nt"), F.col("n").alias("ng")))).alias("s"), F.when(F.col("t") == F.col("g"), F.col("n")).otherwise(0).alias("hit"))
    per = sides.groupBy("s.k").agg(F.sum("s.nt").alias("nt"), F.sum("s.ng").alias("ng"), (F.sum("hit") / 2).alias("tp"))
    n, agree = F.sum("nt"), F.sum("tp") / F.sum("nt")
    chance = F.sum(F.col("nt").cast("double") * F.col("ng")) / (n * n)
    f1 = F.when(F.col("nt") > 0, 2 * F.col("tp") / (F.col("nt") + F.col("ng")))
    return per.agg(F.avg(f1).alias("macro_f1"), ((agree - chance) / F.nullif(1 - chance, F.lit(0.0))).alias("kappa"))


def binned_rates(df: DataFrame, column: str, tie: str, hit: Column, bins: int, *group: str) -> DataFrame:
    """(group, bin, n, lowest, highest, rate) of equal-mass bins of a column within a group."""
    known = df.where(F.col(column).isNotNull()).select(*group, column, tie, hit.cast("double").alias("_h"))
    return equal_mass_bins(known, list(group), [column, tie], bins, "bin").groupBy(*group, "bin").agg(F.count("*").alias("n"), F.min(column).alias("lowest"), F.max(column).alias("highest"), F.avg("_h").alias("rate"))


def fill_from_pool(rows: DataFrame, row_id: str, group: str, column: str, seed: str, least: int = 20) -> DataFrame:
    """``rows`` with blanks of ``column`` taken from the known values of the group, or of all rows if the group has fewer than ``least``.

    A hash of the row's id picks a place in the pool; known values are numbered in the order of the id. Without any
    known value blanks stay.
    """
    share = hash_share(seed, F.col(row_id))
    values = rows.where(F.col(column).isNotNull()).select(F.col(group).alias("_g"), F.col(column).alias("_c"), F.col(row_id).alias("_id"))
    own = values.where("_g is not null").withColumn("_i", (F.row_number().over(Window.partitionBy("_g").orderBy("_id")) - 1).cast("long"))
    sizes = own.groupBy(F.col("_g").alias("_g2")).agg(F.count("*").alias("_n"))
    # the pool of all rows is numbered group by group, from the groups' sizes, so no task sorts it whole
    blocks = values.groupBy("_g").agg(F.count("*").alias("_m"))
    offset = F.coalesce(F.sum("_m").over(Window.orderBy(F.col("_g").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a group
    starts = blocks.select(F.col("_g").alias("_g3"), offset.alias("_from"))
    everyone = values.withColumn("_i", (F.row_number().over(Window.partitionBy("_g").orderBy("_id")) - 1).cast("long")).join(starts, F.col("_g").eqNullSafe(F.col("_g3"))).select((F.col("_i") + F.col("_from")).alias("_i"), "_c")
    total = F.broadcast(values.agg(F.count("*").alias("_all")))  # one row
    asked = rows.where(F.col(column).isNull()).join(sizes, F.col(group) == F.col("_g2"), "left").crossJoin(total).withColumn("_own", F.coalesce(F.col("_n") >= least, F.lit(False)))
    asked = asked.withColumn("_size", F.when(F.col("_own"), F.col("_n")).otherwise(F.col("_all"))).withColumn("_want", F.least(F.col("_size") - 1, F.floor(share * F.col("_size")).cast("long")))
    columns = [F.col("_c").alias(c) if c == column else F.col(c) for c in rows.columns]
    near = asked.where("_own").join(own.select("_g", "_i", "_c"), (F.col(group) == F.col("_g")) & (F.col("_want") == F.col("_i")), "left").select(*columns)
    far = asked.where("not _own").join(everyone, F.col("_want") == F.col("_i"), "left").select(*columns)
    return rows.where(F.col(column).isNotNull()).unionByName(near).unionByName(far)
