"""Scores of probabilistic predictions over DataFrames: per-row losses, calibration, ranking, drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .order_stats import equal_mass_bins


def brier(y: Column, probabilities: list[Column]) -> Column:
    return sum((F.pow(p - (y == i).cast("double"), F.lit(2)) for i, p in enumerate(probabilities)), F.lit(0.0))


def log_loss(y: Column, probabilities: list[Column], eps: float = 1e-15) -> Column:
    own = F.lit(None).cast("double")
    for i, p in enumerate(probabilities):
        own = F.when(y == i, p).otherwise(own)
    return -F.log(F.greatest(own, F.lit(eps)))


def ranked_probability_score(y: Column, probabilities: list[Column], order: list[int]) -> Column:
    """Squared differences of cumulative probabilities in the given order of classes, over classes less one."""
    total, cum, hit = F.lit(0.0), F.lit(0.0), F.lit(False)
    for i in order[:-1]:
        cum, hit = cum + probabilities[i], hit | (y == i)
        total = total + F.pow(cum - hit.cast("double"), F.lit(2))
    return total / (len(order) - 1)


def calibration(df: DataFrame, p: str, hit: Column, order: list[str], group: list[str], bins: int = 15) -> DataFrame:
    """(group, bin, n, mean_p, rate) of equal-mass bins within a group, by the columns of ``order``."""
    cells = df.select(*dict.fromkeys([*group, p, *order]), hit.cast("double").alias("_hit"))
    return equal_mass_bins(cells, group, order, bins, "bin").groupBy(*group, "bin").agg(F.count("*").alias("n"), F.avg(p).alias("mean_p"), F.avg("_hit").alias("rate"))


def expected_calibration_error(bins: DataFrame, *group: str) -> DataFrame:
    return bins.groupBy(*group).agg((F.sum(F.col("n") * F.abs(F.col("mean_p") - F.col("rate"))) / F.sum("n")).alias("ece"))


def auroc(df: DataFrame, score: str, hit: Column, *group: str) -> DataFrame:
    """Area under the ROC curve by group from counts per distinct score, so that ties count half; null without both classes."""
    w = Window.partitionBy(*group).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    steps = df.groupBy(*group, score).agg(F.sum(hit.cast("long")).alias("_p"), F.sum((~hit).cast("long")).alias("_n"))
    below = steps.withColumn("_below", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    area = F.sum(F.col("_p") * (F.col("_below") + F.col("_n") / 2))
    return below.groupBy(*group).agg((area / F.nullif(F.sum("_p") * F.sum("_n"), F.lit(0))).alias("auroc"))


def average_precision(df: DataFrame, score: str, hit: Column, *group: str) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    steps = df.groupBy(*group, score).agg(F.sum(hit.cast("long")).alias("_p"), F.count("*").alias("_n"))
    cum = steps.withColumn("_precision", F.sum("_p").over(w) / F.sum("_n").over(w))
    return cum.groupBy(*group).agg((F.sum(F.col("_p") * F.col("_precision")) / F.nullif(F.sum("_p"), F.lit(0))).alias("average_precision"))


def ndcg(df: DataFrame, queue: str, gain: Column, order: list, k: int) -> DataFrame:
    """(queue, ndcg) of the best ``k`` by ``order`` against the best order of gains."""
    ranked = df.withColumn("_g", gain.cast("double")).withColumn("_r", F.row_number().over(Window.partitionBy(queue).orderBy(*order))).withColumn(
        "_i", F.row_number().over(Window.partitionBy(queue).orderBy(F.desc("_g"), *order))
    )
    got = F.sum(F.when(F.col("_r") <= k, F.col("_g") / F.log2(F.col("_r") + 1.0)))
    best = F.sum(F.when(F.col("_i") <= k, F.col("_g") / F.log2(F.col("_i") + 1.0)))
    return ranked.groupBy(queue).agg((got / F.nullif(best, F.lit(0.0))).alias("ndcg"))


def recall_at_effort(df: DataFrame, group: str, order: list, effort: str, hit: Column, share: float = 0.2) -> DataFrame:
    """(group, recall): hits among the rows, in order, whose running effort is within ``share`` of all."""
    w = Window.partitionBy(group)
    run = F.sum(effort).over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) <= share * F.sum(effort).over(w)
    return df.withColumn("_h", hit.cast("long")).withColumn("_in", run).groupBy(group).agg((F.sum(F.when(F.col("_in"), F.col("_h")).otherwise(0)) / F.nullif(F.sum("_h"), F.lit(0))).alias("recall"))


def stability_index(df: DataFrame, column: str, sample: Column, bins: int = 10) -> DataFrame:
    """Population stability index between rows where ``sample`` is true and the others; edges are quantiles of the former."""
    marked = df.select(F.col(column).cast("double").alias("_x"), sample.alias("_a")).where("_x is not null")
    cuts = [i / bins for i in range(1, bins)]
    edges = marked.where("_a").agg(F.percentile("_x", F.array(*map(F.lit, cuts))).alias("_e"))
    b = F.size(F.filter("_e", lambda e: e < F.col("_x")))
    put = marked.crossJoin(F.broadcast(edges)).groupBy(b.alias("bin")).agg(F.count_if("_a").alias("a"), F.count_if(~F.col("_a")).alias("b"))  # one row of edges
    total = Window.partitionBy()
    pa = F.greatest(F.col("a") / F.sum("a").over(total), F.lit(1e-4))
    pb = F.greatest(F.col("b") / F.sum("b").over(total), F.lit(1e-4))
    return put.withColumn("_t", (pa - pb) * F.log(pa / pb)).agg(F.sum("_t").alias("psi"))


def weighted_auroc(df: DataFrame, score: str, hit: Column, weight: Column, *group: str) -> DataFrame:
    """Area under the ROC curve of weighted rows by group, ties count half; null without both classes."""
    w = Window.partitionBy(*group).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    steps = df.groupBy(*group, score).agg(F.sum(F.when(hit, weight).otherwise(0)).alias("_p"), F.sum(F.when(hit, 0).otherwise(weight)).alias("_n"))
    below = steps.withColumn("_below", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    area = F.sum(F.col("_p") * (F.col("_below") + F.col("_n") / 2))
    return below.groupBy(*group).agg((area / F.nullif(F.sum("_p") * F.sum("_n"), F.lit(0))).alias("auroc"))


def weighted_scores(df: DataFrame, y: Column, probabilities: list[Column], weight: Column) -> DataFrame:
    """(brier, base_brier, skill, log_loss, accuracy) of weighted rows; the base says the weighted class shares. One row."""
    k = len(probabilities)
    best = F.greatest(*probabilities)
    first = F.lit(None).cast("int")
    for i in range(k - 1, -1, -1):
        first = F.when(probabilities[i] == best, i).otherwise(first)
    rows = df.select(y.alias("_y"), weight.cast("double").alias("_w"), brier(y, probabilities).alias("_b"), log_loss(y, probabilities).alias("_l"), (first == y).cast("double").alias("_hit"))
    w = F.sum("_w")
    shares = [F.sum(F.when(F.col("_y") == i, F.col("_w")).otherwise(0.0)) / w for i in range(k)]
    sums = rows.agg((F.sum(F.col("_w") * F.col("_b")) / w).alias("brier"), (F.sum(F.col("_w") * F.col("_l")) / w).alias("log_loss"), (F.sum(F.col("_w") * F.col("_hit")) / w).alias("accuracy"), (1 - sum(s * s for s in shares)).alias("base_brier"))
    return sums.withColumn("skill", 1 - F.col("brier") / F.nullif("base_brier", F.lit(0.0)))


def balanced_accuracy(df: DataFrame, truth: Column, guess: Column, *group: str) -> DataFrame:
    """(group, balanced_accuracy): mean over the classes that occur in truth of the share that is guessed right."""
    per = df.withColumns({"_t": truth, "_hit": (truth == guess).cast("double")}).where("_t is not null").groupBy(*group, "_t").agg(F.avg("_hit").alias("_recall"))
    return per.groupBy(*group).agg(F.avg("_recall").alias("balanced_accuracy"))


def classwise_calibration_error(df: DataFrame, y: Column, probabilities: list[str], tie: str, group: list[str], bins: int = 15) -> DataFrame:
    """(group, ece): mean over classes of each class's calibration error in equal-mass bins; all classes are one relation."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("_k"), F.col(p).alias("_p")) for i, p in enumerate(probabilities)])).alias("_c")
    long_ = df.withColumn("_y", y).select(*group, tie, "_y", each).select(*group, tie, "_y", "_c.*")
    per = expected_calibration_error(calibration(long_, "_p", F.col("_y") == F.col("_k"), ["_p", tie], [*group, "_k"], bins), *group, "_k")
    return per.groupBy(*group).agg(F.avg("ece").alias("ece"))


def multiclass_scores(df: DataFrame, truth: Column, probabilities: list[Column], *group: str) -> DataFrame:
    """(group, n, brier, log_loss, accuracy, macro_f1) of a label of several answers, over rows whose answer and probabilities are known.

    Probabilities are cut to [0, 1] and made to add up to 1; the guess is the first greatest. The F1 of an answer that is in
    neither truth nor guesses is 0. One aggregate, with the counts of truth and guess as columns.
    """
    k = len(probabilities)
    cut = [F.least(F.lit(1.0), F.greatest(F.lit(0.0), p.cast("double"))) for p in probabilities]
    total = F.greatest(sum(cut[1:], cut[0]), F.lit(1e-12))
    known = truth.isNotNull()
    for p in probabilities:
        known = known & p.isNotNull() & ~F.isnan(p.cast("double"))
    rows = df.where(known).select(*group, truth.alias("_y"), *[(c / total).alias(f"_p{i}") for i, c in enumerate(cut)])
    q = [F.col(f"_p{i}") for i in range(k)]
    guess = F.lit(None).cast("int")
    for i in range(k - 1, -1, -1):
        guess = F.when(q[i] == F.greatest(*q), i).otherwise(guess)
    y, cells = F.col("_y"), [(t, g) for t in range(k) for g in range(k)]
    counted = rows.withColumn("_g", guess).groupBy(*group).agg(
        F.count("*").alias("n"), F.avg(brier(y, q)).alias("brier"), F.avg(log_loss(y, q)).alias("log_loss"), *[F.count_if((y == t) & (F.col("_g") == g)).alias(f"_c{t}{g}") for t, g in cells]
    )

    def count(keep) -> Column:
        return sum((F.col(f"_c{t}{g}") for t, g in cells if keep(t, g)), F.lit(0))

    f1 = [F.coalesce(2 * count(lambda t, g, c=c: t == g == c) / F.nullif(count(lambda t, g, c=c: t == c) + count(lambda t, g, c=c: g == c), F.lit(0)), F.lit(0.0)) for c in range(k)]
    return counted.select(*group, "n", "brier", "log_loss", (count(lambda t, g: t == g) / F.col("n")).alias("accuracy"), (sum(f1[1:], f1[0]) / k).alias("macro_f1"))


def consistency_gaps(df: DataFrame, pairs: dict[str, tuple[Column, Column]], most: float = 0.05) -> DataFrame:
    """(prediction, n, average_gap, largest_gap, result) of predictions that should agree; CHECK where the average gap is over ``most``."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("prediction"), F.abs(a.cast("double") - b).alias("gap")) for n, (a, b) in pairs.items()])).alias("_g")
    gaps = df.select(each).select("_g.*").where("gap is not null and not isnan(gap)")
    out = gaps.groupBy("prediction").agg(F.count("*").alias("n"), F.avg("gap").alias("average_gap"), F.max("gap").alias("largest_gap"))
    return out.withColumn("result", F.when(F.col("average_gap") > most, "CHECK").otherwise("OK"))
