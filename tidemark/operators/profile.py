"""Profiles, slices, labels and weights of wide tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unpivot(df: DataFrame, ids: list[str], columns: list[str]) -> DataFrame:
    """Long form (ids, name, value as text); one scan."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(*ids, pairs.alias("_p")).select(*ids, "_p.name", "_p.value")


def schema_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(name, type, n, null_share, n_distinct, lowest, highest, mean, median) of each column, in one pass.

    Lowest and highest compare as the column's type does and are shown as text; mean and median are of numbers only.
    """
    kinds, made = dict(df.dtypes), []
    for c in columns:
        numeric = kinds[c].split("(")[0] in ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
        x = F.col(c).cast("double") if numeric else F.lit(None).cast("double")
        made.append(F.struct(
            F.lit(c).alias("name"), F.lit(kinds[c]).alias("type"), F.count("*").alias("n"), (F.count_if(F.col(c).isNull()) / F.nullif(F.count("*"), F.lit(0))).alias("null_share"),
            F.countDistinct(c).alias("n_distinct"), F.min(c).cast("string").alias("lowest"), F.max(c).cast("string").alias("highest"), F.avg(x).alias("mean"), F.median(x).alias("median"),
        ))
    return df.agg(F.array(*made).alias("_all")).select(F.explode("_all").alias("_r")).select("_r.*")


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """(bin, n) of equal-width bins; the highest value is in the last."""
    edges = df.agg(F.min(column).cast("double").alias("_lo"), F.max(column).cast("double").alias("_hi"))
    x = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("_x")).crossJoin(F.broadcast(edges))  # one row of edges
    b = F.least(F.lit(bins - 1), F.floor((F.col("_x") - F.col("_lo")) / ((F.col("_hi") - F.col("_lo")) / bins)))
    return x.where("_hi > _lo").groupBy(b.cast("long").alias("bin")).agg(F.count("*").alias("n"))


def top_values(df: DataFrame, column: str, n: int = 15) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.col(column).asc_nulls_last()).limit(n)


def slices(df: DataFrame, columns: list[str], merged: Column, bad: Column, observed: Column, min_rows: int = 50, min_observed: int = 20) -> DataFrame:
    """(slice, value, n, share, merged_rate, n_observed, bad_rate, small, thin); null is a slice of its own."""
    marked = df.withColumns({"_m": merged, "_b": bad, "_o": observed})
    total = F.sum("n").over(Window.partitionBy("slice"))
    grouped = unpivot(marked, ["_m", "_b", "_o"], columns).groupBy(F.col("name").alias("slice"), F.coalesce("value", F.lit("(null)")).alias("value")).agg(
        F.count("*").alias("n"), F.avg(F.col("_m").cast("double")).alias("merged_rate"), F.count_if(F.col("_o").eqNullSafe(F.lit(True))).alias("n_observed"),
        F.avg(F.when(F.col("_o").eqNullSafe(F.lit(True)), F.col("_b").cast("double"))).alias("bad_rate"),
    )
    return grouped.withColumn("share", F.col("n") / total).withColumn("small", F.col("n") < min_rows).withColumn("thin", F.col("n_observed") < min_observed)


def tri_state(column: Column) -> Column:
    """Booleans, 0/1 and their spellings; anything else is null."""
    text = F.lower(F.trim(column.cast("string")))
    return F.when(text.isin("true", "1", "1.0", "t", "yes"), True).when(text.isin("false", "0", "0.0", "f", "no"), False)


def observed_rows(label: Column, observed: Column, rule: str) -> Column:
    """``observed``: rows whose flag is true; ``window``: any yes, and a no once the flag is true."""
    seen = observed.eqNullSafe(F.lit(True))
    return seen & label.isNotNull() if rule == "observed" else label.eqNullSafe(F.lit(True)) | (label.eqNullSafe(F.lit(False)) & seen)


def any_yes(*labels: Column) -> Column:
    """Three-valued or: an observed yes stands, otherwise anything unobserved leaves it open."""
    return reduce(lambda a, b: a | b, labels)


def funnel(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(step, rule, remaining) after each rule in turn; one pass."""
    kept, counts = F.lit(True), []
    for i, (name, rule) in enumerate(rules.items()):
        kept = kept & rule.eqNullSafe(F.lit(True))
        counts.append(F.struct(F.lit(i + 1).alias("step"), F.lit(name).alias("rule"), F.count_if(kept).alias("remaining")))
    return df.agg(F.array(*counts).alias("_all")).select(F.explode("_all").alias("_r")).select("_r.*")


def mask(df: DataFrame, columns: list[str], where: Column) -> DataFrame:
    """Null in ``columns`` where the condition is true."""
    return df.withColumns({c: F.when(~F.coalesce(where, F.lit(False)), F.col(c)) for c in columns})


def stratum_weights(strata: list[str], part: Column) -> Column:
    """Rows of the stratum over those of it in ``part``, never divided by zero."""
    w = Window.partitionBy(*strata)
    return F.count("*").over(w) / F.greatest(F.sum(part.cast("long")).over(w), F.lit(1))


def entropy(df: DataFrame, key: str, amount: str) -> DataFrame:
    """(key, n, entropy): Shannon entropy of the shares of ``amount``, over log2 n; 0 with at most one share."""
    w = Window.partitionBy(key)
    p = F.col(amount) / F.sum(amount).over(w)
    shares = df.where(F.col(amount) > 0).withColumn("_p", p)
    e = F.when(F.count("*") > 1, -F.sum(F.col("_p") * F.log2("_p")) / F.log2(F.count("*").cast("double"))).otherwise(0.0)
    return shares.groupBy(key).agg(F.count("*").alias("n"), e.alias("entropy"))


def hash_share(seed: str, key: Column, digits: int = 8) -> Column:
    """A reproducible number in [0, 1] from SHA-256 of ``seed:key``."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256), 1, digits), 16, 10).cast("double") / float(16**digits - 1)


def evenly_spread(order: list, cap: int, *partition: str) -> Column:
    """True for at most ``cap`` rows of the partition at evenly spread places, the first and the last among them."""
    w = Window.partitionBy(*partition)
    n, i = F.count("*").over(w), F.row_number().over(w.orderBy(*order)) - 1
    places = F.transform(F.sequence(F.lit(0), F.lit(cap - 1)), lambda j: F.bround(j * (n - 1) / (cap - 1)).cast("int"))
    return (n <= cap) | F.array_contains(places, i.cast("int"))


def page(df: DataFrame, order: list[tuple[str, bool]], offset: int, limit: int, tie: str, most: int = 500) -> DataFrame:
    """A page of ``df`` with ``total_rows``: by (column, descending) with nulls last both ways, then by ``tie``.

    ``limit`` is 1 to ``most``. Rows up to the page's end are all that a task keeps; a page past the end is empty.
    """
    if not 1 <= limit <= most or offset < 0:
        raise ValueError(f"a page has 1 to {most} rows and starts at 0 or later")
    keys = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in order]
    rows = df.orderBy(*keys, tie).offset(offset).limit(limit)
    return rows.crossJoin(F.broadcast(df.agg(F.count("*").alias("total_rows"))))  # one row


def column_profile(df: DataFrame, column: str, bins: int = 20, top: int = 15) -> DataFrame:
    """(kind, label, n): ``month`` counts of a date or time; ``bin`` counts of equal width of a number with more than ``bins`` distinct
    values (about) that differ; else its ``top`` values with null among them, by count and then by text."""
    name = df.schema[column].dataType.typeName()
    if name in ("date", "timestamp", "timestamp_ntz"):
        month = F.date_format(column, "yyyy-MM")
        return df.where(F.col(column).isNotNull()).groupBy(month.alias("label")).agg(F.count("*").alias("n")).select(F.lit("month").alias("kind"), "label", "n")
    if name in ("byte", "short", "integer", "long", "float", "double", "decimal"):
        seen = df.agg(F.approx_count_distinct(column).alias("d"), F.min(column).alias("lo"), F.max(column).alias("hi")).first()
        if seen["d"] > bins and seen["hi"] > seen["lo"]:
            return histogram(df, column, bins).select(F.lit("bin").alias("kind"), F.col("bin").cast("string").alias("label"), "n")
    return top_values(df.select(F.col(column).cast("string").alias("label")), "label", top).select(F.lit("value").alias("kind"), "label", "n")


def ownership(changes: DataFrame, path: str, author: str, at: str, weight: str, inactive: int, minor: float = 0.05) -> DataFrame:
    """(path, n_owners, top_share, n_minor, minor_share, abandoned_share, entropy) of the weights that authors have in a path.

    Minor owners have less than ``minor``; a share is abandoned if its author has changed nothing, in any path, in the ``inactive``
    seconds before the path's last change; entropy over log2 of the owners, 0 for one. Null authors own nothing.
    """
    known = changes.where(F.col(author).isNotNull())
    last_of = known.groupBy(F.col(author).alias("_a")).agg(F.max(at).alias("_active"))
    mine = known.groupBy(path, author).agg(F.sum(weight).alias("_w"), F.max(at).alias("_own_last"))
    whole = Window.partitionBy(path)
    shares = mine.join(last_of, F.col(author) == F.col("_a")).withColumns({"_share": F.col("_w") / F.nullif(F.sum("_w").over(whole), F.lit(0)), "_path_last": F.max("_own_last").over(whole)})
    s = F.col("_share")
    gone = F.col("_active") < F.col("_path_last") - inactive
    bits = -F.sum(F.when(s > 0, s * F.log2(s)).otherwise(0.0))
    return shares.groupBy(path).agg(
        F.count("*").alias("n_owners"), F.max(s).alias("top_share"), F.count_if(s < minor).alias("n_minor"), F.sum(F.when(s < minor, s).otherwise(0.0)).alias("minor_share"),
        F.sum(F.when(gone, s).otherwise(0.0)).alias("abandoned_share"), F.when(F.count("*") > 1, bits / F.log2(F.count("*").cast("double"))).otherwise(0.0).alias("entropy"),
    )
