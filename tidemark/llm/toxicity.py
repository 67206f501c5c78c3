"""Toxicity by cumulative-link ordinal regression on sparse text features.

P(grade >= k | x) = sigmoid(w.x - b_k) with one weight vector w for all thresholds b_1 < b_2 < ...; the expected
severity is the sum of P(grade >= k). Grades come from labels alone: 0 for clean rows, 1 for clean rows of poor quality
(a null quality is not poor), 2 for toxic ones, the top grade, so that no number of toxic words is too many.

Features are the presence of words and of word stems. The fit uses at most ``SAMPLE`` labelled rows (those with the
smallest hash of doc_id); Spark counts the sample's features by label, and each enters with its evidence: the log-odds
between toxic and clean rows in either direction, drawn in by what chance would show among so many features (of the
likelihood ratio G of a feature and m features, the share 1 - ``CHANCE`` ln m / G). Features without evidence weigh nothing;
there is no limit on the others, so the model's size follows the sample's vocabulary, and all words of all texts count.

Defined results: a null or empty text has no features and so the severity of the thresholds alone; rows without label
or with a null one are not fitted; repeated rows are judged alike; texts of any length are read whole, as a set of
distinct words; with no toxic or no clean label every severity is that of the labels' base rate; columns other than
doc_id and text are ignored and kept, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_names, materialize, other_columns

SAMPLE = 6_000
#: A feature is in at least so many labelled rows; fewer show nothing.
LEAST_ROWS = 3
#: Prefixes, in characters, that are features beside whole words, so that inflected forms share a weight.
STEMS = (4, 5, 6, 7)
#: How much of what chance would show is taken off; chosen on held-out labels.
CHANCE = 0.8
RIDGE, STEPS, DECISION = 5e-5, 400, 0.5
PUNCTUATION = string.punctuation


def words_of(text: str | None) -> set[str]:
    """Distinct lower-case words without punctuation at their ends."""
    return {w.strip(PUNCTUATION) for w in set(text.lower().split())} - {""} if text else set()


def features_of(word: str) -> list[str]:
    """The word itself, and its stems, marked."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) >= n)]


@dataclass
class Model:
    """Weights of words and stems, and thresholds in rising order."""

    weights: dict[str, float]
    thresholds: np.ndarray

    def latent(self, texts) -> np.ndarray:
        """w.x of each text: a sparse product over the batch, in which a word is looked up once."""
        number = {f: i for i, f in enumerate(self.weights)}
        weight = np.array(list(self.weights.values()), dtype=float)
        known: dict[str, list[int]] = {}
        rows, columns = [], []
        for row, text in enumerate(texts):
            for w in words_of(text):
                found = known.get(w)
                if found is None:
                    found = known[w] = [number[f] for f in features_of(w) if f in number]
                if found:
                    rows += [row] * len(found)
                    columns += found
        once = np.unique(np.array(rows, dtype=np.int64) * max(1, len(weight)) + np.array(columns, dtype=np.int64))
        row, column = np.divmod(once, max(1, len(weight)))
        return np.bincount(row, weight[column] if len(weight) else None, len(texts)).astype(float)

    def at_least(self, texts) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... by text."""
        return sigmoid(self.latent(texts)[:, None] - self.thresholds[None, :])


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_ordinal(rows: list[np.ndarray], scale: np.ndarray, grades: np.ndarray, levels: int, steps: int = STEPS, ridge: float = RIDGE, least: float = 0.0):
    """Weights and thresholds maximising the cumulative-link likelihood by Adam. ``rows``: feature numbers of each row;
    a present feature has the value ``scale``, whose sign its weight keeps (unless ``least`` is below zero)."""
    n_features = len(scale)
    index = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    value = scale[index]
    base = np.array([np.clip((grades >= k).mean(), 1e-4, 1 - 1e-4) for k in range(1, levels)])
    first = -np.log(base / (1 - base))
    # thresholds rise by construction: the first, then exp of the gaps
    theta = np.concatenate([np.zeros(n_features), first[:1], np.log(np.maximum(np.diff(first), 1e-3))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        w, gaps = theta[:n_features], np.exp(theta[n_features + 1 :])
        cut = theta[n_features] + np.concatenate([[0], np.cumsum(gaps)])
        z = np.bincount(owner, w[index] * value, len(rows))
        above = sigmoid(z[:, None] - cut[None, :])  # P(grade >= k)
        edge = np.concatenate([np.ones((len(rows), 1)), above, np.zeros((len(rows), 1))], axis=1)
        slope = np.concatenate([np.zeros((len(rows), 1)), above * (1 - above), np.zeros((len(rows), 1))], axis=1)
        own = np.arange(len(rows))
        p = np.maximum(edge[own, grades] - edge[own, grades + 1], 1e-12)
        low, high = slope[own, grades] / p, slope[own, grades + 1] / p  # d log p / dz = low - high
        dz = (low - high) / len(rows)
        dcut = np.array([(-low[grades == k].sum() + high[grades == k - 1].sum()) / len(rows) for k in range(1, levels)])
        dgap = np.array([dcut[i + 1 :].sum() * gaps[i] for i in range(len(gaps))])
        g = np.concatenate([np.bincount(index, dz[owner] * value, n_features) - ridge * w, [dcut.sum()], dgap])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta + 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        theta[:n_features] = np.maximum(theta[:n_features], least)
    gaps = np.exp(theta[n_features + 1 :])
    return theta[:n_features] * scale, theta[n_features] + np.concatenate([[0], np.cumsum(gaps)])


def fit_model(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows, those with the smallest hash of doc_id.

    Texts become features on the executors; the driver gets rows' features with evidence, never texts.
    """
    wanted = (
        labels.where("toxic is not null and doc_id is not null")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        .select(F.col("doc_id").alias("labelled"), (F.col("toxic") == 1).alias("toxic"), F.coalesce(F.col("quality") == 0, F.lit(False)).alias("poor"))
    )

    def featured(frames):
        for frame in frames:
            found = [sorted({f for w in words_of(t) for f in features_of(w)}) for t in frame["text"]]
            yield pd.DataFrame({"hash": frame["hash"], "toxic": frame["toxic"], "poor": frame["poor"], "features": found})

    chosen = docs.select("doc_id", "text").join(F.broadcast(wanted), F.col("doc_id") == F.col("labelled"))  # at most ``sample`` narrow rows
    chosen = chosen.withColumn("hash", F.xxhash64("doc_id", "text")).orderBy(F.xxhash64("doc_id"), "doc_id", "hash").limit(sample)
    rows = materialize(chosen.select("hash", "toxic", "poor", "text").repartition("hash").mapInPandas(featured, "hash long, toxic boolean, poor boolean, features array<string>"))
    sides = rows.agg(F.count_if("toxic").alias("n1"), F.count_if(~F.col("toxic")).alias("n0")).first()
    n1, n0 = float(sides["n1"]), float(sides["n0"])
    if not n1 or not n0:
        share = float(np.clip(n1 / (n1 + n0) if n1 + n0 else 0.0, 1e-4, 1 - 1e-4))
        return Model({}, np.array([-np.log(share / (1 - share))]))
    a, b = F.col("a"), F.col("b")  # clean and toxic rows with the feature
    odds = F.log((b + 0.5) / (n1 - b + 0.5)) - F.log((a + 0.5) / (n0 - a + 0.5))

    def against_chance(seen, side):
        return sum((F.when(x > 0, x * F.log(x * (n0 + n1) / (n * side))).otherwise(0.0) for x, n, side in ((seen, a + b, side), (side - seen, n0 + n1 - a - b, side))), F.lit(0.0))

    ratio = 2 * (against_chance(a, n0) + against_chance(b, n1))
    counted = materialize(
        rows.select("toxic", F.explode("features").alias("feature"))
        .groupBy("feature").agg(F.count_if(~F.col("toxic")).alias("a"), F.count_if("toxic").alias("b"))
        .where(F.col("a") + F.col("b") >= LEAST_ROWS)
    )
    by_chance = CHANCE * float(np.log(max(2, counted.count())))
    evidence = materialize(counted.where(ratio > by_chance).select("feature", (odds * (1 - by_chance / ratio)).alias("evidence")))
    known = evidence.orderBy("feature").toPandas()
    told = rows.select("hash", F.explode("features").alias("feature")).join(evidence, "feature").groupBy("hash").agg(F.sort_array(F.collect_set("feature")).alias("told"))
    got = rows.select("hash", "toxic", "poor").join(told, "hash", "left").orderBy("hash", "toxic", "poor").toPandas()
    number = {f: i for i, f in enumerate(known["feature"])}
    index = [np.array([number[f] for f in x] if x is not None else [], dtype=np.int64) for x in got["told"]]
    grades = np.where(got["toxic"], 2, got["poor"].to_numpy(np.int64))
    present = np.unique(grades)  # grades that no row has are left out, order kept
    weights, thresholds = fit_ordinal(index, known["evidence"].to_numpy(float), np.searchsorted(present, grades), len(present))
    return Model({f: float(w) for f, w in zip(known["feature"], weights, strict=True) if w}, thresholds)


def _judged(docs: DataFrame, model: Model, name: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)  # words and stems with evidence in at most SAMPLE rows

    @F.pandas_udf("struct<severity double, p_toxic double>")
    def judge(text: pd.Series) -> pd.DataFrame:
        p = shared.value.at_least(text)
        return pd.DataFrame({"severity": p.sum(axis=1), "p_toxic": p[:, -1]})

    return docs.withColumn(name, judge(F.col("text")))


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with expected_severity (0 to the highest grade) and p_toxic, the chance of the highest; they replace
    columns of these names."""
    others, [judged] = other_columns(docs.columns, "expected_severity", "p_toxic"), free_names(docs.columns, "judged")
    return _judged(docs, model, judged).select(*others, F.col(f"{judged}.severity").alias("expected_severity"), F.col(f"{judged}.p_toxic").alias("p_toxic"))


def keep_clean(docs: DataFrame, labels: DataFrame, decision: float = DECISION) -> DataFrame:
    """``docs``, same columns, without the rows whose chance of the highest grade exceeds ``decision``."""
    [judged] = free_names(docs.columns, "judged")
    return _judged(docs, fit_model(docs, labels), judged).where(F.col(f"{judged}.p_toxic") <= decision).select(*docs.columns)
