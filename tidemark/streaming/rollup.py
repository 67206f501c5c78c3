"""The event operators over streams: bounded lateness, redelivery, tumbling roll-ups, a keyed stage machine."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def once_each(events: DataFrame, ids: list[str], at: str, delay: str = "1 hour") -> DataFrame:
    """Redelivered events count once within the watermark."""
    return events.withWatermark(at, delay).dropDuplicatesWithinWatermark(ids)


def hourly_counts(events: DataFrame, at: str, by: str, amount: str, delay: str = "160 hours") -> DataFrame:
    """Tumbling hours by a key; events later than the watermark are dropped. Batch input gives the same rows."""
    return (
        events.withWatermark(at, delay)
        .groupBy(F.window(at, "1 hour"), by)
        .agg(F.count("*").alias("n"), F.sum(amount).alias("total"))
        .select(F.unix_seconds("window.start").alias("hour"), by, "n", "total")
    )


def run_states(events: DataFrame, key: str, at: str, kind: str, error: str = "error", restart: str = "signup") -> DataFrame:
    """(key, stage, n_events, n_errors) after each batch: the current stage, reset by a restart, errors counted since."""

    def step(_key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        stage, n, errors = state.get if state.exists else ("", 0, 0)
        for row in pd.concat(list(frames)).sort_values([at, kind]).itertuples():
            what = getattr(row, kind)
            if what == restart:
                n, errors = 0, 0
            stage, n, errors = what, n + 1, errors + (what == error)
        state.update((stage, n, errors))
        yield pd.DataFrame({key: [_key[0]], "stage": [stage], "n_events": [n], "n_errors": [errors]})

    return events.groupBy(key).applyInPandasWithState(step, f"{key} long, stage string, n_events long, n_errors long", "stage string, n long, errors long", "update", "NoTimeout")
