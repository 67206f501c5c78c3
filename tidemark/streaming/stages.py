"""The keyed stage machine over a stream: typed state and event-time timers; late events are put in order before they count."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Setting that the state store needs; streams of this module want it in their session.
ROCKS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class StageMachine(StatefulProcessor):
    """Events wait in the state until the watermark has passed them and are then folded in order of time and tie."""

    def __init__(self, key: str, error: str, restart: str):
        self.key, self.error, self.restart = key, error, restart

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "stage string, n long, errors long, since long, last_t long")
        self.waiting = handle.getListState("waiting", "t long, tie long, kind string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for t, tie, kind in zip(frame["t"], frame["tie"], frame["kind"], strict=True):
                self.waiting.appendValue((int(t), int(tie), kind))
                self.handle.registerTimer(int(t) * 1000)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = expiredTimerInfo.getExpiryTimeInMs() // 1000
        waiting = sorted((int(r[0]), int(r[1]), r[2]) for r in self.waiting.get())
        due = [r for r in waiting if r[0] <= until]
        if not due:
            return
        stage, n, errors, since, last_t = self.state.get() if self.state.exists() else (None, 0, 0, due[0][0], 0)
        for t, _, kind in due:
            if kind == self.restart:
                n, errors, since = 0, 0, t
            stage, n, errors, last_t = kind, n + 1, errors + (kind == self.error), t
        self.state.update((stage, n, errors, since, last_t))
        self.waiting.clear()
        rest = [r for r in waiting if r[0] > until]
        if rest:
            self.waiting.put(rest)
        yield pd.DataFrame({self.key: [key[0]], "stage": [stage], "n_events": [n], "n_errors": [errors], "since": [since], "last_t": [last_t]})


def run_states(events: DataFrame, key: str, at: str, tie: str, kind: str, error: str, restart: str, delay: str = "1 hour") -> DataFrame:
    """(key, stage, n_events, n_errors, since, last_t) of a key whenever the watermark passes events of it; the last row of a key
    is that of the batch form over the events up to the watermark. Events later than ``delay`` are dropped."""
    shaped = events.withWatermark(at, delay).select(F.col(key), F.col(at), F.unix_seconds(at).alias("t"), F.col(tie).cast("long").alias("tie"), F.col(kind).alias("kind"))
    schema = f"{key} {events.schema[key].dataType.simpleString()}, stage string, n_events long, n_errors long, since long, last_t long"
    return shaped.groupBy(key).transformWithStateInPandas(StageMachine(key, error, restart), schema, "Update", "EventTime")
