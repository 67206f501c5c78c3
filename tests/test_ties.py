"""Queries of events agree with their SQL where events fall into one second."""

import duckdb
import pandas as pd
import pytest
from test_queries import rows

from tidemark.plans.catalog_of_queries import ORACLE_SQL, QUERIES

DAY = 86_400
# (user, seconds, type): errors of one second, views and clicks of one second, quiet views
EVENTS = [
    (1, 10, "signup"), (1, 40, "signup"), (1, 70, "signup"), (1, 80, "click"), (1, 90, "error"), (1, 90, "error"), (1, 95, "error"),
    (2, 10, "error"), (2, 10, "error"), (2, 11, "purchase"),
    (3, 100, "view"), (3, 100, "click"), (4, 100, "view"), (4, 100, "view"), (5, 100, "view"), (5, 100 + DAY, "click"),
    (6, 100, "view"), (6, 101 + DAY, "click"), (7, 100, "view"), (7, 101, "click"), (8, 5, "error"), (8, 5, "error"), (8, 5, "error"),
]


def written(folder, events):
    at = pd.Timestamp("2024-01-01")
    made = pd.DataFrame([(i, at + pd.Timedelta(t, "s"), u, k, float(i)) for i, (u, t, k) in events], columns=["event_id", "ts", "user_id", "event_type", "value"])
    made["ts"] = made["ts"].astype("datetime64[us]")
    made.to_parquet(folder / "events.parquet")


def test_deltas_of_one_second_go_by_event(spark, tmp_path):
    written(tmp_path, [(i, (1, 7, "view")) for i in (9, 4, 6, 1)])
    got = QUERIES["e32_deltas"](spark, str(tmp_path)).toPandas()
    assert rows(got[["d_amount"]]) == [("2",), ("3",), ("3",), ("~",)]


@pytest.mark.parametrize("name", ["e29_state_at_moment", "e21_cycle_position", "k2_event_triggers"])
def test_events_of_one_second(spark, tmp_path, name):
    written(tmp_path, list(enumerate(EVENTS)))
    con = duckdb.connect()
    con.sql(f"create view events as select * from read_parquet('{tmp_path}/events.parquet')")
    assert rows(QUERIES[name](spark, str(tmp_path)).toPandas()) == rows(con.sql(ORACLE_SQL[name]).df())
