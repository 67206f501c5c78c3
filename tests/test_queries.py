"""Every core query with SQL agrees with DuckDB on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from tidemark.plans.catalog_of_queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(frame):
    def plain(x):
        if x is None or (not hasattr(x, "__len__") and pd.isna(x)):
            return "~"
        if isinstance(x, bool) or type(x).__name__ == "bool_":
            return str(bool(x))
        return f"{float(x):.6g}" if type(x).__name__ not in ("str", "date", "ndarray", "Timestamp") else str(x)

    frame = frame[sorted(frame.columns)]
    return sorted(map(tuple, frame.astype(object).map(plain).values.tolist()))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    ours, theirs = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLE_SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)
