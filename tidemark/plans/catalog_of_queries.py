"""All named queries over the test tables, with the SQL that they must agree with."""

from . import chain_queries, cut_queries, fold_queries, history_queries, lifecycle_queries, order_queries, outcome_queries, pit_queries, profile_queries, rank_queries, review_queries, table_queries

MODULES = (pit_queries, table_queries, history_queries, review_queries, rank_queries, outcome_queries, lifecycle_queries, cut_queries, order_queries, fold_queries, chain_queries, profile_queries)
QUERIES: dict = {name: q for m in MODULES for name, q in m.QUERIES.items()}
ORACLE_SQL: dict = {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
