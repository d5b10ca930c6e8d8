"""Registry of named queries and their DuckDB oracle SQL.

A query is ``(spark, sf_dir) -> DataFrame`` over the given tables (through
the fixture views); the oracle is an independent SQL text over the same
parquet tables.  Queries without an exact SQL form (model fits, streams)
register no oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
OPERATOR_IDS: dict[str, str] = {}


def query(name: str, op_id: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        OPERATOR_IDS[name] = op_id
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco
