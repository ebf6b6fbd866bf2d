"""Registry behind ``__spark_entry__.queries()`` / ``oracle_sql()``.

Each registered query is ``fn(spark, sf_dir) -> DataFrame`` over the given
tables; ``sql`` is an independent DuckDB statement computing the same rows
with the same column names.  Queries that are not deterministic (samples,
partition layout) register without SQL.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco
