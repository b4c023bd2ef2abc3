"""Where operators' modules put their queries and the SQL that DuckDB can check them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) -> DataFrame callable, with its SQL where SQL can express it."""

    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return put
