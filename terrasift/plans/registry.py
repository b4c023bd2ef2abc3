"""Queries of the engine and their oracle SQL; each module of plans adds to these with ``query``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) -> DataFrame callable with its DuckDB equivalent."""

    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
