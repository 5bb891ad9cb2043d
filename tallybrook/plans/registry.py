"""Name -> (query, SQL). A query takes the session and the folder of the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the DuckDB SQL for the same result."""

    def register(fn: Query) -> Query:
        QUERIES[name or fn.__name__] = fn
        if sql is not None:
            ORACLES[name or fn.__name__] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def window_start_sql(ts: str, seconds: int) -> str:
    """Epoch-aligned window start in DuckDB (``time_bucket`` has another origin)."""
    us = f"({seconds}::BIGINT * 1000000)"
    return f"make_timestamp(epoch_us({ts}) // {us} * {us})"
