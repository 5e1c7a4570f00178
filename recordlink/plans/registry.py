"""Names of the registered queries, each with its check in DuckDB SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recordlink.session import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a key, with the equivalent SQL on the driver tables."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table whose rows are costly to work on, spread over all cores."""
    return spread(table(spark, sf_dir, name).select(*columns))
