"""Named queries over the given tables, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from lacuna.session import ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name; ``sql`` is the equivalent SQL."""

    def register(fn: Query) -> Query:
        if fn.__name__ in QUERIES:
            raise ValueError(f"query {fn.__name__} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return fn(spark, folder)

        QUERIES[fn.__name__] = run
        if sql:
            SQL[fn.__name__] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
