"""The registered queries: each reads the tables of a folder and returns a DataFrame.

A query may carry an equivalent SQL text, against which its result is compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


# The modules that register queries.
MODULES = ["quality", "profiling", "text", "registry", "storage"]
