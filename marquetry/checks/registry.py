"""Collects the queries and their SQL under the function's name or a given one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_schemas: dict[str, StructType] = {}


def check(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        key = name or query.__name__
        QUERIES[key] = query
        ORACLES[key] = sql
        return query

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table; its schema is read from the footer only the first time."""
    path = f"{sf.rstrip('/')}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)
