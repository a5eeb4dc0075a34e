"""Name -> query and name -> checking SQL of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.readers import scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str, *cols: str) -> DataFrame:
    """One table of a scale folder, pruned to the columns named."""
    return scan(spark, f"{folder}/{name}.parquet", cols or None)


def register(name: str, fn: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} registered twice")
    QUERIES[name] = fn
    if sql is not None:
        ORACLES[name] = sql
