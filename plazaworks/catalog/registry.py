"""Name -> query and name -> checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from ..sources.readers import scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one scale folder, read on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def __call__(self, name: str, *cols: str) -> DataFrame:
        return scan(self.spark, f"{self.folder}/{name}.parquet", cols or None)


def query(sql: str | None = None):
    """Register a function ``(tables) -> DataFrame`` under its own name."""

    def add(fn: Callable[[Tables], DataFrame]):
        name = fn.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def money(c) -> Column:
    """Exact amount, so that sums do not depend on their order."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def num(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def day(c) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def stamp(c) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
