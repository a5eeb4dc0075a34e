"""Unions, differences and the comparison of two sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import anti_join


def union_sources(sources: Mapping[str, DataFrame], tag: str = "source") -> DataFrame:
    """UNION ALL by column name; missing columns become typed NULLs."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """UNION DISTINCT by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()


def new_rows(new: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows not yet in the history, by key."""
    return anti_join(new, history, keys)


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], amount: str, tolerance: float = 0.0) -> DataFrame:
    """Amounts of two sources per key with their difference and a status.

    Both sides are summed first, so the full join is one row against one row.
    """
    left = a.groupBy(*keys).agg(F.sum(amount).alias("amount_a"))
    right = b.groupBy(*keys).agg(F.sum(amount).alias("amount_b"))
    out = left.join(right, list(keys), "full")
    diff = F.coalesce(F.col("amount_a"), F.lit(0)) - F.coalesce(F.col("amount_b"), F.lit(0))
    status = (
        F.when(F.col("amount_a").isNull(), "only_b")
        .when(F.col("amount_b").isNull(), "only_a")
        .when(F.abs(diff) <= tolerance, "equal")
        .otherwise("different")
    )
    return out.withColumns({"difference": diff, "status": status})


def tagged_differences(sources: Mapping[str, DataFrame], keys: Sequence[str], amount: str, trusted: str) -> DataFrame:
    """Stack sources and compare every row with the trusted source's amount of its key."""
    right = sources[trusted].groupBy(*keys).agg(F.min(amount).alias("correct_amount"))
    stacked = union_sources(sources, "origin").join(right, list(keys), "left")
    return stacked.withColumns(
        {
            "consider": F.when(F.col("correct_amount").isNull() & (F.col("origin") != trusted), "NO").otherwise("SI"),
            "correct_amount": F.coalesce(F.col("correct_amount"), F.col(amount)),
        }
    ).withColumn("difference", F.col("correct_amount") - F.col(amount))
