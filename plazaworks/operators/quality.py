"""Outliers, document gaps, incomplete rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import order_statistics
from .joins import attach, attach_group
from .windows import blocked_window


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows without any missing value."""
    return df.na.drop(subset=list(cols) if cols else None)


def zscore_filter(df: DataFrame, group: Sequence[str], cols: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Drop rows further than ``limit`` deviations from their group's mean.

    Groups without spread have no z-score and keep their rows.
    """
    aggs = [a for c in cols for a in (F.avg(c).alias(f"_m_{c}"), F.stddev_samp(c).alias(f"_s_{c}"))]
    out = attach_group(df, group, *aggs)
    z = [F.abs(F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}"))) > limit for c in cols]
    far = reduce(lambda a, b: a | b, [F.coalesce(x, F.lit(False)) for x in z])
    return out.where(~far).select(*df.columns)


def winsorize(df: DataFrame, group: Sequence[str], cols: Sequence[str], tail: float = 0.03) -> DataFrame:
    """Pull the lowest and highest ``tail`` share of each group to the nearest kept value."""
    out, n = df, F.col("n")
    cut = F.floor(n * F.lit(tail))
    for c in cols:
        stats = order_statistics(df, group, c, {"_lo": cut, "_hi": n - cut - 1}).drop("n")
        out = attach(out, stats, group, null_safe=True)
        held = F.least(F.greatest(F.col(c), F.col("_lo")), F.col("_hi"))
        out = out.withColumn(c, F.when(F.col(c).isNotNull(), held)).drop("_lo", "_hi")
    return out


def sequence_gaps(df: DataFrame, series: Sequence[str], number: str, width: int = 1_000_000, chunk: int = 10_000) -> DataFrame:
    """Numbers missing between the smallest and largest of each series.

    Numbers are cut into blocks of ``width`` so that a single long series is
    read by many tasks; a long gap is opened in chunks so that no row ever
    holds more than ``chunk`` numbers.
    """
    n = F.col(number).cast("bigint")
    known = df.where(n.isNotNull()).select(*series, n.alias("_n")).distinct()
    block = F.floor(F.col("_n") / width)
    gaps = blocked_window(known, list(series), ["_n"], block, following={"_next": "_n"}).where(F.col("_next") - F.col("_n") > 1)
    starts = gaps.select(*series, "_next", F.explode(F.sequence(F.col("_n") + 1, F.col("_next") - 1, F.lit(chunk).cast("bigint"))).alias("_from"))
    upto = F.least(F.col("_from") + (chunk - 1), F.col("_next") - 1)
    return starts.select(*series, F.explode(F.sequence(F.col("_from"), upto)).alias(number))


def compare_records(df: DataFrame, rules: dict[str, Column], bad: str = "Corregir", good: str = "Ok") -> DataFrame:
    """One verdict column per rule: ``bad`` where it holds, ``good`` elsewhere."""
    return df.withColumns({n: F.when(cond, bad).otherwise(good) for n, cond in rules.items()})
