"""One row per key, first k rows per key, priorities among duplicates.

All of these filter ``row_number() <= k`` right above the window, which Spark
turns into a group limit *before* the shuffle: each input partition sends at
most ``k`` rows per key, so a key that holds a third of the table stays small.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of each key with their position.

    ``order`` must be total (end it with a unique column), otherwise ties are
    broken at random.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``."""
    return top_per_key(df, keys, order, 1, "_rn").drop("_rn")


def nth_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The ``k``-th row of each key; keys with fewer rows are absent."""
    return top_per_key(df, keys, order, k, "_rn").where(F.col("_rn") == k).drop("_rn")


def first_k_wide(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], cols: Sequence[str], k: int, names: str = "{col}_{i}"
) -> DataFrame:
    """First ``k`` values of each column side by side."""
    top = top_per_key(df, keys, order, k, "_rn")
    wide = [
        F.max(F.when(F.col("_rn") == i, F.col(c))).alias(names.format(col=c, i=i))
        for i in range(1, k + 1)
        for c in cols
    ]
    return top.groupBy(*keys).agg(*wide)


def first_last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``first_<col>`` and ``last_<col>`` of each key in ascending ``order``.

    Two partial aggregates; no rows are sorted or gathered per key.
    """
    by, row = F.struct(*order), F.struct(*cols)
    out = df.groupBy(*keys).agg(F.min_by(row, by).alias("_f"), F.max_by(row, by).alias("_l"))
    return out.select(
        *keys,
        *[F.col(f"_f.{c}").alias(f"first_{c}") for c in cols],
        *[F.col(f"_l.{c}").alias(f"last_{c}") for c in cols],
    )


def priority_dedup(
    sources: Sequence[DataFrame], keys: Sequence[str], order: Sequence[Column] = (), priority: str = "priority"
) -> DataFrame:
    """Stack sources in order of trust and keep the most trusted row per key."""
    tagged = [s.withColumn(priority, F.lit(i)) for i, s in enumerate(sources, 1)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return latest_per_key(stacked, keys, [F.col(priority).asc(), *order])


def drop_duplicates_ordered(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``keep='first'`` under a stated order (for ``'last'`` reverse the order)."""
    return latest_per_key(df, keys, order)


def flag_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], row_id: Sequence[str], flag: str) -> DataFrame:
    """Mark the first row of each key and keep all rows.

    ``row_id`` identifies a row.  The firsts are found under the group limit and
    joined back on the row id, so rows of a hot key spread over all tasks.
    """
    ids = list(dict.fromkeys([*keys, *row_id]))
    firsts = latest_per_key(df, keys, order).select(*ids)
    on = reduce(lambda a, b: a & b, [F.col(f"d.{c}").eqNullSafe(F.col(f"f.{c}")) for c in ids])
    joined = df.alias("d").join(firsts.withColumn("_hit", F.lit(True)).alias("f"), on, "left")
    return joined.select("d.*", F.coalesce(F.col("f._hit"), F.lit(False)).alias(flag))


def amount_on_first_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], row_id: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """Keep amounts on the first row of a group and zero the repeats."""
    marked = flag_first(df, keys, order, row_id, "_first")
    return marked.withColumns(
        {c: F.when(F.col("_first"), F.coalesce(F.col(c), F.lit(0))).otherwise(F.lit(0)) for c in cols}
    ).drop("_first")


def dominant_label(df: DataFrame, key: str, label: str, counted: str, count: str = "n") -> DataFrame:
    """Label with the most distinct ``counted`` values per key; ties go to the smaller label."""
    sizes = df.groupBy(key, label).agg(F.count_distinct(counted).alias(count))
    return latest_per_key(sizes, [key], [F.col(count).desc(), F.col(label).asc()])


def rank_groups(df: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    """Group sizes, largest first."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).orderBy(F.desc(count), *keys)


def top_groups(df: DataFrame, keys: Sequence[str], k: int, count: str = "n") -> DataFrame:
    """The ``k`` largest groups."""
    return rank_groups(df, keys, count).limit(k)
