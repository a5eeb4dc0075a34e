"""Rows to columns and back, lists in a cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import attach
from .windows import Sampled, blocked_window


def eav_pivot(df: DataFrame, keys: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """Attribute rows to one column per listed attribute (largest value wins)."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names])


def status_time(
    df: DataFrame, keys: Sequence[str], status: str, ts: str, values: Sequence[str], prefix: str = "time_", first_for: Sequence[str] = ()
) -> DataFrame:
    """One ``time_<status>`` column per listed status.

    The latest time of a status counts, except for ``first_for`` statuses where
    the earliest does.  One partial aggregate, no pivot pass over the values.
    """
    cols = []
    for v in values:
        at = F.when(F.col(status) == v, F.col(ts))
        cols.append((F.min(at) if v in first_for else F.max(at)).alias(f"{prefix}{v}"))
    return df.groupBy(*keys).agg(*cols)


def unpivot_times(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str, value: str) -> DataFrame:
    """Wide times to (status, time) rows; missing times give no row."""
    return melt(df, ids, cols, name, value).where(F.col(value).isNotNull())


def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str, value: str) -> DataFrame:
    """Columns to rows, NULLs kept."""
    return df.unpivot(list(ids), list(cols), name, value)


def pivot_agg(df: DataFrame, keys: Sequence[str], column: str, values: Sequence, agg, prefix: str = "") -> DataFrame:
    """Cross table with a stated aggregate; ``agg`` maps a masked column to an aggregate.

    Rows without a key are left out, as a cross table does.
    """
    known = df.where(~F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)))
    return known.groupBy(*keys).agg(*[agg(F.col(column) == v).alias(f"{prefix}{v}") for v in values])


def concat_values(c, sep: str = "|", distinct: bool = True) -> Column:
    """Aggregate: values of a group as one text, in sorted order.

    The distinct form buffers each value once per task; use the plain form only
    where a group is known to be short, because its text lists every row.
    """
    c = F.col(c).cast("string") if isinstance(c, str) else c
    return F.array_join(F.sort_array(F.collect_set(c) if distinct else F.collect_list(c)), sep)


def single_or_list(df: DataFrame, keys: Sequence[str], cols: Sequence[str], sep: str = "|", more: Sequence[Column] = ()) -> DataFrame:
    """The value where a key has one distinct value, else all of them joined.

    ``more`` are further aggregates to take in the same pass.
    """
    aggs = [concat_values(c, sep).alias(f"_t_{c}") for c in cols]
    out = df.groupBy(*keys).agg(*aggs, *more)
    # one distinct value joins to itself, none joins to '': that is NULL again
    texts = {c: F.when(F.col(f"_t_{c}") != "", F.col(f"_t_{c}")) for c in cols}
    rest = [c for c in out.columns if c not in keys and not c.startswith("_t_")]
    return out.select(*keys, *[e.alias(c) for c, e in texts.items()], *rest)


def list_pages(df: DataFrame, keys: Sequence[str], value: str, most: int = 1000, sep: str = "|", name: str = "listed") -> DataFrame:
    """The distinct values of each key in sorted order, in texts of at most ``most`` values: keys, page, pages, values, ``name``.

    Page 0 is the cell of a report; the pages after it are the overflow of keys
    with more values, so no cell grows with the data and no value is lost.
    Values are numbered in blocks between sampled edges, and no task sees all
    values of a key.  NULL values are left out; NULL keys are a key.
    """
    text = F.col(value).cast("string").alias("_v")
    known = df.where(F.col(value).isNotNull()).select(*keys, text).distinct()
    rows = blocked_window(known, keys, ["_v"], Sampled([*keys, "_v"]), row_number="_n", group_count="values")
    page = F.floor((F.col("_n") - 1) / most).cast("int")
    out = rows.groupBy(*keys, page.alias("page"), "values").agg(F.array_join(F.sort_array(F.collect_list("_v")), sep).alias(name))
    return out.select(*keys, "page", F.ceil(F.col("values") / most).cast("int").alias("pages"), "values", name)


def pivot_concat(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], text: str, sep: str = ",") -> DataFrame:
    """Cross table whose cells list the distinct texts."""
    out = df.groupBy(*keys).agg(
        *[concat_values(F.when(F.col(column) == v, F.col(text)), sep).alias(v) for v in values]
    )
    return out.select(*keys, *[F.when(F.col(v) != "", F.col(v)).alias(v) for v in values])


def class_distribution(df: DataFrame, key: str, order: str) -> DataFrame:
    """Share and running share of each ordered class per key.

    The window runs over the class counts, which are one row per (key, class).
    """
    counts = df.where(F.col(order).isNotNull()).groupBy(key, order).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(key)
    upto = w.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumns(
        {"share": F.col("n") / F.sum("n").over(w), "cumulative_share": F.sum("n").over(upto) / F.sum("n").over(w)}
    )


def plausible_interval(df: DataFrame, key: str, order: str, lo: float, hi: float, classes: Sequence[int], skip_first: bool = True) -> DataFrame:
    """Flag rows whose class lies in the plausible interval of their key.

    The interval starts at the first class whose running share exceeds ``lo``
    and ends at the last class whose running share is below ``hi``.  With
    ``skip_first`` the first class is never looked at, as the reports do; where
    no class qualifies the search falls back to its starting point.
    """
    looked = list(classes[1:] if skip_first else classes)
    counts = df.where(F.col(order).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count(F.when(F.col(order) <= c, 1)).alias(f"_c{c}") for c in looked]
    )
    share = {c: F.col(f"_c{c}") / F.col("_n") for c in looked}
    low = F.coalesce(*[F.when(share[c] > lo, F.lit(c)) for c in looked], F.lit(looked[0]))
    high = F.coalesce(*[F.when(share[c] < hi, F.lit(c)) for c in reversed(looked)], F.lit(looked[-1]))
    limits = counts.select(key, low.alias("min_class"), high.alias("max_class"))
    ok = (F.col(order) >= F.col("min_class")) & (F.col(order) <= F.col("max_class"))
    return attach(df, limits, [key]).withColumn("plausible", F.coalesce(ok.cast("int"), F.lit(0)))


def previous_states(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: dict[str, str], block=None) -> DataFrame:
    """History rows with the state that came before each of them."""
    return blocked_window(df, keys, order, block, previous=cols)
