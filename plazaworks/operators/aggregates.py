"""Grouped measures, allocations, imputation, order statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import attach, attach_group
from .keys import latest_per_key
from .windows import BLOCKS, Sampled, with_block


def sum_when(condition: Column, amount) -> Column:
    """Sum over the rows that meet a condition, 0 when there are none."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0))


def ledger_columns(kind: str, amount: str, charges: Mapping[str, tuple[Sequence[str], Sequence[str]]]) -> list[Column]:
    """Aggregates, one per measure: amounts charged minus amounts paid back."""
    k, out = F.col(kind), []
    for name, (back, charged) in charges.items():
        total = sum_when(k.isin(list(charged)), amount)
        out.append((total - sum_when(k.isin(list(back)), amount) if back else total).alias(name))
    return out


def ledger_measures(
    df: DataFrame, keys: Sequence[str], kind: str, amount: str, charges: Mapping[str, tuple[Sequence[str], Sequence[str]]]
) -> DataFrame:
    """All measures of a ledger from one pass and one aggregate."""
    return df.groupBy(*keys).agg(*ledger_columns(kind, amount, charges))


def allocate_evenly(df: DataFrame, keys: Sequence[str], amounts: Sequence[str]) -> DataFrame:
    """Spread a group amount that is repeated on each row evenly over its rows."""
    out = attach_group(df, keys, F.count(F.lit(1)).alias("_n"))
    return out.withColumns({a: F.try_divide(F.col(a), F.col("_n")) for a in amounts}).drop("_n")


def threshold_groups(docs: DataFrame, payer: Sequence[str], amount: str, minimum: float) -> DataFrame:
    """Documents (one row each) of payers whose documents together reach a minimum."""
    payers = docs.groupBy(*payer).agg(F.sum(amount).alias("_total")).where(F.col("_total") >= minimum).select(*payer)
    return docs.join(payers, list(payer), "left_semi")


def frequency_encode(df: DataFrame, cols: Sequence[str], suffix: str = "_enc") -> DataFrame:
    """Count of each row's category as a column."""
    out = df
    for c in cols:
        counts = df.groupBy(c).agg(F.count(F.lit(1)).alias(f"{c}{suffix}"))
        out = attach(out, counts, [c], null_safe=True)
    return out


def value_counts(df: DataFrame, c: str) -> DataFrame:
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))


def control_totals(totals: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Check list: one labelled row per whole-table total; a table with several totals is read once."""
    tables: dict[int, tuple[DataFrame, list[Column]]] = {}
    for n, (df, agg) in totals.items():
        tables.setdefault(id(df), (df, []))[1].append(F.struct(F.lit(n).alias("label"), agg.cast("double").alias("total")))
    rows = [df.agg(F.array(*aggs).alias("_t")).select(F.inline("_t")) for df, aggs in tables.values()]
    return reduce(lambda a, b: a.unionByName(b), rows)


def at_latest(df: DataFrame, period: str) -> DataFrame:
    """Rows of the latest period; the maximum is a scalar subquery, not a collect."""
    return df.where(F.col(period) == df.agg(F.max(period)).scalar())


def upto_latest(df: DataFrame, period: str, where: Column) -> DataFrame:
    """Rows up to the latest period that meets a condition."""
    return df.where(F.col(period) <= df.where(where).agg(F.max(period)).scalar())


def order_statistics(df: DataFrame, group: Sequence[str], value: str, picks: Mapping[str, Column], blocks: int = BLOCKS) -> DataFrame:
    """Exact order statistics per group without gathering a group anywhere.

    ``picks`` maps a name to the 0-based rank wanted, an expression over the
    group's row count ``n``.  Equal values are counted together first.  Sampled
    edges cut the sorted (group, value) pairs into even ranges, whatever the
    values; the exact counts of the ranges tell in which range a rank lies, and
    only the rows of those ranges are looked at a second time.
    """
    known = df.where(F.col(value).isNotNull()).select(*group, F.col(value).cast("double").alias("_x"))
    counts = known.groupBy(*group, "_x").agg(F.count(F.lit(1)).alias("_c"))
    placed = with_block(counts, Sampled([*group, "_x"], blocks, known), "_at")
    ranges = placed.groupBy(*group, "_at").agg(F.sum("_c").alias("_n"))
    # at most ``blocks`` + 1 rows a group
    w = Window.partitionBy(*(group or [F.lit(0)]))
    before = F.coalesce(F.sum("_n").over(w.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.withColumns({"n": F.sum("_n").over(w), "_before": before})
    ranks = F.array(*[F.struct(F.lit(i).alias("_pick"), r.cast("bigint").alias("_rank")) for i, r in enumerate(picks.values())])
    wanted = ranges.select(*group, "_at", "n", "_n", "_before", F.explode(ranks).alias("_p"))
    wanted = wanted.where((F.col("_p._rank") >= F.col("_before")) & (F.col("_p._rank") < F.col("_before") + F.col("_n")))
    # one row a range: several ranks may lie in it
    wanted = wanted.groupBy(*[F.col(g).alias(f"_g_{g}") for g in group], F.col("_at").alias("_r")).agg(F.first("n").alias("n"), F.first("_before").alias("_before"), F.collect_list("_p").alias("_ranks"))
    on = [placed[g].eqNullSafe(F.col(f"_g_{g}")) for g in group] + [placed["_at"] == F.col("_r")]
    second = placed.join(wanted, reduce(lambda a, b: a & b, on)).drop("_r", *[f"_g_{g}" for g in group])
    inner = Window.partitionBy(*group, "_at").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    second = second.withColumn("_upto", F.col("_before") + F.sum("_c").over(inner))
    hit = F.filter("_ranks", lambda p: (F.col("_upto") > p["_rank"]) & (F.col("_upto") - F.col("_c") <= p["_rank"]))
    found = second.select(*group, "n", "_x", F.explode(hit).alias("_p"))
    return found.groupBy(*group).agg(F.first("n").alias("n"), *[F.max(F.when(F.col("_p._pick") == i, F.col("_x"))).alias(name) for i, name in enumerate(picks)])


def medians(df: DataFrame, group: Sequence[str], value: str, name: str) -> DataFrame:
    """Exact median per group (mean of the two middle values)."""
    n = F.col("n")
    stats = order_statistics(df, group, value, {"_a": F.floor((n - 1) / 2), "_b": F.floor(n / 2)})
    return stats.select(*group, ((F.col("_a") + F.col("_b")) / 2).alias(name))


def modes(df: DataFrame, group: Sequence[str], value: str, name: str) -> DataFrame:
    """Most frequent value per group, the smallest of equals."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_c"))
    best = latest_per_key(counts, group, [F.desc("_c"), F.asc(value)]) if group else counts.orderBy(F.desc("_c"), F.asc(value)).limit(1)
    return best.select(*group, F.col(value).alias(name))


def impute_by_group(
    df: DataFrame, group: str, numbers: Sequence[str] = (), texts: Sequence[str] = (), use_group: bool = True, suffix: str = ""
) -> DataFrame:
    """Fill missing numbers with the group's median and texts with its mode.

    A group without any value falls back to the whole table.  With
    ``use_group=False`` the whole-table value is used at once, which is what the
    reports' own fill comes down to.
    """
    out = df
    for c in [*numbers, *texts]:
        make = medians if c in numbers else modes
        fills = []
        if use_group:
            out = attach(out, make(df, [group], c, f"_g_{c}"), [group], null_safe=True)
            fills.append(F.col(f"_g_{c}"))
        fills.append(make(df, [], c, "_w").select("_w").scalar())
        out = out.withColumn(f"{c}{suffix}", F.coalesce(F.col(c), *fills)).drop(f"_g_{c}")
    return out
