"""Rule lists compiled to expressions, and vocabularies looked up in tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sem import ascii_pattern, col
from .joins import attach


def case_first(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """Searched CASE: the first condition that holds gives the value."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    out = reduce(lambda acc, r: acc.when(r[0], as_col(r[1])) if acc is not None else F.when(r[0], as_col(r[1])), rules, None)
    return out if default is None else out.otherwise(as_col(default))


def classify(c, rules: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """Ordered (pattern, label) rules over a text; first match wins."""
    c = col(c)
    return case_first([(c.rlike(ascii_pattern(p)), label) for p, label in rules], default)


def classify_by_prefix(c, lists: Mapping[str, Sequence[str]] = {}, patterns: Mapping[str, str] = {}, default: str = "Otro") -> Column:
    """Label by membership in a list first, then by pattern."""
    c = col(c)
    rules = [(c.isin(list(v)), k) for k, v in lists.items()] + [(c.rlike(ascii_pattern(p)), k) for k, p in patterns.items()]
    return case_first(rules, default)


def null_if_sentinel(c, sentinels: Sequence[str], min_len: int = 0) -> Column:
    """NULL for place-holder texts and for texts that are too short."""
    c = col(c)
    return F.when(~c.isin(list(sentinels)) & (F.length(c) >= min_len), c)


def any_flag(cols: Sequence[str], yes: str = "Si", bad: str = "Incorrecto", good: str = "Correcto") -> Column:
    """``bad`` as soon as one flag column says ``yes``."""
    hits = [F.coalesce(F.col(c) == yes, F.lit(False)) for c in cols]
    return F.when(reduce(lambda a, b: a | b, hits), bad).otherwise(good)


def bands(c, edges: Sequence[tuple[float | None, str]]) -> Column:
    """Label of the first band whose upper edge lies above the value; NULL stays NULL."""
    c = col(c)
    rules = [(c < hi if hi is not None else c.isNotNull(), label) for hi, label in edges]
    return case_first(rules)


def ranges(c, table: Sequence[tuple[float | None, float | None, str]]) -> Column:
    """Label of the first closed range ``lo <= value <= hi`` that holds the value."""
    c = col(c)
    rules = []
    for lo, hi, label in table:
        cond = c.isNotNull()
        if lo is not None:
            cond = cond & (c >= lo)
        if hi is not None:
            cond = cond & (c <= hi)
        rules.append((cond, label))
    return case_first(rules)


def label_rank(c, mapping: Mapping[str, int], default: int) -> Column:
    """Order number of a label."""
    c = col(c)
    return case_first([(c == k, v) for k, v in mapping.items()], default)


def vocabulary(c, groups: Mapping[str, Sequence[str]]) -> Column:
    """Canonical word for a carrier word (compared in upper case); unknown words stay, '' is NULL."""
    c = col(c)
    up = F.upper(c)
    rules = [(up.isin(list(words)), label) for label, words in groups.items()]
    return case_first([*rules, (F.length(c) == 0, F.lit(None).cast("string"))], c)


def map_vocabulary(df: DataFrame, column: str, mapping: DataFrame, source: str, target: str, name: str) -> DataFrame:
    """The same from a table that grows: left join, unknown words stay; of several targets the smallest counts."""
    side = mapping.select(F.upper(F.col(source)).alias("_w"), F.col(target).alias("_t")).groupBy("_w").agg(F.min("_t").alias("_t"))
    out = attach(df.withColumn("_w", F.upper(F.col(column))), side, ["_w"])
    return out.withColumn(name, F.coalesce(F.col("_t"), F.col(column))).drop("_w", "_t")


def scope_commerce(name, seller_id, order_id, names: Sequence[str], label: str, seller_pattern: str, order_pattern: str) -> Column:
    """Commerce of a case: by listed name, else by seller prefix, else by order prefix."""
    name, seller_id, order_id = col(name), col(seller_id), col(order_id)
    other = ~name.isin(list(names))
    return case_first(
        [
            (name.isin(list(names)), label),
            (other & seller_id.rlike(seller_pattern), label),
            (other & order_id.rlike(order_pattern), label),
        ],
        name,
    )


def tariff(amount, size, table: Sequence[tuple], exempt: Column | None = None, default: float = 0.0) -> Column:
    """Fee by size class and price band: rows of (sizes, from, below, fee), first match."""
    amount, size = col(amount), col(size)
    rules = []
    if exempt is not None:
        rules.append((exempt, F.lit(default)))
    for sizes, lo, hi, fee in table:
        cond = F.lit(True)
        if sizes is not None:
            cond = cond & size.isin(list(sizes))
        if lo is not None:
            cond = cond & (amount >= lo)
        if hi is not None:
            cond = cond & (amount < hi)
        rules.append((cond, F.lit(float(fee))))
    return case_first(rules, F.lit(default))


def dated_tariff(at, amount, size, periods: Sequence[tuple], exempt: Column | None = None) -> Column:
    """Tariff of the period a date falls in: (from date, below date, table)."""
    at = col(at)
    rules = []
    for start, end, table in periods:
        cond = at >= F.lit(start).cast("timestamp_ntz")
        if end is not None:
            cond = cond & (at < F.lit(end).cast("timestamp_ntz"))
        rules.append((cond, tariff(amount, size, table, exempt)))
    return case_first(rules, F.lit(0.0))
