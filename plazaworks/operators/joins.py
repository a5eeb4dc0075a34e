"""Joins: cascades, unique matches, positions, prefixes, effective dates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sem import regexp_extract_all_n
from ..session import discard, in_slices, store
from .windows import Sampled, blocked_window, carry_last, with_sequence


def _same(keys: Sequence[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys])


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Left join of one-row-per-key ``stats``; size decides broadcast at run time.

    ``null_safe`` lets NULL keys meet, as grouped statistics need.  Without keys
    the single row of ``stats`` is read as a scalar subquery.
    """
    if not keys:
        row = stats.select(F.struct("*").alias("s")).scalar()
        return df.withColumn("_s", row).select(*df.columns, *[F.col(f"_s.`{c}`") for c in stats.columns])
    if not null_safe:
        return df.join(stats, list(keys), "left")
    new = [c for c in stats.columns if c not in keys]
    return df.alias("d").join(stats.alias("s"), _same(keys, "d", "s"), "left").select("d.*", *[f"s.`{c}`" for c in new])


def attach_one(df: DataFrame, side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of a table that may hold a key more than once: its smallest row counts, so ``df`` keeps its rows."""
    rest = [c for c in side.columns if c not in keys]
    one = side.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*")
    return attach(df, one, keys)


def attach_group(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Group statistics on every row.

    The statistics come from a partial aggregate, not from a window, so a hot
    key is reduced before it moves.
    """
    return attach(df, df.groupBy(*keys).agg(*aggs), keys, null_safe=True)


def anti_join(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key is not in ``b``."""
    return a.join(b.select(*keys), list(keys), "left_anti")


def exclude_keys(df: DataFrame, key: str, listed: DataFrame) -> DataFrame:
    """Drop listed keys; rows without a key are dropped too, as ``NOT IN`` does."""
    return anti_join(df.where(F.col(key).isNotNull()), listed, [key])


def keep_keys(df: DataFrame, key: str, agg: Column, test) -> DataFrame:
    """Rows of the keys whose aggregate passes ``test(column)``."""
    good = df.groupBy(key).agg(agg.alias("_a")).where(test(F.col("_a"))).select(key)
    return df.join(good, key, "left_semi")


def flag_by_group(df: DataFrame, key: str, flags: dict[str, Column]) -> DataFrame:
    """Aggregate predicates of the row's group as boolean columns."""
    stats = df.groupBy(key).agg(*[c.alias(n) for n, c in flags.items()])
    return attach(df, stats, [key]).withColumns({n: F.coalesce(F.col(n), F.lit(False)) for n in flags})


def key_conflict_flag(df: DataFrame, keys: Sequence[str], owner: str, name: str = "observation") -> DataFrame:
    """'OK' where a key has one owner, 'NOK' where it has several."""
    stats = df.groupBy(*keys).agg((F.min(owner) == F.max(owner)).alias("_one"))
    return attach(df, stats, keys, null_safe=True).withColumn(name, F.when(F.col("_one"), "OK").otherwise("NOK")).drop("_one")


def cascade_join(
    left: DataFrame, rules: Sequence[tuple[Sequence[Column], DataFrame, Sequence[str], str]], name: str, default=None
) -> DataFrame:
    """First rule that has a value wins.

    A rule is (left key expressions, right table, right keys, right value).  All
    rules are looked up side by side and coalesced, instead of splitting the
    rows after each try; each right side is reduced to one row per key first
    (smallest value), so the left row count never changes.
    """
    out, found = left, []
    for i, (exprs, right, right_keys, value) in enumerate(rules):
        lk, v = [f"_k{i}_{j}" for j in range(len(exprs))], f"_v{i}"
        side = right.where(F.col(value).isNotNull()).groupBy(*[F.col(k).alias(l) for k, l in zip(right_keys, lk)])
        side = side.agg(F.min(value).alias(v))
        out = out.withColumns(dict(zip(lk, exprs))).join(side, lk, "left").drop(*lk)
        found.append(v)
    tail = [] if default is None else [F.lit(default)]
    return out.withColumn(name, F.coalesce(*[F.col(v) for v in found], *tail)).drop(*found)


def longest_prefix_match(
    df: DataFrame, code: str, codes: DataFrame, codes_key: str, lens: Sequence[int], name: str, keep_code: bool = True
) -> DataFrame:
    """Longest listed prefix of a hierarchical code; the code itself if none is listed."""
    listed = codes.select(F.col(codes_key).alias("_p")).where(F.col("_p").isNotNull()).distinct()
    out, hits = df, []
    for n in sorted(lens, reverse=True):
        side = listed.where(F.length("_p") == n).select(F.col("_p").alias(f"_p{n}"), F.lit(True).alias(f"_h{n}"))
        out = out.withColumn(f"_p{n}", F.substring(code, 1, n)).join(side, f"_p{n}", "left")
        hits.append(F.when(F.col(f"_h{n}"), F.col(f"_p{n}")))
    last = [F.col(code)] if keep_code else []
    return out.withColumn(name, F.coalesce(*hits, *last)).drop(*[f"{p}{n}" for n in lens for p in ("_p", "_h")])


def unique_values(right: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys that identify exactly one value, with that value.

    Smallest and largest value agree exactly when there is one, so no distinct
    count (and no second shuffle) is needed.
    """
    spread = right.groupBy(*keys).agg(F.min(value).alias(value), F.max(value).alias("_max"))
    return spread.where(F.col(value) == F.col("_max")).drop("_max")


def join_if_unique(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Left join that only trusts keys with a single candidate value."""
    return attach(left, unique_values(right, keys, value), keys)


def _halves(seed: int, *parts: Column) -> list[Column]:
    """96 bits of some values, in two columns."""
    return [F.xxhash64(F.lit(seed), *parts), F.hash(F.lit(seed), *parts)]


def _key(rule: int, parts: Sequence[Column]) -> list[Column]:
    """96 bits of a rule's number and its key, in two columns; null where a part is null."""
    known = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    return [F.when(known, h).alias(n) for n, h in zip(("_h", "_i"), _halves(rule, *parts))]


#: Rows of a side from which rules are looked up one after another, and how many are stored together.
ROWS_AT_ONCE, RULES_AT_ONCE = 2_000_000, 5


def first_unique_match(
    left: DataFrame, right: DataFrame, rules: Sequence[tuple[Sequence[Column], Sequence[Column]]], value: str, number: str = "rule",
    made: dict[str, Column] | None = None, told: Sequence[str] | None = None, rows: int | None = None,
) -> DataFrame:
    """``left`` with the ``value`` of the first rule whose key stands for exactly one value of ``right``.

    A rule is (left key expressions, right key expressions) of the same types; a
    null part matches nothing.  ``number`` is the rule's number from 1, 0 where
    none matches.  ``made``: columns that left keys are written with, which are
    not part of the result; ``told``: columns of ``left`` that all left keys
    follow from; ``rows``: about how many rows ``right`` has, where that is known.

    Both sides become (rule, key) rows and meet in one join, whatever the number
    of rules; the smallest rule of each row then goes back to it.  Rows of
    ``left`` with the same keys are looked up once.  Keys, rows
    and values are told apart by 88 bits or more.

    All (rule, key) rows of a large table are more than its disks should hold at
    once: from ``ROWS_AT_ONCE`` rows of ``right`` on, each rule meets in a join
    of its own, whose matches are stored before the next one begins, and the
    later joins go by slices.  The sides are read once a rule and slice, so
    they should be stored tables, or cheap to make from such.
    """
    keyed = left.withColumns(made) if made else left
    parts = [F.col(c) for c in told] if told else [h for l, _ in rules for h in l]
    # a null leaves a hash as it was, so which parts are null is part of it
    same = dict(zip(("_s0", "_s1"), _halves(0, *[F.isnull(h) for h in parts], *parts)))
    # values travel as numbers of 56 and 32 bits, which hash aggregates hold in place; a rule's number fits above them
    v0, v1 = _halves(0, F.col(value))
    marks = {"_v0": F.shiftrightunsigned(v0, 8), "_v1": v1.cast("long").bitwiseAND(F.lit((1 << 32) - 1))}
    numbered = list(enumerate(rules, 1))

    def matches(some: Sequence[tuple[int, tuple[Sequence[Column], Sequence[Column]]]]) -> DataFrame:
        """The rows' matches by some rules, as the rule's number above the mark of its value."""
        asked = F.array(*[F.struct(F.lit(i).cast("long").alias("_rule"), *_key(i, l)) for i, (l, _) in some])
        probes = keyed.select(*[c.alias(n) for n, c in same.items()], F.inline(asked)).where(F.col("_h").isNotNull())
        offered = F.array(*[F.struct(*_key(i, r)) for i, (_, r) in some])
        offers = right.select(*[c.alias(n) for n, c in marks.items()], F.inline(offered)).where(F.col("_h").isNotNull())
        spread = offers.groupBy("_h", "_i").agg(*[f(m).alias(f"{m}{n}") for m in marks for n, f in (("a", F.min), ("b", F.max))])
        single = spread.where("_v0a = _v0b and _v1a = _v1b").select("_h", "_i", *[F.col(f"{m}a").alias(m) for m in marks])
        return probes.join(single, ["_h", "_i"]).select(*same, *[(F.shiftleft("_rule", 56) + F.col(m)).alias(m) for m in marks])

    def smallest(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*same).agg(*[F.min(m).alias(m) for m in marks])

    def valued(first: DataFrame, right: DataFrame) -> DataFrame:
        first = first.select(*same, F.shiftright("_v0", 56).cast("int").alias(number), *[F.col(m).bitwiseAND(F.lit((1 << 56) - 1)).alias(m) for m in marks])
        values = right.select(value, *[c.alias(n) for n, c in marks.items()]).groupBy(*marks).agg(F.first(value).alias(value))
        return first.join(values, list(marks)).drop(*marks)

    def back(left: DataFrame, found: DataFrame) -> DataFrame:
        out = left.join(found, list(same), "left").drop(*same)
        return out.withColumn(number, F.coalesce(number, F.lit(0)))

    # generated columns: a filter on them is not moved below, where it would work out the keys once more
    named = (left if told else keyed).select(*left.columns, F.inline(F.array(F.struct(*[c.alias(n) for n, c in same.items()]))))
    if len(rules) <= RULES_AT_ONCE or (right.count() if rows is None else rows) < ROWS_AT_ONCE:
        return back(named, valued(smallest(matches(numbered)), right))
    groups = [numbered[i : i + RULES_AT_ONCE] for i in range(0, len(rules), RULES_AT_ONCE)]
    kept = [store(matches([rule]) for rule in g) for g in groups]
    first = in_slices(lambda mine: smallest(reduce(DataFrame.unionByName, kept).where(mine("_s0"))))
    for table in kept:
        discard(table)
    # a value's mark stands in the low bits of what has the rule above it
    low = F.col("_v0").bitwiseAND(F.lit((1 << 56) - 1))
    found = in_slices(lambda mine: valued(first.where(mine(low)), right.where(mine(marks["_v0"]))))
    discard(first)
    out = in_slices(lambda mine: back(named.where(mine("_s0")), found.where(mine("_s0"))))
    discard(found)
    return out


def pair_by_position(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_order, right_order, left_block=None, right_block=None,
    name: str = "position", how: str = "left",
) -> DataFrame:
    """k-th left row of a key with the k-th right row of it.

    The join key includes the position, so even a hot key pairs one to one and
    its rows are spread by the hash of (key, position).
    """
    a = with_sequence(left, keys, left_order, name, left_block)
    b = with_sequence(right, keys, right_order, name, right_block)
    return a.join(b, [*keys, name], how)


def explode_matches(df: DataFrame, ids: Sequence[str], patterns: Sequence[tuple[str, str]], name: str) -> DataFrame:
    """One row per distinct regex match found in any of the (column, pattern) pairs."""
    found = [F.coalesce(regexp_extract_all_n(c, p), F.array().cast("array<string>")) for c, p in patterns]
    merged = F.array_distinct(F.concat(*found)) if len(found) > 1 else F.array_distinct(found[0])
    return df.select(*ids, F.explode(merged).alias(name))


def effective_lookup(
    df: DataFrame, rules: DataFrame, keys: Sequence[str], at: str, start: str, end: str, default: dict | None = None
) -> DataFrame:
    """Rule valid for the key at a date: ``start <= at < end``, open ends are NULL.

    An as-of join: rules and rows of a key form one stream in the order of time,
    cut between sampled edges, that carries the last rule along.  Every row
    comes out once, whatever the number of rules and rows of its key: where
    rules overlap (:func:`rule_overlaps` lists them), the one that began last
    counts; of rules that begin together, the one that ends last, an open end
    being last of all.  Unmatched rows keep NULL or the given defaults; NULL
    keys match nothing.
    """
    new = [c for c in rules.columns if c not in (*keys, start, end)]
    rule = F.struct(F.col(end).isNull().alias("open"), F.col(end).alias("end"), *[F.col(c).alias(f"v_{c}") for c in new])
    known = rules.na.drop(subset=list(keys)).groupBy(*keys, F.col(start).alias("_t")).agg(F.max(rule).alias("_rule")).withColumn("_late", F.lit(0))
    rows = df.select(*keys, F.col(at).alias("_t"), F.lit(1).alias("_late"), F.struct(*df.columns).alias("_row"))
    stream = known.unionByName(rows, allowMissingColumns=True)
    out = carry_last(stream, keys, ["_t", "_late"], "_rule", Sampled([*keys, "_t"])).where("_late = 1")
    valid = F.col("_rule.open") | (F.col(f"_row.{at}") < F.col("_rule.end"))
    out = out.select("_row.*", *[F.when(valid, F.col("_rule")[f"v_{c}"]).alias(c) for c in new])
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in (default or {}).items()})


def rule_overlaps(rules: DataFrame, keys: Sequence[str], start: str, end: str, name: str = "next_start") -> DataFrame:
    """Rules that are still valid when the next one of their key begins, with that one's start.

    There are none exactly where no two rules of a key overlap.
    """
    first = rules.na.drop(subset=list(keys))
    order = [start, "_ends"]
    rows = first.withColumns({"_ends": F.struct(F.col(end).isNull().alias("open"), F.col(end).alias("end")), "_one": F.lit(True)})
    out = blocked_window(rows, keys, order, Sampled([*keys, *order]), following={name: start, "_more": "_one"})
    return out.where(F.col("_more") & (F.col(end).isNull() | F.col(name).isNull() | (F.col(name) < F.col(end)))).drop("_ends", "_one", "_more")
