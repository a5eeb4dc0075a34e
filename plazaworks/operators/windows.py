"""Windows over whole histories that stay even when one key is huge.

A plain window sends all rows of a key to one task.  Here the ordered history
is cut into *blocks* (a month, a day, a range of ids, a range between sampled
edges); each (key, block) is its own window partition.  What earlier blocks
contribute -- how many rows, which running total, which last value -- comes from
one small aggregate per block and enters the block as an extra head row, so the
result is the same as that of the uncut window.  The large side is shuffled once.
Summaries of many short histories are as long as the table; positions are taken
without them where no key can have more than ``SHORT`` rows.

The block summaries of a key are rows in an order themselves, so they are cut
into coarser blocks in the same way: no task sees all blocks of a long history.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, ROW, TAIL = 0, 1, 2
FAN = 1024  # numbered blocks in a coarser block
BLOCKS = 1024  # ranges between sampled edges; to be raised with the number of tasks of a cluster
PER_EDGE = 8  # sampled rows for each edge
SHORT = 1 << 18  # rows of a history that one task orders as it is
BUCKETS = 1 << 16  # hashes of keys whose rows are counted to tell short histories


class Sampled(NamedTuple):
    """Blocks between sampled edges: ``order`` is compared with at most ``blocks`` edges taken from ``rows`` (else the table itself)."""

    order: Sequence[str]
    blocks: int = BLOCKS
    rows: DataFrame | None = None


def natural_block(df: DataFrame, column: str, unit: str = "month", width: int = 1_000_000) -> Column | Sampled:
    """A block that fits the type of the leading order column.

    Times are cut by ``unit``, numbers by ``width``, texts between sampled
    edges; none of these ever decreases along the column.
    """
    kind = dict(df.dtypes)[column]
    if kind.startswith(("timestamp", "date")):
        return F.date_trunc(unit, column)
    return Sampled([column]) if kind == "string" else F.floor(F.col(column) / width)


def sampled_edges(df: DataFrame, order: Sequence[str], blocks: int = BLOCKS) -> Column:
    """Sorted array of at most ``blocks`` values of the order columns that part the rows evenly: a scalar subquery.

    Every ``PER_EDGE``-th row of a random sample of about ``blocks * PER_EDGE``
    rows; the sample's size does not grow with the table.  Edges decide where
    rows are handled and never what comes out.
    """
    rows = df.select(F.struct(*order).alias("_o"))
    share = F.lit(float(blocks * PER_EDGE)) / F.greatest(rows.agg(F.count(F.lit(1))).scalar(), F.lit(1))
    some = rows.where(F.rand(17) < share).agg(F.sort_array(F.collect_list("_o")).alias("_all"))
    picked = F.filter(F.col("_all"), lambda _, i: i % PER_EDGE == PER_EDGE - 1)
    return some.select(F.array_distinct(picked)).scalar()


def with_block(df: DataFrame, block: Column | Sampled, name: str = "_block") -> DataFrame:
    """``df`` with its block: a column's value, or the number of sampled edges at or below the row.

    Where keys lead the order columns of sampled edges, a key with many rows is
    cut into many blocks, whatever its values.  Rows that tie on them share one.
    """
    if isinstance(block, Column):
        return df.withColumn(name, block)
    edges, me = sampled_edges(block.rows or df, block.order, block.blocks), F.struct(*block.order)
    out = df.withColumn(name, F.lit(0))
    # halving, one projection a step; past the last edge there is null, which is not at or below anything
    for k in reversed(range((2 * block.blocks).bit_length())):
        out = out.withColumn(name, F.col(name) + F.when(F.get(edges, F.col(name) + ((1 << k) - 1)) <= me, 1 << k).otherwise(0))
    return out


def _coarser(df: DataFrame, block: str) -> Column | None:
    """The block of a block: years of times, thousands of numbers."""
    kind = dict(df.dtypes)[block]
    if kind.startswith(("timestamp", "date")):
        return F.year(block)
    return None if kind == "string" else F.floor(F.col(block) / FAN)


def blocked_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    block: Column | Sampled | None = None,
    *,
    row_number: str | None = None,
    sums: Mapping[str, Column] | None = None,
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    range_frame: bool = False,
    range_order: Sequence[str] | None = None,
    group_count: str | None = None,
    short: int | None = None,
) -> DataFrame:
    """Add running columns over ``order`` (ascending) within ``keys``.

    ``block`` must not decrease along ``order`` within a key and is constant among rows that
    tie on it; ``None`` computes plain windows for histories known to be short.

    See :func:`natural_block` for a block by the type of the order column;
    :class:`Sampled` blocks follow the rows.

    * ``row_number`` -- name of the position column
    * ``sums`` -- name -> summed expression, up to the current row
      (``range_frame`` includes the rows that tie with it, by ``range_order``
      where that is only the first part of ``order``)
    * ``group_count`` -- name of the number of rows of the whole key
    * ``previous`` / ``following`` -- name -> column read from the neighbour row

    With ``short`` only keys that may have more rows than that are cut, so that
    a table of many short histories has no block summaries at all.
    """
    sums, previous, following = dict(sums or {}), dict(previous or {}), dict(following or {})
    columns = df.columns
    added = [n for n in (row_number,) if n] + [*sums, *previous, *following] + [n for n in (group_count,) if n]
    data = df if block is None else with_block(df, block)
    data = data.withColumns({f"_v_{n}": e for n, e in sums.items()} | {f"_c_{n}": F.lit(1).cast("bigint") for n in (row_number, group_count) if n})
    totals = {n: f"_v_{n}" for n in sums} | ({row_number: f"_c_{row_number}"} if row_number else {})
    whole = {group_count: f"_c_{group_count}"} if group_count else {}
    ties = (range_order or order) if range_frame else None
    if block is not None and short is not None and keys and not whole:
        data = _with_long(data, keys, short)
    out = _running(data, keys, order, 0 if block is None else 2, totals, whole, previous, following, ties if sums else None, [*sums])
    return out.select(*[c for c in columns if c not in added], *added)


def _with_long(df: DataFrame, keys: Sequence[str], short: int) -> DataFrame:
    """``df`` with ``_long``: whether the key may have more than ``short`` rows. The blocks of other keys become one.

    Rows are counted by a hash of the key, so the list of hashes that hold many
    is bounded; a short key that shares one is cut like a long one.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    many = df.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > short)
    out = df.withColumn("_bucket", bucket).join(F.broadcast(many.select("_bucket", F.lit(True).alias("_long"))), "_bucket", "left").drop("_bucket")
    return out.withColumn("_block", F.when(F.col("_long"), F.col("_block")))


def _running(df, keys, order, levels: int, totals, whole, previous, following, ties=None, tied=(), before=False) -> DataFrame:
    """``df`` with running totals (``totals``: name -> column), totals of the key (``whole``) and neighbours.

    ``levels`` says how often histories are cut, by the column ``_block``; with
    ``before`` a total leaves the row itself out and is null on the first.
    """
    if not levels or "_block" not in df.columns:
        w = Window.partitionBy(*(keys or [F.lit(0)]))
        new = _columns(w.orderBy(*order), w.orderBy(*ties) if ties else None, tied, totals, previous, following, before)
        return df.withColumns(new | {n: F.sum(c).over(w) for n, c in whole.items()})
    carried = sorted({*previous.values(), *following.values()})
    by = F.struct(*order)
    if cut := "_long" in df.columns:
        df, long = df.drop("_long"), df.where("_long")
    blocks = (long if cut else df).groupBy(*keys, F.col("_block").alias("_at")).agg(
        *[F.sum(c).alias(c) for c in sorted({*totals.values(), *whole.values()})],
        *([F.min_by(F.struct(*carried), by).alias("_first"), F.max_by(F.struct(*carried), by).alias("_last")] if carried else []),
    )
    coarse = _coarser(blocks, "_at")
    if coarse is not None:
        blocks = blocks.withColumn("_block", coarse)
    sofar, all_ = {f"_b{levels}_{c}": c for c in sorted({*totals.values()})}, {f"_w{levels}_{c}": c for c in sorted({*whole.values()})}
    ends = {"_in": "_last"} if carried else {}, {"_out": "_first"} if carried else {}
    edges = _running(blocks, keys, ["_at"], levels - 1, sofar, all_, *ends, before=True)

    def edge(tag: int, source: str) -> Column:
        heads = [(F.col(b) if tag == HEAD else F.lit(None).cast(edges.schema[b].dataType)).alias(c) for b, c in sofar.items()]
        return F.struct(F.lit(tag).alias("_tag"), *heads, *all_, *[F.col(f"{source}.{c}").alias(c) for c in carried if c not in keys])

    rows = F.array(edge(HEAD, "_in"), *([edge(TAIL, "_out")] if following else []))
    heads = edges.select(*keys, F.col("_at").alias("_block"), F.explode(rows).alias("_e")).select(*keys, "_block", "_e.*")
    stacked = df.withColumn("_tag", F.lit(ROW)).unionByName(heads, allowMissingColumns=True)
    w = Window.partitionBy(*keys, "_block")
    new = _columns(w.orderBy("_tag", *order), w.orderBy("_tag", *ties) if ties else None, tied, totals, previous, following, before)
    new |= {n: F.max(f"_w{levels}_{c}").over(w) for n, c in whole.items()}
    return stacked.withColumns(new).where(F.col("_tag") == ROW).drop("_tag", *all_)


def _columns(w, ties, tied, totals, previous, following, before) -> dict[str, Column]:
    rows = w.rowsBetween(Window.unboundedPreceding, -1 if before else Window.currentRow)
    same = ties.rangeBetween(Window.unboundedPreceding, Window.currentRow) if ties is not None else rows
    new = {n: F.sum(c).over(same if n in tied else rows) for n, c in totals.items()}
    new |= {n: F.lag(c).over(w) for n, c in previous.items()}
    return new | {n: F.lead(c).over(w) for n, c in following.items()}


def carry_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, block: Column | Sampled) -> DataFrame:
    """``df`` with the latest known ``value`` at or before each row of its key, in place of its own.

    Rows that tie on ``order`` must not both know a value.  One head row a block
    brings in what earlier blocks knew.
    """
    data = with_block(df, block)
    known = F.when(F.col(value).isNotNull(), F.struct(*order))
    per_block = data.groupBy(*keys, "_block").agg(F.max_by(value, known).alias(value))
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    heads = per_block.withColumn(value, F.last(value, ignorenulls=True).over(w)).where(F.col(value).isNotNull()).withColumn("_tag", F.lit(HEAD))
    stacked = data.withColumn("_tag", F.lit(ROW)).unionByName(heads, allowMissingColumns=True)
    rows = Window.partitionBy(*keys, "_block").orderBy("_tag", *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = stacked.withColumn(value, F.last(value, ignorenulls=True).over(rows))
    return out.where(F.col("_tag") == ROW).drop("_tag", "_block")


def running_sum(df, keys, order, value, name, block=None, range_frame=False) -> DataFrame:
    """Running total; ``range_frame`` gives tied rows the same total."""
    return blocked_window(df, keys, order, block, sums={name: F.col(value)}, range_frame=range_frame)


def with_previous(df, keys, order, cols: Mapping[str, str], block=None) -> DataFrame:
    """Values of the row just before, e.g. the previous state of an entity."""
    return blocked_window(df, keys, order, block, previous=cols)


def diff_prev(df, keys, order, value, name, block=None) -> DataFrame:
    """Difference to the previous row; NULL on the first."""
    out = blocked_window(df, keys, order, block, previous={"_prev": value})
    return out.withColumn(name, F.col(value) - F.col("_prev")).drop("_prev")


def with_sequence(df, keys, order, name="n", block=None) -> DataFrame:
    """Position of each row within its key."""
    return blocked_window(df, keys, order, block, row_number=name, short=SHORT)


def first_last_flags(df, keys, order, block=None, first="is_first", last="is_last") -> DataFrame:
    """Mark the first and the last row of each key; all rows stay."""
    out = blocked_window(df, keys, order, block, row_number="_n", group_count="_all")
    flags = {first: F.col("_n") == 1, last: F.col("_n") == F.col("_all")}
    return out.withColumns(flags).drop("_n", "_all")


def with_row_id(df, order, block, name="row_id") -> DataFrame:
    """Gap-free global ids in ``order`` without sorting the table in one task.

    Only the per-block counts pass through one task.
    """
    return blocked_window(df, [], order, block, row_number=name)


def conditional_sequence(df, key: str, order, condition: Column, name="n", block=None) -> DataFrame:
    """Number rows that meet ``condition`` among themselves and the others in the whole key."""
    return (
        blocked_window(df, [key], order, block, row_number="_all", sums={"_hits": condition.cast("int")})
        .withColumn(name, F.when(condition, F.col("_hits")).otherwise(F.col("_all")).cast("bigint"))
        .drop("_all", "_hits")
    )
