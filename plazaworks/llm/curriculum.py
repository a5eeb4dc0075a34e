"""Mixing sources to target weights along a time-varying curriculum. Column expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import written

WEIGHTS = (3, 1, 2)  # of the sources in code point order, repeating
SHARE, MOST = 1.5, 2  # all targets together, and each at most, in sizes
#: Weight schedule of each weight class: (time, weight) knots joined by lines; time runs from 0 to 1.
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
)
HASH_DIGITS = 3  # a source is cumulated in 16^3 blocks


def demand_inverse(q: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Time at which the integral of a schedule reaches the share ``q`` of its whole.

    Within a piece the integral is a parabola; this form of its root is stable
    where the piece is flat.
    """
    pieces, total = [], 0.0
    for (t0, a), (t1, b) in zip(knots, knots[1:], strict=False):
        pieces.append((total, t0, t1 - t0, a, b))
        total += (t1 - t0) * (a + b) / 2
    out = None
    for start, t0, width, a, b in pieces:
        d = q * F.lit(total) - F.lit(start)
        root = F.sqrt(F.greatest(F.lit(a * a) + 2 * d * F.lit((b - a) / width), F.lit(0.0)))
        time = F.lit(t0) + 2 * d / (F.lit(a) + root)
        out = time if out is None else F.when(d >= 0, time).otherwise(out)
    return F.least(F.greatest(out, F.lit(knots[0][0])), F.lit(knots[-1][0]))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Target of every source (source, source_size): weight x level, and at most ``most`` sizes.

    What the capped sources leave is shared by weight among the rest, which
    raises the level until no target is above its cap. In the order of cap per
    weight the capped sources come first, so one pass of running sums finds it.
    """
    line = W.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sources.withColumn("nth", F.row_number().over(line) - 1).withColumn("class", F.pmod("nth", F.lit(len(weights))).cast("int"))
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("class") + 1))
    ranked = ranked.withColumn("cap", most * F.col("source_size")).withColumn("budget", share * F.sum("source_size").over(W.partitionBy()))
    order = W.orderBy(F.col("cap") / F.col("weight"), "nth")
    capped = F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    ranked = ranked.withColumn("level", (F.col("budget") - capped) / rest).withColumn("full", F.col("level") > F.col("cap") / F.col("weight"))
    level = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "nth", "level"))).over(W.partitionBy())["level"]
    target = F.when(F.col("full"), F.col("cap")).otherwise(level * F.col("weight"))
    return ranked.select("source", "source_size", "class", target.cast("double").alias("target"))


def mix(docs: DataFrame, seed: int = 0, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, schedules: Sequence = SCHEDULES) -> DataFrame:
    """Words the mix takes from every row of ``docs`` (doc_id, text, source), in training order.

    Columns: doc_id, source, size, source_size, target, taken, passes (how often
    the row is begun), position (time in [0, 1] of its first pass, null if none)
    and later_position (of its second). Rows are range-sorted by position.

    A source is read in the order of a seeded hash, again from its start when it
    is used up, until its target is reached; the last document is taken in part.
    The middle of a pass stands at a share of the source's target, and the
    inverse of the integrated schedule turns that share into a time.

    Running sums are cut into hash blocks, so a source with any share of the
    rows is spread over them. Null texts have size 0 and are taken with 0 words;
    null sources form a source of their own; rows with equal doc_ids stand
    together, ordered by size. Reruns agree for one seed.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    base = written(docs.select("doc_id", "source", F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("size"), name.alias("h")), "sizes")
    base = base.withColumn("block", F.substring("h", 1, HASH_DIGITS))
    per_block = base.groupBy("source", "block").agg(F.sum("size").alias("words"))
    table = targets(per_block.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most).withColumnRenamed("source", "s")
    start = F.sum("words").over(W.partitionBy("source").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    blocks = per_block.select(F.col("source").alias("s"), F.col("block").alias("b"), F.coalesce(start, F.lit(0)).alias("start"))
    blocks = blocks.join(table.withColumnRenamed("s", "t"), F.col("s").eqNullSafe(F.col("t"))).drop("t")
    rows = base.join(blocks, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    inside = W.partitionBy("source", "block").orderBy("h", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    wanted = F.floor(F.col("target") + 0.5).cast("long")
    part = [F.greatest(F.lit(0), F.least(F.col("size"), wanted - F.col("at") - p * F.col("source_size"))).cast("long") for p in range(most)]
    position = []
    for p in range(most):
        middle = (F.col("at") + p * F.col("source_size") + part[p] / 2) / wanted
        by_class = [F.when(F.col("class") == c, demand_inverse(middle, schedules[c % len(schedules)])) for c in range(len(weights))]
        position.append(F.when(part[p] > 0, F.coalesce(*by_class)))
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", sum(part[1:], part[0]).alias("taken"),
        sum([(x > 0).cast("int") for x in part[1:]], (part[0] > 0).cast("int")).alias("passes"),
        position[0].alias("position"), (position[1] if most > 1 else F.lit(None).cast("double")).alias("later_position"),
    ).orderBy("position", "doc_id")
