"""Sharding by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

VNODES = 64  # points of each shard on the ring
BLOCK_BITS = 16  # the ring is numbered in 2^16 blocks, so that no task sorts a whole arc


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(point, shard) of all virtual nodes in clockwise order; a shard's points do not depend on the others."""
    at = lambda s, v: int.from_bytes(hashlib.md5(f"{s}:{v}".encode()).digest()[:8], "big", signed=True)
    return sorted((at(s, v), s) for s in range(shards) for v in range(vnodes))


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Most rows of each shard: with no slack counts differ by one at most, else (1 + slack) times the mean."""
    if slack == 0:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [-int(-(1 + slack) * rows // shards)] * shards


def flows(counts: dict[int, int], owners: list[int], capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, from, to, shard, first slot): where the rows of each arc go, in the arc's order.

    All arcs offer their rows to the next virtual node clockwise, then what it
    had no room for to the one after it, and so on. Every entry empties an arc
    or fills a shard, so there are no more entries than arcs and shards.
    """
    left, room, used = dict(counts), list(capacity), [0] * len(capacity)
    done = dict.fromkeys(counts, 0)
    out = []
    for step in range(len(owners)):
        if not left:
            break
        for arc in sorted(left):
            shard = owners[(arc + step) % len(owners)]
            take = min(left[arc], room[shard] - used[shard])
            if take:
                out.append((arc, done[arc], done[arc] + take, shard, used[shard]))
                done[arc] += take
                used[shard] += take
                left[arc] -= take
                if not left[arc]:
                    del left[arc]
    return out


def _arc_of(ends: np.ndarray):
    """Column function: number of the arc, between two points of the ring, that a place is on."""

    @F.pandas_udf("int")
    def arc(places: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for p in places:
            yield pd.Series(np.searchsorted(ends, p.to_numpy(), side="left") % len(ends)).astype("int32")

    return arc


def bounded_ring(docs: DataFrame, shards: int, vnodes: int = VNODES, slack: float = 0.0, keep: Sequence[str] = ()) -> DataFrame:
    """Shard and gapless slot of every row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Columns named in ``keep`` go along with their rows and must not bear one of
    these names.

    A row stands on the ring at the hash of its doc_id and belongs to the next
    virtual node clockwise; rows that find its shard full go on clockwise. With
    ``slack`` 0 the counts differ by one at most (law `rows`), so
    ``grown_shard`` is null.

    Only one count per arc (shards x vnodes, a number that does not grow with
    the rows) reaches the driver, which works out the overflow on counts. Rows
    are numbered within blocks of the ring and placed by a join with the flows.
    A null text has size 8 and the checksum of no bytes; null and repeated
    doc_ids are rows like any other, ordered by size and checksum.
    """
    points = ring(shards, vnodes)
    ends = np.array([p for p, _ in points], np.int64)
    arc = _arc_of(ends)
    place = F.xxhash64(F.col("doc_id").cast("long")).alias("place")
    block = F.shiftright("place", 64 - BLOCK_BITS).alias("block")

    spots = docs.select(place).select("place", arc("place").alias("arc"), block)
    blocks = spots.groupBy("arc", "block").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["arc"]: r["n"] for r in blocks.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    moved = flows(counts, [s for _, s in points], capacities(sum(counts.values()), shards, slack))
    table = docs.sparkSession.createDataFrame(moved, "arc int, lo long, hi long, shard int, first long")
    # the first arc begins before the ring's start: its blocks up to the first point come last
    order = [F.when((F.col("arc") == 0) & (F.col("block") <= F.lit(int(ends[0]) >> (64 - BLOCK_BITS))), 1).otherwise(0), F.col("block")]
    before = blocks.withColumn("before", F.sum("n").over(W.partitionBy("arc").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)))
    before = before.select("arc", "block", F.coalesce("before", F.lit(0)).alias("before"))

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), place, *keep)
    rows = rows.select("*", arc("place").alias("arc"), block)
    nth = F.row_number().over(W.partitionBy("arc", "block").orderBy("place", "doc_id", "size", "text_crc32")) - 1
    rows = rows.withColumn("nth", nth).join(before, ["arc", "block"]).withColumn("nth", F.col("nth") + F.col("before"))
    placed = rows.join(table, "arc").where("nth >= lo and nth < hi")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows" if slack == 0 else "ring").alias("law"), "shard",
        (F.col("first") + F.col("nth") - F.col("lo")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), *keep,
    )


def owner_of(place: int, points: list[tuple[int, int]]) -> int:
    """The shard of the next virtual node clockwise of a place, without bounds."""
    at = bisect_right([p for p, _ in points], place - 1)
    return points[at % len(points)][1]
