"""Helpers shared by the operators: tables in the shared folder, components of a graph, words in bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, shared_folder

# ASCII bytes that are not digits or letters part words; all bytes of longer code points belong to words
WORD_SPLIT = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The rows are computed once, survive the loss of any executor, and later
    reads prune columns.
    """
    spark: SparkSession = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def blank_words(text: str | None) -> list[bytes]:
    """Words parted by blanks (space, \\t to \\r), with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def alnum_words(text: str | None) -> list[bytes]:
    """Runs of ASCII digits, letters and all non-ASCII characters, with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().translate(WORD_SPLIT).split() if text else []


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit; works in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def mix32(x: np.ndarray, a: int, b: int, tmp: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit numbers chosen by two odd multipliers; works in place."""
    for shift, mul in ((16, a), (15, b)):
        np.right_shift(x, np.uint32(shift), out=tmp)
        np.bitwise_xor(x, tmp, out=x)
        np.multiply(x, np.uint32(mul), out=x)
    np.right_shift(x, np.uint32(16), out=tmp)
    np.bitwise_xor(x, tmp, out=x)
    return x


def rows_of(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that what is made from long texts stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))).first())


def _smallest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its smallest node.

    Large-star and small-star steps by turns: each node points its larger, then
    its smaller neighbours at the smallest one it knows, until nothing changes.
    The number of rounds grows with the logarithm of the longest chain.  Every
    round is two aggregates joined back to the edges and ends in a checkpoint.
    Null ends and loops are ignored.
    """
    u, v = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = cut_lineage(edges.where("a <> b").select(u, v).distinct())
    before = _summary(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _smallest(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = _smallest(large)
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        after = _summary(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
