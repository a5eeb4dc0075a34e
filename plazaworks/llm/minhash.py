"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blank_words, connected_components, mix32, mix64, rows_of, written

SHINGLE = 5  # words
PERCENT = 75  # least similarity of a link, in hundredths
BANDS, ROWS = 40, 5  # a pair at the threshold shares no band with probability (1 - 0.75^5)^40 = 2e-5
CHUNK = 1 << 16  # shingles hashed at once


def shingle_sets(texts: list[str | None], k: int = SHINGLE) -> list[np.ndarray]:
    """Per text its distinct shingles as sorted 64-bit hashes; fewer than ``k`` words make one shingle."""
    words = [blank_words(t) for t in texts]
    counts = np.array([len(w) for w in words])
    if not counts.sum():
        return [np.empty(0, np.uint64)] * len(texts)
    flat = np.empty(counts.sum(), object)
    flat[:] = [w for ws in words for w in ws]
    hashes = pd.util.hash_array(flat, categorize=False)
    out, at = [], 0
    for n in counts:
        own = hashes[at : at + n]
        at += n
        if n == 0:
            out.append(np.empty(0, np.uint64))
            continue
        width = min(k, n)
        mixed = np.full(n - width + 1, width, np.uint64)
        for j in range(width):  # order matters: each word is mixed into what stands before it
            mixed *= np.uint64(0x9E3779B97F4A7C15)
            mixed += own[j : j + len(mixed)]
            mix64(mixed)
        out.append(np.unique(mixed))
    return out


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Circulant MinHash of non-empty sets: one row of ``coordinates`` minima per set.

    The first permutation scatters the shingles over a ring of 2^32 places. The
    second one is read with a shift of k places for coordinate k, so two
    permutations give all coordinates.
    """
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])[:-1]
    flat = np.concatenate(sets)
    ring = (flat ^ (flat >> np.uint64(32))).astype(np.uint32)
    z, tmp = np.empty_like(ring), np.empty_like(ring)
    ring = mix32(ring, 0x7FEB352D, 0x846CA68B, tmp)
    out = np.empty((len(sets), coordinates), np.uint32)
    for k in range(coordinates):
        np.add(ring, np.uint32(k), out=z)
        out[:, k] = np.minimum.reduceat(mix32(z, 0x21F0AAAD, 0xD35A2D97, tmp), starts)
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """64-bit key of every band of every signature; the band's number is part of the key."""
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands)).copy()
    cells = sig.reshape(len(sig), bands, rows)
    for r in range(rows):
        keys *= np.uint64(0x9E3779B97F4A7C15)
        keys += cells[:, :, r]
        mix64(keys)
    return keys


def _sketch(batches: Iterator[pa.RecordBatch], k: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in rows_of(batches):
        ids, sets = batch.column(0), shingle_sets(batch.column(1).to_pylist(), k)
        keys = [None] * len(sets)
        some, size = [], 0
        for i in [*range(len(sets)), None]:  # None: the rest
            if i is None or size > CHUNK:
                if some:
                    for j, row in zip(some, band_keys(signatures([sets[j] for j in some], bands * rows), bands, rows), strict=True):
                        keys[j] = row.view(np.int64)
                some, size = [], 0
            if i is not None and len(sets[i]):
                some.append(i)
                size += len(sets[i])
        digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
            names=["doc_id", "n_shingles", "set_id", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in rows_of(batches):
        sets = [s.view(np.int64) for s in shingle_sets(batch.column(1).to_pylist(), k)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])


def _sets_of(texts: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, shingles) of the texts of some nodes."""
    wanted = texts.join(nodes.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    return wanted.mapInArrow(partial(_sets, k=k), "node long, shingles array<long>")


def verified(pairs: DataFrame, texts: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
    sets = _sets_of(texts, ends, k)
    left, right = sets.toDF("a", "sa"), sets.toDF("b", "sb")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", F.size("sa").alias("n"), F.size("sb").alias("m"), F.size(F.array_intersect("sa", "sb")).alias("i"))
    return both.where(F.col("i") * 100 >= percent * (F.col("n") + F.col("m") - F.col("i"))).select("a", "b")


def _prefix_pairs(members: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs of different components among ``members`` (node, component) that can still reach the similarity.

    All sets are ordered by rarity, shingles of one set alone first. A pair at
    the threshold t must overlap in t/(1+t) of both sizes, so its first common
    shingle stands early enough in both orders to leave room for that overlap.
    No link is missed, whatever the size of a group; a passage that many
    documents share comes last in the order and lists no pairs.
    """
    sets = written(_sets_of(texts, members, k), "sets")
    shingles = sets.select("node", F.explode("shingles").alias("s"))
    common = shingles.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = shingles.join(common, "s").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("order"))
    ranked = ranked.join(sets.select("node", F.size("shingles").alias("n")), "node").join(members, "node")
    own = F.col("n") - F.size("order")
    # the smallest partner allowed has t n shingles and overlaps in all of them
    room = F.floor(F.col("n") * (100 - percent) / 100).cast("int") + 1 - own
    spots = ranked.where(room > 0).select("node", "n", "component", own.alias("own"), F.posexplode(F.slice("order", F.lit(1), room)).alias("at", "o"))
    spots = spots.select("o.s", "node", "n", "component", (F.col("own") + F.col("at")).alias("at"))
    mixed = spots.groupBy("s").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("s")
    spots = spots.join(mixed, "s")
    a, b = spots.toDF("s", "a", "n", "ca", "i"), spots.toDF("s", "b", "m", "cb", "j")
    left = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j"))
    fits = left * (100 + percent) >= percent * (F.col("n") + F.col("m"))
    return a.join(b, "s").where((F.col("ca") < F.col("cb")) & fits).select("a", "b").distinct()


def _leader_links(members: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Verified pairs of each node with the most central leader of its buckets.

    A node's weight is the number of places it shares; the heaviest node of a
    bucket leads it, which in a group of copies is one close to the original.
    ``members`` holds (key, node, component, weight).
    """
    heavy = F.struct("weight", -F.col("node"), "component")
    leaders = members.groupBy("key").agg(F.max(heavy).alias("top"))
    led = members.join(leaders, "key").where("component <> top.component")
    pairs = led.groupBy(F.col("node").alias("a")).agg((-F.max("top")["col2"]).alias("b"))
    return written(verified(pairs, texts, k, percent), "links")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Near-duplicate classes of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept, one row per row.

    1. One pass makes each text's shingle set, its digest and its band keys;
       that small table is written. Equal sets become one node, named by the
       smallest doc_id.
    2. Each bucket of a band points its members at its most central node; each
       node is verified against the heaviest node it was pointed at. That one pair
       per node connects groups of copies of any size.
    3. Nodes of buckets that still hold several components are paired across
       components by their rarest shingles, and verified on the full sets.

    Null or empty texts have no shingles and link with nothing. Rows with one
    doc_id are one document. A null doc_id links with nothing: its component_id
    is null and it is kept. Other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = written(texts.mapInArrow(partial(_sketch, k=k, bands=bands, rows=rows), "doc_id long, n_shingles long, set_id binary, bands array<long>"), "sketch")
    named = sketch.where("doc_id is not null and n_shingles > 0")
    nodes = named.groupBy("set_id").agg(F.min("doc_id").alias("node"))
    reps = named.join(nodes, (named["set_id"] == nodes["set_id"]) & (named["doc_id"] == nodes["node"])).select("node", "bands")
    spots = reps.select("node", F.explode("bands").alias("key"))
    buckets = spots.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = spots.join(buckets, "key")
    weights = shared.groupBy("node").agg(F.sum("size").alias("weight"))
    members = written(shared.select("key", "node").join(weights, "node"), "members")

    links = _leader_links(members.withColumn("component", F.col("node")), texts, k, percent)
    rest = _mixed(members, connected_components(links)).select("node", "component").distinct()
    more = verified(written(_prefix_pairs(rest, texts, k, percent), "rest"), texts, k, percent)

    copies = named.join(nodes, "set_id").where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    component = connected_components(links.union(more).union(copies))
    out = sketch.select("doc_id", "n_shingles").join(component.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component_id = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component_id.alias("component_id"), F.coalesce(F.col("doc_id") == component_id, F.lit(True)).alias("kept"))


def _mixed(members: DataFrame, component: DataFrame) -> DataFrame:
    """The members of buckets that hold several components."""
    placed = members.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    return placed.join(mixed, "key").select("key", "node", "component", "weight")
