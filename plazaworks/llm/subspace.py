"""Near-duplicate vectors by a subspace pigeonhole join with exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, written

COSINE = 0.9
BLOCK_DIMS = 16  # dimensions of a block of the rotated space
CHUNK = 4096  # vectors of one side of a task, and about as many of a cell's own
EPS = 1e-9  # added to every budget, far above rounding errors


def rotation(dims: int, seed: int = 7) -> np.ndarray:
    """A fixed random rotation, which spreads the differences of two vectors over all blocks."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dims]).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def blocks_of(dims: int) -> list[tuple[int, int]]:
    return [(i, min(dims, i + BLOCK_DIMS)) for i in range(0, dims, BLOCK_DIMS)]


def budget(start: int, stop: int, dims: int, cosine: float) -> float:
    """Part of the squared distance 2 - 2 cos that a block may hold, in proportion to its dimensions.

    If all blocks held more, the whole distance would be larger.
    """
    return (2 - 2 * cosine) * (stop - start) / dims + EPS


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _rotated(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)) @ rotation(x.shape[1])


def _cells(z: np.ndarray, bits: int, most: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own cell of every row, and (row, cell) of the higher cells within its range.

    A cell is the signs of the first coordinates. Another cell is in range if
    the squared coordinates that would have to change sign fit the budget.
    """
    weights = 1 << np.arange(bits)
    own = ((z[:, :bits] > 0) * weights).sum(1)
    rows, cells, cost = np.arange(len(z)), own, np.zeros(len(z))
    for j in range(bits):
        more = cost + z[rows, j] ** 2
        fits = more <= most
        rows, cells, cost = np.concatenate([rows, rows[fits]]), np.concatenate([cells, cells[fits] ^ (1 << j)]), np.concatenate([cost, more[fits]])
    higher = cells > own[rows]
    return own, rows[higher], cells[higher]


def _place(batches: Iterator[pa.RecordBatch], bits: int, cosine: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
        for dims in np.unique(lengths):
            same = batch.filter(pa.array(lengths == dims))
            x, ids = _matrix(same.column(1)), same.column(0).to_numpy()
            z = _rotated(x)
            for b, (start, stop) in enumerate(blocks_of(int(dims))):
                own, rows, cells = _cells(z[:, start:stop], min(bits, stop - start), budget(start, stop, int(dims), cosine))
                rows, cells = np.concatenate([np.arange(len(x)), rows]), np.concatenate([own, cells])
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, dims), pa.int32()), pa.array(np.full(n, b), pa.int32()), pa.array(cells, pa.int32()), pa.array(np.arange(n) < len(x)), pa.array(ids[rows], pa.int64())],
                    names=["dims", "block", "cell", "home", "node"],
                )


def _join(table: pa.Table, cosine: float) -> pa.Table:
    """Links between the two sides of one task: (node, links, root).

    A pair counts in the first block whose budget it keeps, so that the union
    over blocks needs no list of pairs. ``root`` is the smallest node that the
    links of this task connect a node with.
    """
    dims, block = table.column("dims")[0].as_py(), table.column("block")[0].as_py()
    left = table.column("left").combine_chunks().to_numpy(zero_copy_only=False)
    ids, copies = table.column("node").combine_chunks().to_numpy(), table.column("copies").combine_chunks().to_numpy()
    home = table.column("home").combine_chunks().to_numpy(zero_copy_only=False)
    x = _matrix(table.column("embedding").combine_chunks()).astype(np.float64)
    norms, z = np.linalg.norm(x, axis=1), _rotated(x)
    spans = blocks_of(dims)
    most = np.array([budget(a, b, dims, cosine) for a, b in spans])
    a, b = np.flatnonzero(left), np.flatnonzero(~left)
    start, stop = spans[block]
    za, zb = z[a, start:stop], z[b, start:stop]
    found = []
    for at in range(0, len(a), 256):
        near = (za[at : at + 256] ** 2).sum(1)[:, None] + (zb**2).sum(1) - 2 * za[at : at + 256] @ zb.T <= most[block] + EPS
        near &= ~home[b] | (ids[a[at : at + 256]][:, None] < ids[b])
        i, j = np.nonzero(near)
        for k in range(0, len(i), 20_000):
            p, q = a[at + i[k : k + 20_000]], b[j[k : k + 20_000]]
            linked = np.einsum("ij,ij->i", x[p], x[q]) / (norms[p] * norms[q]) >= cosine
            p, q = p[linked], q[linked]
            parts = np.add.reduceat((z[p] - z[q]) ** 2, [s for s, _ in spans], axis=1) if len(p) else np.empty((0, len(spans)))
            first = (parts[:, block] <= most[block]) & (parts[:, :block] > most[:block]).all(1)
            found.append((p[first], q[first]))
    p, q = (np.concatenate([f[i] for f in found]) if found else np.empty(0, int) for i in (0, 1))
    links = np.bincount(p, copies[q], len(x)) + np.bincount(q, copies[p], len(x))
    root = ids.copy()
    while len(p):
        lower = np.minimum(root[p], root[q])
        new = root.copy()
        np.minimum.at(new, p, lower)
        np.minimum.at(new, q, lower)
        if (new == root).all():
            break
        root = new
    some = links > 0
    return pa.table({"node": pa.array(ids[some], pa.int64()), "links": pa.array(links[some].astype(np.int64), pa.int64()), "root": pa.array(root[some], pa.int64())})


def linked_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Links of every row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    1. Equal vectors become one node with a number of copies.
    2. Unit vectors are rotated and cut into blocks of 16 dimensions. Two
       vectors within the distance hold no more than a proportional share of it
       in at least one block. In every block a vector is sent to its own cell
       and to the higher cells that this share can reach.
    3. Cells are joined in chunks of about four thousand vectors a side;
       candidates are verified on the whole vectors in double precision, and
       counted in the first block that found them.

    A group of near copies of any size is spread over chunk pairs; only sums and
    one root per node leave a task. Null, empty and zero vectors and those with
    null or non-finite components link with nothing; vectors of different
    lengths link with nothing either. Rows that share a vec_id are vectors of
    their own, linked by what they hold; a row without an id has no component,
    links with nothing and is kept. Other columns are ignored.
    """
    e = F.col("embedding")
    finite = F.coalesce(F.forall(e, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False))), F.lit(False))
    sound = F.col("vec_id").isNotNull() & finite & F.coalesce(F.exists(e, lambda v: v != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", sound.alias("sound"))
    nodes = rows.where("sound").groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")  # numbered once, as written
    bits = max(1, math.ceil(math.log2(max(1, nodes.count()) / CHUNK)))
    spots = nodes.select("node", "embedding").mapInArrow(partial(_place, bits=bits, cosine=cosine), "dims int, block int, cell int, home boolean, node long")
    spots = written(spots, "cells")
    key = ["dims", "block", "cell"]
    sizes = spots.groupBy(*key).agg(F.ceil(F.count_if("home") / CHUNK).cast("int").alias("lefts"), F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("rights")).where("lefts > 0")
    sized = spots.join(sizes, key)
    turn = lambda side, n: F.pmod(F.xxhash64("node", F.lit(side)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    lefts = sized.where("home").select(*key, "home", "node", F.lit(True).alias("left"), turn("left", "lefts").alias("i"), every("rights").alias("j"))
    rights = sized.select(*key, "home", "node", F.lit(False).alias("left"), turn("right", "rights").alias("j"), every("lefts").alias("i"))
    tasks = lefts.unionByName(rights).join(nodes.drop("first"), "node")

    def task(rows: pa.Table) -> pa.Table:
        return _join(rows, cosine)

    found = tasks.groupBy(*key, "i", "j").applyInArrow(task, "node long, links long, root long")
    found = written(found, "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    component = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).distinct())
    known = nodes.join(links, "node", "left").join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = known.groupBy("component").agg(F.min("first").alias("least"))
    known = known.join(names, "component").select("embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("least").alias("component"))
    linked = rows.where("sound").join(known, "embedding").select("vec_id", "n_links", F.col("component").alias("component_id"))
    alone = rows.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
