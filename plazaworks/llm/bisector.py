"""Centroid clustering by a tournament of bisectors, in whole numbers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

SCALE = 256  # a component x becomes floor(SCALE * x)
SMALL = 1 << 24  # sums of products of numbers below this stay far below 2^63
LIMB = 10**18  # sums are added up in Spark in digits of this base
BATCH = 4096  # vectors handled at once
LONG = 2**63 - 1


class Tournament(NamedTuple):
    """The bisectors of all pairs of centroids: ``normal[i, j] . x > threshold[i, j]`` where j is nearer to x than i."""

    centroids: np.ndarray  # (k, d)
    normal: np.ndarray  # (k, k, d)
    threshold: np.ndarray  # (k, k)


def exact_type(*arrays: np.ndarray) -> type:
    """int64 where no sum of products of these numbers can leave it, else Python's own numbers."""
    small = all(a.size == 0 or (a.dtype != object and a.shape[-1] <= 4096 and -SMALL < a.min() and a.max() < SMALL) for a in arrays)
    return np.int64 if small else object


def tournament(centroids: list[list[int]]) -> Tournament:
    """Integer normals and thresholds: |x - c_j|^2 < |x - c_i|^2 where 2 x . (c_j - c_i) > |c_j|^2 - |c_i|^2."""
    c = np.array(centroids, object)
    # products of the largest components must stay below 2^63; Python's numbers hold any
    c = c.astype(np.int64) if all(-SMALL < x < SMALL for row in centroids for x in row) else c
    norm = (c * c).sum(axis=1)
    return Tournament(c, 2 * (c[None, :, :] - c[:, None, :]), norm[None, :] - norm[:, None])


def nearest(x: np.ndarray, t: Tournament) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row, the smaller one of equals, and the squared distance to it.

    The holder of a row meets the other centroids in rising order, one sign test
    each; zero leaves the holder, which has the smaller number.
    """
    kind = exact_type(x, t.centroids)
    x, centroids, normal, threshold = (a.astype(kind) for a in (x, *t))
    holder = np.zeros(len(x), np.int64)
    for j in range(1, len(centroids)):
        side = (x * normal[holder, j]).sum(axis=1) - threshold[holder, j]
        holder[side > 0] = j
    apart = x - centroids[holder]
    return holder, (apart * apart).sum(axis=1)


def whole_vectors(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, vectors): which rows have ``dims`` finite components, and those components as floor(SCALE * x)."""
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == dims)
    flat = column.take(pa.array(rows)).flatten().cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    x = flat.reshape(len(rows), dims)
    good = np.isfinite(x).all(axis=1)
    rows, x = rows[good], x[good]
    if x.size and np.abs(x).max() >= SMALL / SCALE:  # beyond the range of int64 sums: Python's numbers, exact at any size
        return rows, np.array([[_floor(v) for v in row] for row in x.tolist()], object)
    return rows, np.floor(x * SCALE).astype(np.int64)


def _floor(v: float) -> int:
    """floor(SCALE * v); a number of 2^53 or more is whole, and SCALE times it may be more than a double holds."""
    return int(v) * SCALE if abs(v) >= 2.0**53 else int(np.floor(v * SCALE))


def _vectors(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            rows, x = whole_vectors(part.column(1), dims)
            if len(rows):
                yield part.column(0).take(pa.array(rows)), x


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, digit) of a number in base LIMB; the last digit has the sign."""
    place = 0
    while not -LIMB < value < LIMB:
        value, digit = divmod(value, LIMB)
        yield place, digit
        place += 1
    yield place, value


def _sums(batches: Iterator[pa.RecordBatch], dims: int, t: Tournament) -> Iterator[pa.RecordBatch]:
    """Of a task's vectors the sum of every component in every cluster; component -1 is the count."""
    total = [[0] * (dims + 1) for _ in t.centroids]
    for _, x in _vectors(batches, dims):
        holder, _ = nearest(x, t)
        for c in np.unique(holder).tolist():
            mine = x[holder == c]
            total[c] = [a + int(b) for a, b in zip(total[c], [*mine.sum(axis=0).tolist(), len(mine)], strict=True)]
    rows = [(c, d if d < dims else -1, place, digit) for c, row in enumerate(total) if row[dims] for d, v in enumerate(row) for place, digit in _limbs(v)]
    if rows:
        c, d, place, digit = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int32()) for v in (c, d, place)] + [pa.array(digit, pa.int64())], names=["cluster", "component", "place", "digit"])


def _assigned(batches: Iterator[pa.RecordBatch], dims: int, t: Tournament) -> Iterator[pa.RecordBatch]:
    for ids, x in _vectors(batches, dims):
        holder, distance = nearest(x, t)
        fits = [int(v) if v <= LONG else None for v in distance.tolist()]
        yield pa.RecordBatch.from_arrays([ids, pa.array(holder, pa.int32()), pa.array(fits, pa.int64())], names=["vec_id", "cluster", "distance"])


def _whole(vectors: DataFrame, dims: int):
    """Condition: the vector has ``dims`` components, all finite."""
    e = F.col("embedding")
    odd = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return e.isNotNull() & (F.size(e) == dims) & ~odd


def first_centroids(vectors: DataFrame, k: int, dims: int, seed: int) -> list[list[int]]:
    """The vectors with the smallest sha256 of ``seed:vec_id``, at most ``k`` of them."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = vectors.where(_whole(vectors, dims)).select(F.col("embedding").cast("array<double>").alias("e"), order.alias("h")).orderBy("h", "e").limit(k)
    return [[_floor(v) for v in row["e"]] for row in chosen.collect()]


def moved(vectors: DataFrame, centroids: list[list[int]], dims: int) -> list[list[int]]:
    """The centroids after one round: the floor of the mean of their vectors, in every component."""
    sums = vectors.mapInArrow(partial(_sums, dims=dims, t=tournament(centroids)), "cluster int, component int, place int, digit long")
    total: dict[tuple[int, int], int] = {}
    # one row per centroid, component and digit, whatever the number of vectors
    for r in sums.groupBy("cluster", "component", "place").agg(F.sum(F.col("digit").cast("decimal(38,0)")).alias("digit")).collect():
        key = r["cluster"], r["component"]
        total[key] = total.get(key, 0) + int(r["digit"]) * LIMB ** r["place"]
    return [[total[i, d] // total[i, -1] for d in range(dims)] if (i, -1) in total else c for i, c in enumerate(centroids)]


def _fitting(total: int | None) -> int | None:
    return int(total) if total is not None and total <= LONG else None


def clusters(vectors: DataFrame, k: int = 40, dims: int = 64, rounds: int = 5, seed: int = 2) -> DataFrame:
    """Cluster of every whole vector of ``vectors`` (vec_id, embedding): vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Each round is one pass over the vectors without a shuffle of them: a task
    assigns its vectors and passes on k x (dims + 1) sums. Only those sums reach
    the driver. All arithmetic is in whole numbers, so results do not depend on
    the order of rows or on the number of tasks; numbers too large for 64 bits
    are handled as Python's.

    Vectors that are null, of another length, or hold null, NaN or infinite
    components are no rows of the result. Ties of distance go to the smaller
    number. Repeated vec_ids are rows each; among the first centroids rows of one
    vec_id are ordered by their components, and a null vec_id stands for empty
    text. Fewer vectors than k make fewer centroids, none an empty result. A
    distance or inertia beyond a long is null. Other columns are ignored.
    """
    vectors = vectors.select("vec_id", "embedding")
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    centroids = first_centroids(vectors, k, dims, seed)
    if not centroids:
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = moved(vectors, centroids, dims)
    placed = written(vectors.mapInArrow(partial(_assigned, dims=dims, t=tournament(centroids)), f"vec_id {kind}, cluster int, distance long"), "clusters")
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n"), F.count("distance").alias("known"))
    inertia = {r["cluster"]: r["s"] if r["n"] == r["known"] else None for r in sums.collect()}  # k rows
    whole = None if None in inertia.values() else sum(inertia.values())
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    facts = spark.createDataFrame([(c, _fitting(s), _fitting(whole), digest[c]) for c, s in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
