"""Polygons as cells of several sizes.

A polygon becomes inner cells, which need no test, and border cells, which hold
only the edges that pass through them.  Where it has more detail its cells are
smaller, so the cost of a point does not grow with the corners of its polygon.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZES = (0.64, 0.16, 0.04, 0.01, 0.0025)  # degrees; each a quarter of the one before
FEW = 16  # edges that a cell may hold before it is cut again

EDGES = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def _crossings(e: np.ndarray, x: float, y: float) -> int:
    """Edges (x1, y1, x2, y2) that a ray from (x, y) eastwards crosses."""
    x1, y1, x2, y2 = e.T
    over = (y1 > y) != (y2 > y)
    x1, y1, x2, y2 = (v[over] for v in (x1, y1, x2, y2))
    return int((x < (x2 - x1) * (y - y1) / (y2 - y1) + x1).sum())


def _turns(e: np.ndarray, ax: float, ay: float, px: float, py: float) -> int:
    """Edges crossed on the way from (ax, ay) up or down to py, then along to px."""
    x1, y1, x2, y2 = e.T
    with np.errstate(divide="ignore", invalid="ignore"):
        yi = (y2 - y1) * (ax - x1) / (x2 - x1) + y1
        xi = (x2 - x1) * (py - y1) / (y2 - y1) + x1
    up = ((x1 > ax) != (x2 > ax)) & ((yi > ay) != (yi > py))
    along = ((y1 > py) != (y2 > py)) & ((xi > ax) != (xi > px))
    return int(up.sum() + along.sum())


def cells_of(ring: np.ndarray, sizes: Sequence[float] = SIZES, few: int = FEW) -> Iterator[tuple[int, int, int, bool, np.ndarray | None]]:
    """(level, column, row, whether the centre is inside, edges or None) of the cells that a ring (n, 2) covers.

    Cells that no edge touches and whose centre is outside are left out.  A cell
    with more than ``few`` edges is cut into sixteen, down to the smallest size;
    whether a centre is inside follows from that of the cell above and the edges
    between the two.
    """
    edges = np.concatenate([ring, np.roll(ring, -1, axis=0)], axis=1)
    low, high = ring.min(axis=0), ring.max(axis=0)
    # cells above the largest size are only steps on the way; the first one holds the whole ring
    top = 0
    while np.any(np.floor(high / (sizes[0] * 4**top)) - np.floor(low / (sizes[0] * 4**top)) > 1):
        top += 1
    span = [sizes[0] * 4**k for k in range(top, 0, -1)] + list(sizes)

    def held(e: np.ndarray, level: int, cx: int, cy: int) -> np.ndarray:
        s, slack = span[level], span[level] * 1e-9
        x0, y0 = cx * s - slack, cy * s - slack
        x1, y1 = (cx + 1) * s + slack, (cy + 1) * s + slack
        near = (np.minimum(e[:, 0], e[:, 2]) <= x1) & (np.maximum(e[:, 0], e[:, 2]) >= x0) & (np.minimum(e[:, 1], e[:, 3]) <= y1) & (np.maximum(e[:, 1], e[:, 3]) >= y0)
        e = e[near]
        # all four corners on one side of the edge's line: it passes by
        side = [(e[:, 2] - e[:, 0]) * (y - e[:, 1]) - (e[:, 3] - e[:, 1]) * (x - e[:, 0]) for x in (x0, x1) for y in (y0, y1)]
        return e[(np.minimum.reduce(side) <= 0) & (np.maximum.reduce(side) >= 0)] if len(e) else e

    stack = []
    for cx in range(int(np.floor(low[0] / span[0])), int(np.floor(high[0] / span[0])) + 1):
        for cy in range(int(np.floor(low[1] / span[0])), int(np.floor(high[1] / span[0])) + 1):
            inside = _crossings(edges, (cx + 0.5) * span[0], (cy + 0.5) * span[0]) % 2 == 1
            stack.append((0, cx, cy, inside, held(edges, 0, cx, cy)))
    while stack:
        level, cx, cy, inside, mine = stack.pop()
        size = span[level]
        if level >= top and (len(mine) <= few or level == len(span) - 1):
            if len(mine):
                yield level - top, cx, cy, inside, mine
            elif inside:
                yield level - top, cx, cy, True, None
            continue
        if not len(mine) and not inside:
            continue
        ax, ay = (cx + 0.5) * size, (cy + 0.5) * size
        for i in range(4):
            for j in range(4):
                x, y = 4 * cx + i, 4 * cy + j
                small = span[level + 1]
                turned = _turns(mine, ax, ay, (x + 0.5) * small, (y + 0.5) * small) % 2 == 1 if len(mine) else False
                stack.append((level + 1, x, y, inside != turned, held(mine, level + 1, x, y)))


def _cover(batches: Iterator[pa.RecordBatch], sizes: Sequence[float], few: int) -> Iterator[pa.RecordBatch]:
    kinds = pa.struct([(n, pa.float64()) for n in ("x1", "y1", "x2", "y2")])
    for batch in batches:
        for r in range(batch.num_rows):
            ring = batch.column(1)[r].as_py() or []
            ring = np.array([(p["lon"], p["lat"]) for p in ring if p and p["lon"] is not None and p["lat"] is not None], float).reshape(-1, 2)
            cells = list(cells_of(ring, sizes, few)) if len(ring) >= 3 else []
            for at in range(0, len(cells), 1024):
                part = cells[at : at + 1024]
                names = pa.concat_arrays([batch.column(0).slice(r, 1)] * len(part))
                edges = [None if c[4] is None else [dict(zip(("x1", "y1", "x2", "y2"), e, strict=True)) for e in c[4].tolist()] for c in part]
                yield pa.RecordBatch.from_arrays(
                    [names, *[pa.array([c[k] for c in part], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.bool_()))], pa.array(edges, pa.list_(kinds))],
                    names=["area", "level", "cx", "cy", "inside", "edges"],
                )


def polygon_cover(polygons: DataFrame, name: str, ring: str, sizes: Sequence[float] = SIZES, few: int = FEW) -> DataFrame:
    """(area, level, cx, cy, inside, edges): the cells of every polygon, one polygon at a time in its task.

    Rings are arrays of (lon, lat) corners; those of fewer than three cover nothing.
    """
    kind = polygons.schema[name].dataType.simpleString()
    schema = f"area {kind}, level int, cx long, cy long, inside boolean, edges {EDGES}"
    return polygons.select(F.col(name).alias("area"), F.col(ring).alias("ring")).mapInArrow(partial(_cover, sizes=tuple(sizes), few=few), schema)


def in_cell(lon: Column, lat: Column, cell: Column, size: float) -> Column:
    """Whether a point of a cell is inside: the centre's answer, turned by each edge on the way to the point."""
    ax, ay = (cell["cx"] + 0.5) * size, (cell["cy"] + 0.5) * size

    def crossed(e: Column) -> Column:
        yi = (e["y2"] - e["y1"]) * (ax - e["x1"]) / F.nullif(e["x2"] - e["x1"], F.lit(0.0)) + e["y1"]
        xi = (e["x2"] - e["x1"]) * (lat - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]
        up = ((e["x1"] > ax) != (e["x2"] > ax)) & ((yi > ay) != (yi > lat))
        along = ((e["y1"] > lat) != (e["y2"] > lat)) & ((xi > ax) != (xi > lon))
        return F.coalesce(up.cast("int"), F.lit(0)) + F.coalesce(along.cast("int"), F.lit(0))

    turns = F.aggregate(F.coalesce(cell["edges"], F.array().cast(EDGES)), F.lit(0), lambda n, e: n + crossed(e))
    return cell["inside"] != (turns % 2 == 1)


def covered_by(points: DataFrame, lon: str, lat: str, cover: DataFrame, name: str, sizes: Sequence[float] = SIZES) -> DataFrame:
    """``points`` with each area that holds them; points in no area stay once, with a NULL.

    One equi-join on the cell for each size, each with one row a cell, so the
    points keep their number until the areas found are opened; a cell that holds
    a third of all points is split by AQE like any hot join key.
    """
    cells = cover.groupBy("level", "cx", "cy").agg(F.collect_list(F.struct("area", "cx", "cy", "inside", "edges")).alias("_cells"))
    out, found = points, []

    def holds(size: float):
        return lambda cell: in_cell(F.col(lon), F.col(lat), cell, size)

    for level, size in enumerate(sizes):
        side = cells.where(F.col("level") == level).select(F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), F.col("_cells").alias(f"_c{level}"))
        out = out.withColumns({"_cx": F.floor(F.col(lon) / size), "_cy": F.floor(F.col(lat) / size)}).join(side, ["_cx", "_cy"], "left").drop("_cx", "_cy")
        found.append(F.transform(F.filter(f"_c{level}", holds(size)), lambda cell: cell["area"]))
    empty = F.array().cast(f"array<{cover.schema['area'].dataType.simpleString()}>")
    areas = reduce(lambda a, b: F.concat(a, b), [F.coalesce(f, empty) for f in found])
    return out.select(*points.columns, F.explode_outer(areas).alias(name))
