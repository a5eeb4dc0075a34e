"""Points, areas and cells."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .cover import SIZES, covered_by, polygon_cover
from .joins import attach, attach_group


def _hull(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Corners of the convex hull, counter-clockwise from the leftmost point."""
    pts = sorted(set(points))
    if len(pts) < 3:
        return pts

    def side(path):
        chain = []
        for p in path:
            while len(chain) > 1:
                (ax, ay), (bx, by) = chain[-2], chain[-1]
                if (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax) > 0:
                    break
                chain.pop()
            chain.append(p)
        return chain[:-1]

    return side(pts) + side(pts[::-1])


def _cross(a: Column, b: Column, p: Column) -> Column:
    """Positive where p lies left of the way from a to b."""
    return (b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"])


def _extremes(pts: DataFrame, directions: int) -> DataFrame:
    """(g, e): per group the farthest points in all directions, counter-clockwise from the leftmost, each once."""
    xy = F.struct("x", "y")
    turns = [math.pi + 2 * math.pi * k / directions for k in range(1, directions)]
    far = [F.max(F.struct((F.col("x") * math.cos(t) + F.col("y") * math.sin(t)).alias("d"), xy.alias("p")))["p"].alias(f"_{k}") for k, t in enumerate(turns, 1)]
    wide = pts.groupBy("g").agg(F.min(xy).alias("_0"), *far)
    return wide.select("g", F.array_distinct(F.array(*[f"_{k}" for k in range(directions)])).alias("e"))


def convex_hull(df: DataFrame, group: str, lon: str, lat: str, directions: int = 64) -> DataFrame:
    """Hull corners per group: (group, corner, lon, lat), counter-clockwise from the leftmost.

    A hull of hulls is the hull of the whole, so every batch of a scan is
    reduced to its corners before anything moves.  The farthest points in
    ``directions`` directions are corners of the hull; a point inside their
    polygon is none, and of the others each lies beyond one of its sides.  The
    corners beyond a side depend on the points there alone, so every (group,
    side) is a task of its own, and no task holds a whole hull.  Points on a
    straight side are no corners; rows without a place are left out.
    """
    gtype = dict(df.dtypes)[group]
    pts = df.select(F.col(group).alias("g"), F.col(lon).cast("double").alias("x"), F.col(lat).cast("double").alias("y"))
    pts = pts.where(F.col("x").isNotNull() & F.col("y").isNotNull())

    def reduce_batches(batches):
        for pdf in batches:
            for g, part in pdf.groupby("g", dropna=False, sort=False):
                corners = _hull(list(zip(part["x"], part["y"])))
                yield pd.DataFrame({"g": [part["g"].iloc[0]] * len(corners), "x": [c[0] for c in corners], "y": [c[1] for c in corners]})

    local = cut_lineage(pts.mapInPandas(reduce_batches, f"g {gtype}, x double, y double"))
    ends = _extremes(local, directions)
    end = lambda i: F.get("e", i % F.size("e"))
    me = F.struct("x", "y")
    beyond = F.filter(F.sequence(F.lit(0), F.size("e") - 1), lambda i: _cross(end(i), end(i + 1), me) < 0)
    spread = attach(local, ends, ["g"], null_safe=True).withColumn("side", F.get(beyond, F.lit(0))).where("side is not null").select("g", "e", "side", "x", "y")
    own = ends.select("g", "e", F.posexplode("e").alias("side", "p")).select("g", "e", "side", F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    sides = spread.unionByName(own).select("g", "side", "x", "y", end(F.col("side")).alias("a"), end(F.col("side") + 1).alias("b"))
    sides = sides.select("g", "side", "x", "y", F.col("a.x").alias("ax"), F.col("a.y").alias("ay"), F.col("b.x").alias("bx"), F.col("b.y").alias("by"))

    def chain(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        first, last = ((float(pdf[f"{n}x"].iloc[0]), float(pdf[f"{n}y"].iloc[0])) for n in "ab")
        corners = _hull([first, last, *zip(pdf["x"], pdf["y"])])
        at = corners.index(first)
        corners = corners[at:] + corners[:at]
        corners = corners[: corners.index(last)] if last != first else corners
        return pd.DataFrame({"g": [pdf["g"].iloc[0]] * len(corners), "side": [key[1]] * len(corners), "nth": range(len(corners)), "x": [c[0] for c in corners], "y": [c[1] for c in corners]})

    chains = sides.groupBy("g", "side").applyInPandas(chain, f"g {gtype}, side int, nth int, x double, y double")
    # a farthest point between two others on a straight line is no corner; at most ``directions`` rows a group
    known = chains.groupBy("g", "side").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("nth") == 0, me)).alias("first"), F.max(F.when(F.col("nth") == 1, me)).alias("second"), F.max_by(me, "nth").alias("last")
    )
    w = Window.partitionBy("g").orderBy("side")
    whole = Window.partitionBy("g")
    before = F.lag("last").over(w)
    after = F.coalesce("second", F.lead("first").over(w), F.min_by("first", "side").over(whole))
    flat = (F.col("side") > 0) & (F.sum("n").over(whole) > 2) & (_cross(before, F.col("first"), after) <= 0)
    known = known.withColumn("flat", F.coalesce(flat, F.lit(False)))
    start = F.coalesce(F.sum(F.col("n") - F.col("flat").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    known = known.select("g", "side", "flat", start.alias("start"))
    out = attach(chains, known, ["g", "side"], null_safe=True).where(~F.col("flat") | (F.col("nth") > 0))
    corner = (F.col("start") + F.col("nth") - F.col("flat").cast("int")).cast("int")
    return out.select(F.col("g").alias(group), corner.alias("corner"), F.col("x").alias(lon), F.col("y").alias(lat))


def point_in_polygon_join(points: DataFrame, lon: str, lat: str, polygons: DataFrame, name: str, ring: str, sizes: Sequence[float] = SIZES) -> DataFrame:
    """Area of each point; points in no area keep a NULL area, points in several have a row for each.

    Areas are covered with cells of several sizes (``plazaworks.operators.cover``)
    and meet the points by cell: the join is an equi-join, inner cells need no
    test and border cells test their own few edges.
    """
    return covered_by(points, lon, lat, polygon_cover(polygons, name, ring, sizes), name, sizes)


def cell_counts(df: DataFrame, cell: Column, name: str = "cell") -> DataFrame:
    """Points per grid cell."""
    return df.groupBy(cell.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def area_users(df: DataFrame, area: str, user: str, is_new: Column) -> DataFrame:
    """Rows, distinct users, and new and returning users per area."""
    return df.groupBy(area).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(user).alias("users"),
        F.count_distinct(F.when(is_new, F.col(user))).alias("new_users"),
        F.count_distinct(F.when(~is_new, F.col(user))).alias("returning_users"),
    )


def heavy_users(df: DataFrame, user: str, more_than: int = 2) -> DataFrame:
    """Rows of users with more than ``more_than`` rows, with their count."""
    return attach_group(df, [user], F.count(F.lit(1)).alias("n")).where(F.col("n") > more_than)


def od_matrix(df: DataFrame, origin: str, destination: str) -> DataFrame:
    """Trips per origin and destination."""
    return df.groupBy(origin, destination).agg(F.count(F.lit(1)).alias("n"))


def peak_window(df: DataFrame, ts: str, start: str, end: str, first_hour: int = 8, last_hour: int = 19) -> DataFrame:
    """Working-day rows between two days, inside the busy hours (all ends included)."""
    t = F.col(ts)
    in_days = (t >= F.lit(start).cast("timestamp_ntz")) & (t < F.lit(end).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY"))
    return df.where(in_days & ~F.dayofweek(t).isin(1, 7) & F.hour(t).between(first_hour, last_hour))
