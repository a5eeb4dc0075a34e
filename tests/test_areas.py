"""Polygon covers and hulls against brute force."""

import time

import numpy as np
import pytest

from plazaworks.operators import cover as C
from plazaworks.operators import spatial
from plazaworks.operators.spatial import convex_hull, point_in_polygon_join


def star(corners, seed, radius=0.5, at=(0.1, -0.2)):
    """A ring whose corners go in and out; only neighbours meet."""
    rng = np.random.default_rng(seed)
    turn = np.arange(corners) * 2 * np.pi / corners
    reach = radius * rng.uniform(0.4, 1.0, corners)
    return np.stack([at[0] + reach * np.cos(turn), at[1] + reach * np.sin(turn)], axis=1)


def inside(ring, x, y):
    a, b = ring, np.roll(ring, -1, axis=0)
    out = np.zeros(len(x), bool)
    for (x1, y1), (x2, y2) in zip(a.tolist(), b.tolist(), strict=True):
        if y1 != y2:
            out ^= ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
    return out


def rings(spark, *shapes):
    rows = [(n, [{"lon": float(x), "lat": float(y)} for x, y in r]) for n, r in shapes]
    return spark.createDataFrame(rows, "zone string, ring array<struct<lon:double,lat:double>>")


def test_points_agree_with_the_ring(spark):
    """Polygons that overlap, a square on cell borders, one within a cell, one over many large cells, and none."""
    square = np.array([(0.0, 0.0), (0.64, 0.0), (0.64, 0.64), (0.0, 0.64)])
    shapes = [("a", star(300, 1)), ("b", star(40, 2, 0.2, (0.3, 0.0))), ("square", square), ("tiny", star(9, 3, 0.0004)), ("wide", star(12, 4, 9.0)), ("line", square[:2]), ("none", square[:0])]
    rng = np.random.default_rng(5)
    pts = np.concatenate([rng.uniform(-0.7, 0.9, (3000, 2)), rng.uniform(-10, 10, (800, 2)), 0.1 + rng.uniform(-0.0005, 0.0005, (300, 2)) + [0, -0.3], star(300, 1)[:50] * 0.999])
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)] + [(-1, None, 1.0), (-2, 1.0, None)], "id int, lon double, lat double")
    want = {(i, n) for n, r in shapes if len(r) > 2 for i in np.flatnonzero(inside(r, pts[:, 0], pts[:, 1])).tolist()}
    alone = set(range(-2, len(pts))) - {i for i, _ in want}
    got = sorted((r["id"], r["zone"] or "") for r in point_in_polygon_join(points, "lon", "lat", rings(spark, *shapes), "zone", "ring").collect())
    assert got == sorted([*want, *((i, "") for i in alone)])


@pytest.mark.parametrize("corners", [4, 1000, 20000])
def test_cells_hold_few_edges(corners):
    ring = star(corners, 7)
    cells = list(C.cells_of(ring))
    held = [len(c[4]) for c in cells if c[4] is not None]
    larger = [len(c[4]) for c in cells if c[4] is not None and c[0] < len(C.SIZES) - 1]
    assert max(larger, default=0) <= C.FEW
    # the spikes of a star are as long as it is wide, some two hundred of the smallest cells
    assert sum(held) <= 250 * corners and sum(larger) <= C.FEW * len(larger)
    area = sum((C.SIZES[c[0]]) ** 2 for c in cells if c[4] is None)
    assert area < 0.5 * abs(np.sum(ring[:, 0] * np.roll(ring[:, 1], -1) - ring[:, 1] * np.roll(ring[:, 0], -1))) + 1e-9


def test_a_large_polygon_stays_linear():
    """Ten times the corners on a smooth line: about ten times the edges held and the time, not a hundred times."""
    def work(n):
        turn = np.arange(n) * 2 * np.pi / n
        ring = np.stack([np.cos(turn), np.sin(turn)], axis=1)
        start = time.perf_counter()
        held = sum(len(c[4]) for c in C.cells_of(ring) if c[4] is not None)
        return held, time.perf_counter() - start

    small, large = work(10_000), work(100_000)
    assert large[0] < 12 * small[0] and large[1] < 30 * small[1]


def test_repeated_points_and_names(spark):
    """Rows are kept as they are: repeated points, areas of one name, extra columns."""
    box = np.array([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)])
    areas = rings(spark, ("x", box), ("x", box + 0.5))
    points = spark.createDataFrame([(0.25, 0.25, 7), (0.25, 0.25, 7), (0.75, 0.75, 8), (3.0, 3.0, 9)], "lon double, lat double, level int")
    got = sorted((r["level"], r["zone"]) for r in point_in_polygon_join(points, "lon", "lat", areas, "zone", "ring").collect() if r["zone"])
    assert got == [(7, "x"), (7, "x"), (8, "x"), (8, "x")]
    assert point_in_polygon_join(points, "lon", "lat", areas.limit(0), "zone", "ring").where("zone is null").count() == 4


def hull_of(points):
    """Corners by gift wrapping in whole numbers, counter-clockwise from the leftmost, lowest one."""
    pts = sorted(set(points))
    out, at = [], pts[0]
    while not out or at != out[0]:
        out.append(at)
        best = None
        for p in pts:
            if p == at:
                continue
            turn = 0 if best is None else (best[0] - at[0]) * (p[1] - at[1]) - (best[1] - at[1]) * (p[0] - at[0])
            far = best is None or (p[0] - at[0]) ** 2 + (p[1] - at[1]) ** 2 > (best[0] - at[0]) ** 2 + (best[1] - at[1]) ** 2
            if best is None or turn < 0 or (turn == 0 and far):
                best = p
        if best is None:
            break
        at = best
    return out


def test_hulls_agree_with_gift_wrapping(spark):
    """Whole numbers with many points on straight sides, groups of one, two and three points, a line, nulls."""
    rng = np.random.default_rng(6)
    groups = {f"g{i}": [tuple(map(int, p)) for p in rng.integers(0, size, (n, 2))] for i, (n, size) in enumerate([(400, 9), (400, 1000), (60, 4), (3, 50), (2, 50), (1, 5)])}
    groups["line"] = [(i, 2 * i) for i in range(30)]
    groups["same"] = [(1, 1)] * 5
    groups[None] = [(0, 0), (4, 0), (4, 4), (0, 4), (2, 0), (2, 2), (4, 2)]
    rows = [(g, float(x), float(y)) for g, pts in groups.items() for x, y in pts] + [("g0", None, 1.0), ("none", 1.0, None)]
    got = {}
    for r in convex_hull(spark.createDataFrame(rows, "g string, x double, y double"), "g", "x", "y", 16).orderBy("corner").collect():
        got.setdefault(r["g"], []).append((r["corner"], r["x"], r["y"]))
    for g, pts in groups.items():
        assert got[g] == [(i, float(x), float(y)) for i, (x, y) in enumerate(hull_of(pts))], g
    assert "none" not in got


def test_no_task_holds_a_whole_circle(spark, monkeypatch):
    """All points are corners; each side of the farthest points holds a small part of them."""
    n = 20_000
    turn = np.arange(n) * 2 * np.pi / n
    rows = [("a", float(np.cos(t)), float(np.sin(t))) for t in turn]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(64)
    out = convex_hull(df, "g", "x", "y").orderBy("corner").collect()
    assert len(out) == n and [r["corner"] for r in out] == list(range(n))
    ends = spatial._extremes(df.select("g", "x", "y"), 64).collect()[0]["e"]
    places = sorted(round(np.arctan2(e["y"], e["x"]) * n / 2 / np.pi) % n for e in ends)
    assert len(places) == 64 and max(np.diff([*places, places[0] + n])) < 0.02 * n


@pytest.mark.parametrize(
    ("a", "b", "metres"),
    [  # lon, lat; published distances on the WGS 84 ellipsoid, and a degree along the equator and a meridian
        ((0.0, 0.0), (1.0, 0.0), 111319.491),
        ((0.0, 0.0), (0.0, 1.0), 110574.389),
        ((0.0, 89.0), (0.0, 90.0), 111693.865),
        ((0.0, -90.0), (0.0, 90.0), 20015115.0),  # opposite: great circle
        ((144 + 25 / 60 + 29.5244 / 3600, -37 - 57 / 60 - 3.7203 / 3600), (143 + 55 / 60 + 35.3839 / 3600, -37 - 39 / 60 - 10.1561 / 3600), 54972.271),
        ((10.0, 10.0), (10.0, 10.0), 0.0),
    ],
)
def test_distance_on_the_ellipsoid(one, a, b, metres):
    from pyspark.sql import functions as F

    from plazaworks.functions.geo import spheroid_m

    x = [F.lit(v) for v in (*a, *b)]
    assert one(spheroid_m(*x)) == pytest.approx(metres, abs=1.0)
    assert one(spheroid_m(x[2], x[3], x[0], x[1])) == pytest.approx(metres, abs=1.0)


def test_distance_of_nothing_is_nothing(one):
    from pyspark.sql import functions as F

    from plazaworks.functions.geo import spheroid_m

    assert one(spheroid_m(F.lit(None).cast("double"), F.lit(1.0), F.lit(1.0), F.lit(1.0))) is None


def test_steps_end_at_the_fixed_point(spark):
    """More steps than a row needs change nothing."""
    from pyspark.sql import functions as F

    from plazaworks.functions.geo import spheroid_m

    rows = [(float(a), float(b)) for a, b in ((-77.0, -12.0), (-76.5, -12.4), (0.0, 0.0), (100.0, 60.0))]
    df = spark.createDataFrame(rows, "lon double, lat double")
    far = [spheroid_m("lon", "lat", F.lit(-76.958073), F.lit(-12.21717), n).alias(f"m{n}") for n in (12, 24, 60)]
    for r in df.select(*far).collect():
        assert r["m12"] == pytest.approx(r["m24"], abs=1e-6) and r["m24"] == pytest.approx(r["m60"], abs=1e-6)
