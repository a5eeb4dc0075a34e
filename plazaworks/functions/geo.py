"""Coordinates: parsing, distances, cells."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sem import col, regexp_extract_n, safe_cast

EARTH_M = 6371008.8  # mean radius in metres
KM_PER_DEGREE = 111.32  # fixed value: kilometres of one degree


def parse_latlon(c) -> tuple[Column, Column]:
    """``'lat,lon'`` text -> (lat, lon)."""
    return (
        safe_cast(regexp_extract_n(c, r"^([-0-9.]+)"), "double"),
        safe_cast(regexp_extract_n(c, r"([-0-9.]+)$"), "double"),
    )


def geodesic_m(lon1, lat1, lon2, lat2) -> Column:
    """Great-circle metres (haversine; within 0.5 % of the ellipsoid)."""
    lon1, lat1, lon2, lat2 = (F.radians(col(c)) for c in (lon1, lat1, lon2, lat2))
    h = F.pow(F.sin((lat2 - lat1) / 2), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2)
    h = F.when(h > 1, F.lit(1.0)).otherwise(h)  # rounding may step over 1; NULL stays NULL
    return F.lit(2 * EARTH_M) * F.asin(F.sqrt(h))


# Semi-major axis in metres and flattening of the WGS 84 ellipsoid.
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563
ROUNDS = 24  # steps of the iteration; points not almost opposite each other need a handful


def spheroid_m(lon1, lat1, lon2, lat2, rounds: int = ROUNDS) -> Column:
    """Metres on the WGS 84 ellipsoid, by Vincenty's inverse formula as a column expression.

    The difference of longitudes on the auxiliary sphere is iterated to its fixed
    point, ``rounds`` times at most; a row that has reached it is left alone.  Equal points are 0 metres apart.
    Points within half a degree of opposite each other, where the iteration need
    not converge, get the great-circle distance; a NULL stays NULL.
    """
    lon1, lat1, lon2, lat2 = (F.radians(col(c)) for c in (lon1, lat1, lon2, lat2))
    f, a = F.lit(WGS84_F), WGS84_A
    b = a * (1 - WGS84_F)
    u1, u2 = F.atan((1 - f) * F.tan(lat1)), F.atan((1 - f) * F.tan(lat2))
    # everything that a step needs is worked out once a row
    fixed = F.struct((lon2 - lon1).alias("l"), F.sin(u1).alias("s1"), F.cos(u1).alias("c1"), F.sin(u2).alias("s2"), F.cos(u2).alias("c2"))

    def angles(p: Column, lam: Column) -> dict[str, Column]:
        x, y = p["c2"] * F.sin(lam), p["c1"] * p["s2"] - p["s1"] * p["c2"] * F.cos(lam)
        sin_s = F.sqrt(x * x + y * y)
        cos_s = p["s1"] * p["s2"] + p["c1"] * p["c2"] * F.cos(lam)
        sin_a = F.coalesce(F.try_divide(p["c1"] * p["c2"] * F.sin(lam), sin_s), F.lit(0.0))
        cos2_a = 1 - sin_a * sin_a
        # on the equator there is no such angle, and no term that needs it
        cos_2m = F.coalesce(cos_s - F.try_divide(2 * p["s1"] * p["s2"], cos2_a), F.lit(0.0))
        return {"sin_s": sin_s, "cos_s": cos_s, "sin_a": sin_a, "cos2_a": cos2_a, "cos_2m": cos_2m, "s": F.atan2(sin_s, cos_s)}

    def step(p: Column):
        def once(state: Column, _: Column) -> Column:
            lam = state["lam"]

            def next_of(q: Column) -> Column:
                c = f / 16 * q["cos2_a"] * (4 + f * (4 - 3 * q["cos2_a"]))
                inner = q["cos_2m"] + c * q["cos_s"] * (2 * q["cos_2m"] * q["cos_2m"] - 1)
                return p["l"] + (1 - c) * f * q["sin_a"] * (q["s"] + c * q["sin_s"] * inner)

            after = _bound(F.struct(*[v.alias(n) for n, v in angles(p, lam).items()]), next_of)
            return F.when(state["before"] == lam, state).otherwise(F.struct(lam.alias("before"), after.alias("lam")))

        return once

    def metres(p: Column) -> Column:
        start = F.struct(F.lit(None).cast("double").alias("before"), p["l"].alias("lam"))
        lam = F.aggregate(F.array_repeat(F.lit(0), rounds), start, step(p))["lam"]

        def length(q: Column) -> Column:
            u = q["cos2_a"] * (a * a - b * b) / (b * b)
            big_a = 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u)))
            big_b = u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))
            m = 2 * q["cos_2m"] * q["cos_2m"]
            turn = q["cos_s"] * (m - 1) - big_b / 6 * q["cos_2m"] * (4 * q["sin_s"] * q["sin_s"] - 3) * (2 * m - 3)
            return b * big_a * (q["s"] - big_b * q["sin_s"] * (q["cos_2m"] + big_b / 4 * turn))

        return _bound(lam, lambda x: _bound(F.struct(*[v.alias(n) for n, v in angles(p, x).items()]), length))

    distance = _bound(fixed, metres)
    opposite = geodesic_m(*(F.degrees(x) for x in (lon1, lat1, lon2, lat2)))
    return F.when(opposite > math.pi * EARTH_M * (1 - 0.5 / 180), opposite).otherwise(distance)


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def manhattan_km(lon1, lat1, lon2, lat2) -> Column:
    """City-block kilometres; longitude is scaled at the first point's latitude."""
    lon1, lat1, lon2, lat2 = (col(c) for c in (lon1, lat1, lon2, lat2))
    scale = F.cos(F.radians(lat1))
    return F.abs(lat1 - lat2) * KM_PER_DEGREE + F.abs(lon1 - lon2) * KM_PER_DEGREE * scale


def local_metres(lon, lat, lon0: float, lat0: float) -> tuple[Column, Column]:
    """Plane metres (east, north) around an origin."""
    k = KM_PER_DEGREE * 1000.0
    return (col(lon) - lon0) * (k * math.cos(math.radians(lat0))), (col(lat) - lat0) * k


def square_cell(lon, lat, size_m: float, lon0: float = 0.0, lat0: float = 0.0) -> Column:
    """Id ``'col:row'`` of the square cell that holds a point."""
    x, y = local_metres(lon, lat, lon0, lat0)
    return F.concat_ws(":", F.floor(x / size_m).cast("string"), F.floor(y / size_m).cast("string"))


def hex_cell(lon, lat, size_m: float, lon0: float = 0.0, lat0: float = 0.0) -> Column:
    """Id ``'col:row'`` of the hexagon (flat-to-flat ``size_m``) that holds a point.

    Hexagon centres lie on two interleaved rectangular lattices; the nearer
    centre wins.  The ids are this library's own, not those of any global index.
    """
    x, y = local_metres(lon, lat, lon0, lat0)
    dx, dy = size_m, size_m * 3.0**0.5
    ax, ay = F.round(x / dx), F.round(y / dy)
    bx, by = F.floor(x / dx), F.floor(y / dy)
    da = F.pow(x - ax * dx, 2) + F.pow(y - ay * dy, 2)
    db = F.pow(x - (bx + 0.5) * dx, 2) + F.pow(y - (by + 0.5) * dy, 2)
    near_a = da <= db
    cx = F.when(near_a, ax * 2).otherwise(bx * 2 + 1).cast("bigint")
    cy = F.when(near_a, ay * 2).otherwise(by * 2 + 1).cast("bigint")
    return F.concat_ws(":", cx.cast("string"), cy.cast("string"))


# edge of a cell in metres by resolution, for the two levels the reports use
CELL_METRES = {8: 800.0, 12: 16.0}


def grid_cell(lon, lat, resolution: int) -> Column:
    """Hexagon id at a resolution (8 is a neighbourhood, 12 a doorstep)."""
    return hex_cell(lon, lat, CELL_METRES[resolution])
