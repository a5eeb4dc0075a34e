"""Points, distances, cells, areas."""

import math

from pyspark.sql import functions as F

from ..functions import geo as G
from ..operators import spatial as S
from ..operators.keys import drop_duplicates_ordered
from ..operators.quality import compare_records
from ..session import spread
from .registry import query

# places are made from keys, so that both engines see the same points
_LON, _LAT = (-77.1, 7919, 10007, 0.3), (-12.2, 104729, 10009, 0.3)


def _place(key, spec):
    base, mul, mod, span = spec
    return F.lit(base) + ((F.col(key) * mul) % mod).cast("double") / mod * F.lit(span)


def _place_sql(key, spec):
    base, mul, mod, span = spec
    return f"(CAST({base} AS DOUBLE) + CAST(({key}*{mul})%{mod} AS DOUBLE)/{mod}*CAST({span} AS DOUBLE))"


def _points(t, table="customer", key="c_custkey", *more):
    return t(table, key, *more).withColumns({"lon": _place(key, _LON), "lat": _place(key, _LAT)})


def _points_sql(table="customer", key="c_custkey"):
    return f"(SELECT *, {_place_sql(key, _LON)} AS lon, {_place_sql(key, _LAT)} AS lat FROM {table})"


_HUB = (-76.958073, -12.217170)  # fixed values: the hub
_HAVERSINE = "2*6371008.8::DOUBLE*asin(sqrt(least(1.0::DOUBLE, pow(sin((radians({b})-radians(lat))/2),2)+cos(radians(lat))*cos(radians({b}))*pow(sin((radians({a})-radians(lon))/2),2))))"


@query(f"""
SELECT c_custkey, ROUND({_HAVERSINE.format(a='CAST(-76.958073 AS DOUBLE)', b='CAST(-12.21717 AS DOUBLE)')}/1000,3) AS geodesic_km,
 ROUND(abs(lat-CAST(-12.21717 AS DOUBLE))*CAST(111.32 AS DOUBLE)+abs(lon-CAST(-76.958073 AS DOUBLE))*CAST(111.32 AS DOUBLE)*cos(radians(lat)),3) AS manhattan_km FROM {_points_sql()}
""")
def geo_distance(t):
    x, y = F.lit(_HUB[0]), F.lit(_HUB[1])
    return _points(t).select(
        "c_custkey", F.round(G.geodesic_m("lon", "lat", x, y) / 1000, 3).alias("geodesic_km"), F.round(G.manhattan_km("lon", "lat", x, y), 3).alias("manhattan_km")
    )


def _vincenty_sql(rounds: int) -> str:
    """Vincenty's iteration written out, one step a common table."""
    f, a = repr(G.WGS84_F), repr(G.WGS84_A)
    parts = [f"""p AS (SELECT c_custkey, lon, lat, radians({_HUB[0]!r}::DOUBLE-lon) AS l, atan((1-{f}::DOUBLE)*tan(radians(lat))) AS u1, atan((1-{f}::DOUBLE)*tan(radians({_HUB[1]!r}::DOUBLE))) AS u2 FROM {_points_sql()}),
 q AS (SELECT *, sin(u1) AS s1, cos(u1) AS c1, sin(u2) AS s2, cos(u2) AS c2 FROM p), n0 AS (SELECT *, l AS lam FROM q)"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS (SELECT *, sqrt(pow(c2*sin(lam),2)+pow(c1*s2-s1*c2*cos(lam),2)) AS ss, s1*s2+c1*c2*cos(lam) AS cs FROM n{i}),
 b{i} AS (SELECT *, c1*c2*sin(lam)/ss AS sa FROM a{i}), d{i} AS (SELECT *, 1-sa*sa AS ca, cs-2*s1*s2/(1-sa*sa) AS cm, atan2(ss,cs) AS sg FROM b{i}), e{i} AS (SELECT *, {f}::DOUBLE/16*ca*(4+{f}::DOUBLE*(4-3*ca)) AS c FROM d{i})""")
        if i < rounds:
            parts.append(f"n{i + 1} AS (SELECT c_custkey, lon, lat, l, u1, u2, s1, c1, s2, c2, l+(1-c)*{f}::DOUBLE*sa*(sg+c*ss*(cm+c*cs*(2*cm*cm-1))) AS lam FROM e{i})")
    b = repr(G.WGS84_A * (1 - G.WGS84_F))
    return f"""WITH {", ".join(parts)}, g AS (SELECT *, ca*({a}::DOUBLE*{a}-{b}::DOUBLE*{b})/({b}::DOUBLE*{b}) AS u FROM e{rounds}),
 h AS (SELECT *, 1+u/16384*(4096+u*(-768+u*(320-175*u))) AS big_a, u/1024*(256+u*(-128+u*(74-47*u))) AS big_b FROM g)
SELECT c_custkey, ROUND({b}::DOUBLE*big_a*(sg-big_b*ss*(cm+big_b/4*(cs*(2*cm*cm-1)-big_b/6*cm*(4*ss*ss-3)*(4*cm*cm-3)))),3) AS metres FROM h"""


@query(_vincenty_sql(8))
def spheroid_distance(t):
    """Metres on the ellipsoid from each customer to the hub."""
    return spread(_points(t)).select("c_custkey", F.round(G.spheroid_m("lon", "lat", F.lit(_HUB[0]), F.lit(_HUB[1])), 3).alias("metres"))


@query("""
SELECT s_suppkey, TRY_CAST(regexp_extract(p,'^([-0-9.]+)',1) AS DOUBLE) AS lat, TRY_CAST(regexp_extract(p,'([-0-9.]+)$',1) AS DOUBLE) AS lon FROM
 (SELECT s_suppkey, CASE WHEN s_suppkey%10=0 THEN 'unknown' ELSE '-12.'||CAST(s_suppkey AS VARCHAR)||', -77.0'||CAST(s_nationkey AS VARCHAR) END AS p FROM supplier)
""")
def latlon_text(t):
    s = t("supplier", "s_suppkey", "s_nationkey")
    text = F.concat(F.lit("-12."), F.col("s_suppkey").cast("string"), F.lit(", -77.0"), F.col("s_nationkey").cast("string"))
    lat, lon = G.parse_latlon("p")
    return s.withColumn("p", F.when(F.col("s_suppkey") % 10 == 0, "unknown").otherwise(text)).select("s_suppkey", lat.alias("lat"), lon.alias("lon"))


_K = G.KM_PER_DEGREE * 1000.0
_KX = _K * math.cos(math.radians(-12.05))


@query(f"""
SELECT CAST(CAST(floor(x/500) AS BIGINT) AS VARCHAR)||':'||CAST(CAST(floor(y/500) AS BIGINT) AS VARCHAR) AS cell, COUNT(*) AS n FROM
 (SELECT (lon-CAST(-77.0 AS DOUBLE))*CAST({_KX!r} AS DOUBLE) AS x, (lat-CAST(-12.05 AS DOUBLE))*CAST({_K!r} AS DOUBLE) AS y FROM {_points_sql()}) GROUP BY 1
""")
def square_counts(t):
    return S.cell_counts(_points(t), G.square_cell("lon", "lat", 500.0, -77.0, -12.05))


_DY = 500.0 * 3.0**0.5


@query(f"""
WITH p AS (SELECT (lon-CAST(-77.0 AS DOUBLE))*CAST({_KX!r} AS DOUBLE) AS x, (lat-CAST(-12.05 AS DOUBLE))*CAST({_K!r} AS DOUBLE) AS y FROM {_points_sql()}),
q AS (SELECT x, y, round(x/500) AS ax, round(y/CAST({_DY!r} AS DOUBLE)) AS ay, floor(x/500) AS bx, floor(y/CAST({_DY!r} AS DOUBLE)) AS b_y FROM p),
h AS (SELECT *, pow(x-ax*500,2)+pow(y-ay*CAST({_DY!r} AS DOUBLE),2)<=pow(x-(bx+0.5::DOUBLE)*500,2)+pow(y-(b_y+0.5::DOUBLE)*CAST({_DY!r} AS DOUBLE),2) AS near FROM q)
SELECT CAST(CAST(CASE WHEN near THEN ax*2 ELSE bx*2+1 END AS BIGINT) AS VARCHAR)||':'||CAST(CAST(CASE WHEN near THEN ay*2 ELSE b_y*2+1 END AS BIGINT) AS VARCHAR) AS cell, COUNT(*) AS n FROM h GROUP BY 1
""")
def hexagon_counts(t):
    """Points per 500 m hexagon."""
    return S.cell_counts(_points(t), G.hex_cell("lon", "lat", 500.0, -77.0, -12.05))


@query(f"""
WITH p AS (SELECT DISTINCT c_nationkey AS g, lon AS x, lat AS y FROM {_points_sql()}),
e AS (SELECT a.g, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS b_y FROM p a JOIN p b ON a.g=b.g AND (a.x<>b.x OR a.y<>b.y)),
o AS (SELECT g, ax, ay, bx, b_y FROM e WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.g=e.g AND ((bx-ax)*(p.y-ay)-(b_y-ay)*(p.x-ax)<0 OR ((bx-ax)*(p.y-ay)-(b_y-ay)*(p.x-ax)=0 AND (p.x-ax)*(p.x-bx)+(p.y-ay)*(p.y-b_y)>0)))),
c AS (SELECT g, ax AS x, ay AS y, atan2(b_y-ay, bx-ax) AS way FROM o UNION SELECT g, MIN(x), MIN(y), 0 FROM p GROUP BY 1 HAVING COUNT(*)=1)
SELECT g AS c_nationkey, CAST(ROW_NUMBER() OVER (PARTITION BY g ORDER BY way) - 1 AS INT) AS corner, x AS lon, y AS lat FROM
 (SELECT g, x, y, CASE WHEN way<=-pi()/2 THEN way+2*pi() ELSE way END AS way FROM c)
""")
def hull_corners(t):
    """Convex hull of the customers of every nation."""
    return S.convex_hull(_points(t, "customer", "c_custkey", "c_nationkey"), "c_nationkey", "lon", "lat")


# corners of a zone around its centre, in degrees
_SHAPE = ((-0.05, -0.04), (0.05, -0.03), (0.02, 0.0), (0.04, 0.05), (-0.04, 0.04))


def _zones(t):
    n = t("nation", "n_nationkey", "n_name").withColumns({"x": _place("n_nationkey", _LON), "y": _place("n_nationkey", _LAT)})
    ring = F.array(*[F.struct((F.col("x") + F.lit(dx)).alias("lon"), (F.col("y") + F.lit(dy)).alias("lat")) for dx, dy in _SHAPE])
    return n.select(F.col("n_name").alias("zone"), ring.alias("ring"))


_EDGES = " UNION ALL ".join(
    f"SELECT n_name, lon+CAST({a[0]} AS DOUBLE) AS x1, lat+CAST({a[1]} AS DOUBLE) AS y1, lon+CAST({b[0]} AS DOUBLE) AS x2, lat+CAST({b[1]} AS DOUBLE) AS y2 FROM z"
    for a, b in zip(_SHAPE, _SHAPE[1:] + _SHAPE[:1])
)


@query(f"""
WITH z AS (SELECT * FROM {_points_sql('nation', 'n_nationkey')}), e AS ({_EDGES}), p AS (SELECT c_custkey, lon, lat FROM {_points_sql()}),
h AS (SELECT c_custkey, n_name FROM p, e WHERE (y1>lat)<>(y2>lat) AND lon<(x2-x1)*(lat-y1)/(y2-y1)+x1 GROUP BY 1,2 HAVING COUNT(*)%2=1)
SELECT p.c_custkey, n_name AS zone FROM p LEFT JOIN h USING (c_custkey)
""")
def point_in_polygon(t):
    """Zones of each customer's place; places outside all zones keep a NULL."""
    return S.point_in_polygon_join(_points(t), "lon", "lat", _zones(t), "zone", "ring").select("c_custkey", "zone")


@query("""
SELECT c_nationkey, COUNT(*) AS n, COUNT(DISTINCT o_custkey) AS users, COUNT(DISTINCT CASE WHEN o_orderstatus='F' THEN o_custkey END) AS new_users,
 COUNT(DISTINCT CASE WHEN o_orderstatus<>'F' THEN o_custkey END) AS returning_users FROM orders JOIN customer ON o_custkey=c_custkey GROUP BY 1
""")
def area_users(t):
    rows = t("orders", "o_custkey", "o_orderstatus").join(t("customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return S.area_users(rows, "c_nationkey", "o_custkey", F.col("o_orderstatus") == "F")


_OD = "SELECT o_orderkey, o_custkey, c_nationkey AS origin, CAST(o_orderkey%25 AS INT) AS destination FROM orders JOIN customer ON o_custkey=c_custkey"


def _trips(t):
    rows = t("orders", "o_orderkey", "o_custkey", "o_orderdate").join(t("customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.select("o_orderkey", "o_custkey", "o_orderdate", F.col("c_nationkey").alias("origin"), (F.col("o_orderkey") % 25).cast("int").alias("destination"))


@query(f"WITH t AS ({_OD}), h AS (SELECT * FROM t WHERE o_custkey IN (SELECT o_custkey FROM t GROUP BY 1 HAVING COUNT(*)>12)) SELECT origin, destination, COUNT(*) AS n FROM h GROUP BY 1,2")
def od_matrix(t):
    """Trips of heavy users per origin and destination."""
    return S.od_matrix(S.heavy_users(_trips(t), "o_custkey", 12), "origin", "destination")


@query("""
SELECT event_id FROM events WHERE ts>=TIMESTAMP '2024-01-09' AND ts<TIMESTAMP '2024-01-16' AND dayofweek(ts) NOT IN (0,6) AND hour(ts) BETWEEN 8 AND 19
""")
def peak_window(t):
    return S.peak_window(t("events", "event_id", "ts"), "ts", "2024-01-09", "2024-01-15").select("event_id")


@query(f"""
WITH p AS (SELECT c_custkey, lon, lat, lon+CAST((c_custkey%7) AS DOUBLE)/CAST(10000 AS DOUBLE) AS lon2, lat AS lat2, c_name, c_mktsegment FROM {_points_sql()})
SELECT c_custkey, CASE WHEN c_custkey%7>=3 THEN 'Corregir' ELSE 'Ok' END AS location_check, CASE WHEN levenshtein(lower(c_name),lower(c_mktsegment))>=17 THEN 'Corregir' ELSE 'Ok' END AS address_check FROM p
""")
def record_comparison(t):
    """Stated against corrected place (25 m) and address (five letters or more)."""
    p = _points(t, "customer", "c_custkey", "c_name", "c_mktsegment").withColumn("lon2", F.col("lon") + (F.col("c_custkey") % 7).cast("double") / 10000)
    moved = G.geodesic_m("lon", "lat", "lon2", "lat")
    out = compare_records(p, {"location_check": moved >= 25, "address_check": F.levenshtein(F.lower("c_name"), F.lower("c_mktsegment")) >= 17})
    return out.select("c_custkey", "location_check", "address_check")


@query(f"""
WITH t AS ({_OD}), d AS (SELECT DISTINCT o_orderkey, origin FROM t) SELECT n_name, COUNT(*) AS n FROM d JOIN nation ON origin=n_nationkey GROUP BY 1 HAVING COUNT(*)>=22
""")
def area_report(t):
    """Orders once each, counted per district, busy districts only."""
    once = drop_duplicates_ordered(_trips(t), ["o_orderkey"], [F.asc("origin")])
    counts = once.groupBy("origin").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 22)
    return counts.join(t("nation", "n_nationkey", "n_name"), F.col("origin") == F.col("n_nationkey")).select("n_name", "n")
