"""Operators against brute force on small random tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plazaworks.operators import aggregates as A
from plazaworks.operators import joins as J
from plazaworks.operators import keys as K
from plazaworks.operators import quality as Q
from plazaworks.operators import reshape as R
from plazaworks.operators import spatial as S
from plazaworks.operators import windows as W
from plazaworks.operators.entities import duplicates_wide, union_sizes


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds half of the rows; NULL keys and tied orders occur."""
    rnd = random.Random(7)
    data = []
    for i in range(400):
        key = "hot" if rnd.random() < 0.5 else rnd.choice(["a", "b", None])
        data.append((i, key, rnd.randrange(60), round(rnd.uniform(-50, 50), 2), rnd.choice(["x", "y", None])))
    return data, spark.createDataFrame(data, "id long, k string, o long, v double, s string").cache()


def groups(data):
    out = {}
    for r in data:
        out.setdefault(r[1], []).append(r)
    return out


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_blocked_window_equals_plain_window(rows, width):
    data, df = rows
    block = F.floor(F.col("o") / width)
    args = dict(row_number="n", sums={"run": F.col("v")}, previous={"p": "id"}, following={"f": "id"}, group_count="c")
    cut = W.blocked_window(df, ["k"], ["o", "id"], block, **args)
    whole = W.blocked_window(df, ["k"], ["o", "id"], None, **args)
    tidy = lambda d: sorted((r["id"], r["n"], round(r["run"], 6), r["p"], r["f"], r["c"]) for r in d.collect())
    assert tidy(cut) == tidy(whole)


def test_range_frame_shares_ties(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 1, 2), (1, 2, 3)], "k int, o int, v int")
    out = W.running_sum(df, ["k"], ["o"], "v", "run", F.col("o"), range_frame=True)
    assert sorted(r["run"] for r in out.collect()) == [3, 3, 6]


def test_global_ids_have_no_gaps(rows):
    data, df = rows
    out = W.with_row_id(df, ["o", "id"], F.floor(F.col("o") / 9)).orderBy("row_id").collect()
    assert [r["row_id"] for r in out] == list(range(1, len(data) + 1))
    assert [(r["o"], r["id"]) for r in out] == sorted((r[2], r[0]) for r in data)


def test_latest_is_one_row_per_key(rows):
    data, df = rows
    out = {r["k"]: r["id"] for r in K.latest_per_key(df, ["k"], [F.desc("o"), F.desc("id")]).collect()}
    assert out == {k: max(rs, key=lambda r: (r[2], r[0]))[0] for k, rs in groups(data).items()}


def test_flag_first_marks_one_row_per_key(rows):
    data, df = rows
    out = K.flag_first(df, ["k"], [F.asc("o"), F.asc("id")], ["id"], "first").collect()
    assert len(out) == len(data)
    assert {r["id"] for r in out if r["first"]} == {min(rs, key=lambda r: (r[2], r[0]))[0] for rs in groups(data).values()}


def test_order_statistics_match_sorting(rows):
    data, df = rows
    got = {r["k"]: (r["lo"], r["hi"], r["n"]) for r in A.order_statistics(df, ["k"], "v", {"lo": F.floor(F.col("n") * 0.1), "hi": F.col("n") - 1}, 5).collect()}
    for k, rs in groups(data).items():
        v = sorted(r[3] for r in rs)
        assert got[k] == (v[int(len(v) * 0.1)], v[-1], len(v))


def test_median_with_few_blocks(rows):
    data, df = rows
    got = {r["k"]: r["m"] for r in A.medians(df, ["k"], "v", "m").collect()}
    for k, rs in groups(data).items():
        assert got[k] == pytest.approx(float(np.median([r[3] for r in rs])))


def test_allocation_keeps_the_sum(spark):
    df = spark.createDataFrame([(1, 10.0), (1, 10.0), (1, 10.0), (2, 4.0)], "k int, a double")
    out = {r["k"]: r["t"] for r in A.allocate_evenly(df, ["k"], ["a"]).groupBy("k").agg(F.sum("a").alias("t")).collect()}
    assert out == {1: pytest.approx(10.0), 2: pytest.approx(4.0)}


def test_cascade_keeps_rows_and_order_of_rules(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "c")], "i int, k string")
    r1 = spark.createDataFrame([("a", 0.1), ("a", 0.2)], "k string, v double")
    r2 = spark.createDataFrame([("a", 0.5), ("b", 0.3)], "k string, v double")
    out = J.cascade_join(left, [([F.col("k")], r1, ["k"], "v"), ([F.col("k")], r2, ["k"], "v")], "rate", 0.15)
    assert sorted((r["i"], r["rate"]) for r in out.collect()) == [(1, 0.1), (2, 0.3), (3, 0.15), (3, 0.15)]


def test_unique_values(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x"), (2, "y"), (3, None)], "k int, v string")
    assert [(r["k"], r["v"]) for r in J.unique_values(df, ["k"], "v").collect()] == [(1, "x")]


def test_effective_lookup_is_half_open(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("a", 9), ("z", 5)], "k string, t int")
    rules = spark.createDataFrame([("a", None, 5, "early"), ("a", 5, None, "late")], "k string, f int, u int, w string")
    out = J.effective_lookup(df, rules, ["k"], "t", "f", "u", {"w": "none"})
    assert sorted((r["k"], r["t"], r["w"]) for r in out.collect()) == [("a", 1, "early"), ("a", 5, "late"), ("a", 9, "late"), ("z", 5, "none")]


def test_duplicates_against_pairs(spark):
    rnd = random.Random(3)
    data = [(i, rnd.choice([1, 1, 1, 2, None]), rnd.randrange(12), rnd.choice(["p", "q", None, f"u{i}"])) for i in range(60)]
    df = spark.createDataFrame(data, "id long, a int, b int, c string")
    got = {r["id"]: (r["n_dup"], [r[f"dup{i}"] for i in range(1, 5)]) for r in duplicates_wide(df, "id", ["a", "b", "c"], 4).collect()}
    for x in data:
        partners = sorted({y[0] for y in data if y[0] != x[0] and any(x[j] is not None and x[j] == y[j] for j in (1, 2, 3))}, reverse=True)
        assert got[x[0]] == (len(partners), (partners + [None] * 4)[:4])


def test_gaps_fill_the_range(spark):
    have = {("s", n) for n in (3, 4, 7, 30, 31, 75)} | {("t", 5)}
    df = spark.createDataFrame(list(have), "s string, n long")
    gaps = {(r["s"], r["n"]) for r in Q.sequence_gaps(df, ["s"], "n", width=10, chunk=4).collect()}
    assert not gaps & have
    assert {n for s, n in gaps | have if s == "s"} == set(range(3, 76))
    assert {n for s, n in gaps if s == "t"} == set()


def test_unpivot_drops_nulls_and_melt_keeps_them(spark):
    df = spark.createDataFrame([(1, 10, None)], "k int, a int, b int")
    assert R.unpivot_times(df, ["k"], ["a", "b"], "n", "v").count() == 1
    assert R.melt(df, ["k"], ["a", "b"], "n", "v").count() == 2


def test_single_or_list(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (2, "x"), (3, None)], "k int, v string")
    assert sorted((r["k"], r["v"]) for r in R.single_or_list(df, ["k"], ["v"]).collect()) == [(1, "x"), (2, "x|y"), (3, None)]


def test_hull_against_brute_force(spark):
    rnd = random.Random(5)
    pts = [(rnd.randrange(20), rnd.randrange(20)) for _ in range(80)]
    df = spark.createDataFrame([("g", float(x), float(y)) for x, y in pts], "g string, x double, y double")
    got = {(r["x"], r["y"]) for r in S.convex_hull(df, "g", "x", "y", directions=5).collect()}

    def corner(p):
        # a corner has some direction in which it is the only farthest point
        for i in range(720):
            a = math.pi * (i + 0.37) / 360
            d = [(q[0] * math.cos(a) + q[1] * math.sin(a), q) for q in set(pts)]
            top = max(d)
            if top[1] == p:
                return True
        return False

    assert got == {(float(x), float(y)) for x, y in set(pts) if corner((x, y))}


def test_points_meet_all_areas_and_none(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)]  # a notch from above
    areas = spark.createDataFrame([("n", [{"lon": x, "lat": y} for x, y in ring])], "name string, ring array<struct<lon double, lat double>>")
    pts = spark.createDataFrame([(1, 1.0, 1.0), (2, 2.0, 3.0), (3, 9.0, 9.0), (4, 0.5, 2.5)], "id int, lon double, lat double")
    out = {r["id"]: r["name"] for r in S.point_in_polygon_join(pts, "lon", "lat", areas, "name", "ring", sizes=(2.0, 0.5)).collect()}
    assert out == {1: "n", 2: None, 3: None, 4: "n"}


def test_winsorize_holds_tails(spark):
    df = spark.createDataFrame([("g", float(i)) for i in range(100)], "g string, v double")
    out = [r["v"] for r in Q.winsorize(df, ["g"], ["v"], 0.03).collect()]
    assert min(out) == 3.0 and max(out) == 96.0 and len(out) == 100


def test_partner_counts_of_four_attributes(spark):
    """Nulls, shared values and one value that a third of all rows has; one aggregate and one join whatever the attributes."""
    rnd = random.Random(8)
    rows = [(i, *[None if rnd.random() < 0.2 else "hot" if i % 3 == 0 and j == 0 else f"{j}{rnd.randrange(25)}" for j in range(4)]) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a string, b string, c string, d string")
    out = union_sizes(df, ["a", "b", "c", "d"], "n")
    want = {r[0]: sum(any(x is not None and x == y for x, y in zip(r[1:], q[1:])) for q in rows) for r in rows}
    assert {r["id"]: r["n"] for r in out.collect()} == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2
