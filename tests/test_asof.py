"""Effective rules as an as-of join."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plazaworks.operators import joins as J
from plazaworks.operators import windows as W

RULES = "k string, f int, u int, w string"


def lookup(rules, key, at):
    """The rule that began last, of those the one that ends last; then whether it is still valid."""
    mine = [r for r in rules if r[0] == key and key is not None and (r[1] is None or (at is not None and r[1] <= at))]
    if not mine:
        return None
    _, _, end, w = max(mine, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is None, r[2] or 0, r[3]))
    return w if end is None or (at is not None and at < end) else None


@pytest.mark.parametrize("blocks", [1, 16, 1024])
def test_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(W.Sampled, "__new__", lambda cls, order, _=0, rows=None, new=W.Sampled.__new__: new(cls, order, blocks, rows))
    rng = np.random.default_rng(blocks)
    pick = lambda *v: v[rng.integers(len(v))]
    rules = [(pick("hot", "hot", "a", "b", None), pick(None, *map(int, rng.integers(0, 300, 8))), pick(None, *map(int, rng.integers(0, 400, 8))), f"w{i}") for i in range(150)]
    rows = [(i, "hot" if i % 3 == 0 else pick("a", "b", "c", None), pick(None, *map(int, rng.integers(-5, 420, 20)))) for i in range(600)]
    got = J.effective_lookup(spark.createDataFrame(rows, "id int, k string, t int"), spark.createDataFrame(rules, RULES), ["k"], "t", "f", "u")
    got = [(r["id"], r["w"]) for r in got.collect()]
    assert len(got) == len(rows) and set(got) == {(i, lookup(rules, k, t)) for i, k, t in rows}


def test_many_rules_of_a_hot_key_keep_the_rows(spark):
    """As many rules as rows of one key: each row meets one rule, and no block holds many of them."""
    rules = spark.range(20_000).select(F.lit("hot").alias("k"), (F.col("id") * 5).cast("int").alias("f"), (F.col("id") * 5 + 4).cast("int").alias("u"), F.col("id").cast("string").alias("w"))
    rows = spark.range(100_000).select(F.col("id").cast("int").alias("t"), F.lit("hot").alias("k"))
    out = J.effective_lookup(rows, rules, ["k"], "t", "f", "u")
    wrong = out.where(~F.col("w").eqNullSafe(F.when(F.col("t") % 5 < 4, F.floor(F.col("t") / 5).cast("string"))))
    assert out.count() == 100_000 and wrong.count() == 0
    sizes = W.with_block(rows, W.Sampled(["k", "t"])).groupBy("_block").count()
    assert sizes.agg(F.max("count")).first()[0] < 3_000


def test_overlaps_are_reported(spark):
    rules = [("a", 0, 10, "1"), ("a", 10, 20, "2"), ("b", 0, 10, "3"), ("b", 2, 3, "4"), ("b", 5, None, "5"), ("c", None, None, "6"), ("c", 7, 9, "7"), ("d", None, 3, "8"), ("d", None, 5, "9"), (None, 1, 9, "x"), (None, 1, 9, "y")]
    got = {(r["w"], r["next_start"]) for r in J.rule_overlaps(spark.createDataFrame(rules, RULES), ["k"], "f", "u").collect()}
    assert got == {("3", 2), ("6", 7), ("8", None)}
    assert J.rule_overlaps(spark.createDataFrame(rules[:2], RULES), ["k"], "f", "u").count() == 0


def test_empty_sides(spark):
    rows = spark.createDataFrame([("a", 1)], "k string, t int")
    none = spark.createDataFrame([], RULES)
    assert [tuple(r) for r in J.effective_lookup(rows, none, ["k"], "t", "f", "u", {"w": "Other"}).collect()] == [("a", 1, "Other")]
    assert J.effective_lookup(rows.limit(0), none, ["k"], "t", "f", "u").columns == ["k", "t", "w"]
