"""Blocked windows and order statistics: cut at every level, on hot keys, crowded values and texts."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plazaworks.ml.models import one_vs_rest_auc
from plazaworks.operators import windows as W
from plazaworks.operators.aggregates import medians, order_statistics
from plazaworks.operators.reshape import list_pages


@pytest.fixture(scope="module")
def history(spark):
    """A third of the rows has one key; keys, values and texts may be null; texts begin alike."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.integers(40)}"
        rows.append((i, key, int(rng.integers(0, 2000)), None if i % 7 == 0 else int(rng.integers(-50, 50)), f"order-000{rng.integers(0, 5000):05d}"))
    return spark.createDataFrame(rows, "id int, key string, at int, v int, name string")


def both(df, keys, order, block, **kw):
    same = [c for c in (kw.get("row_number"), kw.get("group_count"), *kw.get("sums", {}), *kw.get("previous", {}), *kw.get("following", {})) if c]
    pick = lambda out: sorted(tuple(r) for r in out.select("id", *same).collect())
    return pick(W.blocked_window(df, keys, order, block, **kw)), pick(W.blocked_window(df, keys, order, None, **kw))


@pytest.mark.parametrize("fan", [2, 1024])
@pytest.mark.parametrize("keys", [["key"], []])
def test_levels_do_not_change_results(history, monkeypatch, fan, keys):
    monkeypatch.setattr(W, "FAN", fan)  # 400 blocks in 200 coarser ones, or all in one
    got, want = both(
        history, keys, ["at", "id"], F.floor(F.col("at") / 5), row_number="n", group_count="all", sums={"sofar": F.col("v")},
        previous={"before": "v", "before_id": "id"}, following={"after": "name"},
    )
    assert got == want


@pytest.mark.parametrize("block", ["floor(at / 3)", W.Sampled(["key", "at"], 64), "date_trunc('year', timestamp_seconds(at * 100000))"])
def test_ties_share_their_total(history, block):
    block = F.expr(block) if isinstance(block, str) else block
    got, want = both(history, ["key"], ["at"], block, sums={"sofar": F.col("v")}, range_frame=True)
    assert got == want


def test_texts_that_begin_alike(history):
    """Blocks of texts follow the texts that are there."""
    block = W.natural_block(history, "name")
    blocks = W.with_block(history, block._replace(blocks=64)).groupBy("_block").count().collect()
    assert len(blocks) > 30 and max(r["count"] for r in blocks) < 0.1 * 3000
    got, want = both(history, ["key"], ["name", "id"], block, row_number="n", previous={"before": "id"}, following={"after": "id"})
    assert got == want


def test_numbers_of_blocks_follow_the_order(history):
    rows = W.with_block(history, W.Sampled(["at", "id"], 64)).orderBy("at", "id").select("_block").collect()
    numbers = [r["_block"] for r in rows]
    assert numbers == sorted(numbers) and len(set(numbers)) > 30


def test_no_window_sees_all_blocks(spark):
    """A third of a million rows has one key, each row in a block of its own: its summaries are cut too."""
    df = spark.range(1_000_000).select((F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 1000)).alias("key"), "id")
    rows = df.groupBy("key", F.floor(F.col("id") / W.FAN).alias("coarse")).count()
    assert rows.agg(F.max("count")).first()[0] <= W.FAN
    out = W.blocked_window(df, ["key"], ["id"], F.col("id"), row_number="n")
    hot = out.where("key = -1").agg(F.min("n"), F.max("n"), F.count_distinct("n"), F.sum(F.col("n") * 3 - 3 - F.col("id"))).first()
    assert tuple(hot) == (1, 333334, 333334, 0)


@pytest.fixture(scope="module")
def crowded(spark):
    """Group 'a' crowds near zero beside one extreme value, 'b' is one value, 'c' has one row."""
    rng = np.random.default_rng(9)
    rows = [("a", float(x)) for x in rng.normal(size=2001) / 1e6] + [("a", 1e300), ("a", None)] + [("b", 5.0)] * 700 + [("c", -3.0), (None, 2.0), (None, 4.0)]
    return spark.createDataFrame(rows, "g string, x double")


def test_ranges_are_even_beside_an_extreme_value(crowded):
    known = crowded.where("x is not null")
    placed = W.with_block(known.distinct(), W.Sampled(["g", "x"], 64, known), "at")
    assert placed.groupBy("g", "at").count().agg(F.max("count")).first()[0] < 200


@pytest.mark.parametrize("blocks", [1, 64, 4096])
def test_order_statistics_are_exact(crowded, blocks):
    n = F.col("n")
    got = {r["g"]: tuple(r)[1:] for r in order_statistics(crowded, ["g"], "x", {"lo": F.lit(0), "mid": F.floor(n / 2), "hi": n - 1, "none": n}, blocks).collect()}
    values = {}
    for g, x in crowded.collect():
        if x is not None:
            values.setdefault(g, []).append(x)
    assert got == {g: (len(v), sorted(v)[0], sorted(v)[len(v) // 2], sorted(v)[-1], None) for g, v in values.items()}


def test_medians_of_the_whole_table(crowded):
    values = sorted(x for _, x in crowded.collect() if x is not None)
    want = (values[(len(values) - 1) // 2] + values[len(values) // 2]) / 2
    assert medians(crowded, [], "x", "m").collect()[0]["m"] == want
    assert medians(crowded.where("x > 1e301"), ["g"], "x", "m").count() == 0


def test_auc_of_crowded_scores(spark):
    rng = np.random.default_rng(1)
    score = np.round(rng.random(500) ** 8 / 1e4, 9)
    truth = rng.random(500) < 0.3 + score * 5000
    df = spark.createDataFrame([("yes" if t else "no", float(s)) for t, s in zip(truth, score, strict=True)], "label string, p double")
    pos, neg = score[truth], score[~truth]
    want = ((pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2) / (len(pos) * len(neg))
    got = one_vs_rest_auc(df, "label", {"yes": "p"}, 32).collect()[0]["auc"]
    assert got == pytest.approx(want, abs=1e-12)


def test_plain_windows_agree_with_spark(history):
    w = Window.partitionBy("key").orderBy("at", "id")
    want = sorted(tuple(r) for r in history.select("id", F.row_number().over(w).alias("n")).collect())
    assert sorted(tuple(r) for r in W.with_sequence(history, ["key"], ["at", "id"], "n", W.Sampled(["key", "at", "id"], 16)).select("id", "n").collect()) == want


def test_lists_are_cut_into_pages(spark):
    rows = [("hot", f"v{i:04d}") for i in range(950)] * 2 + [("one", "x"), ("one", None), (None, "y"), ("none", None)]
    out = list_pages(spark.createDataFrame(rows, "k string, v string"), ["k"], "v", 100)
    pages = {(r["k"], r["page"]): (r["pages"], r["values"], r["listed"].split("|")) for r in out.collect()}
    assert pages.pop(("one", 0)) == (1, 1, ["x"]) and pages.pop((None, 0)) == (1, 1, ["y"])
    assert len(pages) == 10 and [v for i in range(10) for v in pages["hot", i][2]] == [f"v{i:04d}" for i in range(950)]
    assert all(p[:2] == (10, 950) and len(p[2]) <= 100 for p in pages.values())


def test_short_histories_have_no_block_summaries(spark, monkeypatch):
    """Positions of keys with few rows need no summaries of their blocks; long keys beside them are cut as before."""
    rows = [(k, None if i % 7 == 3 else (i * 37) % 101, i) for k, n in ((None, 9), ("a", 60), ("b", 2), ("c", 1), ("d", 25)) for i in range(n)]
    history = spark.createDataFrame(rows, "key string, at int, id int")
    want = set()
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        want |= {(*r, n) for n, r in enumerate(mine, 1)}
    summaries = {}
    for short in (1, 20, 1000):
        monkeypatch.setattr(W, "SHORT", short)
        for name, block in (("numbers", F.floor(F.col("at") / 10)), ("sampled", W.Sampled(["key", "at", "id"], 8))):
            out = W.with_sequence(history, ["key"], ["at", "id"], "n", block)
            got = out.collect()
            assert len(got) == len(rows) and {tuple(r) for r in got} == want
            summaries[short, name] = "Union" in out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert summaries[20, "numbers"] and not summaries[1000, "numbers"] and not summaries[1000, "sampled"]
