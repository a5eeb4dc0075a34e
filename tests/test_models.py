"""Models and outliers as the reference has them."""

import __spark_entry__ as entry
import numpy as np
import pytest
from pyspark.sql import functions as F

from plazaworks.ml import models as M

QUERIES = entry.queries()


def test_models_have_the_references_size(spark, folder, monkeypatch):
    from plazaworks.catalog import learning

    asked = {}

    class Asked(Exception):
        pass

    def keep(name):
        def made(pipeline):
            asked[name] = pipeline.getStages()[-1]
            raise Asked

        make = getattr(learning.M, name)
        monkeypatch.setattr(learning.M, name, lambda *a, **k: made(make(*a, **k)))

    for name, job in (("mlp_classifier", "size_network"), ("tree_classifier", "reloaded_model")):
        keep(name)
        with pytest.raises(Asked):
            QUERIES[job](spark, folder)
    assert asked["mlp_classifier"].getLayers()[:-1] == [5, 256, 128, 64] and asked["mlp_classifier"].getMaxIter() == 20
    assert asked["tree_classifier"].getMaxDepth() == 28


def test_outliers_of_all_measures(spark, folder):
    before = {r["p_partkey"]: r for r in QUERIES["category_tails"](spark, folder).collect()}
    assert set(before[next(iter(before))].asDict()) == {"p_partkey", "width", "length", "height"}
    assert set(QUERIES["category_removed"](spark, folder).columns) == {"p_partkey", "width", "length", "height"}


def test_learning_stops_and_keeps_the_best_weights(spark):
    """Labels are noise: the loss on held rows soon grows, and the weights of its smallest value are returned."""
    rng = np.random.default_rng(0)
    rows = [(float(a), float(b), str(int(a + 0.7 * rng.normal() > 0))) for a, b in rng.normal(size=(120, 2))]
    df = spark.createDataFrame(rows, "a double, b double, label string")
    train, valid = df.limit(60), df.subtract(df.limit(60))
    model, history = M.fit_early_stopping(train, valid, ["a", "b"], "label", 2, hidden=(24, 24), epochs=120, step=10, patience=2)
    h = history.orderBy("epoch").collect()
    assert len(h) < 12 and h[-1]["epoch"] == 10 * len(h)  # stopped before the last pass
    best = min(range(len(h)), key=lambda i: h[i]["valid_loss"])
    assert [r["kept"] for r in h] == [i == best for i in range(len(h))] and len(h) - 1 - best == 2
    held = M.PipelineModel(stages=model.stages[:-1]).transform(valid)
    assert M.log_loss(model.stages[-1], held) == pytest.approx(h[best]["valid_loss"], abs=1e-9)


def test_rounds_go_on_from_each_other(spark):
    rng = np.random.default_rng(1)
    rows = [(float(a), float(b), str(int(a * b > 0))) for a, b in rng.normal(size=(200, 2))]
    df = spark.createDataFrame(rows, "a double, b double, label string")
    _, history = M.fit_early_stopping(df, df.limit(0), ["a", "b"], "label", 2, hidden=(8,), epochs=25, step=10)
    h = history.orderBy("epoch").collect()
    assert [r["epoch"] for r in h] == [10, 20, 25] and [r["kept"] for r in h] == [False, False, True]
    assert h[0]["train_loss"] > h[1]["train_loss"] > h[2]["train_loss"]


@pytest.mark.parametrize("parts", [1, 3])
def test_passes_are_those_of_sparks_optimiser(spark, parts):
    """The weights and the loss after some iterations are what Spark's own fit gives, over full and other blocks; no pass is run twice."""
    from plazaworks.ml.descent import Passes, descend

    rng = np.random.default_rng(2)
    rows = [(float(a), float(b), str(int(a * b > 0) + int(a > 1))) for a, b in rng.normal(size=(700, 2))]
    df = spark.createDataFrame(rows, "a double, b double, label string").coalesce(parts)
    *before, network = M.mlp_classifier(["a", "b"], "label", 3, (12, 6)).getStages()
    data = M.Pipeline(stages=before).fit(df).transform(df).select("label_index", "features")
    passes, asked = Passes(data, network.getLayers(), network.getBlockSize()), []
    seen = lambda w: asked.append(w) or passes(w)
    start = passes(network.copy({network.maxIter: 0}).fit(data).weights.toArray())
    for most in (2, 12):
        model, now = network.copy({network.maxIter: most}).fit(data), descend(seen, start, most, network.getTol())
        assert now.weights == pytest.approx(model.weights.toArray(), abs=1e-9)
        assert now.log_loss == pytest.approx(M.log_loss(model, data), abs=1e-9)
        assert now.value == pytest.approx(model.summary().objectiveHistory[-1], abs=1e-9)
    assert not any((w == start.weights).all() for w in asked)


def test_a_descent_that_finds_no_step_stays(spark):
    from plazaworks.ml.descent import Point, descend

    wrong = lambda w: Point(w, float(w @ w), -2 * w, 0.0)  # noqa: E731  # the gradient points the other way
    start = wrong(np.array([1.0, 2.0]))
    assert descend(wrong, start, 5, 1e-6) is start
    right = lambda w: Point(w, float(w @ w), 2 * w, 0.0)
    assert descend(right, right(np.array([1.0, 2.0])), 20, 1e-6).value < 1e-6


def test_a_network_learns_without_sparks_passes(spark, monkeypatch):
    """The table is gone over once for each loss and gradient; Spark's row-by-row passes see one row only."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier

    seen, fit = [], MultilayerPerceptronClassifier._fit
    monkeypatch.setattr(MultilayerPerceptronClassifier, "_fit", lambda self, rows: seen.append((self.getMaxIter(), rows.count())) or fit(self, rows))
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(float(a), float(b), str(int(a * b > 0))) for a, b in rng.normal(size=(150, 2))], "a double, b double, label string")
    M.fit_early_stopping(df, df, ["a", "b"], "label", 2, hidden=(4,), epochs=4)
    assert seen and set(seen) == {(0, 1)}


def test_tfidf_against_brute_force(spark, folder):
    import math
    import re
    from collections import Counter

    from plazaworks.ml.features import stop_words

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    stop = set(stop_words())
    words = {d: Counter(w for w in re.split(r"[\W_]+", t.lower()) if w and w not in stop) for d, t in texts.items()}
    seen = Counter(w for c in words.values() for w in c)
    idf = {w: math.log((len(texts) + 1) / (n + 1)) for w, n in seen.items()}
    got = {r["doc_id"]: (r["words"], r["weight"]) for r in QUERIES["text_tfidf"](spark, folder).collect()}
    assert set(got) == set(texts)
    for d, c in words.items():
        assert got[d][0] == len(c)
        assert got[d][1] == pytest.approx(sum(n * idf[w] for w, n in c.items()), abs=2e-4)


def test_component_variance_against_numpy(spark, folder):
    from plazaworks.catalog.registry import Tables
    from plazaworks.catalog.sizes_data import sized_parts

    measures = ["width", "length", "height", "weight", "volume_m3"]
    x = np.array([tuple(r) for r in sized_parts(Tables(spark, folder)).select(*measures).collect()], float)
    x = x[np.isfinite(x).all(axis=1)]
    spread = np.linalg.eigvalsh(np.cov(((x - x.mean(axis=0)) / x.std(axis=0, ddof=1)).T))[::-1]
    want = (spread / spread.sum())[:4]
    got = QUERIES["component_variance"](spark, folder).orderBy("component").collect()
    assert [r["share"] for r in got] == pytest.approx(want.tolist(), abs=1e-6)
    assert [r["cumulative_share" if "cumulative_share" in r else "cumulative"] for r in got] == pytest.approx(np.cumsum(want).tolist(), abs=1e-6)


def test_a_reloaded_tree_predicts_as_before(spark, folder, tmp_path):
    from plazaworks.catalog.registry import Tables
    from plazaworks.catalog.sizes_data import sized_parts
    from plazaworks.sources import sinks

    parts = sized_parts(Tables(spark, folder))
    model = M.tree_classifier(["width", "length", "height", "weight", "volume_m3"], "size").fit(parts)
    sinks.save_pipeline(model, str(tmp_path / "m"))
    fresh = {r["p_partkey"]: r["predicted"] for r in M.score(model, parts).collect()}
    again = {r["p_partkey"]: r["predicted"] for r in M.score(sinks.load_pipeline(str(tmp_path / "m")), parts).collect()}
    assert fresh == again == {r["p_partkey"]: r["predicted"] for r in QUERIES["reloaded_model"](spark, folder).collect()}
    truth = {r["p_partkey"]: r["size"] for r in parts.select("p_partkey", "size").collect()}
    assert sum(truth[k] == v for k, v in fresh.items()) > 0.95 * len(fresh)  # a tree of depth 28 knows its own rows


def test_metrics_of_the_tree_add_up(spark, folder):
    rows = {r["class"]: r for r in QUERIES["size_tree"](spark, folder).collect()}
    classes = [r for n, r in rows.items() if n not in ("Micro", "Macro", "Weighted")]
    total = sum(r["support"] for r in classes)
    assert rows["Micro"]["support"] == rows["Weighted"]["support"] == total
    assert rows["Micro"]["recall"] == pytest.approx(sum(r["recall"] * r["support"] for r in classes) / total)
    for r in classes:
        if r["precision"] and r["recall"]:
            assert r["f1"] == pytest.approx(2 * r["precision"] * r["recall"] / (r["precision"] + r["recall"]))


def test_passes_are_dealt_by_rows(spark, tmp_path):
    """A file with one row group is read by one task; work that is large per row takes more of them, whatever the file."""
    from plazaworks.session import ROWS_PER_TASK, spread

    path = str(tmp_path / "one")
    spark.range(3 * ROWS_PER_TASK).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    dealt = spread(df).select(F.spark_partition_id().alias("p"), "id").groupBy("p").agg(F.count("id").alias("n"), F.sum("id").alias("s")).collect()
    assert len(dealt) == 3 and max(r["n"] for r in dealt) < 1.2 * ROWS_PER_TASK
    assert sum(r["n"] for r in dealt) == 3 * ROWS_PER_TASK and sum(r["s"] for r in dealt) == sum(range(3 * ROWS_PER_TASK))
    assert spread(df.limit(5)).count() == 5
    assert spread(df.limit(0)).count() == 0
