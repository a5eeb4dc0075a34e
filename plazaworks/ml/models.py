"""Classifiers, splits, scoring and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, MultilayerPerceptronClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.windows import BLOCKS, Sampled, blocked_window
from ..session import cut_lineage, spread
from .descent import Passes, descend
from .features import scaled


def split(df: DataFrame, weights: Sequence[float], seed: int = 42, by: Sequence[str] | None = None) -> list[DataFrame]:
    """Random parts of a table.

    With ``by`` (an id) a row's part only depends on its id and the seed, so a
    recomputed partition or a re-read table gives the same parts.
    """
    if by is None:
        return df.randomSplit(list(weights), seed=seed)
    total, buckets = sum(weights), 10_000
    place = F.pmod(F.xxhash64(F.lit(seed), *by), F.lit(buckets))
    parts, lo = [], 0
    for i, w in enumerate(weights):
        hi = buckets if i == len(weights) - 1 else lo + round(w / total * buckets)
        parts.append(df.where((place >= lo) & (place < hi)))
        lo = hi
    return parts


def tree_classifier(features: Sequence[str], label: str, max_depth: int = 28, min_instances: int = 1) -> Pipeline:
    """Label index, feature vector, decision tree, and the label read back."""
    return Pipeline(
        stages=[
            StringIndexer(inputCol=label, outputCol="label_index", handleInvalid="keep"),
            VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip"),
            DecisionTreeClassifier(labelCol="label_index", featuresCol="features", maxDepth=max_depth, minInstancesPerNode=min_instances, seed=42),
        ]
    )


def mlp_classifier(features: Sequence[str], label: str, classes: int, hidden: Sequence[int] = (256, 128, 64), epochs: int = 20) -> Pipeline:
    """Dense network on standardised features; the scaler is part of the model."""
    return Pipeline(
        stages=[
            StringIndexer(inputCol=label, outputCol="label_index", handleInvalid="skip"),
            *scaled(features, "features").getStages(),
            MultilayerPerceptronClassifier(
                labelCol="label_index", featuresCol="features", layers=[len(features), *hidden, classes], maxIter=epochs, seed=42
            ),
        ]
    )


def log_loss(model, rows: DataFrame) -> float:
    """Mean negative log-likelihood of the indexed labels; infinite without rows."""
    p = F.get(vector_to_array("probability"), F.col("label_index").cast("int"))
    value = model.transform(rows).agg(F.avg(-F.log(F.greatest(p, F.lit(1e-15))))).first()[0]
    return float("inf") if value is None else value


def fit_early_stopping(
    train: DataFrame, valid: DataFrame, features: Sequence[str], label: str, classes: int, hidden: Sequence[int] = (256, 128, 64), epochs: int = 20,
    step: int = 2, patience: int = 3, min_delta: float = 0.0,
) -> tuple[PipelineModel, DataFrame]:
    """The network with the smallest loss on ``valid``, and (epoch, train_loss, valid_loss, kept) of every round.

    Each round goes on from the weights of the one before for ``step`` passes
    over ``train``.  Learning ends after ``epochs`` passes, or when ``patience``
    rounds in a row were not better than the best by more than ``min_delta``;
    the weights of the best round are returned.  Without validation rows all
    rounds run and the last one stays.  Weights, gradients and losses are all
    that reaches the driver.  Rows are dealt to tasks by their number, so a pass
    takes more tasks on a larger table; the passes are Spark's optimiser over
    blocks of rows (:mod:`.descent`), and the model is Spark's.
    """
    *before, network = mlp_classifier(features, label, classes, hidden, epochs).getStages()
    prepared = Pipeline(stages=before).fit(train)
    ready = lambda df: cut_lineage(spread(prepared.transform(df).select("label_index", "features")))
    rows, held = ready(train), ready(valid)
    one = cut_lineage(rows.limit(1))  # with no pass to run, a fit only makes the model
    made = lambda **p: network.copy({getattr(network, n): v for n, v in {"maxIter": 0, **p}.items()}).fit(one)
    passes = Passes(rows, network.getLayers(), network.getBlockSize())
    now = passes(made().weights.toArray())
    best, best_loss, worse, history = None, float("inf"), 0, []
    for done in range(step, epochs + step, step):
        now = descend(passes, now, min(step, epochs - done + step), network.getTol())
        model = made(initialWeights=DenseVector(now.weights))
        loss = log_loss(model, held)
        better = best is None or loss < best_loss - min_delta or loss == float("inf")
        if better:
            best, best_loss, worse = model, loss, 0
        else:
            worse += 1
        history.append((min(done, epochs), now.log_loss, float(loss)))
        if worse >= patience:
            break
    kept = min((loss, i) for i, (_, _, loss) in enumerate(history))[1] if best_loss < float("inf") else len(history) - 1
    table = [(*h, i == kept) for i, h in enumerate(history)]
    return PipelineModel(stages=[*prepared.stages, best]), train.sparkSession.createDataFrame(table, "epoch int, train_loss double, valid_loss double, kept boolean")


def labels_of(model: PipelineModel) -> list[str]:
    """Class names in the order of their index."""
    return next(s for s in model.stages if isinstance(s, StringIndexerModel)).labels


def score(model: PipelineModel, df: DataFrame, prefix: str = "p_", label: str = "predicted") -> DataFrame:
    """Predicted class name and one probability column per class."""
    names = labels_of(model)
    out = model.transform(df).withColumn("_p", vector_to_array("probability"))
    out = out.withColumns({f"{prefix}{n}": F.get("_p", F.lit(i)) for i, n in enumerate(names)})
    return IndexToString(inputCol="prediction", outputCol=label, labels=[*names, "__unknown"]).transform(out).drop("_p", "rawPrediction")


def confusion(pred: DataFrame, label: str, predicted: str) -> DataFrame:
    """Rows per (true class, predicted class)."""
    return pred.groupBy(F.col(label).alias("label"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def class_metrics(pred: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall and F1 per class, with micro, macro and weighted averages.

    All from one confusion count; the rest is arithmetic on a few rows.
    """
    cells = confusion(pred, label, predicted)
    # each cell counts once for its true class and once for its predicted class
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("guessed")),
                F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("guessed")),
            )
        ).alias("s"),
        F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit"),
    )
    per = sides.groupBy("s.class").agg(F.sum("s.support").alias("support"), F.sum("s.guessed").alias("guessed"), (F.sum("hit") / 2).alias("hit"))
    zero = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    per = per.withColumns({"precision": zero(F.col("hit"), F.col("guessed")), "recall": zero(F.col("hit"), F.col("support"))})
    per = per.withColumn("f1", zero(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    measures = ["precision", "recall", "f1"]
    known = per.where(F.col("support") > 0)
    micro = per.agg(zero(F.sum("hit"), F.sum("support")).alias("m"), F.sum("support").alias("support"))
    micro = micro.select(F.lit("Micro").alias("class"), "support", *[F.col("m").alias(m) for m in measures])
    macro = known.agg(F.sum("support").alias("support"), *[F.avg(m).alias(m) for m in measures]).select(F.lit("Macro").alias("class"), "support", *measures)
    weighted = known.agg(
        F.sum("support").alias("s"), *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in measures]
    ).select(F.lit("Weighted").alias("class"), F.col("s").alias("support"), *measures)
    rows = per.select(F.col("class").cast("string").alias("class"), "support", *measures)
    return rows.unionByName(micro).unionByName(macro).unionByName(weighted)


def one_vs_rest_auc(pred: DataFrame, label: str, probabilities: dict[str, str], blocks: int = BLOCKS) -> DataFrame:
    """Area under the ROC curve of each class against the others.

    Rows with equal scores are counted together, and the counts are cumulated
    over blocks between sampled scores, so no class is sorted in one task,
    however its scores crowd together.
    """
    long = pred.select(
        F.col(label).alias("_l"),
        F.explode(F.array(*[F.struct(F.lit(k).alias("class"), F.col(c).cast("double").alias("score")) for k, c in probabilities.items()])).alias("s"),
    )
    hit = (F.col("_l") == F.col("s.class")).cast("int")
    counts = long.groupBy("s.class", "s.score").agg(F.sum(hit).alias("pos"), F.sum(1 - hit).alias("neg"))
    block = Sampled(["class", "score"], blocks, long.select("s.class", "s.score"))
    run = blocked_window(counts, ["class"], ["score"], block, sums={"upto": F.col("neg")})
    below = F.col("upto") - F.col("neg")
    return run.groupBy("class").agg(
        F.try_divide(F.sum(F.col("pos") * (below + F.col("neg") / 2)), F.sum("pos") * F.sum("neg")).alias("auc")
    )
