"""Features of products: text, volume, word sequences, scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, PCA, CountVectorizer, RegexTokenizer, StandardScaler, StopWordsRemover, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sem import safe_cast


def stop_words(language: str = "spanish") -> list[str]:
    """Stop words that ship with Spark."""
    return StopWordsRemover.loadDefaultStopWords(language)


def text_features(cols: Sequence[str], language: str = "spanish", vocabulary: int = 1 << 18, min_df: float = 1.0) -> Pipeline:
    """Tokens, counts and inverse document frequencies of each text column.

    The vocabulary is bounded as by Spark's own default, because a model keeps it on every executor.
    """
    stages = []
    for c in cols:
        stages += [
            RegexTokenizer(inputCol=c, outputCol=f"{c}_words", pattern=r"[^\p{L}\p{N}]+", toLowercase=True),
            StopWordsRemover(inputCol=f"{c}_words", outputCol=f"{c}_tokens", stopWords=stop_words(language)),
            CountVectorizer(inputCol=f"{c}_tokens", outputCol=f"{c}_counts", vocabSize=vocabulary, minDF=min_df),
            IDF(inputCol=f"{c}_counts", outputCol=f"{c}_tfidf"),
        ]
    return Pipeline(stages=stages)


def prepare_features(df: DataFrame, width: str, length: str, height: str, others: Sequence[str] = (), scale: int = 4, volume: str = "volumen_cm3") -> DataFrame:
    """Numbers read safely, rounded, with the volume; incomplete rows are dropped."""
    nums = [width, length, height, *others]
    out = df.withColumns({c: safe_cast(c, "double") for c in nums})
    out = out.withColumn(volume, F.col(width) * F.col(length) * F.col(height))
    return out.withColumns({c: F.round(c, scale) for c in [*nums, volume]}).na.drop(subset=[*nums, volume])


def common_words(df: DataFrame, tokens: str, num_words: int = 50) -> list[str]:
    """The ``num_words - 1`` most common words, by falling count, equal counts by word.

    This is the fitted state of :func:`word_sequences`; its size is the
    parameter's, whatever the table's.
    """
    words = df.select(F.explode(tokens).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return [r["w"] for r in words.orderBy(F.desc("n"), F.asc("w")).limit(num_words - 1).collect()]


def word_sequences(df: DataFrame, tokens: str, words: Sequence[str], name: str = "sequence", length: int = 50) -> DataFrame:
    """Word ids of each text, cut to the last ``length`` and padded behind.

    Ids are the positions in ``words``, from 1; other words are left out.
    """
    table = F.create_map(*[F.lit(x) for i, w in enumerate(words, 1) for x in (w, i)])
    known = F.filter(F.col(tokens), lambda w: w.isin(list(words)))
    kept = df.withColumn("_w", F.reverse(F.slice(F.reverse(known), 1, length)))
    ids = kept.withColumn("_i", F.transform("_w", lambda w: F.element_at(table, w)))
    padded = F.concat(F.col("_i"), F.array_repeat(F.lit(0), F.lit(length) - F.size("_i")))
    return ids.withColumn(name, padded).drop("_w", "_i")


def scaled(features: Sequence[str], out: str = "scaled") -> Pipeline:
    """Assemble and standardise; fit on the training rows and reuse for scoring."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="skip"),
            StandardScaler(inputCol="_raw", outputCol=out, withMean=True, withStd=True),
        ]
    )


def pca(features: Sequence[str], k: int) -> Pipeline:
    """Standardise, then principal components."""
    return Pipeline(stages=[*scaled(features).getStages(), PCA(k=k, inputCol="scaled", outputCol="pca")])


def explained_variance(df: DataFrame, model) -> DataFrame:
    """Share and running share of variance per component of a fitted :func:`pca`."""
    rows, run = [], 0.0
    for i, v in enumerate(model.stages[-1].explainedVariance.toArray(), 1):
        run += float(v)
        rows.append((i, float(v), run))
    return df.sparkSession.createDataFrame(rows, "component int, share double, cumulative double")


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Balanced weight per class: n / (classes * class size)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_c"))
    total = counts.agg((F.sum("_c") / F.count(F.lit(1))).alias("t")).scalar()
    return counts.select(label, (total / F.col("_c")).alias(name))
