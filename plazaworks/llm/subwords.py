"""Quality classifier: averaged hashed word and character n-gram vectors with a softmax output."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import char_ngrams, held_out, labelled_sample, word_bucket

BUCKETS = 1 << 15  # of words, and as many of character n-grams
DIMS = 8
SHORTEST, LONGEST = 2, 4  # character n-grams
PER_CLASS, MOST_CHARS = 3000, 20_000  # the labelled sample
EPOCHS, RATE = 5, 0.5
CACHE = 300_000  # words whose features a task remembers


@dataclass
class Subwords:
    """Learned vectors, output weights and bias of two classes."""

    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray


def features_of(words: list[str]) -> list[np.ndarray]:
    """Feature numbers of each word: its own, and those of its character n-grams."""
    grams, counts = char_ngrams(words, SHORTEST, LONGEST, BUCKETS)
    return [np.append(g + BUCKETS, word_bucket(w, BUCKETS)) for w, g in zip(words, np.split(grams, np.cumsum(counts)[:-1]), strict=True)]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def train(sample: list[tuple[str, int]], epochs: int = EPOCHS, rate: float = RATE, dims: int = DIMS, seed: int = 0) -> Subwords:
    """Stochastic gradient descent, one text at a time, with a rate that falls to zero.

    A class that is rarer in the sample weighs more. Without any labelled text
    the model gives one half everywhere.
    """
    rng = np.random.default_rng(seed)
    model = Subwords(rng.uniform(-1 / dims, 1 / dims, (2 * BUCKETS, dims)), np.zeros((dims, 2)), np.zeros(2))
    vocabulary = list(dict.fromkeys(w for text, _ in sample for w in text.split()))
    known = dict(zip(vocabulary, features_of(vocabulary), strict=True)) if vocabulary else {}
    bags, ys = [], []
    for text, y in sample:
        if words := text.split():
            at, n = np.unique(np.concatenate([known[w] for w in words]), return_counts=True)
            bags.append((at, n / n.sum()))
            ys.append(y)
    share = np.bincount(ys, minlength=2) / max(1, len(ys))
    if not share.all():
        model.bias[1] = 0.0 if not ys else 8.0 * (share[1] - 0.5)
        return model
    steps, done = epochs * len(bags), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            (at, n), y = bags[i], ys[i]
            mean = n @ model.vectors[at]
            error = _softmax(mean @ model.weights + model.bias)
            error[y] -= 1
            step = rate * (1 - done / steps) * np.sqrt(0.5 / share[y])
            back = model.weights @ error
            model.weights -= step * np.outer(mean, error)
            model.bias -= 0.1 * step * error
            # a text's many features share its gradient; the factor keeps each one's step near the rate
            model.vectors[at] -= step * np.outer(n * min(len(at), 50), back)
            done += 1
    return model


def scorer(model: Subwords) -> Callable[[Column], Column]:
    """Column function: probability of label 1 of a text; null and empty texts get that of the bias.

    The output is linear in the features, so a word's part is worked out once
    and remembered; the memory is emptied when it holds 300 000 words.
    """
    part = (model.vectors @ (model.weights[:, 1] - model.weights[:, 0])).astype(np.float64)
    bias = float(model.bias[1] - model.bias[0])

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        value: dict[str, float] = {}
        size: dict[str, int] = {}
        for texts in batches:
            out = np.full(len(texts), bias)
            for i, text in enumerate(texts):
                words = text.split() if text else None
                if not words:
                    continue
                if len(value) > CACHE:
                    value.clear()
                    size.clear()
                if new := list(set(words).difference(value)):
                    grams, counts = char_ngrams(new, SHORTEST, LONGEST, BUCKETS)
                    sums = np.add.reduceat(part[BUCKETS + grams], np.cumsum(counts) - counts) + part[[word_bucket(w, BUCKETS) for w in new]]
                    value |= zip(new, sums.tolist(), strict=True)
                    size |= zip(new, (counts + 1).tolist(), strict=True)
                out[i] += sum(map(value.__getitem__, words)) / sum(map(size.__getitem__, words))
            yield pd.Series(1 / (1 + np.exp(-out)))

    return F.pandas_udf(score, "double")


def quality(docs: DataFrame, labels: DataFrame, least: float = 0.3, per_class: int = PER_CLASS, most_chars: int = MOST_CHARS) -> DataFrame:
    """Quality of every row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Learned from ``labels`` (doc_id, quality) of rows that are not held out, on a
    sample of at most ``per_class`` rows a class with at most ``most_chars``
    characters; every whole text is scored. Only the text enters the score.
    """
    model = train(labelled_sample(docs, labels, "quality", per_class, most_chars))
    rows = docs.select("doc_id", held_out().alias("held_out"), scorer(model)("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= least).cast("int"))
