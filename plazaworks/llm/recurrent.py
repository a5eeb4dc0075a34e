"""Toxicity: a bidirectional gated recurrent network with attention pooling over windows that overlap by half."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import char_ngrams, class_totals, held_out, labelled_sample, word_bucket

WIDTH, STRIDE = 24, 12  # words of a window, and between two starts; passages of up to 13 words stand whole in one
HIDDEN, EMBED, ATTEND = 8, 8, 8
WORDS, CHARS = 1 << 14, 1 << 15  # hash buckets of words and of character n-grams
SHORTEST, LONGEST = 2, 5  # character n-grams
PER_CLASS, MOST_CHARS = 1500, 12_000  # the labelled sample
EPOCHS, RATE, BATCH = 6, 0.2, 256
CACHE = 150_000  # words whose input gates a task remembers
AT_ONCE = 4096  # windows whose words are looked up at once
BLOCK = 1024  # windows that run through the network at once
Params = dict[str, np.ndarray]


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def starts_of(n: int) -> range:
    """Starts of overlapping windows that cover ``n`` words; the last one may be short."""
    return range(0, max(1, n - STRIDE), STRIDE)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def new_params(seed: int = 0) -> Params:
    rng, h = np.random.default_rng(seed), HIDDEN
    draw = lambda *shape, s=0.3: rng.normal(0, s, shape).astype(np.float32)
    return {
        "words": draw(WORDS, EMBED), "chars": draw(CHARS, EMBED), "input": draw(2 * EMBED, 6 * h), "input_bias": np.zeros(6 * h, np.float32),
        "forward": draw(h, 3 * h), "backward": draw(h, 3 * h), "attend": draw(2 * h, ATTEND), "attend_out": draw(ATTEND),
        "out": draw(2 * h), "out_bias": np.zeros(1, np.float32),
    }


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of words, those of their character n-grams word after word, and how many each has."""
    return np.array([word_bucket(w, WORDS) for w in words]), *char_ngrams(words, SHORTEST, LONGEST, CHARS)


def word_inputs(p: Params, ids: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Input vector of each word: its own one, and the mean of its character n-grams."""
    means = np.add.reduceat(p["chars"][grams], np.cumsum(counts) - counts) / counts[:, None]
    return np.concatenate([p["words"][ids], means], axis=1).astype(np.float32)


def run_gates(table: np.ndarray, steps: np.ndarray, u: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (steps, hidden, windows) of one direction; row ``steps[t]`` of ``table`` holds the inputs' parts."""
    h = HIDDEN
    state = np.zeros((h, steps.shape[1]), np.float32)
    out = np.empty((len(steps), *state.shape), np.float32)
    for t, rows in enumerate(steps):
        a, s = np.ascontiguousarray(table[rows].T), u.T @ state
        zr = _sigmoid(a[: 2 * h] + s[: 2 * h])
        z, r = zr[:h], zr[h:]
        n = np.tanh(a[2 * h :] + r * s[2 * h :])
        if keep is not None:
            keep.append((state, z, r, n, s[2 * h :]))
        state = n + z * (state - n)
        out[t] = state
    return out


def back_gates(grad: np.ndarray, u: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gates and of ``u`` from those of the states."""
    du, dgates = np.zeros_like(u), np.empty((len(grad), 3 * HIDDEN, grad.shape[2]), np.float32)
    dstate = np.zeros_like(grad[0])
    for t in range(len(grad) - 1, -1, -1):
        before, z, r, n, s_n = kept[t]
        d = grad[t] + dstate
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (before - n) * z * (1 - z)
        dr = dn * s_n * r * (1 - r)
        dgates[t] = np.concatenate([dz, dr, dn])
        ds = np.concatenate([dz, dr, dn * r])
        du += before @ ds.T
        dstate = d * z + u @ ds
    return dgates, du


def logits(p: Params, table: np.ndarray, at: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Output of each window; ``at`` (windows, steps) names rows of ``table``, whose row 0 stands for no word."""
    h, steps = HIDDEN, np.ascontiguousarray(at.T)
    kf, kb = ([], []) if keep is not None else (None, None)
    forward = run_gates(table[:, : 3 * h], steps, p["forward"], kf)
    backward = run_gates(table[:, 3 * h :], steps[::-1], p["backward"], kb)[::-1]
    states = np.concatenate([forward, backward], axis=1)
    hidden = np.tanh(p["attend"].T @ states)
    weight = np.where(steps > 0, p["attend_out"] @ hidden, np.float32(-30))
    weight = np.exp(weight - weight.max(0))
    weight /= weight.sum(0)
    pooled = (weight[:, None] * states).sum(0)
    if keep is not None:
        keep |= {"kf": kf, "kb": kb, "states": states, "hidden": hidden, "weight": weight, "pooled": pooled}
    return p["out"] @ pooled + p["out_bias"][0]


def summed(at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers of ``at`` in order, and the sum of the rows of ``values`` of each."""
    order = np.argsort(at, kind="stable")
    ranked = at[order]
    starts = np.flatnonzero(np.diff(ranked, prepend=-1))
    return ranked[starts], np.add.reduceat(values[order], starts)


def gradients(p: Params, table: np.ndarray, at: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[Params, np.ndarray]:
    """Gradients of the weighted log loss, and those of the rows of ``table`` below row 0; ``at`` names each of them."""
    k: dict = {}
    d = ((_sigmoid(logits(p, table, at, k)) - y) * w / len(y)).astype(np.float32)
    g: Params = {"out": k["pooled"] @ d, "out_bias": np.array([d.sum()], np.float32)}
    dpooled = p["out"][:, None] * d
    dweight = (k["states"] * dpooled).sum(1)
    dscore = k["weight"] * (dweight - (k["weight"] * dweight).sum(0))
    dhidden = p["attend_out"][:, None] * dscore[:, None] * (1 - k["hidden"] ** 2)
    g["attend_out"] = (k["hidden"] * dscore[:, None]).sum((0, 2))
    g["attend"] = (k["states"] @ dhidden.transpose(0, 2, 1)).sum(0)
    dstates = k["weight"][:, None] * dpooled + p["attend"] @ dhidden
    h = HIDDEN
    df, g["forward"] = back_gates(dstates[:, :h], p["forward"], k["kf"])
    db, g["backward"] = back_gates(dstates[::-1, h:], p["backward"], k["kb"])
    dgates = np.concatenate([df, db[::-1]], axis=1).transpose(0, 2, 1).reshape(-1, 6 * h)
    named, dtable = summed(at.T.ravel(), dgates)
    return g, dtable[int(named[0] == 0) :]


def windows(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all windows of texts that stand one after the other, filled up with 0, and the text of each."""
    counts = np.array([len(starts_of(n)) for n in lengths.tolist()])
    owner = np.repeat(np.arange(len(lengths)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    ends = np.cumsum(lengths)
    places = ((ends - lengths)[owner] + STRIDE * within)[:, None] + np.arange(WIDTH)
    padded = np.concatenate([ids, np.zeros(WIDTH, ids.dtype)])
    return np.where(places < ends[owner, None], padded[places], 0), owner


def train(sample: list[tuple[str, int]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 0, totals: tuple[int, int] | None = None) -> Params:
    """Learn from labelled texts with Adagrad and backpropagation through time.

    A toxic text need not be toxic in every window. The first two epochs teach
    all windows the label of their text; later ones teach the highest windows
    of each text and a few others of clean texts. At the end the largest output
    of a text is calibrated by logistic regression on texts.
    """
    p = new_params(seed)
    p["calibration"] = np.array([1.0, 0.0], np.float32)
    rng = np.random.default_rng(seed)
    vocabulary: dict[str, int] = {}
    ids, lengths, ys = [], [], []
    for text, y in sample:
        if words := words_of(text):
            ids += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]
            lengths.append(len(words))
            ys.append(y)
    ys = np.array(ys, np.float32)
    if not len(ys) or ys.min() == ys.max():
        p["out"][:] = 0
        p["out_bias"][:] = 0 if not len(ys) else 8 * (ys[0] - 0.5)
        return p
    at, owner = windows(np.array(ids), np.array(lengths))
    features = word_features(list(vocabulary))
    word_ids, word_counts = features[0], features[2]
    word_grams = np.split(features[1], np.cumsum(word_counts)[:-1])
    squares = {k: np.full_like(v, 1e-4) for k, v in p.items() if k != "calibration"}

    def step(rows: np.ndarray, w: np.ndarray) -> None:
        used, places = np.unique(at[rows], return_inverse=True)
        used, places = (used[1:], places) if used[0] == 0 else (used, places + 1)  # row 0: no word
        places = places.reshape(len(rows), WIDTH)
        ids, grams, counts = word_ids[used - 1], np.concatenate([word_grams[i - 1] for i in used]), word_counts[used - 1]
        x = word_inputs(p, ids, grams, counts)
        table = np.concatenate([np.zeros((1, 6 * HIDDEN), np.float32), x @ p["input"] + p["input_bias"]])
        g, dt = gradients(p, table, places, ys[owner[rows]], w)
        g["input"], g["input_bias"] = x.T @ dt, dt.sum(0)
        dx = dt @ p["input"].T
        touched = {name: (slice(None), d) for name, d in g.items()}
        touched["words"] = summed(ids, dx[:, :EMBED])
        touched["chars"] = summed(grams, np.repeat(dx[:, EMBED:] / counts[:, None], counts, axis=0))
        for name, (part, d) in touched.items():
            squares[name][part] += d * d
            p[name][part] -= rate * d / np.sqrt(squares[name][part])

    def best() -> tuple[np.ndarray, np.ndarray]:
        table = gate_table(p, *features)
        z = outputs(p, table, at)
        return z, np.maximum.reduceat(z, np.flatnonzero(np.diff(owner, prepend=-1)))

    for epoch in range(epochs):
        if epoch < 2:
            chosen = np.arange(len(at))
        else:
            z, top = best()
            some = (z >= top[owner] - 1e-6) | (ys[owner] == 0) & (rng.random(len(at)) < 0.15)
            chosen = np.flatnonzero(some)
        y = ys[owner[chosen]]
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6)).astype(np.float32)
        order = rng.permutation(len(chosen))
        for i in range(0, len(order), BATCH):
            part = order[i : i + BATCH]
            step(chosen[part], weight[part])
    _, top = best()
    # the sample's classes count as often as they do among all labelled rows
    shares = np.array(totals or [(ys == 0).sum(), (ys == 1).sum()], float) / [(ys == 0).sum(), (ys == 1).sum()]
    weight = shares[ys.astype(int)]
    p["calibration"] = calibrated(top, ys, weight * len(ys) / weight.sum())
    return p


def calibrated(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Slope and shift of a weighted logistic regression of the label on one number: damped Newton steps, a small ridge."""
    z = z.astype(np.float64)
    mean, spread = z.mean(), z.std() + 1e-6
    x, w = np.stack([(z - mean) / spread, np.ones_like(z)], 1), np.zeros(2)
    loss = lambda v: weight @ (np.logaddexp(0, x @ v) - y * (x @ v)) + 0.5 * v @ v
    for _ in range(30):
        q = 1 / (1 + np.exp(-(x @ w)))
        step = np.linalg.solve((x * (weight * q * (1 - q))[:, None]).T @ x + np.eye(2), x.T @ (weight * (q - y)) + w)
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-9:
            step /= 2
        w = w - step
    return np.array([w[0] / spread, w[1] - w[0] * mean / spread], np.float32)


def gate_table(p: Params, *features: np.ndarray) -> np.ndarray:
    """Input parts of the gates of words, below a row of zeros for no word."""
    parts = [np.zeros((1, 6 * HIDDEN), np.float32)]
    if features:
        ids, grams, counts = features
        ends = np.cumsum(counts)
        for i in range(0, len(ids), AT_ONCE):  # the vectors of all n-grams together would be large
            some = slice(i, min(i + AT_ONCE, len(ids)))
            x = word_inputs(p, ids[some], grams[ends[i] - counts[i] : ends[some.stop - 1]], counts[some])
            parts.append(x @ p["input"] + p["input_bias"])
    return np.concatenate(parts)


def scorer(p: Params) -> Callable[[Column], Column]:
    """Column function: toxicity of a text, that of its most toxic window.

    A word enters the gates by a product that does not depend on its
    neighbours, so it is worked out once per word and remembered. Null and empty
    texts have one window without words.
    """

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, int] = {}
        table = gate_table(p)
        slope, shift = (float(x) for x in p["calibration"])
        for texts in batches:
            top = []
            for words in together(texts):
                if len(known) > CACHE:
                    known.clear()
                    table = gate_table(p)
                if new := list(set().union(*words).difference(known)):
                    table = _grown(table, gate_table(p, *word_features(new))[1:], len(known) + 1)
                    known |= zip(new, range(len(known) + 1, len(known) + len(new) + 1), strict=True)
                lengths = np.array([len(w) for w in words])
                ids = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.int64, lengths.sum())
                top.append(highest(p, table, *windows(ids, lengths)))
            top = np.concatenate([*top, []])
            yield pd.Series(1 / (1 + np.exp(-np.clip(slope * top + shift, -30, 30))))

    return F.pandas_udf(score, "double")


def _grown(table: np.ndarray, rows: np.ndarray, at: int) -> np.ndarray:
    """``table`` with ``rows`` put at ``at``; room is doubled when it runs out."""
    if at + len(rows) > len(table):
        table = np.concatenate([table, np.zeros((max(len(table), at + len(rows) - len(table)), table.shape[1]), np.float32)])
    table[at : at + len(rows)] = rows
    return table


def together(texts: pd.Series) -> Iterator[list[list[str]]]:
    """Words of texts, so many texts at a time as have some thousand windows."""
    some: list[list[str]] = []
    n = 0
    for text in texts:
        some.append(words_of(text))
        n += len(some[-1])
        if n >= AT_ONCE * STRIDE:
            yield some
            some, n = [], 0
    if some:
        yield some


def highest(p: Params, table: np.ndarray, at: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Largest output of the windows of each text."""
    return np.maximum.reduceat(outputs(p, table, at), np.flatnonzero(np.diff(owner, prepend=-1)))


def outputs(p: Params, table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Output of each window, a block of windows at a time."""
    return np.concatenate([logits(p, table, at[i : i + BLOCK]) for i in range(0, len(at), BLOCK)])


def toxicity_model(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most_chars: int = MOST_CHARS) -> Params:
    """The network learned from ``labels`` (doc_id, toxic) of rows that are not held out, on a bounded sample."""
    return train(labelled_sample(docs, labels, "toxic", per_class, most_chars, fill=True), totals=class_totals(labels, "toxic"))


def toxicity(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """Toxicity of every row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Windows that start every 12 words of the whole text are scored; the text has
    the score of its highest window. A passage of 14 to 24 words may be cut in two. Only the text enters the score. Repeated rows and
    null ids are scored like any other.
    """
    rows = docs.select("doc_id", held_out().alias("held_out"), scorer(toxicity_model(docs, labels))("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= least).cast("int"))
