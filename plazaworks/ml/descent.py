"""Passes of a dense network over a table: Spark's optimiser, its loss and gradient taken by whole blocks of rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from math import inf, isfinite, nan, sqrt

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

#: Gradients sent to the driver by a pass, unless more cores are there.
MOST_SUMS = 96
#: Blocks of rows that a task works on at a time, and previous steps the optimiser remembers.
BLOCKS_AT_ONCE, MEMORY = 32, 10


@dataclass
class Point:
    """Weights with the mean loss over blocks, its gradient, and the mean loss over rows."""

    weights: np.ndarray
    value: float
    gradient: np.ndarray
    log_loss: float


class Passes:
    """Loss and gradient of a sigmoid network with a softmax end, over (label_index, features).

    As in Spark's multilayer perceptron, the loss is the mean over the blocks of
    a task's rows of each block's mean, and a layer's weights lie input by
    input, followed by its biases.
    """

    def __init__(self, rows: DataFrame, layers: Sequence[int], block: int):
        rows = rows.select("label_index", vector_to_array("features").alias("x"))
        most = max(MOST_SUMS, rows.sparkSession.sparkContext.defaultParallelism)
        self.rows = rows.coalesce(most) if rows.rdd.getNumPartitions() > most else rows
        self.layers, self.block = list(layers), block

    def __call__(self, weights: np.ndarray) -> Point:
        layers, block = self.layers, self.block

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = Sums(weights, layers)
            for x, y in _chunks(batches, layers[0], block):
                total.add(x, y, block)
            if total.rows:
                names = ["gradient", "value", "blocks", "log_loss", "rows"]
                yield pa.RecordBatch.from_pylist([dict(zip(names, (total.gradient.tobytes(), total.value, total.blocks, total.log_loss, total.rows)))])

        parts = self.rows.mapInArrow(sums, "gradient binary, value double, blocks long, log_loss double, rows long").toArrow().to_pylist()
        gradient = np.zeros(len(weights))
        for p in parts:
            gradient += np.frombuffer(p["gradient"])
        blocks, rows = sum(p["blocks"] for p in parts), sum(p["rows"] for p in parts)
        if not rows:
            return Point(weights, nan, gradient, inf)
        return Point(weights, sum(p["value"] for p in parts) / blocks, gradient / blocks, sum(p["log_loss"] for p in parts) / rows)


def _chunks(batches: Iterator[pa.RecordBatch], width: int, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows in order, in whole blocks; what is left over at the end comes by itself."""
    x, y = np.empty((0, width)), np.empty(0, int)
    for b in batches:
        x = np.concatenate([x, b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)])
        y = np.concatenate([y, b.column(0).to_numpy(zero_copy_only=False).astype(int)])
        if len(y) >= block * BLOCKS_AT_ONCE:
            whole = len(y) // block * block
            yield x[:whole], y[:whole]
            x, y = x[whole:], y[whole:]
    whole = len(y) // block * block
    for some in (slice(whole), slice(whole, None)):
        if len(y[some]):
            yield x[some], y[some]


class Sums:
    """Sums over blocks of their mean loss and gradient, and over rows of their loss."""

    def __init__(self, weights: np.ndarray, layers: Sequence[int]):
        self.gradient, self.value, self.blocks, self.log_loss, self.rows = np.zeros(len(weights)), 0.0, 0, 0.0, 0
        self.layers, at = [], 0
        for n, m in zip(layers, layers[1:]):
            cut = slice(at, at + n * m), slice(at + n * m, at := at + n * m + m)
            self.layers.append((weights[cut[0]].reshape(n, m), weights[cut[1]], *cut))

    def add(self, x: np.ndarray, y: np.ndarray, block: int) -> None:
        """Adds whole blocks, or one that is not full."""
        size = min(len(y), block)
        outputs = [x]
        for w, b, *_ in self.layers:
            z = outputs[-1] @ w
            z += b
            if len(outputs) < len(self.layers):
                with np.errstate(over="ignore"):
                    np.exp(np.negative(z, out=z), out=z)
                z += 1
                np.reciprocal(z, out=z)
            else:
                z -= z.max(axis=1, keepdims=True)
                np.exp(z, out=z)
                z /= z.sum(axis=1, keepdims=True)
            outputs.append(z)
        p = outputs.pop()
        target = np.zeros_like(p)
        target[np.arange(len(y)), y] = 1
        with np.errstate(divide="ignore", invalid="ignore"):
            self.value -= (target * np.log(p)).sum() / size
        self.log_loss -= np.log(np.maximum(p[np.arange(len(y)), y], 1e-15)).sum()
        self.blocks, self.rows = self.blocks + -(-len(y) // block), self.rows + len(y)
        delta = p - target
        for w, _, at, bias in reversed(self.layers):
            a = outputs.pop()
            self.gradient[at] += (a.T @ delta).ravel() / size
            self.gradient[bias] += delta.sum(axis=0) / size
            if outputs:
                delta = delta @ w.T
                delta *= a
                delta *= np.subtract(1, a, out=a)


class NoStep(Exception):
    """The search along a direction ended without a step."""


@dataclass
class State:
    """A point of the descent with the steps and gradient differences that led there, the last one first."""

    point: Point
    iterations: int = 0
    steps: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    values: list[float] = field(default_factory=lambda: [inf])


def descend(passes, start: Point, most: int, tolerance: float) -> Point:
    """``most`` iterations of L-BFGS from ``start``, as Spark runs them: strong Wolfe steps, and a second try without memory where none is found.

    passes: gives the :class:`Point` of some weights; ``start`` is one already, so
    going on from where another descent ended looks at no row twice.
    """
    state, first, failed = State(start), start.value, False
    while not _ended(state, most, tolerance, first):
        try:
            direction = _direction(state)
            point = _step(passes, state, direction)
        except NoStep:
            if failed:
                break
            state, failed = State(state.point, state.iterations, [], state.values), True
            continue
        old, failed = state.point, False
        steps = [(point.weights - old.weights, point.gradient - old.gradient), *state.steps][:MEMORY]
        state = State(point, state.iterations + 1, steps, [*state.values, point.value][-20:])
    return state.point


def _ended(state: State, most: int, tolerance: float, first: float) -> bool:
    value = state.point.value
    flat = len(state.values) > 1 and abs(value - max(state.values)) <= tolerance * first
    return state.iterations >= most or flat or np.linalg.norm(state.point.gradient) <= max(tolerance * value, 1e-8)


def _direction(state: State) -> np.ndarray:
    d, scale, seen = state.point.gradient.copy(), 1.0, []
    if state.steps:
        s, g = state.steps[0]
        if not s @ g >= 0:
            raise NoStep
        scale = (s @ g) / (g @ g)
    for s, g in state.steps:
        seen.append((s @ d) / (s @ g))
        if np.isnan(seen[-1]):
            raise NoStep
        d -= seen[-1] * g
    d *= scale
    for (s, g), a in zip(reversed(state.steps), reversed(seen)):
        d += (a - (g @ d) / (s @ g)) * s
    return -d


def _step(passes, state: State, direction: np.ndarray) -> Point:
    """The point that a strong Wolfe search (c1 1e-4, c2 0.9, ten widenings, ten cuts by cubics) finds along a direction."""
    start = state.point
    fall = start.gradient @ direction
    if fall > 0:
        raise NoStep
    at = lambda t: (p := passes(start.weights + direction * t), t, p.value, p.gradient @ direction)
    high = lambda c: c[2] > start.value + 1e-4 * c[1] * fall

    def found(c):
        if c[1] * np.linalg.norm(start.gradient) < 1e-10:
            raise NoStep
        return c[0]

    def zoom(low, hi):
        for _ in range(10):
            c = at(_between(*sorted((low, hi), key=lambda b: b[1])))
            if high(c) or c[2] >= low[2]:
                hi = c
            else:
                if abs(c[3]) <= 0.9 * abs(fall):
                    return found(c)
                if c[3] * (hi[1] - low[1]) >= 0:
                    hi = low
                low = c
        raise NoStep

    low, t = (start, 0.0, start.value, fall), 1 / np.linalg.norm(direction) if state.iterations == 0 else 1.0
    for i in range(10):
        c = at(t)
        if not isfinite(c[2]):
            t /= 2
            continue
        if high(c) or (i > 0 and c[2] >= low[2]):
            return zoom(low, c)
        if abs(c[3]) <= 0.9 * abs(fall):
            return found(c)
        if c[3] >= 0:
            return zoom(c, low)
        low, t = c, t * 1.5
    raise NoStep


def _between(l, r) -> float:
    """The lowest place of the cubic through two points, not too near to either."""
    _, lt, lv, ld = l
    _, rt, rv, rd = r
    d1 = ld + rd - 3 * (lv - rv) / (lt - rt)
    square = d1 * d1 - ld * rd
    d2 = sqrt(square) if square >= 0 else nan
    t = rt - (rt - lt) * (rd + d2 - d1) / (rd - ld + 2 * d2)
    lo, hi = lt + 0.1 * (rt - lt), lt + 0.9 * (rt - lt)
    return lo if t < lo else hi if t > hi else t
