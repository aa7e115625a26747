"""Linear classifiers by gradient descent over sparse features.

Training documents are staged as one row each, with the positions and values of their words, and a fit keeps them as blocks of
arrays in files beside the tasks. A step is one job of one stage: each task computes the margins and the gradient of its blocks in numpy
and sends f numbers, which are added up: by the driver for up to 64 tasks, in a tree for more. Tasks are bounded by the cores, not by the documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.blocks import Blocks, held
from tidemark.operators.regression import BoldRate
from tidemark.operators.words import DICTIONARY_SIZE
from tidemark.session import cut, small_side


@dataclass
class Fit:
    """Weights by position, and one trace row per step: iteration, cost, norm, rate."""

    weights: np.ndarray
    trace: list[tuple] = field(default_factory=list)

    def weights_frame(self, spark: SparkSession) -> DataFrame:
        return weights_frame(spark, self.weights)

    def trace_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.trace, "iteration INT, cost DOUBLE, norm DOUBLE, rate DOUBLE")


def weights_frame(spark: SparkSession, weights: np.ndarray) -> DataFrame:
    """``pos, weight`` from a weight vector."""
    table = pa.table({"pos": np.arange(len(weights), dtype="int32"), "weight": weights})
    return spark.createDataFrame(table)


def with_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    """The features of documents with a label. Several labels of an id count as the largest, so no row repeats."""
    return features.join(labels.groupBy("doc_id").agg(F.max("label").alias("label")), "doc_id")


def labelled(rows: DataFrame) -> DataFrame:
    """``doc_id, pos, x, label, lead`` of labelled features, with one leading row per document.

    The window leaves the rows partitioned by document and sorted, which is what each step needs.
    """
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("pos")) == 1
    return rows.select("doc_id", "pos", "x", F.col("label").cast("int").alias("label"), first.alias("lead"))


@contextmanager
def training_table(rows: DataFrame) -> Iterator[DataFrame]:
    """``doc_id, label, pos, x`` with the arrays of a document, staged; a fit keeps them as blocks.

    ``rows`` are labelled features; a document's list holds at most one entry per dictionary word.
    """
    cells = F.sort_array(F.collect_list(F.struct("pos", "x")))
    docs = rows.groupBy("doc_id").agg(F.max("label").cast("int").alias("label"), cells.alias("cells"))
    yield cut(docs.select("doc_id", "label", F.col("cells.pos").alias("pos"), F.col("cells.x").alias("x")))


def _logistic(theta: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    small = np.exp(-np.abs(theta))
    cost = np.maximum(theta, 0) + np.log1p(small) - label * theta
    return cost, np.where(theta >= 0, 1, small) / (1 + small) - label


def _hinge(theta: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sign = 2 * label - 1
    return np.maximum(1 - sign * theta, 0), np.where(sign * theta < 1, -sign, 0)


@dataclass(frozen=True)
class Loss:
    """Cost of a document and its slope in the margin, as SQL over ``theta`` and ``label`` (0 or 1) and on arrays."""

    cost: str
    slope: str
    on: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


# ln(1 + e^theta) - y theta, in forms that do not overflow.
LOGISTIC = Loss(
    "greatest(theta, 0D) + log1p(exp(-abs(theta))) - label * theta",
    "if(theta >= 0, 1D, exp(theta)) / (1 + exp(-abs(theta))) - label",
    _logistic,
)
# max(0, 1 - s theta) with s = -1 or 1.
HINGE = Loss(
    "greatest(1 - (2 * label - 1) * theta, 0D)",
    "if((2 * label - 1) * theta < 1, 1 - 2 * label, 0)",
    _hinge,
)


def weighted_hinge(positive: float, negative: float) -> Loss:
    """Hinge loss times a weight per class."""
    weight = f"if(label = 1, {float(positive)!r}D, {float(negative)!r}D)"

    def on(theta: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        times = np.where(label == 1, positive, negative)
        cost, slope = _hinge(theta, label)
        return times * cost, times * slope

    return Loss(f"{weight} * {HINGE.cost}", f"{weight} * {HINGE.slope}", on)


def loss_pass(data: DataFrame, weights: DataFrame, loss: Loss, f: int = DICTIONARY_SIZE) -> DataFrame:
    """``pos, gradient, cost``: summed data gradient, and the cost of documents led by that position."""
    margins = data.join(small_side(weights, f), "pos").selectExpr(
        "pos", "x", "label", "lead", "sum(x * weight) OVER (PARTITION BY doc_id) AS theta"
    )
    rows = margins.selectExpr("pos", f"x * ({loss.slope}) AS g", f"if(lead, {loss.cost}, 0D) AS c")
    return rows.groupBy("pos").agg(F.sum("g").alias("gradient"), F.sum("c").alias("cost"))


# Words of documents that a block holds, about; a document is never split.
BLOCK_WORDS = 1 << 16
# Partitions whose sums the driver adds up itself; those of more are added in a tree.
FLAT_PARTS = 64

# Weights of words, margins and gradients are summed in whole numbers of 2^-30, slopes and costs of documents are whole numbers of 2^-24.
# So small that rounding does not show, so large that two ways to take a logarithm round alike.
UNIT = 2.0**30
SLOPE_UNIT = 2.0**24


def whole(value: np.ndarray) -> np.ndarray:
    """The nearest whole number, halves upwards."""
    return np.floor(value + 0.5)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents as bytes: labels, numbers of words, positions and values."""
    for batch in batches:
        label, sizes, pos, x = _documents(batch)
        ends = np.cumsum(sizes, dtype=np.int64)
        first = 0
        while first < len(sizes):
            start = int(ends[first - 1]) if first else 0
            end = max(int(np.searchsorted(ends, start + BLOCK_WORDS, side="right")), first + 1)
            stop = int(ends[end - 1])
            parts = label[first:end].astype(np.int32), sizes[first:end].astype(np.int32), pos[start:stop].astype(np.int32), x[start:stop]
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in parts], ["label", "sizes", "pos", "x"])
            first = end


def _unpacked(block: tuple) -> tuple[np.ndarray, ...]:
    return tuple(np.frombuffer(part, kind) for part, kind in zip(block, (np.int32, np.int32, np.int32, np.float64)))


def _narrow(block: tuple[np.ndarray, ...], exact: bool) -> tuple[np.ndarray, ...]:
    """The block with positions of 16 bits where these do, and for exact sums with values as whole numbers of 2^-30 where 32 bits do."""
    label, sizes, pos, x = block
    if (pos <= 0xFFFF).all():
        pos = pos.astype(np.uint16)
    if exact:
        units = whole(x * UNIT)
        x = units.astype(np.int32) if (np.abs(units) < 2.0**31).all() else x
    return label, sizes, pos, x


@contextmanager
def packed(data: DataFrame, exact: bool = False) -> Iterator[Blocks]:
    """A training table as blocks of ``BLOCK_WORDS`` words, kept in files while a fit reads them.

    A step over them is one job of one stage. There is a partition a core, so what the steps send does not grow with the
    documents. ``exact``: for ``_exact_sums`` alone.
    """
    rows = data.select("label", "pos", "x").mapInArrow(_pack, "label binary, sizes binary, pos binary, x binary").rdd
    with held(rows.map(lambda row: _narrow(_unpacked(tuple(row)), exact))) as blocks:
        yield blocks


def _documents(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Labels, numbers of words, positions and values of the rows of a training table."""
    lists = batch.column("pos")
    return batch.column("label").to_numpy(), lists.value_lengths().to_numpy(), lists.flatten().to_numpy(), batch.column("x").flatten().to_numpy()


def _totals(parts: Iterator[tuple[np.ndarray, ...]], w: np.ndarray, loss: Loss) -> tuple[float, np.ndarray]:
    """Cost and gradient of the documents of a task."""
    gradient, cost = np.zeros(len(w)), 0.0
    for label, sizes, pos, x in parts:
        row = np.repeat(np.arange(len(sizes)), sizes)
        theta = np.bincount(row, weights=x * w[pos], minlength=len(sizes))
        costs, slope = loss.on(theta, label)
        gradient += np.bincount(pos, weights=x * slope[row], minlength=len(w))
        cost += float(costs.sum())
    return cost, gradient


def _by_document(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of the values of each document, in one run over them."""
    sums, filled = np.zeros(len(sizes)), np.flatnonzero(sizes)
    if len(filled):
        sums[filled] = np.add.reduceat(values, (np.cumsum(sizes, dtype=np.int64) - sizes)[filled])
    return sums


def _exact_totals(parts: Iterator[tuple[np.ndarray, ...]], w: np.ndarray, loss: Loss) -> tuple[int, np.ndarray]:
    """As ``_totals``, in whole numbers: their sums do not depend on any order while a block stays below 2^53."""
    gradient, cost = np.zeros(len(w), dtype=np.int64), 0
    for label, sizes, pos, x in parts:
        pos = pos.astype(np.intp)
        x = whole(x * UNIT) if x.dtype.kind == "f" else x.astype(np.float64)
        v = w.take(pos)
        v *= x
        v += 0.5
        theta = _by_document(np.floor(v, out=v), sizes) / UNIT
        costs, slope = (whole(v * SLOPE_UNIT) for v in loss.on(theta, label))
        x *= np.repeat(slope / SLOPE_UNIT, sizes)
        x += 0.5
        gradient += np.bincount(pos, weights=np.floor(x, out=x), minlength=len(w)).astype(np.int64)
        cost += int(costs.sum())
    return cost, gradient


def _step(weights, loss: Loss):
    """Per task of a training table: the gradient at each position of its documents, and their cost at position -1."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, gradient = _totals((_documents(b) for b in batches), weights.value, loss)
        used = np.flatnonzero(gradient)
        columns = [np.append(used, -1).astype(np.int32), np.append(gradient[used], cost)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["pos", "value"])

    return step


def _added(parts: RDD, add: Callable):
    """The sum of one row per partition: here for a few of them, else in a tree of tasks."""
    return reduce(add, parts.collect()) if parts.getNumPartitions() <= FLAT_PARTS else parts.treeReduce(add)


def _sums(data: DataFrame | Blocks, w: np.ndarray, loss: Loss) -> tuple[float, np.ndarray]:
    """Data cost and gradient at w over the blocks of a training table."""
    if isinstance(data, DataFrame):
        with packed(data) as blocks:
            return _sums(blocks, w, loss)
    if not data.getNumPartitions():
        return 0.0, np.zeros(len(w))
    step = lambda rows: [_totals(rows, w, loss)]
    return data.run(lambda blocks: _added(blocks.mapPartitions(step), lambda a, b: (a[0] + b[0], a[1] + b[1])))


def _exact_sums(data: DataFrame | Blocks, w: np.ndarray, loss: Loss) -> tuple[float, np.ndarray]:
    """As ``_sums``, the same to the last bit for any partitioning.

    A partition's totals go on as upper and lower 32 bits, so that their sums are whole numbers for any number of partitions.
    """
    if isinstance(data, DataFrame):
        with packed(data, exact=True) as blocks:
            return _exact_sums(blocks, w, loss)
    if not data.getNumPartitions():
        return 0.0, np.zeros(len(w))

    def step(rows):
        cost, gradient = _exact_totals(rows, w, loss)
        return [(cost, gradient >> 32, gradient & 0xFFFFFFFF)]

    cost, high, low = data.run(lambda blocks: _added(blocks.mapPartitions(step), lambda a, b: tuple(x + y for x, y in zip(a, b))))
    gradient = np.array([float((h << 32) + v) for h, v in zip(high.tolist(), low.tolist())]) / UNIT
    return float(cost) / SLOPE_UNIT, gradient


def _exact_square(w: np.ndarray) -> float:
    """|w|^2 in whole numbers of 2^-30."""
    return float(whole(w * w * UNIT).astype(np.int64).sum()) / UNIT


def _start(f: int, seed: int | None) -> np.ndarray:
    """Zeros, or seeded normal values with deviation 0.1."""
    return np.zeros(f) if seed is None else np.random.default_rng(seed).normal(0, 0.1, f)


def fit_logistic(
    data: DataFrame,
    f: int = DICTIONARY_SIZE,
    rate: float = 0.1,
    l2: float = 1e-3,
    tolerance: float = 1e-3,
    max_iterations: int = 1000,
    seed: int | None = None,
) -> Fit:
    """Logistic regression without intercept: summed loss + l2 |w|^2.

    Stops when the norm of the weights moves less than the tolerance. The rate grows until the cost rises, which blows up the
    smallest difference between two sums; all sums are exact here, so every partitioning takes the same steps to the end.
    """
    fit, bold = Fit(_start(f, seed)), BoldRate(rate)
    square = _exact_square(fit.weights)
    with packed(data, exact=True) as blocks:
        for i in range(max_iterations):
            w = fit.weights
            cost, gradient = _exact_sums(blocks, w, LOGISTIC)
            cost += l2 * square
            fit.weights = w - bold.rate * (gradient + 2 * l2 * w)
            before, square = square**0.5, _exact_square(fit.weights)
            after = square**0.5
            fit.trace.append((i, cost, after, bold.rate))
            if abs(after - before) < tolerance:
                break
            bold.step(cost)
    return fit


def fit_svm(
    data: DataFrame,
    n_docs: int,
    f: int = DICTIONARY_SIZE,
    c: float = 50.0,
    rate: float = 1.0,
    tolerance: float = 1e-3,
    max_iterations: int = 1000,
    seed: int | None = None,
) -> Fit:
    """Linear SVM by subgradient: mean hinge + c / (2n) |w|^2.

    Stops when the cost rises or the norm of the weights moves less than the tolerance.
    """
    fit, bold = Fit(_start(f, seed)), BoldRate(rate, last_cost=999999.0)
    with packed(data) as blocks:
        for i in range(max_iterations):
            w = fit.weights
            hinge, gradient = _sums(blocks, w, HINGE)
            cost = hinge / n_docs + c / (2 * n_docs) * float(w @ w)
            if cost > bold.last_cost:
                break
            fit.weights = w - bold.rate * (gradient / n_docs + c / n_docs * w)
            before, after = float(np.linalg.norm(w)), float(np.linalg.norm(fit.weights))
            fit.trace.append((i, cost, after, bold.rate))
            if abs(after - before) < tolerance:
                break
            bold.step(cost)
    return fit


def fit_weighted_svm(
    data: DataFrame,
    positive_share: float,
    f: int = DICTIONARY_SIZE,
    rate: float = 1.0,
    tolerance: float = 1e-3,
    cost_tolerance: float = 0.5,
    max_iterations: int = 1000,
    seed: int | None = None,
) -> Fit:
    """SVM with the hinge of positives weighted by the negative share and the other way round.

    Sums, not means, and no penalty. Stops when norm or cost moves less than its tolerance.
    """
    loss = weighted_hinge(1 - positive_share, positive_share)
    fit, bold = Fit(_start(f, seed)), BoldRate(rate, up=1.005, last_cost=9999999.0)
    with packed(data) as blocks:
        for i in range(max_iterations):
            w = fit.weights
            cost, gradient = _sums(blocks, w, loss)
            fit.weights = w - bold.rate * gradient
            before, after = float(np.linalg.norm(w)), float(np.linalg.norm(fit.weights))
            fit.trace.append((i, cost, after, bold.rate))
            if abs(after - before) < tolerance or abs(bold.last_cost - cost) < cost_tolerance:
                break
            bold.step(cost)
    return fit


def fit_sgd(
    data: DataFrame,
    loss: Loss,
    f: int = DICTIONARY_SIZE,
    iterations: int = 300,
    step: float = 1.0,
    l2: float = 0.01,
    tolerance: float = 1e-3,
) -> Fit:
    """Full-batch descent on the mean loss with rate step / sqrt(t) and L2 shrinkage.

    Stops when the weights move less than tolerance * max(|w|, 1).
    """
    n = data.count()
    fit = Fit(np.zeros(f))
    with packed(data) as blocks:
        for t in range(1, iterations + 1):
            w, rate = fit.weights, step / t**0.5
            cost, gradient = _sums(blocks, w, loss)
            fit.weights = w * (1 - rate * l2) - rate * gradient / n
            after = float(np.linalg.norm(fit.weights))
            fit.trace.append((t - 1, cost / n + l2 / 2 * float(w @ w), after, rate))
            if t > 1 and float(np.linalg.norm(fit.weights - w)) < tolerance * max(after, 1.0):
                break
    return fit


# How many steps back the curvature is remembered.
LBFGS_MEMORY = 10
# A step must lower the cost by this part of what the slope promises, else it is halved.
ARMIJO = 1e-4


def _lbfgs_direction(gradient: np.ndarray, past: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The two-loop recursion: minus the gradient times an inverse curvature built from past steps and changes of gradient."""
    q, kept = gradient.copy(), []
    for step, change in reversed(past):
        share = (step @ q) / (step @ change)
        kept.append(share)
        q -= share * change
    if past:
        step, change = past[-1]
        q *= (step @ change) / (change @ change)
    for (step, change), share in zip(past, reversed(kept)):
        q += (share - (change @ q) / (step @ change)) * step
    return -q


def fit_lbfgs(
    data: DataFrame,
    f: int = DICTIONARY_SIZE,
    l2: float = 0.01,
    iterations: int = 100,
    tolerance: float = 1e-8,
) -> Fit:
    """Logistic regression without intercept: mean loss + l2 / 2 |w|^2, by L-BFGS.

    One job a step, and one more for each time that a step is halved. Stops when no part of the gradient is above the tolerance. With
    l2 above 0 the optimum is unique. The trace has the cost and the norm after each step, and the step's length as rate.
    """
    n = data.count()
    fit, past = Fit(np.zeros(f)), []
    if not n:
        return fit

    with packed(data) as blocks:

        def at(w: np.ndarray) -> tuple[float, np.ndarray]:
            cost, gradient = _sums(blocks, w, LOGISTIC)
            return cost / n + l2 / 2 * float(w @ w), gradient / n + l2 * w

        cost, gradient = at(fit.weights)
        for i in range(iterations):
            if np.abs(gradient).max() <= tolerance:
                break
            way = _lbfgs_direction(gradient, past)
            # without curvature the first step is of length 1
            rate = 1.0 if past else 1 / max(float(np.linalg.norm(gradient)), 1e-12)
            slope = float(way @ gradient)
            while True:
                step = rate * way
                new_cost, new_gradient = at(fit.weights + step)
                if new_cost <= cost + ARMIJO * rate * slope or rate < 1e-10:
                    break
                rate /= 2
            change = new_gradient - gradient
            if step @ change > 1e-12 * float(change @ change):
                past = [*past, (step, change)][-LBFGS_MEMORY:]
            stuck = new_cost >= cost
            if not stuck or np.abs(new_gradient).max() < np.abs(gradient).max():
                fit.weights, cost, gradient = fit.weights + step, new_cost, new_gradient
            fit.trace.append((i, cost, float(np.linalg.norm(fit.weights)), rate))
            if stuck:
                break
    return fit
