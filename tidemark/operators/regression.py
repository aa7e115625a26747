"""Linear regression: closed form and gradient descent with an adaptive rate."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class BoldRate:
    """A rate that shrinks when the cost rises and grows when it falls; equal cost keeps it.

    The first comparison is against ``last_cost``, so a start at 0 shrinks the rate at once.
    """

    rate: float
    up: float = 1.05
    down: float = 0.5
    last_cost: float = 0.0

    def step(self, cost: float) -> None:
        if cost > self.last_cost:
            self.rate *= self.down
        elif cost < self.last_cost:
            self.rate *= self.up
        self.last_cost = cost


def ols_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line ``m, b`` and the row count, from one aggregation."""
    known = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return known.agg(
        F.regr_slope(y, x).alias("m"), F.regr_intercept(y, x).alias("b"), F.count(F.lit(1)).alias("n")
    )


def line_sums(df: DataFrame, x: str, y: str) -> DataFrame:
    """The five sums behind the line: ``n, sum_x, sum_y, sum_xx, sum_xy``."""
    a, b = F.col(x), F.col(y)
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(a).alias("sum_x"),
        F.sum(b).alias("sum_y"),
        F.sum(a * a).alias("sum_xx"),
        F.sum(a * b).alias("sum_xy"),
    )


def _moments(df: DataFrame, columns: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Row count, means and centred co-moments (divided by n) of the columns, in one pass."""
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    row = df.agg(
        F.count(F.lit(1)),
        *[F.avg(c) for c in columns],
        *[F.covar_pop(columns[i], columns[j]) for i, j in pairs],
    ).first()
    d = len(columns)
    cov = np.empty((d, d))
    for (i, j), value in zip(pairs, row[1 + d :]):
        cov[i, j] = cov[j, i] = value
    return row[0], np.array(row[1 : 1 + d], dtype=float), cov


def _from_moments(df: DataFrame, xs: list[str], y: str, standardize: bool):
    """mean(r), mean(r^2), mean(x r) of the residual r as a function of the parameters.

    Centred moments keep the residual sums accurate: the mean residual is formed
    directly and only the variance part is quadratic.
    """
    n, mean, cov = _moments(df, [*xs, y])
    mx, my, sxx, sxy, syy = mean[:-1], mean[-1], cov[:-1, :-1], cov[:-1, -1], cov[-1, -1]
    if standardize:
        spread = np.sqrt(np.diag(sxx))
        mx, sxx, sxy = np.zeros_like(mx), sxx / np.outer(spread, spread), sxy / spread

    def residual_means(b: float, w: np.ndarray):
        r = my - b - w @ mx
        return r, syy - 2 * w @ sxy + w @ sxx @ w + r * r, sxy - sxx @ w + mx * r

    return residual_means


def _from_passes(df: DataFrame, xs: list[str], y: str, standardize: bool):
    """The same means by one job per call over the given rows."""
    if standardize:
        _, mean, cov = _moments(df, xs)
        spread = np.sqrt(np.diag(cov))
        scaled = [((F.col(c) - float(m)) / float(s)).alias(c) for c, m, s in zip(xs, mean, spread)]
        df = df.select(*scaled, y)

    def residual_means(b: float, w: np.ndarray):
        r = F.col(y) - F.lit(float(b))
        for c, v in zip(xs, w):
            r = r - F.col(c) * F.lit(float(v))
        rows = df.select(*xs, r.alias("r"))
        row = rows.agg(
            F.avg("r"), F.avg(F.col("r") * F.col("r")), *[F.avg(F.col(c) * F.col("r")) for c in xs]
        ).first()
        return row[0], row[1], np.array(row[2:], dtype=float)

    return residual_means


def _triangle(rows: np.ndarray) -> np.ndarray:
    """The triangular factor of a matrix, square also where the matrix has few rows."""
    width = rows.shape[1]
    return np.linalg.qr(np.vstack([rows, np.zeros((width, width))]), mode="r")


def _merged_triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for a task: the factor of the stacked factors ``r``, and the number of rows behind them."""
    held, n = None, 0
    for batch in batches:
        for r in batch.column("r").to_pylist():
            r = np.array(r).reshape(round(len(r) ** 0.5), -1)
            held = r if held is None else _triangle(np.vstack([held, r]))
        n += pc.sum(batch.column("n")).as_py() or 0
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([held.ravel().tolist()]), pa.array([n])], ["r", "n"])


def _row_triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for a task: the factor of its rows, with ones as the first column."""
    held, n = None, 0
    for batch in batches:
        columns = [np.ones(batch.num_rows), *[c.to_numpy(zero_copy_only=False) for c in batch.columns]]
        rows = np.stack(columns, axis=1)
        held = _triangle(rows if held is None else np.vstack([held, rows]))
        n += batch.num_rows
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([held.ravel().tolist()]), pa.array([n])], ["r", "n"])


def _from_factors(df: DataFrame, xs: list[str], y: str):
    """The same means from a triangular factor of the rows (1, x, y), which one job builds as a tree of tasks.

    The factor has the rows' own digits, where moments have only those of their squares. Tasks send one factor each, which about the root of the number of
    shuffle partitions merge before the driver does.
    """
    schema = "r array<double>, n bigint"
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in (*xs, y)])
    middle = math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = numbers.mapInArrow(_row_triangles, schema).repartition(max(1, middle)).mapInArrow(_merged_triangles, schema).collect()
    width = len(xs) + 2
    r = _triangle(np.vstack([np.zeros((1, width)), *[np.array(p.r).reshape(width, width) for p in parts]]))
    n = sum(p.n for p in parts)

    def residual_means(b: float, w: np.ndarray):
        rest = r @ np.array([-b, *-np.asarray(w), 1.0])
        means = r.T @ rest / n
        return means[0], rest @ rest / n, means[1:-1]

    return residual_means


def _descend(residual_means, d: int, iterations: int, rate: BoldRate, half: bool, start: float) -> Iterator[tuple]:
    """Rows of iteration, cost before the update, intercept and weights after it."""
    b, w = start, np.full(d, start)
    cost_factor, step_factor = (0.5, 1.0) if half else (1.0, 2.0)
    for i in range(iterations):
        r, rr, xr = residual_means(b, w)
        cost = cost_factor * rr
        w = w + rate.rate * step_factor * xr
        b = b + rate.rate * step_factor * r
        rate.step(cost)
        yield (i, float(cost), float(b), *[float(v) for v in w])


def _trace(df: DataFrame, xs: list[str], y: str, method: str, standardize: bool, names: list[str], **kw) -> DataFrame:
    known = df.select(*xs, y).dropna()
    if method == "moments":
        rows = list(_descend(_from_moments(known, xs, y, standardize), len(xs), **kw))
    elif method == "factors" and not standardize:
        rows = list(_descend(_from_factors(known, xs, y), len(xs), **kw))
    elif method == "passes":
        known = known.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = list(_descend(_from_passes(known, xs, y, standardize), len(xs), **kw))
        finally:
            known.unpersist()
    else:
        raise ValueError(f"unknown method {method!r}")
    schema = "iteration INT, cost DOUBLE, " + ", ".join(f"{n} DOUBLE" for n in names)
    return df.sparkSession.createDataFrame(rows, schema)


def descend_line(
    df: DataFrame,
    x: str,
    y: str,
    iterations: int = 100,
    rate: float = 1e-4,
    start: float = 0.1,
    method: str = "passes",
    standardize: bool = False,
) -> DataFrame:
    """Trace ``iteration, cost, b, m`` of a line fitted to the mean squared error.

    ``passes`` runs one job per iteration on the residuals themselves; ``moments`` reads the rows
    once, whatever the number of iterations, and is meant for columns of similar scale: where the
    descent diverges, its rounding errors do too. ``factors`` reads the rows once as well and is for columns as they are.
    """
    kw = dict(iterations=iterations, rate=BoldRate(rate), half=False, start=start)
    return _trace(df, [x], y, method, standardize, ["b", "m"], **kw)


def descend_plane(
    df: DataFrame,
    xs: list[str],
    y: str,
    iterations: int = 100,
    rate: float = 1e-3,
    start: float = 0.1,
    method: str = "passes",
    standardize: bool = False,
) -> DataFrame:
    """Trace ``iteration, cost, b, w0, w1, ...`` of a plane fitted to half the mean squared error."""
    kw = dict(iterations=iterations, rate=BoldRate(rate), half=True, start=start)
    return _trace(df, xs, y, method, standardize, ["b"] + [f"w{i}" for i in range(len(xs))], **kw)
