"""Regression against plain loops."""

import numpy as np
import pytest

from tidemark.operators import regression


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(0.1, 1, (400, 3))
    y = 0.3 + x @ [0.5, -0.2, 0.1] + rng.normal(0, 0.05, 400)
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y)]
    return spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE, y DOUBLE").repartition(5), x, y


def plain_line(x, y, iterations, rate):
    m = b = 0.1
    old, rows = 0.0, []
    for i in range(iterations):
        r = y - (m * x + b)
        cost = (r**2).mean()
        m, b = m + rate * 2 * (x * r).mean(), b + rate * 2 * r.mean()
        rate = rate * 0.5 if cost > old else rate * 1.05 if cost < old else rate
        old = cost
        rows.append((i, cost, b, m))
    return rows


def plain_plane(x, y, iterations, rate):
    w, b, old, rows = np.full(x.shape[1], 0.1), 0.1, 0.0, []
    for i in range(iterations):
        r = y - (x @ w + b)
        cost = (r**2).mean() / 2
        w, b = w + rate * (x * r[:, None]).mean(axis=0), b + rate * r.mean()
        rate = rate * 0.5 if cost > old else rate * 1.05 if cost < old else rate
        old = cost
        rows.append((i, cost, b, *w))
    return rows


def collected(trace):
    return [tuple(r) for r in trace.orderBy("iteration").collect()]


@pytest.mark.parametrize("method", ["moments", "passes", "factors"])
def test_line_trace(points, method):
    df, x, y = points
    got = collected(regression.descend_line(df, "a", "y", iterations=15, rate=0.01, method=method))
    np.testing.assert_allclose(got, plain_line(x[:, 0], y, 15, 0.01), rtol=1e-9)


@pytest.mark.parametrize("method", ["moments", "passes", "factors"])
def test_plane_trace(points, method):
    df, x, y = points
    got = collected(regression.descend_plane(df, ["a", "b", "c"], "y", iterations=15, rate=0.05, method=method))
    np.testing.assert_allclose(got, plain_plane(x, y, 15, 0.05), rtol=1e-9)


def test_first_rate_is_halved(points):
    """The first cost is compared with 0, so the second step uses half the rate."""
    df, x, y = points
    a, b, c = collected(regression.descend_line(df, "a", "y", iterations=3, rate=0.01))
    assert c[1] < b[1] < a[1]


def test_standardized_descent_meets_least_squares(points):
    df, x, y = points
    got = collected(regression.descend_plane(df, ["a", "b", "c"], "y", iterations=400, rate=0.05, standardize=True))
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    wanted = np.linalg.lstsq(np.c_[np.ones(len(y)), z], y, rcond=None)[0]
    np.testing.assert_allclose(got[-1][2:], wanted, atol=1e-6)
    passes = collected(
        regression.descend_plane(df, ["a", "b", "c"], "y", iterations=5, rate=0.05, standardize=True, method="passes")
    )
    np.testing.assert_allclose(passes, got[:5], rtol=1e-8)


def test_ols_line_and_sums(points):
    df, x, y = points
    row = regression.ols_line(df, "a", "y").first()
    slope, intercept = np.polyfit(x[:, 0], y, 1)
    assert row.m == pytest.approx(slope) and row.b == pytest.approx(intercept) and row.n == 400
    s = regression.line_sums(df, "a", "y").first()
    assert (s.n * s.sum_xy - s.sum_x * s.sum_y) / (s.n * s.sum_xx - s.sum_x**2) == pytest.approx(slope)


def test_large_raw_columns_stay_finite(spark):
    rng = np.random.default_rng(2)
    rows = [(float(t), float(t) / 300, float(t) / 60 + 3) for t in rng.uniform(120, 3600, 300)]
    df = spark.createDataFrame(rows, "t DOUBLE, d DOUBLE, y DOUBLE")
    trace = collected(regression.descend_plane(df, ["t", "d"], "y"))
    assert len(trace) == 100 and all(np.isfinite(r).all() for r in trace)


def test_factors_keep_the_digits_of_the_rows(spark):
    """Columns that differ in their ninth digit: moments lose it, factors do not. Any number of tasks gives the same."""
    rng = np.random.default_rng(6)
    x = 1e9 + rng.uniform(0, 1, 400)
    rows = spark.createDataFrame([(float(a), float(a) + float(b)) for a, b in zip(x, rng.normal(0, 1e-3, 400))], "x DOUBLE, y DOUBLE")
    exact = np.array([[1.0, a, b] for a, b in rows.collect()]) @ np.array([0.0, -1.0, 1.0])
    for parts in (1, 7, 400):
        means = regression._from_factors(rows.repartition(parts), ["x"], "y")
        r, rr, xr = means(0.0, np.array([1.0]))
        np.testing.assert_allclose([r, rr], [exact.mean(), (exact**2).mean()], rtol=1e-3, atol=1e-6)


def test_unknown_method(points):
    with pytest.raises(ValueError):
        regression.descend_line(points[0], "a", "y", method="x")
