"""Classifiers against plain loops and the packaged SGD trainers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plans_util import outer_plan
from tidemark.operators import bayes, classify, evaluate
from tidemark.operators.regression import BoldRate

N, P = 60, 8


def sigma(t):
    return 1 / (1 + np.exp(-t))


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    x = rng.uniform(0, 1, (N, P)) * (rng.uniform(size=(N, P)) < 0.5)
    x[:, 0] += 0.1
    y = ((x @ rng.normal(size=P) + rng.normal(0, 0.1, N)) > 0).astype(int)
    return x, y


@pytest.fixture(scope="module")
def table(spark, data):
    x, y = data
    cells = [(d, p, float(x[d, p])) for d in range(N) for p in range(P) if x[d, p]]
    features = spark.createDataFrame(cells, "doc_id INT, pos INT, x DOUBLE")
    labels = spark.createDataFrame([(d, int(y[d])) for d in range(N)], "doc_id INT, label INT")
    with classify.training_table(classify.with_labels(features, labels)) as held:
        yield held


@pytest.fixture(scope="module")
def long_rows(table):
    return table.select("doc_id", "label", F.explode(F.arrays_zip("pos", "x")).alias("c")).select("doc_id", "label", "c.pos", "c.x")


def exact_logistic(x, y, steps, rate=0.1, l2=1e-3, tolerance=1e-3):
    """The same descent over a dense matrix, in Python's own whole numbers."""
    unit, small = 2**30, 2**24
    whole = lambda v: int(np.floor(v + 0.5))
    cells = [[(p, float(whole(v * unit))) for p, v in enumerate(row) if v] for row in x]
    w, bold, rows = np.zeros(P), BoldRate(rate), []
    for i in range(steps):
        total, gradient = 0, [0] * P
        for row, label in zip(cells, y):
            theta = sum(whole(v * w[p]) for p, v in row) / unit
            total += whole((max(theta, 0) + np.log1p(np.exp(-abs(theta))) - label * theta) * small)
            slope = whole(((1 if theta >= 0 else np.exp(theta)) / (1 + np.exp(-abs(theta))) - label) * small) / small
            for p, v in row:
                gradient[p] += whole(v * slope)
        square = sum(whole(v * v * unit) for v in w) / unit
        cost = total / small + l2 * square
        w = w - bold.rate * (np.array([g / unit for g in gradient]) + 2 * l2 * w)
        after = (sum(whole(v * v * unit) for v in w) / unit) ** 0.5
        rows.append((i, cost, after, bold.rate))
        if abs(after - square**0.5) < tolerance:
            break
        bold.step(cost)
    return rows


def test_whole_logistic_fit_is_the_same_for_any_partitioning(table, data):
    """To the last bit, also against sums in another order."""
    traces = [classify.fit_logistic(table.repartition(n), f=P, tolerance=0, max_iterations=25).trace for n in (1, 8)]
    assert traces[0] == traces[1] and len(traces[0]) == 25
    assert traces[0] == exact_logistic(*data, 25, tolerance=0)


def test_exact_sums_are_near_the_plain_ones(table):
    w = np.linspace(-2, 3, P)
    (cost, gradient), (near, close) = classify._exact_sums(table, w, classify.LOGISTIC), classify._sums(table, w, classify.LOGISTIC)
    assert abs(cost - near) < N * 2.0**-24
    np.testing.assert_allclose(gradient, close, atol=N * 2.0**-24)


def plain_logistic(x, y, steps, rate=0.1, l2=1e-3):
    w, bold, rows = np.zeros(P), BoldRate(rate), []
    for i in range(steps):
        t = x @ w
        cost = (np.log(1 + np.exp(t)) - y * t).sum() + l2 * w @ w
        w = w - bold.rate * (x.T @ (sigma(t) - y) + 2 * l2 * w)
        rows.append((i, cost, np.linalg.norm(w), bold.rate))
        bold.step(cost)
    return w, rows


def test_logistic_trace(table, data):
    fit = classify.fit_logistic(table, f=P, max_iterations=6)
    w, rows = plain_logistic(*data, 6)
    np.testing.assert_allclose(fit.weights, w, rtol=1e-6)
    np.testing.assert_allclose(fit.trace, rows, rtol=1e-6)


def test_logistic_stops_by_norm(table):
    fit = classify.fit_logistic(table, f=P, tolerance=0.5)
    norms = [0.0] + [t[2] for t in fit.trace]
    assert abs(norms[-1] - norms[-2]) < 0.5
    assert all(abs(b - a) >= 0.5 for a, b in zip(norms[:-2], norms[1:-1]))


def test_seeded_start(table):
    a, b = (classify.fit_logistic(table, f=P, max_iterations=1, seed=3).weights for _ in range(2))
    np.testing.assert_array_equal(a, b)
    assert np.linalg.norm(a - classify.fit_logistic(table, f=P, max_iterations=1).weights) > 0


def test_svm_lowers_its_objective(table, data):
    x, y = data
    fit = classify.fit_svm(table, N, f=P, c=1.0, max_iterations=12)
    costs = [t[1] for t in fit.trace]
    assert costs == sorted(costs, reverse=True)
    w = np.zeros(P)
    s = 2 * y - 1
    hit = s * (x @ w) < 1
    first = -(x[hit].T * s[hit]).sum(axis=1) / N
    one = classify.fit_svm(table, N, f=P, c=1.0, max_iterations=1).weights
    np.testing.assert_allclose(one, -first, rtol=1e-9)


def test_weighted_svm_step(table, data):
    x, y = data
    share = y.mean()
    one = classify.fit_weighted_svm(table, share, f=P, max_iterations=1)
    weight = np.where(y == 1, 1 - share, share)
    np.testing.assert_allclose(one.weights, (x.T * (weight * (2 * y - 1))).sum(axis=1), rtol=1e-9)
    assert one.trace[0][1] == pytest.approx(weight.sum())


@pytest.mark.parametrize("name", ["logistic", "hinge"])
def test_sgd_matches_packaged_trainer(spark, table, data, name):
    from pyspark.mllib.classification import LogisticRegressionWithSGD, SVMWithSGD
    from pyspark.mllib.regression import LabeledPoint

    x, y = data
    points = spark.sparkContext.parallelize([LabeledPoint(int(b), a.tolist()) for a, b in zip(x, y)], 2)
    trainer = LogisticRegressionWithSGD if name == "logistic" else SVMWithSGD
    wanted = trainer.train(points, iterations=12).weights.toArray()
    loss = classify.LOGISTIC if name == "logistic" else classify.HINGE
    got = classify.fit_sgd(table, loss, f=P, iterations=12).weights
    np.testing.assert_allclose(got, wanted, rtol=1e-6, atol=1e-9)


def test_no_overflow_at_big_margins(spark):
    df = spark.createDataFrame([(1, 0, 1.0, 1, True), (2, 0, 1.0, 0, True)], "doc_id INT, pos INT, x DOUBLE, label INT, lead BOOLEAN")
    weights = spark.createDataFrame([(0, 5000.0)], "pos INT, weight DOUBLE")
    row = classify.loss_pass(df, weights, classify.LOGISTIC, 1).first()
    assert row.cost == pytest.approx(5000.0) and row.gradient == pytest.approx(1.0)


def test_steps_shuffle_only_gradients(table, spark):
    """Rows stay where the fit cached them; only sums by position move."""
    weights = spark.sparkContext.broadcast(np.zeros(P))
    step = table.mapInArrow(classify._step(weights, classify.HINGE), "pos int, value double")
    text = outer_plan(step.groupBy("pos").agg(F.sum("value")))
    assert "Exchange hashpartitioning(pos" in text and "Exchange hashpartitioning(doc_id" not in text
    assert "Sort" not in text


@pytest.mark.parametrize("loss", [classify.LOGISTIC, classify.HINGE, classify.weighted_hinge(0.3, 0.7)])
def test_steps_match_the_sql_form(spark, table, long_rows, loss):
    w = np.random.default_rng(3).normal(size=P)
    cost, gradient = classify._sums(table, w, loss)
    rows = classify.loss_pass(classify.labelled(long_rows), classify.weights_frame(spark, w), loss, P).collect()
    assert cost == pytest.approx(sum(r.cost for r in rows))
    for r in rows:
        assert gradient[r.pos] == pytest.approx(r.gradient, abs=1e-12)


def test_repeated_ids_are_one_document(spark):
    """An id with a third of all lines and several labels is one row of the table."""
    features = spark.range(300).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("doc_id")).distinct()
    features = features.select("doc_id", F.lit(0).alias("pos"), F.lit(1.0).alias("x"))
    labels = spark.range(300).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("doc_id"), (F.col("id") % 2).alias("label"))
    with classify.training_table(classify.with_labels(features, labels)) as data:
        assert data.count() == 201 and data.agg(F.max(F.size("pos"))).first()[0] == 1
        assert data.filter("doc_id = -1").first().label == 1


def test_naive_bayes_matches_package(spark, data, table, long_rows):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.linalg import Vectors

    x, y = data
    ml = spark.createDataFrame([(float(b), Vectors.dense(a.tolist())) for a, b in zip(x, y)], ["label", "features"])
    model = NaiveBayes(smoothing=1.0).fit(ml)
    vocab = spark.createDataFrame([(p,) for p in range(P)], "pos INT")
    rows = bayes.word_likelihoods(long_rows, vocab, f=P).collect()
    theta = model.theta.toArray()
    for r in rows:
        np.testing.assert_allclose(r.w, theta[:, r.pos], rtol=1e-9)
    labels = table.select("doc_id", "label")
    prior = bayes.class_priors(labels).first().prior
    np.testing.assert_allclose(prior, model.pi.toArray(), rtol=1e-9)
    found = bayes.classify(long_rows, bayes.word_likelihoods(long_rows, vocab, f=P), bayes.class_priors(labels), f=P)
    told = {r.doc_id: r.prediction for r in found.collect()}
    wanted = [int(r.prediction) for r in model.transform(ml).collect()]
    assert [told[d] for d in range(N)] == wanted


def judged(spark, pairs):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "doc_id INT, label INT, prediction INT")


PAIRS = [(1, 1)] * 5 + [(1, 0)] * 2 + [(0, 1)] * 4 + [(0, 0)] * 9


def test_metrics(spark):
    df = judged(spark, PAIRS)
    cells = {(r.label, r.prediction): r.n for r in evaluate.confusion(df).collect()}
    assert cells == {(1, 1): 5, (1, 0): 2, (0, 1): 4, (0, 0): 9} and sum(cells.values()) == len(PAIRS)
    assert evaluate.f1_binary(df).first().f1 == pytest.approx(10 / 16)
    report = {r.label: r for r in evaluate.class_report(df).collect()}
    assert report[1].precision == pytest.approx(5 / 9) and report[1].recall == pytest.approx(5 / 7)
    assert report[0].f1 == pytest.approx(18 / 24) and report[0].support == 13
    assert evaluate.f1_weighted(df).first().f1 == pytest.approx((10 / 16 * 7 + 18 / 24 * 13) / 20)


def test_metrics_without_positives(spark):
    df = judged(spark, [(0, 0)] * 3)
    assert evaluate.f1_binary(df).first().f1 == 0.0
    assert {(r.label, r.prediction): r.n for r in evaluate.confusion(df).collect()}[(1, 1)] == 0


def test_false_positives(spark):
    df = judged(spark, [(0, 0), (0, 1), (1, 1), (0, 1), (0, 1), (0, 1)])
    features = spark.createDataFrame([(1, 0, 0.5), (4, 1, 0.25), (5, 0, 9.0)], "doc_id INT, pos INT, x DOUBLE")
    top = spark.createDataFrame([("a", 0), ("b", 1)], "word STRING, pos INT")
    got = {(r.doc_id, r.word): r.x for r in evaluate.false_positives(df, features, top).collect()}
    assert got == {(1, "a"): 0.5, (1, "b"): 0.0, (3, "a"): 0.0, (3, "b"): 0.0, (4, "a"): 0.0, (4, "b"): 0.25}


def test_split_is_stable_and_disjoint(spark):
    df = spark.range(3000).withColumnRenamed("id", "doc_id")
    a = evaluate.split_rows(df).collect()
    b = evaluate.split_rows(df.repartition(9)).orderBy("doc_id").collect()
    assert sorted(a) == sorted(b)
    parts = evaluate.split_rows(df)
    assert evaluate.training_rows(parts).join(evaluate.held_out_rows(parts), "doc_id").count() == 0
    assert 0.3 < evaluate.held_out_rows(parts).count() / 3000 < 0.37
    assert parts.filter(F.col("part").between(1, 3)).count() == 3000


def plain_objective(x, y, w, l2):
    t = x @ w
    return np.mean(np.logaddexp(0, t) - y * t) + l2 / 2 * w @ w, x.T @ (sigma(t) - y) / len(y) + l2 * w


def test_lbfgs_reaches_the_optimum(table, data):
    fit = classify.fit_lbfgs(table, f=P, l2=0.01)
    _, gradient = plain_objective(*data, fit.weights, 0.01)
    assert np.abs(gradient).max() < 1e-7 and len(fit.trace) < 40
    costs = [t[1] for t in fit.trace]
    assert costs == sorted(costs, reverse=True)
    np.testing.assert_allclose(costs[-1], plain_objective(*data, fit.weights, 0.01)[0], rtol=1e-12)


def test_lbfgs_ends_where_the_packaged_one_does(spark, table, data):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors

    x, y = data
    rows = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x.tolist(), y.tolist())], ["features", "label"])
    packaged = LogisticRegression(regParam=0.01, fitIntercept=False, standardization=False, tol=1e-10, maxIter=200).fit(rows)
    np.testing.assert_allclose(classify.fit_lbfgs(table, f=P, l2=0.01).weights, packaged.coefficients.toArray(), atol=1e-5)


def test_lbfgs_takes_one_job_a_step(table, monkeypatch):
    seen, sums = [], classify._sums
    monkeypatch.setattr(classify, "_sums", lambda *a: seen.append(1) or sums(*a))
    fit = classify.fit_lbfgs(table, f=P, l2=0.01)
    assert len(fit.trace) < len(seen) <= len(fit.trace) + 4


def test_lbfgs_without_rows(table):
    fit = classify.fit_lbfgs(table.limit(0), f=P)
    assert not fit.trace and not fit.weights.any()
