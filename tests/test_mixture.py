"""Mixture sampling: probabilities, draws, counts and the purity report."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import mixture
from tidemark.operators.words import dictionary, words_of
from tidemark.functions.draws import log_gamma
from tidemark.plans.clusters import cluster_documents

K = 3


@pytest.fixture(scope="module")
def docs(spark):
    groups = ["red green blue", "cat dog cow", "sun moon star"]
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(rng.choice(groups[i % 3].split(), 30))) for i in range(60)]
    return spark.createDataFrame(rows + [(99, "...")], "doc_id INT, text STRING").repartition(4)


@pytest.fixture(scope="module")
def parts(docs):
    tokens = T.tokenize(F.col("text"))
    vocab = dictionary(words_of(docs, tokens))
    return vocab, mixture.count_rows(docs, tokens, vocab)


def test_every_document_is_counted(parts, docs):
    with mixture.counts_table(parts[1]) as data:
        assert data.filter("lead").count() == docs.count()
        assert data.agg(F.sum("x")).first()[0] == 60 * 30


def test_probabilities(spark, parts):
    rng = np.random.default_rng(1)
    log_mu = np.log(rng.dirichlet(np.ones(9), K))
    log_pi = np.log([0.5, 0.3, 0.2])
    mixture.check_probabilities(log_mu, log_pi)
    with mixture.counts_table(parts[1]) as data:
        rows = mixture.document_probabilities(data, mixture.log_mu_frame(spark, log_mu), list(log_pi), 9).collect()
        counts = {}
        for r in data.collect():
            counts.setdefault(r.doc_id, np.zeros(9))
            if r.pos >= 0:
                counts[r.doc_id][r.pos] = r.x
    assert len(rows) == 61
    for r in rows:
        s = log_pi + log_mu @ counts[r.doc_id]
        p = np.exp(s - s.max())
        np.testing.assert_allclose(r.probabilities, p / p.sum(), atol=1e-9)
        if r.doc_id == 99:
            np.testing.assert_allclose(r.probabilities, [0.5, 0.3, 0.2])


def test_bad_probabilities_are_caught():
    with pytest.raises(ValueError):
        mixture.check_probabilities(np.zeros((2, 3)), np.log([0.5, 0.5]))
    with pytest.raises(ValueError):
        mixture.check_probabilities(np.log(np.full((2, 2), 0.5)), np.log([1.0]))


def test_draw_follows_the_running_sum(spark):
    df = spark.createDataFrame([(u,) for u in (0.0, 0.19, 0.2, 0.49, 0.5, 0.99999)], "u DOUBLE")
    p = F.array(F.lit(0.2), F.lit(0.3), F.lit(0.5))
    got = [r[0] for r in df.orderBy("u").select(mixture.draw_class(p, 3, F.col("u"))).collect()]
    assert got == [0, 0, 1, 1, 2, 2]


def test_draw_shares(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.array(F.lit(0.2), F.lit(0.3), F.lit(0.5)).alias("probabilities"))
    sizes = {r.cluster: r.n for r in mixture.cluster_sizes(mixture.draw_labels(df, 3, 1, 5)).collect()}
    np.testing.assert_allclose([sizes[j] / 6000 for j in range(3)], [0.2, 0.3, 0.5], atol=0.03)


def test_cluster_counts_sum_to_the_corpus(parts, docs):
    labels = docs.select("doc_id", (F.col("doc_id") % K).alias("cluster"))
    table = mixture.cluster_word_counts(mixture.led_counts(parts[1]), labels)
    row = table.agg(F.sum("cnt"), F.sum("docs")).first()
    assert tuple(row) == (60 * 30, 61)


def test_sweeps_match_the_column_functions(spark, parts):
    """One sweep on arrays draws the labels and counts of the column functions; ids with many lines count once."""
    rng = np.random.default_rng(4)
    log_mu, log_pi = np.log(rng.dirichlet(np.ones(9), K)), np.log([0.5, 0.3, 0.2])
    with mixture.counts_table(parts[1]) as data:
        given = mixture.document_probabilities(data, mixture.log_mu_frame(spark, log_mu), list(log_pi), 9)
        wanted = {r.doc_id: r.cluster for r in mixture.draw_labels(given, K, 5, 11).collect()}
    with mixture.sweep_table(parts[1]) as data:
        got = {r.doc_id: r.cluster for r in mixture.sweep_labels(data, log_mu, log_pi, 5, 11).collect()}
        counts = mixture.sweep_counts(data, log_mu, log_pi, 5, 11).collect()
    assert got == wanted
    sizes = {r.cluster: r.cnt for r in counts if r.pos == mixture.NO_WORD}
    assert sizes == {c: list(wanted.values()).count(c) for c in set(wanted.values())}
    assert sum(r.cnt for r in counts if r.pos != mixture.NO_WORD) == 60 * 30


def test_one_mark_per_document(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("doc_id")
    docs = spark.range(900).select(hot, F.lit("red cat").alias("text"))
    vocab = spark.createDataFrame([("red", 0), ("cat", 1)], "word STRING, pos INT")
    counts = mixture.count_rows(docs, T.tokenize(F.col("text")), vocab, 2)
    assert counts.groupBy("doc_id").count().agg(F.max("count")).first()[0] == 3
    assert counts.filter("doc_id = -1 AND pos = 0").first().cnt == 300
    assert counts.filter("pos = -1").count() == 601


def test_sampler_finds_the_groups(docs):
    sizes, words, labels = cluster_documents(docs, T.tokenize(F.col("text")), clusters=K, sweeps=15, seed=2, check=True)
    rows = [tuple(r) for r in sizes.collect()]
    assert len(rows) == 15 * K
    assert all(sum(n for s, _, n in rows if s == sweep) == 61 for sweep in range(15))
    found = labels.filter("doc_id < 99").withColumn("group", F.col("doc_id") % 3)
    pairs = {(r.cluster, r.group) for r in found.select("cluster", "group").distinct().collect()}
    assert len({c for c, _ in pairs}) == len(pairs), "no cluster mixes two groups"
    assert words.filter("rank = 1").count() == K


def test_sampler_does_not_depend_on_partitions(docs):
    tokens = T.tokenize(F.col("text"))
    a, _, la = cluster_documents(docs.repartition(1), tokens, clusters=K, sweeps=4)
    b, _, lb = cluster_documents(docs.repartition(8), tokens, clusters=K, sweeps=4)
    assert sorted(a.collect()) == sorted(b.collect())
    assert sorted(la.collect()) == sorted(lb.collect())


def test_fixed_class_shares(docs):
    sizes, _, _ = cluster_documents(docs, T.tokenize(F.col("text")), clusters=K, sweeps=2, resample_pi=False)
    assert sizes.count() == 2 * K


def test_top_words(spark):
    weights = spark.createDataFrame([(0, 0, 1.0), (0, 1, 3.0), (0, 2, 3.0), (1, 0, 2.0)], "cluster INT, pos INT, weight DOUBLE")
    vocab = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "word STRING, pos INT")
    got = sorted((r.cluster, r["rank"], r.word) for r in mixture.top_words(weights, vocab, 2).collect())
    assert got == [(0, 1, "b"), (0, 2, "c"), (1, 1, "a")]


def test_purity(spark):
    rows = [("7", "x")] * 5 + [("7", "y")] * 3 + [("7", "z")] + [("7", "w")] + [("2", "x")] * 4 + [("5", "q")] * 2 + [("9", "q")]
    got = [tuple(r) for r in mixture.purity(spark.createDataFrame(rows, "cluster STRING, group STRING")).orderBy("cluster", "rank").collect()]
    assert got == [
        ("2", 4, 1, "x", 4, 1.0), ("5", 2, 1, "q", 2, 1.0),
        ("7", 10, 1, "x", 5, 0.5), ("7", 10, 2, "y", 3, 0.3), ("7", 10, 3, "w", 1, 0.1),
    ]


@pytest.mark.parametrize("shape", [0.1, 0.9, 1.0, 7.5, 4000.0])
def test_gamma_draws(spark, shape):
    """Mean, spread and repeatability of draws by key."""
    draw = log_gamma(F.lit(shape), F.col("id"), F.lit("x"), seed=3).alias("g")
    rows = spark.range(20000).select("id", draw)
    g = np.exp([r.g for r in rows.orderBy("id").collect()])
    np.testing.assert_allclose(g.mean(), shape, rtol=5 / (20000 * shape) ** 0.5)
    np.testing.assert_allclose(g.var(), shape, rtol=0.2 if shape < 0.5 else 0.08)
    again = spark.range(20000).repartition(7).select("id", draw)
    assert rows.exceptAll(again).count() == 0


def test_fitted_state_is_a_table(spark):
    counts = spark.createDataFrame([(0, 1, 50.0), (1, -1, 9.0)], "cluster INT, pos INT, cnt DOUBLE")
    table = mixture.drawn_state(spark, counts, 3, 2, 0.1, 0.1, 4, 7)
    assert table.count() == 2 * 4 and table.filter("drawn IS NULL").count() == 0
    log_mu, log_pi, docs = mixture._state(table.toArrow(), 3, 2)
    mixture.check_probabilities(log_mu, log_pi)
    assert docs.tolist() == [0.0, 9.0] and np.exp(log_mu[0, 1]) > 0.8 and np.exp(log_pi[1]) > 0.8
