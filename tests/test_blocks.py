"""Blocks of a fit lie in files beside the tasks: steps read these, Spark keeps their paths alone."""

import os

import numpy as np
import pytest

from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import blocks as B
from tidemark.operators import classify, mixture, words
from tidemark.plans.clusters import cluster_documents


def arrays(spark, parts=5):
    return spark.sparkContext.parallelize(range(40), parts).map(lambda i: (np.full(1000, i, np.int64), np.arange(i, dtype=np.float32)))


def total(blocks):
    return sum(blocks.mapPartitions(lambda rows: [sum(int(a.sum()) + int(b.sum()) for a, b in rows)]).collect())


WANTED = sum(1000 * i + i * (i - 1) // 2 for i in range(40))


def test_spark_keeps_paths_and_no_file_stays(spark):
    before = {i.id() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()}
    with B.held(arrays(spark)) as blocks:
        assert blocks.getNumPartitions() <= spark.sparkContext.defaultParallelism
        paths = [path for path, _ in blocks.files.collect()]
        assert len(paths) == 5 and all(map(os.path.exists, paths))
        for _ in range(2):
            assert blocks.run(total) == WANTED
        kept = [i.memSize() + i.diskSize() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo() if i.id() not in before]
        assert 0 < sum(kept) < 40 * 1000
    assert not any(map(os.path.exists, paths))


def test_a_step_reads_the_source_where_files_are_out_of_reach(spark):
    with B.held(arrays(spark)) as blocks:
        for path, _ in blocks.files.take(2):
            os.remove(path)
        assert blocks.run(total) == WANTED
        with pytest.raises(Exception, match="division"):
            blocks.run(lambda b: b.source.mapPartitions(lambda rows: [1 // 0 for _ in rows]).collect())


def test_exact_sums_of_narrow_and_wide_blocks(spark, monkeypatch):
    """Empty documents, positions beyond 16 bits and values beyond 32 bits give the whole numbers of plain loops."""
    wide = [(0, [1, 70_000], [0.25, -0.125]), (1, [], []), (1, [0, 1], [6.5, 1e-3]), (0, [2], [-2.5]), (1, [1], [0.1 + 2.0**-31])]
    rows = [(i, *wide[i % 5]) for i in range(50)]
    table = spark.createDataFrame(rows, "doc_id INT, label INT, pos ARRAY<INT>, x ARRAY<DOUBLE>").repartition(3)
    w = np.linspace(-1, 1, 70_001)
    up = lambda v: int(np.floor(v + 0.5))
    cost, gradient = 0, {}
    for _, label, pos, x in rows:
        cells = [(p, float(up(v * 2**30))) for p, v in zip(pos, x)]
        theta = sum(up(v * w[p]) for p, v in cells) / 2**30
        cost += up((max(theta, 0) + np.log1p(np.exp(-abs(theta))) - label * theta) * 2**24)
        slope = up(((1 if theta >= 0 else np.exp(theta)) / (1 + np.exp(-abs(theta))) - label) * 2**24) / 2**24
        for p, v in cells:
            gradient[p] = gradient.get(p, 0) + up(v * slope)
    for words in (1, 3, 1 << 16):
        monkeypatch.setattr(classify, "BLOCK_WORDS", words)
        got = classify._exact_sums(table, w, classify.LOGISTIC)
        assert got[0] == cost / 2**24 and {p: got[1][p] * 2**30 for p in gradient} == gradient
        assert np.count_nonzero(got[1]) <= len(gradient)


def test_narrow_blocks_take_six_bytes_a_word():
    pos, x = np.arange(100, dtype=np.int32), np.linspace(0, 1, 100)
    _, _, near, units = classify._narrow((pos, pos, pos, x), True)
    assert near.dtype == np.uint16 and units.dtype == np.int32 and np.abs(units / 2**30 - x).max() <= 2.0**-31
    assert classify._narrow((pos, pos, pos + 65_500, x * 4), True)[2].dtype == np.int32
    assert classify._narrow((pos, pos, pos, x * 4), True)[3].dtype == np.float64
    assert classify._narrow((pos, pos, pos, x), False)[3] is x


def test_sweeps_read_narrow_blocks(spark):
    """Documents without a word, counts beyond 16 bits, and ids that are null or text draw as ``sweep_counts`` does."""
    cells = [(None, [0, 3], [1.0, 70_000.0]), ("", [], []), ("é1", [1, 2, 4], [3.0, 1.0, 2.0]), ("b", [4], [0.5])]
    rows = spark.createDataFrame([(i if i is None else f"{i}{n}" if n else i, p, x) for n in range(30) for i, p, x in cells], "doc_id STRING, pos ARRAY<INT>, x ARRAY<DOUBLE>")
    rng = np.random.default_rng(3)
    log_mu, log_pi = np.log(rng.dirichlet(np.full(5, 30.0), 3)), np.log([0.5, 0.3, 0.2])
    wanted = mixture.drawn_state(spark, mixture.sweep_counts(rows, log_mu, log_pi, 2, 7), 5, 3, 0.1, 0.1, 3, 7)
    with mixture.packed(rows.repartition(4)) as blocks:
        got = mixture._gathered(mixture.swept(blocks, log_mu, log_pi, 2, 0.1, 0.1, 7).collect())
        for path, _ in blocks.files.take(1):
            os.remove(path)
        again = mixture._gathered(blocks.run(lambda b: mixture.swept(b, log_mu, log_pi, 2, 0.1, 0.1, 7).collect()))
    for a, b, c in zip(got, mixture._state(wanted.toArrow(), 5, 3), again):
        np.testing.assert_allclose(a, b, rtol=1e-9)
        np.testing.assert_allclose(a, c, rtol=1e-9)
    assert got[2].sum() == 120


def test_scores_are_sums_of_weights(monkeypatch):
    rng = np.random.default_rng(5)
    sizes = np.array([0, 3, 0, 40, 1, 7, 0], np.int32)
    pos, x, by_pos = rng.integers(0, 9, 51).astype(np.uint16), rng.integers(1, 5, 51).astype(np.uint16), rng.normal(size=(9, 4))
    ends = np.cumsum(sizes)
    wanted = [(x[b - n : b, None] * by_pos[pos[b - n : b]]).sum(axis=0) for n, b in zip(sizes, ends)]
    for words_at_once in (1, 8, 1 << 13):
        monkeypatch.setattr(mixture, "GATHERED", words_at_once)
        np.testing.assert_allclose(mixture._scores(sizes, pos, x, by_pos), wanted, atol=1e-12)


def test_clusters_of_words_counted_by_letters(spark):
    texts = ["red green Blue", "cat dog cow cat", None, "12 ...", "sun moon star", "Red cat"]
    docs = spark.createDataFrame([(None if i == 7 else i % 50, t) for i, t in enumerate(texts * 20)], "doc_id INT, text STRING").repartition(3)
    tokens = T.tokenize(F.col("text"))
    vocab = words.dictionary(words.words_of(docs, tokens), 6)
    wanted = mixture.count_rows(docs, tokens, vocab, 6)
    for bound in (words.BROADCAST_BYTES, 0):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(words, "BROADCAST_BYTES", bound)
            got = words.letter_term_counts(docs, vocab, 6, mark=mixture.NO_WORD).groupBy("doc_id", "pos").agg(F.sum("cnt").alias("cnt"))
            assert got.count() == wanted.count() and not got.exceptAll(wanted).count()
    found = [cluster_documents(docs, t, clusters=3, sweeps=3, f=6) for t in (None, tokens)]
    for a, b in zip(*found):
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
