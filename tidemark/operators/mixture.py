"""Mixture of multinomials by Gibbs sampling.

State between sweeps is the ln word probabilities (k x f) and ln class shares (k). A sweep is one job over blocks of
documents in files beside the tasks: tasks draw the labels of their documents in numpy and send a row of counts per cluster; these are
summed by cluster, the next probabilities are drawn where the sums lie, and k x f numbers reach the driver.
All draws depend on their keys and the seed alone. The column functions do the same for frames of any layout.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.draws import TRIES, log_gamma
from tidemark.functions.numeric import uniform
from tidemark.operators.blocks import Blocks, held
from tidemark.operators.scoring import dot_products
from tidemark.operators.words import DICTIONARY_SIZE, count_by, known_words
from tidemark.session import cut, keep, small_side

# Smallest word probability, so that no draw gives ln 0.
FLOOR = 1e-300
# Fixed value: how far the word probabilities of a class may be from 1 in all.
MASS_ERROR = 0.001
# The position that stands for "no dictionary word".
NO_WORD = -1


def count_rows(docs: DataFrame, tokens: Column, vocab: DataFrame, f: int = DICTIONARY_SIZE) -> DataFrame:
    """``doc_id, pos, cnt``, with one row (NO_WORD, 0) for each document, so none is lost.

    Lines that share an id are one document. Marks are counted with the words, before
    the shuffle, so an id with very many lines adds one row per task and position.
    """
    words = known_words(docs.select("doc_id", F.explode(tokens).alias("word")), vocab, f)
    seen = words.select("doc_id", "pos", F.lit(1).alias("n"))
    marks = docs.select("doc_id", F.lit(NO_WORD).alias("pos"), F.lit(0).alias("n"))
    return seen.unionByName(marks).groupBy("doc_id", "pos").agg(F.sum("n").alias("cnt"))


def led_counts(counts: DataFrame) -> DataFrame:
    """``doc_id, pos, x, lead`` with one leading row per document, grouped by document."""
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("pos")) == 1
    return counts.select("doc_id", "pos", F.col("cnt").cast("double").alias("x"), first.alias("lead"))


@contextmanager
def counts_table(counts: DataFrame) -> Iterator[DataFrame]:
    """Led counts, checkpointed and cached while sweeps read them."""
    data = keep(led_counts(cut(counts).repartition("doc_id")))
    try:
        yield data
    finally:
        data.unpersist()


@contextmanager
def sweep_table(counts: DataFrame) -> Iterator[DataFrame]:
    """``doc_id, pos, x`` with the arrays of a document (empty without a dictionary word), staged; a fit keeps them as blocks."""
    word = F.when(F.col("pos") != NO_WORD, F.struct("pos", F.col("cnt").cast("double").alias("x")))
    docs = counts.groupBy("doc_id").agg(F.sort_array(F.collect_list(word)).alias("cells"))
    yield cut(docs.select("doc_id", F.col("cells.pos").alias("pos"), F.col("cells.x").alias("x")))


#: Documents that a block holds, and words whose weights are gathered at once within a task; a document is never split.
BLOCK_ROWS = 1024
GATHERED = 1 << 13


def _scores(sizes: np.ndarray, pos: np.ndarray, x: np.ndarray, by_pos: np.ndarray) -> np.ndarray:
    """For each document and cluster: the sum of its words' values times weights. A document's weights lie together, so it is one product."""
    scores = np.zeros((len(sizes), by_pos.shape[1]))
    ends = np.cumsum(sizes, dtype=np.int64)
    pos, x = pos.astype(np.intp), x.astype(np.float64)
    space = np.empty((min(len(pos), max(GATHERED, int(sizes.max(initial=0)))), by_pos.shape[1]))
    first = 0
    while first < len(sizes):
        start = int(ends[first] - sizes[first])
        end = max(int(np.searchsorted(ends, start + GATHERED, side="right")), first + 1)
        bounds = ends[first:end].tolist()
        weights = np.take(by_pos, pos[start : bounds[-1]], axis=0, out=space[: bounds[-1] - start], mode="clip")
        at = start
        for row, stop in enumerate(bounds, first):
            np.dot(x[at:stop], weights[at - start : stop - start], out=scores[row])
            at = stop
        first = end
    return scores


def _labels(ids: list[bytes], sizes: np.ndarray, pos: np.ndarray, x: np.ndarray, by_pos: np.ndarray, log_pi: np.ndarray, sweep: int, seed: int) -> np.ndarray:
    """The drawn cluster of each document, the same as ``draw_labels`` draws: by a digest of document, sweep and seed."""
    scores = _scores(sizes, pos, x, by_pos) + log_pi
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    running = np.cumsum(raised / raised.sum(axis=1, keepdims=True), axis=1)
    end = f":{sweep}:{seed}".encode()
    digests = np.frombuffer(b"".join([hashlib.md5(i + end).digest()[:8] for i in ids]), ">u8")
    at = (digests.astype(np.uint64) >> np.uint64(12)).astype(np.float64) / 2.0**52
    return (running[:, :-1] <= at[:, None]).sum(axis=1).astype(np.int32)


def _named(ids: pa.Array) -> list[bytes]:
    return [str(i).encode() for i in ids.to_pylist()]


def _slices(batches: Iterator[pa.RecordBatch]):
    """Per ``BLOCK_ROWS`` documents: their ids, numbers of words, positions and counts."""
    for whole in batches:
        for first in range(0, whole.num_rows, BLOCK_ROWS):
            batch = whole.slice(first, BLOCK_ROWS)
            lists = batch.column("pos")
            yield batch.column("doc_id"), lists.value_lengths().to_numpy(), lists.flatten().to_numpy(), batch.column("x").flatten().to_numpy()


def _drawn(batches: Iterator[pa.RecordBatch], log_mu: np.ndarray, log_pi: np.ndarray, sweep: int, seed: int):
    """Per slice of documents: their ids, drawn clusters, and the row, position and count of each word."""
    by_pos = np.ascontiguousarray(log_mu.T)
    for ids, sizes, pos, x in _slices(batches):
        label = _labels(_named(ids), sizes, pos, x, by_pos, log_pi, sweep, seed)
        yield ids, label, np.repeat(np.arange(len(sizes)), sizes), pos, x


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents as bytes: ids and their lengths, numbers of words, positions and counts."""
    for ids, sizes, pos, x in _slices(batches):
        names = _named(ids)
        lengths = np.array([len(i) for i in names], np.int32)
        parts = b"".join(names), lengths.tobytes(), sizes.astype(np.int32).tobytes(), pos.astype(np.int32).tobytes(), x.tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in parts], ["ids", "lengths", "sizes", "pos", "x"])


def _unpacked(row: tuple) -> tuple[np.ndarray, ...]:
    """The arrays of a block; positions and counts take 16 bits where these do."""
    ids, lengths, sizes, pos, x = (np.frombuffer(part, kind) for part, kind in zip(row, (np.uint8, np.int32, np.int32, np.int32, np.float64)))
    if (pos <= 0xFFFF).all():
        pos = pos.astype(np.uint16)
    if (np.floor(np.clip(x, 0, 0xFFFF)) == x).all():
        x = x.astype(np.uint16)
    return ids, lengths, sizes, pos, x


@contextmanager
def packed(data: DataFrame) -> Iterator[Blocks]:
    """A ``sweep_table`` as blocks of documents, kept in files while sweeps read them, in a partition a core."""
    rows = data.select("doc_id", "pos", "x").mapInArrow(_pack, "ids binary, lengths binary, sizes binary, pos binary, x binary").rdd
    with held(rows.map(lambda row: _unpacked(tuple(row)))) as blocks:
        yield blocks


def drawn_logs(shape: np.ndarray, cluster: int, pos: np.ndarray, step: int, seed: int) -> np.ndarray:
    """``log_gamma`` of the shapes for the keys cluster, position and step, on arrays: the same digests and proposals."""

    def digests(n: int, at: np.ndarray) -> np.ndarray:
        joined = b"".join([hashlib.md5(f"{cluster}:{i}:{step}:{n}:{seed}".encode()).digest() for i in pos[at].tolist()])
        return np.frombuffer(joined, ">u8").reshape(-1, 2).astype(np.uint64)

    def part(whole: np.ndarray, bits: int) -> np.ndarray:
        return (whole.astype(np.float64) + 0.5) / 2.0**bits

    low = shape < 1
    d = np.where(low, shape + 1, shape) - 1.0 / 3
    log_cube = np.zeros(len(shape))
    left = np.arange(len(shape))
    for n in range(TRIES):
        high, rest = digests(n, left).T
        near = part(high >> np.uint64(12), 52)
        turn = part((high & np.uint64(0xFFF)) << np.uint64(40) | rest >> np.uint64(24), 52)
        x, u, own = np.sqrt(-2 * np.log(near)) * np.cos(6.283185307179586 * turn), np.log(part(rest & np.uint64(0xFFFFFF), 24)), d[left]
        root = 1 + x / np.sqrt(9 * own)
        cube = root * root * root
        log = np.log(np.where(cube > 0, cube, 1.0))
        taken = (cube > 0) & (u < x * x / 2 + own - own * cube + own * log)
        log_cube[left[taken]] = log[taken]
        left = left[~taken]
    drawn = np.log(d) + log_cube
    few = np.flatnonzero(low)
    drawn[few] += np.log(part(digests(TRIES, few)[:, 0] >> np.uint64(12), 52)) / shape[few]
    return drawn


def _redrawn(cluster: int, counts: np.ndarray, alpha: float, beta: float, step: int, seed: int) -> tuple[int, np.ndarray, float]:
    """A cluster, its row of ``drawn_state`` and its documents, from its counts: documents first, then words by position."""
    shape = counts + np.where(np.arange(len(counts)) == 0, float(alpha), float(beta))
    return cluster, drawn_logs(shape, cluster, np.arange(len(counts)) - 1, step, seed), float(counts[0])


def swept(blocks: Blocks | RDD, log_mu: np.ndarray, log_pi: np.ndarray, sweep: int, alpha: float, beta: float, seed: int) -> RDD:
    """One sweep and the draw after it, ``(cluster, drawn, documents)``: a row of counts per task and cluster is shuffled."""
    state = blocks.context.broadcast((log_mu, log_pi))

    def count(rows):
        mu, pi = state.value
        k, f = mu.shape
        by_pos, total = np.ascontiguousarray(mu.T), np.zeros(k * (f + 1))
        for ids, lengths, sizes, pos, x in rows:
            ends, name = np.cumsum(lengths).tolist(), ids.tobytes()
            names = [name[a:b] for a, b in zip([0, *ends], ends)]
            label = _labels(names, sizes, pos, x, by_pos, pi, sweep, seed)
            np.add.at(total, np.repeat(label.astype(np.int64) * (f + 1) + 1, sizes) + pos, x.astype(np.float64))
            np.add.at(total, label.astype(np.int64) * (f + 1), 1.0)
        return enumerate(total.reshape(k, f + 1))

    sums = blocks.mapPartitions(count).reduceByKey(lambda a, b: a + b, min(len(log_pi), blocks.context.defaultParallelism))
    return sums.map(lambda row: _redrawn(*row, alpha, beta, sweep + 1, seed))


def sweep_counts(data: DataFrame, log_mu: np.ndarray, log_pi: np.ndarray, sweep: int, seed: int) -> DataFrame:
    """``cluster, pos, cnt`` after one draw for each document of a ``sweep_table``: words by position, documents at NO_WORD."""
    state = data.sparkSession.sparkContext.broadcast((log_mu, log_pi))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mu, pi = state.value
        k, f = mu.shape
        total = np.zeros(k * (f + 1))
        for _, label, row, pos, x in _drawn(batches, mu, pi, sweep, seed):
            np.add.at(total, label[row] * (f + 1) + pos, x)
            np.add.at(total, label * (f + 1) + f, 1.0)
        used = np.flatnonzero(total)
        pos = used % (f + 1)
        columns = [(used // (f + 1)).astype(np.int32), np.where(pos == f, NO_WORD, pos).astype(np.int32), total[used]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cluster", "pos", "cnt"])

    parts = data.mapInArrow(count, "cluster int, pos int, cnt double")
    return parts.groupBy("cluster", "pos").agg(F.sum("cnt").alias("cnt"))


def sweep_labels(data: DataFrame, log_mu: np.ndarray, log_pi: np.ndarray, sweep: int, seed: int) -> DataFrame:
    """``doc_id, cluster`` of one draw."""
    state = data.sparkSession.sparkContext.broadcast((log_mu, log_pi))
    schema = data.select("doc_id", F.lit(0).alias("cluster")).schema

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, drawn, *_ in _drawn(batches, *state.value, sweep, seed):
            yield pa.RecordBatch.from_arrays([ids, pa.array(drawn)], ["doc_id", "cluster"])

    return data.mapInArrow(label, schema)


def class_probabilities(scores: list[Column]) -> list[Column]:
    """exp(s - max) / sum exp(s - max) over the classes."""
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    raised = [F.exp(s - top) for s in scores]
    total = sum(raised[1:], raised[0])
    return [r / total for r in raised]


def draw_class(probabilities: Column, k: int, at: Column) -> Column:
    """The class whose running probability first exceeds ``at`` in [0, 1)."""
    p = [F.get(probabilities, F.lit(j)) for j in range(k)]
    running, passed = p[0], F.lit(0)
    for j in range(k - 1):
        passed = passed + F.when(running <= at, 1).otherwise(0)
        running = running + p[j + 1]
    return passed


def document_probabilities(data: DataFrame, log_mu: DataFrame, log_pi: list[float], f: int) -> DataFrame:
    """``doc_id, probabilities`` of the k classes given ln word probabilities ``pos, w``."""
    k = len(log_pi)
    scored = dot_products(data, log_mu, k, f)
    scores = [F.col(f"score_{j}") + F.lit(float(log_pi[j])) for j in range(k)]
    return scored.select("doc_id", F.array(*class_probabilities(scores)).alias("probabilities"))


def draw_labels(probabilities: DataFrame, k: int, sweep: int, seed: int) -> DataFrame:
    """``doc_id, cluster``, drawn with a number fixed by document, sweep and seed."""
    at = uniform(F.col("doc_id"), F.lit(sweep), seed=seed)
    return probabilities.select("doc_id", draw_class(F.col("probabilities"), k, at).alias("cluster"))


def cluster_word_counts(data: DataFrame, labels: DataFrame) -> DataFrame:
    """``cluster, pos, cnt`` (x summed by cluster and position) and ``docs`` led by that position."""
    return (
        data.join(labels, "doc_id")
        .groupBy("cluster", "pos")
        .agg(F.sum("x").alias("cnt"), F.count(F.when(F.col("lead"), 1)).alias("docs"))
    )


def cluster_sizes(labels: DataFrame) -> DataFrame:
    """Documents per cluster."""
    return count_by(labels, "cluster")


def check_probabilities(log_mu: np.ndarray, log_pi: np.ndarray) -> None:
    """Raise unless there is one share per class and each class spreads its whole mass over the words."""
    if len(log_pi) != len(log_mu):
        raise ValueError(f"{len(log_pi)} class shares for {len(log_mu)} classes")
    off = np.abs(np.exp(log_mu).sum(axis=1) - 1)
    if off.max() > MASS_ERROR:
        raise ValueError(f"the words of class {int(off.argmax())} have a mass {off.max():.4f} away from 1")


def log_mu_frame(spark: SparkSession, log_mu: np.ndarray) -> DataFrame:
    """``pos, w`` with the k values of each position."""
    k, f = log_mu.shape
    offsets = np.arange(0, k * f + 1, k, dtype="int32")
    values = pa.ListArray.from_arrays(offsets, np.ascontiguousarray(log_mu.T).reshape(-1))
    return spark.createDataFrame(pa.table({"pos": np.arange(f, dtype="int32"), "w": values}))


def drawn_state(spark: SparkSession, counts: DataFrame | None, f: int, k: int, alpha: float, beta: float, step: int, seed: int) -> DataFrame:
    """``cluster, pos, cnt, drawn``: ln of a gamma draw for each word and, at NO_WORD, for the share of each cluster.

    The draws are of shape beta + count and alpha + documents, from the ``counts`` of a sweep (without them all are 0), and
    fixed by cluster, position, step and seed.
    """
    cell = F.col("id")
    grid = spark.range(k * (f + 1)).select(
        F.floor(cell / (f + 1)).cast("int").alias("cluster"), (cell % (f + 1) - 1).cast("int").alias("pos")
    )
    if counts is None:
        grid = grid.withColumn("cnt", F.lit(0.0))
    else:
        grid = grid.join(counts, ["cluster", "pos"], "left").withColumn("cnt", F.coalesce("cnt", F.lit(0.0)))
    shape = F.col("cnt") + F.when(F.col("pos") == NO_WORD, float(alpha)).otherwise(float(beta))
    return grid.withColumn("drawn", log_gamma(shape, F.col("cluster"), F.col("pos"), F.lit(step), seed=seed))


def _log_shares(drawn: np.ndarray) -> np.ndarray:
    """ln of the shares of draws given by their ln, along the last axis; none is below FLOOR."""
    top = drawn.max(axis=-1, keepdims=True)
    total = top + np.log(np.exp(drawn - top).sum(axis=-1, keepdims=True))
    return np.maximum(drawn - total, np.log(FLOOR))


def _state(table: pa.Table, f: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ln word probabilities, ln class shares and documents per cluster."""
    cluster, pos, cnt, drawn = (table[c].to_numpy() for c in ("cluster", "pos", "cnt", "drawn"))
    grid, docs = np.empty((k, f + 1)), np.zeros(k)
    grid[cluster, pos + 1] = drawn
    docs[cluster[pos == NO_WORD]] = cnt[pos == NO_WORD]
    return _log_shares(grid[:, 1:]), _log_shares(grid[:, 0]), docs


def _gathered(rows: list[tuple[int, np.ndarray, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``_state``, from one row per cluster."""
    _, drawn, docs = zip(*sorted(rows, key=lambda row: row[0]))
    grid = np.stack(drawn)
    return _log_shares(grid[:, 1:]), _log_shares(grid[:, 0]), np.array(docs)


@dataclass
class Mixture:
    """The last draw: ln word probabilities, ln class shares, and cluster counts per sweep."""

    log_mu: np.ndarray
    log_pi: np.ndarray
    sizes: list[np.ndarray]


def fit_mixture(
    data: DataFrame,
    f: int,
    k: int = 20,
    alpha: float = 0.1,
    beta: float = 0.1,
    sweeps: int = 200,
    seed: int = 7,
    resample_pi: bool = True,
    check: bool = False,
) -> tuple[Mixture, DataFrame]:
    """Run the sweeps over a ``sweep_table``; returns the state and the last labels (lazy).

    ``f`` is the number of dictionary words. The driver holds k x f numbers, and every draw depends on its keys and
    the seed only. With ``resample_pi`` off the class shares keep their first draw.
    """
    context = data.sparkSession.sparkContext

    def unseen(step: int) -> RDD:
        """The draws without a document."""
        return context.parallelize(range(k), k).map(lambda j: _redrawn(j, np.zeros(f + 1), alpha, beta, step, seed))

    log_mu, log_pi, _ = _gathered(unseen(0).collect())
    labels, sizes = None, []
    with packed(data) as blocks:
        for sweep in range(sweeps):
            if check:
                check_probabilities(log_mu, log_pi)
            if sweep + 1 == sweeps:
                labels = sweep_labels(data, log_mu, log_pi, sweep, seed)
            if blocks.getNumPartitions():
                rows = blocks.run(lambda b: swept(b, log_mu, log_pi, sweep, alpha, beta, seed).collect())
            else:
                rows = unseen(sweep + 1).collect()
            log_mu, drawn_pi, docs = _gathered(rows)
            sizes.append(docs)
            if resample_pi:
                log_pi = drawn_pi
    return Mixture(log_mu, log_pi, sizes), labels


def top_words(weights: DataFrame, vocab: DataFrame, k: int = 100, by: str = "weight") -> DataFrame:
    """``cluster, rank, word, weight``: the k heaviest words of each cluster.

    ``weights`` holds cluster, pos and the weight; equal weights go by position.
    """
    rank = F.row_number().over(Window.partitionBy("cluster").orderBy(F.col(by).desc(), "pos"))
    best = weights.withColumn("rank", rank).filter(F.col("rank") <= k)
    return best.join(vocab.select("pos", "word"), "pos").select("cluster", "rank", "word", by)


def purity(clusters: DataFrame, biggest: int = 3, groups: int = 3) -> DataFrame:
    """``cluster, size, rank, group, n, share``: the main true groups of the biggest clusters.

    ``clusters`` holds cluster and group. Rows are counted before any ranking, so a
    big cluster costs no more than a small one.
    """
    pairs = count_by(clusters, "cluster", "group")
    sizes = pairs.groupBy("cluster").agg(F.sum("n").alias("size"))
    top = sizes.orderBy(F.col("size").desc(), "cluster").limit(biggest)
    rank = F.row_number().over(Window.partitionBy("cluster").orderBy(F.col("n").desc(), "group"))
    ranked = pairs.join(small_side(top, biggest), "cluster").withColumn("rank", rank)
    return ranked.filter(F.col("rank") <= groups).select(
        "cluster", "size", "rank", "group", "n", (F.col("n") / F.col("size")).alias("share")
    )
