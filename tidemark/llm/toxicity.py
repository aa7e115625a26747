"""Toxicity by a small convolutional text classifier over hashed word embeddings."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from copy import deepcopy
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, Plain, Spans, blocks, mix, released, row_of, word_bounds
from tidemark.session import small_side

#: Letters, digits and all bytes beyond ASCII make words here.
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: A word counts as the sum of the embeddings of itself and of its first bytes.
HEADS = (4, 6)
SALTS = np.array([0xA24BAED4963EE407, 0x9FB21C651E98DF25], dtype=np.uint64)
#: Shards that learn side by side at most, and slices in which their moves are added up.
SHARDS = 64
SLICES = 16
#: Bytes of a broadcast key.
ROW_BYTES = 64
#: Words of the texts of a step, about; a text is never split.
STEP_WORDS = 1 << 17
#: Moves are summed in whole numbers of 2^-30, so that no order of the shards shows; log odds are counted in bins of 2^-10.
UNIT = 2.0**30
BIN = 2.0**10


@dataclass
class Settings:
    """Bounds of ``sample``, shape of the network and its training; ``sample_bytes`` is also what a task may hold of packed texts."""

    toxic_docs: int = 2500
    other_docs: int = 4500
    sample_bytes: int = 64 << 20
    bits: int = 18
    width: int = 8
    filters: int = 8
    spans: tuple[int, ...] = (1, 2, 3)
    epochs: int = 6
    least_steps: int = 1000
    batch: int = 32
    rate: float = 0.05
    shrink: float = 1e-4
    seed: int = 7


def word_ids(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word of a block and of its heads (rows x 3), and the number of each text's first word."""
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets, LETTER)
    spans = Spans(data)
    ids = [spans(starts, ends)]
    # mixed again, so that a word and its heads of the same bytes have buckets of their own
    ids += [mix(spans(starts, np.minimum(ends, starts + head)) ^ SALTS[k]) for k, head in enumerate(HEADS)]
    return (np.stack(ids, axis=1) >> np.uint64(64 - bits)).astype(np.int32), first


@dataclass
class Network:
    """Embeddings, filters and the weights of the maxima; ``logit`` gives a text's log odds of toxicity."""

    settings: Settings
    table: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    weights: np.ndarray
    offset: float = 0.0
    scale: float = 1.0
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    @classmethod
    def fresh(cls, settings: Settings) -> Network:
        draw = np.random.default_rng(settings.seed)
        normal = lambda *shape: draw.normal(0, 0.3, shape).astype(np.float32)
        return cls(
            settings,
            normal(1 << settings.bits, settings.width) * np.float32(0.3),
            [normal(k, settings.width, settings.filters) for k in settings.spans],
            [np.zeros(settings.filters, np.float32) for _ in settings.spans],
            normal(len(settings.spans) * settings.filters),
        )

    @property
    def _blanks(self) -> int:
        """Rows of zeros after each text, as many as the widest filter, so that none that starts by its first blank spans two texts."""
        return max(self.settings.spans)

    def _spread(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words' vectors with blank rows after each text, and the starts and ends of the places where filters count."""
        n = np.diff(first)
        starts = first[:-1] + self._blanks * np.arange(len(n))
        x = np.zeros((len(ids) + self._blanks * len(n) + self._blanks, self.settings.width), np.float32)
        x[np.arange(len(ids)) + self._blanks * row_of(first)] = self.table[ids[:, 0]] + self.table[ids[:, 1]] + self.table[ids[:, 2]]
        return x, starts, starts + n + 1

    def _maps(self, x: np.ndarray) -> Iterator[np.ndarray]:
        rows = len(x) - self._blanks
        for filters, bias in zip(self.filters, self.bias):
            out = x[:rows] @ filters[0]
            for k in range(1, len(filters)):
                out += x[k : k + rows] @ filters[k]
            yield out + bias

    def logit(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        x, starts, ends = self._spread(ids, first)
        if not len(starts):
            return np.empty(0)
        bounds = np.stack([starts, ends], axis=1).ravel()
        best = [np.maximum(np.maximum.reduceat(out, bounds, axis=0)[::2], 0) for out in self._maps(x)]
        # row by row, so that a text's score does not depend on those beside it
        return (np.concatenate(best, axis=1).astype(np.float64) * self.weights).sum(axis=1) * self.scale + self.offset

    def score(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(ids, first), -40, 40)))

    def step(self, texts: list[np.ndarray], labels: np.ndarray, memory: dict[str, np.ndarray], seen: np.ndarray) -> None:
        """One step of adaptive gradient descent; only the words at the maxima get a gradient."""
        s = self.settings
        ids = np.concatenate(texts)
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        x, starts, ends = self._spread(ids, first)
        tops, places = [], []
        for out in self._maps(x):
            where = np.stack([a + out[a:b].argmax(axis=0) for a, b in zip(starts, ends)])
            places.append(where)
            tops.append(np.take_along_axis(out, where, axis=0))
        hidden = np.maximum(np.concatenate(tops, axis=1), 0)
        chance = 1 / (1 + np.exp(-np.clip(hidden @ self.weights + self.offset, -40, 40)))
        error = ((chance - labels) / len(labels)).astype(np.float32)
        back = error[:, None] * self.weights * (hidden > 0)
        owner = np.full(len(x), -1)
        owner[np.arange(len(ids)) + self._blanks * row_of(first)] = np.arange(len(ids))
        rows, moves = [], []
        for k, (filters, where) in enumerate(zip(self.filters, places)):
            part = back[:, k * s.filters : (k + 1) * s.filters]
            change = np.zeros_like(filters)
            for j in range(len(filters)):
                at = where + j
                change[j] = np.einsum("df,dfw->wf", part, x[at])
                word = owner[at]
                real = word >= 0
                rows.append(word[real])
                moves.append((part[:, :, None] * filters[j].T[None])[real])
            self._move(f"f{k}", filters, change + s.shrink * filters, memory)
            self._move(f"b{k}", self.bias[k], part.sum(axis=0), memory)
        self._move("w", self.weights, hidden.T @ error + s.shrink * self.weights, memory)
        self.offset -= s.rate * float(error.sum())
        buckets = ids[np.concatenate(rows)].ravel()
        moves = np.repeat(np.concatenate(moves), ids.shape[1], axis=0)
        used, back_to = np.unique(buckets, return_inverse=True)
        total = np.zeros((len(used), s.width), np.float32)
        np.add.at(total, back_to, moves)
        total += s.shrink * self.table[used]
        memory["table"][used] += (total * total).sum(axis=1)
        self.table[used] -= s.rate * total / np.sqrt(memory["table"][used] + 1e-6)[:, None]
        seen[used] = True

    def memory(self) -> dict[str, np.ndarray]:
        """Sums of squared gradients before the first step."""
        named = [("w", self.weights), *((f"f{k}", v) for k, v in enumerate(self.filters)), *((f"b{k}", v) for k, v in enumerate(self.bias))]
        return {"table": np.zeros(len(self.table), np.float32), **{name: np.full(v.shape, 1e-6, np.float32) for name, v in named}}

    def dense(self, memory: dict[str, np.ndarray]) -> list[np.ndarray]:
        """What every step moves, but for the offset."""
        return [self.weights, *self.filters, *self.bias, *(memory[name] for name in sorted(memory) if name != "table")]

    def constant(self, share: float) -> Network:
        """Every text gets the share of toxic rows."""
        self.table[:] = 0
        self.weights[:] = 0
        self.offset = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return self

    def _move(self, name: str, values: np.ndarray, change: np.ndarray, memory: dict[str, np.ndarray]) -> None:
        sums = memory.setdefault(name, np.full(values.shape, 1e-6, np.float32))
        sums += change * change
        values -= (self.settings.rate * change / np.sqrt(sums)).astype(np.float32)


def fit(texts: list[np.ndarray], labels: np.ndarray, langs: list[str | None], toxic_share: float, settings: Settings) -> Network:
    """Train on four fifths of the given texts; calibrate log odds and the thresholds by language on the rest. ``train`` does so over a table.

    ``toxic_share`` is the share of toxic rows among all labelled ones, to undo that the sample holds more of them.
    Buckets that no gradient reached become zero: an unknown word says nothing.
    """
    net = Network.fresh(settings)
    labels = labels.astype(np.float32)
    if len(set(labels.tolist())) < 2:
        return net.constant(toxic_share)
    draw = np.random.default_rng(settings.seed)
    order = draw.permutation(len(texts))
    held, train = order[: max(1, len(order) // 5)], order[max(1, len(order) // 5) :]
    memory: dict[str, np.ndarray] = {"table": np.zeros(len(net.table), np.float32)}
    seen = np.zeros(len(net.table), dtype=bool)
    # a small table is gone through more often
    for _ in range(max(settings.epochs, -(-settings.least_steps * settings.batch // max(1, len(train))))):
        draw.shuffle(train)
        for a in range(0, len(train), settings.batch):
            part = train[a : a + settings.batch]
            net.step([texts[i] for i in part], labels[part], memory, seen)
    net.table[~seen] = 0
    # each held-out row stands for the rows of its class in the whole table
    raw = np.concatenate([net.logit(texts[i], np.array([0, len(texts[i])])) for i in held])
    y = labels[held].astype(np.float64)
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    toxic_share = min(max(toxic_share, 1e-3), 1 - 1e-3)
    weight = np.where(y > 0, toxic_share / share, (1 - toxic_share) / (1 - share))
    scale, offset = _logistic(raw, y, weight)
    net.offset = net.offset * scale + offset
    net.scale = scale
    chance = 1 / (1 + np.exp(-np.clip(raw * scale + offset, -40, 40)))
    net.threshold = _best_threshold(chance, y, weight)
    known = np.array([lang or "" for lang in (langs[i] for i in held)])
    for lang in sorted(set(known.tolist()) - {""}):
        own = known == lang
        if y[own].sum() >= 10:
            net.thresholds[lang] = _best_threshold(chance[own], y[own], weight[own])
    return net


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a weighted logistic regression on one number, by Newton's method."""
    slope, offset = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -40, 40)))
        g = np.array([(weight * (p - y) * x).sum() + 0.5 * (slope - 1), (weight * (p - y)).sum()])
        v = weight * p * (1 - p) + 1e-6
        h = np.array([[(v * x * x).sum() + 0.5, (v * x).sum()], [(v * x).sum(), v.sum()]])
        move = np.clip(np.linalg.solve(h, g), -1, 1)
        slope, offset = slope - move[0], offset - move[1]
    return float(max(slope, 0.05)), float(offset)


def _best_threshold(chance: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The score above which F1 is best, half way to the next lower score; at least 0.5, at most 0.9."""
    order = np.argsort(-chance, kind="stable")
    c, w, t = chance[order], weight[order], (y * weight)[order]
    hit, called = np.cumsum(t), np.cumsum(w)
    k = int(np.argmax(2 * hit / (called + t.sum())))
    below = c[k + 1] if k + 1 < len(c) else 0.0
    return float(np.clip((c[k] + below) / 2, 0.5, 0.9))


def held_out(key: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """Whether the remainder of the key's CRC-32 is that of the fold; a null key counts as empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(key).cast("string"), F.lit("")), "UTF-8")) % folds == fold


def _known(labels: DataFrame, key: str, label: str) -> DataFrame:
    """``k, label`` of the labelled keys of the training folds; a key with several labels counts as toxic if one says so."""
    return (
        labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
        .select(F.col(key).alias("k"), F.col(label).cast("int").alias("label"))
        .filter(~held_out("k"))
        .groupBy("k")
        .agg(F.max("label").alias("label"))
    )


def _share(known: DataFrame) -> tuple[int, int]:
    """Labelled keys, and toxic ones."""
    counts = known.agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).first()
    return counts["n"], counts["toxic"] or 0


def _texts(docs: DataFrame, key: str) -> DataFrame:
    return docs.select(F.col(key).alias("k"), F.coalesce("text", F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))


def sample(docs: DataFrame, labels: DataFrame, settings: Settings, key: str = "doc_id", label: str = "toxic") -> tuple[DataFrame, float]:
    """A bounded trial set (text, lang, label) for ``fit`` and the share of toxic rows among all labelled rows of the training folds.

    ``train`` does not use it: it learns from all labelled rows.
    Labels of the held-out fold are never read. A key with several labels counts as toxic if one says so, a key with several rows
    gives the text of least hash. The sample takes the first keys by a hash, at most the settings' numbers of both classes and as many
    whole texts as ``sample_bytes`` holds, those of more than a sixteenth of that last; the ids are a LIMIT, so broadcasting them is bounded.
    """
    known = _known(labels, key, label)
    n, n_toxic = _share(known)
    by_hash = [F.xxhash64("k", F.lit(settings.seed)), F.col("k")]
    toxic = known.filter("label = 1").orderBy(*by_hash).limit(settings.toxic_docs)
    other = known.filter("label = 0").orderBy(*by_hash).limit(settings.other_docs)
    found = _texts(docs, key).join(F.broadcast(toxic.union(other)), "k").groupBy("k", "label").agg(
        F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "lang")).alias("row")
    )
    found = found.select("k", "label", "row.text", "row.lang")
    size = F.octet_length("text").cast("long")
    running = F.sum(size).over(Window.orderBy(size > settings.sample_bytes // 16, *by_hash))  # one row per key of the bounded sample
    found = found.withColumn("running", running).filter(F.col("running") <= settings.sample_bytes).drop("running", "k")
    return found, n_toxic / max(1, n)


def _pack(bits: int):
    """Blocks of labelled texts, those that calibrate apart: labels, languages, numbers of words, and the words' buckets, compressed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, calibrates = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "calibrates"))
            for start, data, offsets in blocks(batch, "text", 1 << 20):
                ids, first = word_ids(data, offsets, bits)
                sizes = np.diff(first)
                own = slice(start, start + len(sizes))
                for side in (False, True):
                    rows = np.flatnonzero(calibrates[own] == side)
                    if not len(rows):
                        continue
                    words = ids[np.repeat(calibrates[own] == side, sizes)]
                    cells = [
                        [side],
                        [label[own][rows].astype(np.int8).tobytes()],
                        [batch.column("lang").slice(start, len(sizes)).take(pa.array(rows)).to_pylist()],
                        [sizes[rows].astype(np.int32).tobytes()],
                        [pa.compress(words.tobytes(), codec="zstd", asbytes=True)],
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, PACKED.types)], schema=PACKED)

    return lambda batches: released(pack(batches))


PACKED = pa.schema([("calibrates", pa.bool_()), ("label", pa.binary()), ("lang", pa.list_(pa.string())), ("sizes", pa.binary()), ("words", pa.binary())])


@contextmanager
def _dealt(docs: DataFrame, known: DataFrame, n: int, shards: int, settings: Settings, key: str) -> Iterator[RDD]:
    """All labelled texts as blocks, a partition per shard, cached while they are learned from.

    A hash of the key deals the rows, orders them and sets a fifth of them apart to calibrate, so the same tables give the same
    blocks for any partitioning of ``docs``. A key with several rows gives the text of least hash. The ``n`` known keys meet
    the texts by that hash of 64 bits, broadcast within the broadcast bound.
    """
    mixed = F.xxhash64("k", F.lit(settings.seed))
    # of the same type, or equal keys would hash apart
    known = known.withColumn("k", F.col("k").cast(docs.select(key).schema[0].dataType)).withColumn("mixed", mixed)
    rows = _texts(docs, key).filter(F.col("k").isNotNull() & ~held_out("k")).withColumn("mixed", mixed)
    rows = rows.join(small_side(known.select("mixed", "label"), n, ROW_BYTES), "mixed").repartition(shards, "mixed", "k")
    place = F.row_number().over(Window.partitionBy("mixed", "k").orderBy(F.xxhash64("text"), "text", "lang"))
    calibrates = (F.pmod("mixed", F.lit(5)) == 0).alias("calibrates")
    rows = rows.withColumn("place", place).filter("place = 1").select("label", "lang", calibrates, "text")
    schema = "calibrates boolean, label binary, lang array<string>, sizes binary, words binary"
    packed = rows.mapInArrow(_pack(settings.bits), schema).rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield packed
    finally:
        packed.unpersist()


def _unpack(block: tuple) -> tuple[np.ndarray, list, np.ndarray, np.ndarray]:
    """Labels, languages, the words' buckets and the number of each text's first word."""
    _, label, lang, sizes, words = block
    first = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, np.int32), dtype=np.int64)])
    ids = np.frombuffer(pa.decompress(words, 12 * int(first[-1]), "zstd", asbytes=True), np.int32).reshape(-1, 1 + len(HEADS))
    return np.frombuffer(label, np.int8), lang, ids, first


def _joined(parts: list[tuple]) -> list[tuple]:
    """Blocks as one, so that all their texts are shuffled together."""
    label, ids, first = zip(*parts) if parts else ([], [], [])
    sizes = [np.diff(f) for f in first]
    return [(np.concatenate(label), np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(sizes))]))] if parts else []


def _learn(rows: Iterator[tuple], net: Network, memory: dict[str, np.ndarray], passes: int, seed: list[int]) -> Iterator[tuple]:
    """The moves of one shard that goes ``passes`` times through its blocks: by slice, places, sums of moves and how many shards moved them.

    Slice -1 holds what every step moves.
    """
    start, kept = net, memory
    net, memory = deepcopy(net), deepcopy(memory)
    s, draw, seen = net.settings, np.random.default_rng(seed), np.zeros(len(net.table), dtype=bool)
    texts = ((label, ids, first) for label, _, ids, first in (_unpack(row) for row in rows if not row[0]))
    n = 0
    for part in [texts] if passes == 1 else [_joined(list(texts))] * passes:
        for label, ids, first in part:
            order, a = draw.permutation(len(label)), 0
            ends = np.cumsum(np.diff(first)[order])
            while a < len(order):
                room = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + STEP_WORDS, side="right"))
                b = max(a + 1, min(room, a + s.batch))
                net.step([ids[first[i] : first[i + 1]] for i in order[a:b]], label[order[a:b]].astype(np.float32), memory, seen)
                a = b
            n += len(label)
    if not n:
        return
    whole = lambda v: np.rint(np.asarray(v, np.float64) * UNIT).astype(np.int64)
    moves = [new.ravel().astype(np.float64) - old.ravel() for new, old in zip(net.dense(memory), start.dense(kept))]
    yield -1, (np.zeros(1, np.int64), whole(np.concatenate([*moves, [net.offset - start.offset]]))[None], np.ones(1, np.int64))
    used = np.flatnonzero(seen)
    moves = np.column_stack([net.table[used].astype(np.float64) - start.table[used], memory["table"][used].astype(np.float64) - kept["table"][used]])
    cuts = np.searchsorted(used, np.arange(SLICES + 1) * -(-len(seen) // SLICES))
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if a < b:
            yield k, (used[a:b], whole(moves[a:b]), np.ones(b - a, np.int64))


def _plus(a: tuple, b: tuple) -> tuple:
    """Moves of the places of two sets of shards, added up."""
    places, at = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    out = places, np.zeros((len(places), a[1].shape[1]), np.int64), np.zeros(len(places), np.int64)
    for part, own in ((a, at[: len(a[0])]), (b, at[len(a[0]) :])):
        out[1][own] += part[1]
        out[2][own] += part[2]
    return out


def _round(packed: RDD, net: Network, memory: dict[str, np.ndarray], passes: int, turn: int) -> np.ndarray:
    """All shards learn from the same network, which then moves by the mean over the shards that moved a place; the buckets that moved."""
    model = packed.context.broadcast((net, memory))
    seed = net.settings.seed
    learn = lambda shard, rows: _learn(rows, *model.value, passes, [seed, turn, shard])
    found = packed.mapPartitionsWithIndex(learn).reduceByKey(_plus, min(SLICES, packed.getNumPartitions())).collect()
    model.unpersist()
    used = [np.empty(0, np.int64)]
    for k, (places, sums, shards) in found:
        moves = sums / UNIT / shards[:, None]
        if k >= 0:
            net.table[places] += moves[:, :-1].astype(np.float32)
            memory["table"][places] += moves[:, -1].astype(np.float32)
            used.append(places)
            continue
        a = 0
        for values in net.dense(memory):
            values += moves[0, a : a + values.size].reshape(values.shape).astype(np.float32)
            a += values.size
        net.offset += float(moves[0, a])
    return np.concatenate(used)


def _binned(rows: Iterator[tuple], net: Network) -> Iterator[tuple]:
    """Language, bin of the log odds, rows and toxic rows of the texts of a shard that calibrate, block by block."""
    for block in rows:
        if block[0]:
            label, langs, ids, first = _unpack(block)
            bins = np.rint(np.clip(net.logit(ids, first), -40, 40) * BIN).astype(np.int64)
            yield from zip(langs, bins.tolist(), [1] * len(bins), label.tolist())


def _calibrate(packed: RDD, net: Network, docs: DataFrame) -> None:
    """Scale and offset of the log odds, and the thresholds, from all rows set apart; without rows of both classes they stay.

    What meets here is a row per bin, and a row per language; those of a language meet in a task, one row per bin.
    """
    spark = docs.sparkSession
    model = packed.context.broadcast(net)
    rows = spark.createDataFrame(packed.mapPartitions(lambda part: _binned(part, model.value)), "lang string, bin long, n long, toxic long")
    bins = rows.groupBy("lang", "bin").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        whole = bins.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).orderBy("bin").toArrow()
        raw, n, toxic = (whole[c].to_numpy().astype(np.float64) for c in ("bin", "n", "toxic"))
        if not 0 < toxic.sum() < n.sum():
            return
        scale, offset = _logistic(raw / BIN, toxic / n, n)

        def best(bin: np.ndarray, n: np.ndarray, toxic: np.ndarray) -> float:
            chance = 1 / (1 + np.exp(-np.clip(bin / BIN * scale + offset, -40, 40)))
            return _best_threshold(chance, toxic / n, n)

        def by_language(part: pa.Table) -> pa.Table:
            part = part.sort_by("bin")
            values = [part[c].to_numpy().astype(np.float64) for c in ("bin", "n", "toxic")]
            found = pa.table({"lang": part["lang"][:1], "threshold": pa.array([best(*values)])})
            return found if values[2].sum() >= 10 else found[:0]

        known = bins.filter("lang <> ''").groupBy("lang").applyInArrow(by_language, "lang string, threshold double")
        net.thresholds = {row["lang"]: row["threshold"] for row in sorted(known.collect())}
        net.threshold = best(raw, n, toxic)
        net.scale, net.offset = scale, net.offset * scale + offset
    finally:
        bins.unpersist()
        model.unpersist()


def train(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, key: str = "doc_id", label: str = "toxic") -> Network:
    """Fit a network to all labelled rows of the training folds; without rows of both classes it gives every text the share of toxic rows.

    The rows are dealt into shards, as many as have rows for ``least_steps`` steps each, at most ``SHARDS``. In each of ``epochs`` rounds
    every shard goes once through its rows, from the network of the round before, and the network moves by the mean of the shards' moves; a
    bucket by the mean over the shards that moved it. A single shard of few rows goes through them more often, in one round. A fifth of the
    rows calibrates log odds and thresholds. A round is one job; at most ``SHARDS`` networks are shuffled, and one comes to the driver.
    """
    settings = settings or Settings()
    net = Network.fresh(settings)
    known = _known(labels, key, label)
    n, toxic = _share(known)
    least = settings.least_steps * settings.batch
    with _dealt(docs, known, n, min(SHARDS, max(1, n * settings.epochs // max(1, least))), settings, key) as packed:
        # rows, toxic rows, rows to learn from, packed bytes
        told = packed.map(lambda b: np.array([len(b[1]), sum(b[1]), 0 if b[0] else len(b[1]), len(b[4])])).fold(np.zeros(4, np.int64), np.add)
        if not 0 < told[1] < told[0]:
            return net.constant(toxic / max(1, n))
        memory, seen = net.memory(), np.zeros(len(net.table), dtype=bool)
        turns, passes = settings.epochs, 1
        if packed.getNumPartitions() == 1:
            turns = max(turns, -(-least // max(1, int(told[2]))))
            if told[3] <= settings.sample_bytes:
                turns, passes = 1, turns
        for turn in range(turns):
            seen[_round(packed, net, memory, passes, turn)] = True
        # an unknown word says nothing
        net.table[~seen] = 0
        _calibrate(packed, net, docs)
    return net


def score_texts(docs: DataFrame, net: Network, text: str = "text", lang: str = "lang") -> DataFrame:
    """All columns of ``docs``, then score (0 to 1), threshold (of the row's language) and rejected (score >= threshold).

    The score depends on the text alone; null and empty texts get that of a text without words. A language without
    a threshold of its own, or a null one, gets the general one. Repeated rows score alike; no shuffle. A
    column named like a result gives way to it.
    """
    plain = Plain(docs, "score", "threshold", "rejected")
    docs, text, lang = plain.rows, plain.of(text), plain.of(lang)
    model = docs.sparkSession.sparkContext.broadcast(net)
    schema = docs.select("*", F.lit(0.0).alias("score")).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # block by block: beside the batch only a block is on its way back
            for start, data, offsets in blocks(batch, text, 1 << 20):
                scores = model.value.score(*word_ids(data, offsets, net_bits))
                part = batch.slice(start, len(scores))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"])

    net_bits = net.settings.bits
    threshold = F.lit(net.threshold)
    for name, value in net.thresholds.items():
        threshold = F.when(F.col(lang) == name, value).otherwise(threshold)
    out = docs.mapInArrow(lambda batches: released(score(batches)), schema).withColumn("threshold", threshold)
    return out.select(*plain.rest, "score", "threshold", (F.col("score") >= F.col("threshold")).alias("rejected"))
