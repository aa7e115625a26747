"""Language-model scores by prediction by partial matching (PPM) over bytes, beside a unigram word score."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, Plain, Spans, blocks, mix, row_of, stage, word_bounds

#: Marks the start and the end of a text; no byte of UTF-8 is 255.
EDGE = 255
#: A context beyond two bytes counts if it makes up more than one in so many training positions; by default every context seen does.
NODES = math.inf
#: The chance of a gram (a byte and the ``ORDER`` bytes before it) is kept in every task if the gram makes up at least one in so many
#: training positions, the ``HEAD_KEPT`` most frequent of them. The others are asked for in a shuffle, with equal results.
HEAD_GRAMS, HEAD_KEPT = 1 << 24, 1 << 22
#: Grams are dealt by their three nearest context bytes into so many buckets, so all longer contexts of a bucket lie in it whole.
BUCKETS = 1 << 10
#: Bytes of text whose rare grams are asked for together.
ASK_BYTES = 1 << 23
#: Positions that a task gathers before it counts their grams, and grams that it holds before it sends them.
GATHERED, HELD = 1 << 23, 1 << 22
#: A word is kept in every task if it makes up at least one in so many training tokens; there are no more of them than this.
HEAD_WORDS = 1 << 21
ORDER = 6
_WORD, _GRAM, _TEXTS = 0, 1, 2


def held_out(key: str = "doc_id", folds: int = 5, fold: int = 1) -> Column:
    """Whether crc32 of the key as text leaves ``fold``; a null key counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(key).cast("string"), F.lit("")), "UTF-8")) % folds == fold


def stream(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts with ``order`` edge marks before and one after each; where each one's coded bytes start and end."""
    n = len(offsets) - 1
    out = np.full(len(data) + n * (order + 1), EDGE, dtype=np.uint8)
    out[np.arange(len(data)) + row_of(offsets) * (order + 1) + order] = data
    starts = offsets[:-1] + np.arange(n) * (order + 1) + order
    return out, starts, starts + np.diff(offsets) + 1


def grams_of(text: np.ndarray) -> np.ndarray:
    """The gram of each place from ``ORDER`` on: the bytes before it, the nearest one highest, and its own byte lowest."""
    n = len(text) - ORDER
    out = np.zeros(max(0, n), dtype=np.int64)
    for k in range(1, ORDER + 1):
        out |= text[ORDER - k : ORDER - k + n].astype(np.int64) << (8 * (ORDER + 1 - k))
    return out | text[ORDER:]


def bucket_of(grams: np.ndarray) -> np.ndarray:
    near = (grams >> (8 * (ORDER - 2))).view(np.uint64)
    return (mix(near + np.uint64(1)) & np.uint64(BUCKETS - 1)).astype(np.int32)


def pack(numbers: np.ndarray) -> bytes:
    """64-bit numbers, their differences by planes of bytes, compressed."""
    steps = np.diff(numbers.astype(np.int64), prepend=np.int64(0))
    return pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T), codec="zstd", asbytes=True) if len(steps) else b""


def unpack(packed: bytes, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, np.int64)
    planes = np.frombuffer(pa.decompress(packed, decompressed_size=8 * n, codec="zstd"), dtype=np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, each once with its counts summed, from parts that are in order themselves."""
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    if len(parts) == 1 or not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


def _find(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the wanted keys stand, and whether they are there at all."""
    if not len(sorted_keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return at, sorted_keys[at] == wanted


class Low:
    """Contexts of up to two bytes, from the counts of all three-byte grams; each process works its tables out."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts
        self.positions = int(counts.sum())
        self.totals = np.bincount(keys >> 8, weights=counts, minlength=1 << 16).astype(np.int64)
        self.types = np.bincount(keys >> 8, minlength=1 << 16)
        zero = np.bincount(keys & 255, weights=counts, minlength=256).astype(np.int64)[None]
        self.one = np.bincount(keys & 0xFFFF, weights=counts, minlength=1 << 16).astype(np.int64).reshape(256, 256)
        unseen = np.full((1, 256), 1 / max(1, 256 - int((zero > 0).sum())))
        self.p1, self.rest1 = _level(self.one, np.broadcast_to(zero, self.one.shape), np.broadcast_to(unseen, self.one.shape))

    def __reduce__(self):
        return Low, (self.keys, self.counts)

    def count(self, grams: np.ndarray) -> np.ndarray:
        """How often the byte of each gram follows its two nearest."""
        at, there = _find(self.keys, self.code(grams))
        return np.where(there, self.counts[at], 0) if len(self.keys) else np.zeros(len(grams), np.int64)

    @staticmethod
    def code(grams: np.ndarray) -> np.ndarray:
        """(older, nearer, byte) of grams of any length whose nearest byte is at bit 48."""
        return ((grams >> 40) & 255) << 16 | (grams >> 48) << 8 | grams & 255

    def below(self, grams: np.ndarray) -> np.ndarray:
        """Chance of each gram's byte, which its two nearest have not seen before, from one byte down."""
        code = self.code(grams)
        pairs, row = np.unique(code >> 8, return_inverse=True)
        a, b = np.searchsorted(self.keys, pairs << 8), np.searchsorted(self.keys, (pairs + 1) << 8)
        two = np.zeros((len(pairs), 256), dtype=np.int64)
        at = np.repeat(a - np.concatenate([[0], np.cumsum(b - a)[:-1]]), b - a) + np.arange(int((b - a).sum())) if len(pairs) else a
        two[np.repeat(np.arange(len(pairs)), b - a), self.keys[at] & 255] = self.counts[at]
        rest = _below(two, self.one[pairs & 255], self.rest1[pairs & 255])
        return np.where(self.totals[code >> 8] > 0, rest[row, code & 255], self.p1[(code >> 8) & 255, code & 255])


def log_chances(asked: np.ndarray, grams: np.ndarray, counts: np.ndarray, low: Low, nodes: float, order: int = ORDER) -> np.ndarray:
    """log10 of the chance of each asked gram; ``grams`` are the training grams of their buckets in order, with counts.

    Escape method C with symbol exclusion: what a context has seen, the shorter one has seen too, so a context without the bytes of the
    longer one has as many types less as that has, and as many occurrences less as those bytes have in it. Contexts that
    hold the edge mark stand at the start of texts only; beyond two bytes they do not count.
    """
    levels, cell, n = {}, grams, counts
    for k in range(ORDER, 2, -1):
        first = np.flatnonzero(np.concatenate([[True], cell[1:] >> 8 != cell[:-1] >> 8])) if len(cell) else np.empty(0, np.int64)
        contexts, types = cell[first] >> 8, np.diff(np.append(first, len(cell)))
        if k > 3:
            shorter, up = np.unique((cell >> 16 << 8) | (cell & 255), return_inverse=True)
            fewer = np.zeros(len(shorter), np.int64)
            np.add.at(fewer, up, n)
            there = fewer[up]
        else:
            shorter, fewer, there = cell, n, low.count((cell >> 8 << 32) | (cell & 255))
        total, taken = (np.add.reduceat(x, first) if len(first) else first for x in (n, there))
        levels[k] = cell, n, contexts, total, types, taken
        cell, n = shorter, fewer
    byte = asked & 255
    chance, done = np.ones(len(asked)), np.zeros(len(asked), dtype=bool)
    less, fewer_types = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
    for k in range(order, 2, -1):
        cell, n, contexts, total, types, taken = levels[k]
        if not len(cell):
            continue
        context = asked >> (8 * (ORDER + 1 - k))
        at, known = _find(contexts, context)
        known &= total[at] * nodes > low.positions
        for j in range(k):
            known &= (context >> (8 * j)) & 255 != EDGE
        spot, seen = _find(cell, context << 8 | byte)
        _step(chance, done, known, np.where(seen, n[spot], 0), total[at] - less, types[at] - fewer_types)
        less, fewer_types = np.where(known, taken[at], 0), np.where(known, types[at], 0)
    pair = low.code(asked) >> 8
    _step(chance, done, low.totals[pair] > 0, low.count(asked), low.totals[pair] - less, low.types[pair] - fewer_types)
    rest = np.flatnonzero(~done)
    chance[rest] *= low.below(asked[rest])
    return np.log10(np.maximum(chance, 1e-300)).astype(np.float32)


def _step(chance: np.ndarray, done: np.ndarray, known: np.ndarray, count: np.ndarray, n: np.ndarray, d: np.ndarray) -> None:
    """One order down: the byte's own share where the context has it, else the escape."""
    weight = np.maximum(n + d, 1)
    hit, miss = known & ~done & (count > 0), known & ~done & (count == 0) & (n > 0)
    chance[hit] *= count[hit] / weight[hit]
    chance[miss] *= d[miss] / weight[miss]
    done |= hit


class Head:
    """Chances of frequent grams, two places for each; one that finds neither free is looked up with the rare ones."""

    def __init__(self, grams: np.ndarray, logs: np.ndarray):
        self.grams, self.logs = grams, logs
        bits = max(4, (2 * len(grams)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.float32)
        left = np.arange(len(grams))
        for turn in (0, 1):
            slot = self.slot(grams[left]) ^ turn
            free = self.keys[slot] < 0
            left, slot = left[free] if turn else left, slot[free] if turn else slot
            slot, first = np.unique(slot, return_index=True)
            self.keys[slot], self.values[slot] = grams[left[first]], logs[left[first]]
            left = np.delete(left, first)

    def __reduce__(self):
        return Head, (self.grams, self.logs)

    def slot(self, grams: np.ndarray) -> np.ndarray:
        return ((grams.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def __call__(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The logs of the grams that are here, 0 for the others, and the numbers of those."""
        slot = self.slot(grams)
        rare = np.flatnonzero(self.keys[slot] != grams)
        out = self.values[slot]
        other = slot[rare] ^ 1
        found = self.keys[other] == grams[rare]
        out[rare] = np.where(found, self.values[other], np.float32(0))
        return out, rare[~found]


@dataclass
class Model:
    """The counts of all grams as a table, the chances and words that every task knows, and what the shorter contexts need."""

    order: int
    nodes: float
    contexts: DataFrame
    low: Low
    head: Head
    words: np.ndarray
    word_counts: np.ndarray
    tokens: int
    types: int
    texts: int

    def known(self) -> "Known":
        return Known(self.head, self.words, self.word_counts, self.tokens, self.types, self.texts)


@dataclass
class Known:
    """What the scoring tasks get of a model."""

    head: Head
    words: np.ndarray
    word_counts: np.ndarray
    tokens: int
    types: int
    texts: int

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sum of the logs of each text's frequent grams, its end included; the other grams and their rows."""
        if len(offsets) < 2:
            return np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64)
        whole, starts, ends = stream(data, offsets, ORDER)
        cost, rare = np.zeros(len(whole) + 1, np.float32), np.empty(0, np.int64)
        grams = grams_of(whole)
        cost[ORDER:-1], rare = self.head(grams)
        row = np.searchsorted(starts, rare + ORDER, side="right") - 1
        inside = (row >= 0) & (rare + ORDER < ends[row])
        bounds = np.stack([starts, ends], axis=1).ravel()
        return np.add.reduceat(cost, bounds, dtype=np.float64)[::2], grams[rare[inside]], row[inside]


def _below(counts: np.ndarray, lower: np.ndarray, lower_rest: np.ndarray) -> np.ndarray:
    """Probability, one order down, of each byte that a context has not seen, the seen ones being excluded."""
    seen = counts > 0
    free = np.where(seen, 0, lower)
    total = free.sum(axis=1, keepdims=True)
    types = (free > 0).sum(axis=1, keepdims=True)
    weight = np.maximum(total + types, 1)
    passed = np.where(total > 0, types / weight, 1.0)
    return np.where(free > 0, free / weight, passed * lower_rest)


def _level(counts: np.ndarray, lower: np.ndarray, lower_rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities after each context, and what its unseen bytes get from below.

    Escape method C: with n occurrences of d different bytes the escape has d / (n + d).
    """
    rest = _below(counts, lower, lower_rest)
    n = counts.sum(axis=1, keepdims=True)
    d = (counts > 0).sum(axis=1, keepdims=True)
    weight = np.maximum(n + d, 1)
    escape = np.where(n > 0, d / weight, 1.0)
    return np.where(counts > 0, counts / weight, escape * rest), rest


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint of each lower-cased word of a block, and the number of each text's first word."""
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets)
    return Spans(data)(starts, ends), first


def _first_counts(text: str):
    """Per task: the words and three-byte grams of its training texts, each once with its count, and the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = np.zeros(1 << 24, dtype=np.uint32)
        words: list[tuple[np.ndarray, np.ndarray]] = []
        texts = 0
        for batch in batches:
            texts += batch.num_rows
            for _, data, offsets in blocks(batch, text):
                whole, starts, ends = stream(data, offsets, ORDER)
                wide = whole.astype(np.int32)
                code = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
                coded = np.ones(len(whole), dtype=bool)
                for k in range(1, ORDER + 1):
                    coded[starts - k] = False
                np.add.at(grams, code[coded[2:]], 1)
                hashes, _ = word_hashes(data, offsets)
                words.append(np.unique(hashes, return_counts=True))
                if len(words) == 16:
                    words = [_summed(words)]
        found, n = _summed(words)
        used = np.flatnonzero(grams)
        for kind, keys, counts in (
            (_WORD, found.view(np.int64), n),
            (_GRAM, used, grams[used].astype(np.int64)),
            (_TEXTS, np.zeros(1, np.int64), np.array([texts], np.int64)),
        ):
            yield from _rows(kind, keys, counts)

    return count


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(parts) == 1:
        return parts[0]
    keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, back, np.concatenate([n for _, n in parts]))
    return keys, counts


def _rows(kind: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(keys), 1 << 16):
        part = slice(a, a + (1 << 16))
        n = len(keys[part])
        columns = [np.full(n, kind, np.int32), keys[part].astype(np.int64), counts[part].astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["kind", "key", "n"])


def _sent(grams: np.ndarray, numbers: np.ndarray | None, block: int = 0) -> pa.RecordBatch:
    """Grams in order as one packed row per bucket, with a number each."""
    bucket = bucket_of(grams)
    order = np.argsort(bucket, kind="stable")
    bucket, grams = bucket[order], grams[order]
    numbers = None if numbers is None else numbers[order]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.empty(0, np.int64)
    runs = [slice(a, b) for a, b in zip(first, np.append(first[1:], len(bucket)))]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[first], pa.int32()),
            pa.array(np.full(len(first), block, np.int64)),
            pa.array([r.stop - r.start for r in runs], pa.int32()),
            pa.array([pack(grams[r]) for r in runs], pa.binary()),
            pa.array([b"" if numbers is None else pack(numbers[r]) for r in runs], pa.binary()),
        ],
        ["bucket", "block", "size", "grams", "counts"],
    )


_PACKED = "bucket int, block bigint, size int, grams binary, counts binary"


def _context_counts(text: str):
    """Per task: the grams of its training texts, each with its count, packed by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[np.ndarray] = []
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for _, data, offsets in blocks(batch, text):
                whole, starts, _ = stream(data, offsets, ORDER)
                coded = np.ones(len(whole), dtype=bool)
                for k in range(1, ORDER + 1):
                    coded[starts - k] = False
                gathered.append(grams_of(whole)[coded[ORDER:]])
                if sum(map(len, gathered)) >= GATHERED:
                    parts = [_merged([*parts, np.unique(np.concatenate(gathered), return_counts=True)])]
                    gathered = []
                    if len(parts[0][0]) >= HELD:
                        yield _sent(*parts[0])
                        parts = []
        if gathered:
            parts = [_merged([*parts, np.unique(np.concatenate(gathered), return_counts=True)])]
        if parts:
            yield _sent(*parts[0])

    return count


def _bucket_counts(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    rows = zip(*(table.column(c).to_pylist() for c in ("size", "grams", "counts")))
    return _merged([(unpack(grams, size), unpack(counts, size)) for size, grams, counts in rows])


def _merge_bucket(table: pa.Table) -> pa.Table:
    grams, counts = _bucket_counts(table)
    return pa.Table.from_batches([_sent(grams, counts)])


def _head_rows(low, nodes: float, order: int, least: float):
    """The frequent grams with their counts and logs, bucket by bucket."""

    def chances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                grams, counts = _bucket_counts(pa.Table.from_batches([batch.slice(i, 1)]))
                often = counts >= least
                logs = log_chances(grams[often], grams, counts, low.value, nodes, order)
                yield pa.RecordBatch.from_arrays([pa.array(grams[often]), pa.array(counts[often]), pa.array(logs)], ["key", "n", "log"])

    return chances


def _asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rare grams of each block, each once, packed by bucket."""
    block, lists = None, []
    for batch in batches:
        ids = batch.column("_block").to_numpy(zero_copy_only=False)
        ends = np.flatnonzero(np.append(ids[1:] != ids[:-1], True)) + 1 if len(ids) else []
        start = 0
        for end in ends:
            if ids[start] != block:
                if lists:
                    yield _sent(np.unique(np.concatenate(lists)), None, block)
                block, lists = int(ids[start]), []
            lists.append(batch.column("_tail").slice(start, end - start).flatten().to_numpy(zero_copy_only=False))
            start = end
    if lists:
        yield _sent(np.unique(np.concatenate(lists)), None, block)


def _answers(low, nodes: float, order: int):
    """The logs of the grams that the blocks ask a bucket for."""

    def answer(asks: pa.Table, contexts: pa.Table) -> pa.Table:
        sizes = asks.column("size").to_pylist()
        parts = [unpack(grams, size) for grams, size in zip(asks.column("grams").to_pylist(), sizes)]
        logs = []
        if parts:
            asked, back = np.unique(np.concatenate(parts), return_inverse=True)
            found = log_chances(asked, *_bucket_counts(contexts), low.value, nodes, order)[back]
            logs = [found[b - n : b].tobytes() for b, n in zip(np.cumsum(sizes), sizes)]
        columns = [asks.column("block"), asks.column("size"), asks.column("grams"), pa.array(logs, pa.binary())]
        return pa.Table.from_arrays(columns, ["_block", "size", "grams", "logs"])

    return answer


def _add_up(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """Per row of a block, the sum of the logs of its rare grams."""
    sizes = answers.column("size").to_pylist()
    grams = [unpack(g, n) for g, n in zip(answers.column("grams").to_pylist(), sizes)]
    logs = [np.frombuffer(x, np.float32) for x in answers.column("logs").to_pylist()]
    keys = np.concatenate(grams) if grams else np.empty(0, np.int64)
    order = np.argsort(keys)
    keys, logs = keys[order], (np.concatenate(logs) if logs else np.empty(0, np.float32))[order]
    tails = rows.column("_tail").combine_chunks()
    tails = pa.concat_arrays(tails.chunks) if isinstance(tails, pa.ChunkedArray) else tails
    lengths = tails.value_lengths().to_numpy(zero_copy_only=False)
    wanted = tails.flatten().to_numpy(zero_copy_only=False)
    found = logs[np.searchsorted(keys, wanted)].astype(np.float64)
    sums = np.bincount(np.repeat(np.arange(len(lengths)), lengths), weights=found, minlength=len(lengths))
    return pa.Table.from_arrays([rows.column("_row"), pa.array(sums)], ["_row", "_deep"])


_COUNTS = "kind int, key bigint, n bigint"


def _pull(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts in key order; only for frames whose rows are bounded by construction."""
    table = df.select("key", "n").toArrow()
    keys, counts = table.column("key").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(keys, kind="stable")
    return keys[order], counts[order]


def train(docs: DataFrame, text: str = "text", order: int = ORDER) -> tuple[Model, DataFrame]:
    """Fit to all rows of ``docs``; the model and the table of all its words (key, n).

    One pass counts words and three-byte grams, a second one all grams of ``ORDER`` bytes and the next, which hold
    the counts of every shorter context; they stay a table, one packed row per bucket. Counts are summed within a task before the
    shuffle. What reaches the driver is bounded: 2**24 grams of three bytes, and the ``HEAD_GRAMS`` grams and
    ``HEAD_WORDS`` words at most that make up one in so many positions or tokens.
    """
    spark = docs.sparkSession
    body = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    text = "text"
    first = stage(body.mapInArrow(_first_counts(text), _COUNTS).groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    texts = first.filter(F.col("kind") == _TEXTS).agg(F.sum("n")).first()[0] or 0
    words = first.filter(F.col("kind") == _WORD).select("key", "n")
    total = words.agg(F.count("*").alias("types"), F.sum("n").alias("tokens")).first()
    tokens, types = (total["tokens"] or 0) + texts, total["types"] + (1 if texts else 0)
    head = _pull(words.filter(F.col("n") >= tokens / HEAD_WORDS))
    grams = _pull(first.filter(F.col("kind") == _GRAM))
    low = Low(*grams)
    sent = body.mapInArrow(_context_counts(text), _PACKED)
    contexts = stage(sent.groupBy("bucket").applyInArrow(_merge_bucket, _PACKED), "contexts")
    known = spark.sparkContext.broadcast(low)
    frequent = contexts.mapInArrow(_head_rows(known, NODES, order, low.positions / HEAD_GRAMS), "key bigint, n bigint, log float").toArrow()
    known.destroy()
    keys, counts, logs = (frequent.column(c).to_numpy() for c in ("key", "n", "log"))
    by_count = np.lexsort((keys, -counts))[:HEAD_KEPT]
    return Model(order, NODES, contexts, low, Head(keys[by_count], logs[by_count]), head[0], head[1], tokens, types, texts), words


def _score_rows(model, text: str):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Known = model.value
        # blocks are numbered within the task's share of the row numbers, so no two tasks have one in common
        block, held = TaskContext.get().partitionId() << 33, 0
        floor = np.log10(0.5) - np.log10(m.tokens + 0.5 * (m.types + 1))
        head_logs = np.log10(m.word_counts + 0.5) - np.log10(m.tokens + 0.5 * (m.types + 1))
        end_log = np.log10(m.texts + 0.5) - np.log10(m.tokens + 0.5 * (m.types + 1))
        for batch in batches:
            parts: list[tuple] = []
            rare, times, tails, block_ids = [], [], [], []
            for _, data, offsets in blocks(batch, text):
                n = len(offsets) - 1
                hashes, first = word_hashes(data, offsets)
                row = row_of(first)
                keys = hashes.view(np.int64)
                at = np.minimum(np.searchsorted(m.words, keys), max(0, len(m.words) - 1))
                known = m.words[at] == keys if len(m.words) else np.zeros(len(keys), dtype=bool)
                base = np.bincount(row[known], weights=head_logs[at[known]], minlength=n) + end_log
                n_known = np.bincount(row[known], minlength=n) + (m.texts > 0)
                scores, tail, tail_row = m.score(data, offsets)
                parts.append((np.diff(first) + 1, n_known, base, scores))
                tails.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(tail_row, np.arange(n + 1)).astype(np.int32)), pa.array(tail)))
                if held >= ASK_BYTES:
                    block, held = block + 1, 0
                held += len(data)
                block_ids.append(np.full(n, block, np.int64))
                # the other words of each text, each once with its number
                o = np.lexsort((keys[~known], row[~known]))
                r, k = row[~known][o], keys[~known][o]
                fresh = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (k[1:] != k[:-1])])) if len(r) else np.empty(0, np.int64)
                count = np.diff(np.append(fresh, len(r)))
                lists = np.searchsorted(r[fresh], np.arange(n + 1)).astype(np.int32)
                rare.append(pa.ListArray.from_arrays(pa.array(lists), pa.array(k[fresh])))
                times.append(pa.ListArray.from_arrays(pa.array(lists), pa.array(count.astype(np.int32))))
            if not parts:
                continue
            n_tokens, n_known, base, scores = (np.concatenate(x) for x in zip(*parts))
            more = [pa.array(n_tokens.astype(np.int64)), pa.array(n_known.astype(np.int64)), pa.array(base), pa.array(scores), pa.concat_arrays(rare), pa.concat_arrays(times), pa.concat_arrays(tails), pa.array(np.concatenate(block_ids))]
            names = ["n_tokens", "n_known", "base_score", "score", "_rare", "_times", "_tail", "_block"]
            keep = [name for name in batch.schema.names if name != text]
            yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in keep], *more], [*keep, *names])

    return score


def score_texts(docs: DataFrame, model: Model, words: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, then n_tokens, n_known, train_tokens (long), base_score and score.

    score is the PPM log10 probability of the text's bytes and its end. base_score sums
    log10((c + 0.5) / (N + 0.5 (V + 1))) over the words and the end. Null and empty texts consist of the end alone. Repeated
    rows are scored one by one; a column named like a result gives way to it. Frequent words are looked up within the task; each text's other words meet
    ``words`` in a join, and only sums by row come back. Frequent grams are looked up within the task, too; the others of a
    block of texts, each once, ask the model's table for their chances.
    """
    plain = Plain(docs, text, "n_tokens", "n_known", "train_tokens", "base_score", "score")
    docs, text = plain.rows, plain.of(text)
    known = docs.sparkSession.sparkContext.broadcast(model.known())
    others = [c for c in docs.columns if c != text]
    kinds = {"n_tokens": "bigint", "n_known": "bigint", "base_score": "double", "score": "double", "_rare": "array<bigint>", "_times": "array<int>", "_tail": "array<bigint>", "_block": "bigint"}
    schema = docs.select(*others, *[F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]).schema
    found = docs.mapInArrow(_score_rows(known, text), schema)
    rows = stage(found.withColumn("_row", F.monotonically_increasing_id()), "scored")
    rare = rows.select("_row", F.explode(F.arrays_zip("_rare", "_times")).alias("w")).select(
        "_row", F.col("w._rare").alias("key"), F.col("w._times").alias("times")
    )
    c = F.coalesce("n", F.lit(0))
    log = F.log10((c + 0.5) / (model.tokens + 0.5 * (model.types + 1)))
    sums = (
        rare.join(words, "key", "left")
        .groupBy("_row")
        .agg(F.sum(F.col("times") * log).alias("_sum"), F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("_more"))
    )
    low = docs.sparkSession.sparkContext.broadcast(model.low)
    asks = rows.filter(F.size("_tail") > 0).select("_block", "_tail").mapInArrow(_asks, _PACKED)
    answers = asks.groupBy("bucket").cogroup(model.contexts.groupBy("bucket")).applyInArrow(
        _answers(low, model.nodes, model.order), "_block bigint, size int, grams binary, logs binary"
    )
    asking = rows.filter(F.size("_tail") > 0).select("_block", "_row", "_tail")
    deep = asking.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(_add_up, "_row bigint, _deep double")
    out = rows.drop("_rare", "_times", "_tail", "_block").join(sums, "_row", "left").join(deep, "_row", "left")
    return out.select(
        *plain.rest,
        "n_tokens",
        (F.col("n_known") + F.coalesce("_more", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("_sum", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("_deep", F.lit(0.0))).alias("score"),
    )
