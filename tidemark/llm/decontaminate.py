"""Benchmark decontamination by Wu-Manber search for many word windows at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Plain, cuts, stage

#: Lower-cased ASCII letters, digits and all bytes beyond ASCII stand for themselves, all else for a blank.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
#: Patterns at least this long get a machine of their own, so that short ones do not shorten its shifts.
LONG = 32
#: Bytes of benchmark text in one machine; a larger benchmark is searched for block by block.
PATTERN_BYTES = 8 << 20
_TABLE_BITS = 18


def plain_words(text: bytes) -> bytes:
    """`` w1 w2 .. wn ``, blanks at both ends; one blank if there is no word."""
    words = text.translate(WORDS).split()
    return b" " + b" ".join(words) + b" " if words else b" "


def windows_of(text: bytes, width: int) -> set[bytes]:
    """The windows of an item: ``width`` consecutive words, or all of them where they are fewer."""
    words = text.translate(WORDS).split()
    if not words:
        return set()
    return {b" " + b" ".join(words[i : i + width]) + b" " for i in range(max(1, len(words) - width + 1))}


@dataclass
class Machine:
    """Shift and bucket tables of patterns whose first ``m`` bytes steer the search by blocks of ``b`` bytes."""

    patterns: list[bytes]
    m: int
    b: int
    shift: np.ndarray
    bucket: np.ndarray
    members: np.ndarray

    @classmethod
    def build(cls, patterns: list[bytes]) -> Machine:
        m = min(map(len, patterns))
        b = min(8, m)
        heads = np.frombuffer(b"".join(p[:m] for p in patterns), dtype=np.uint8).reshape(len(patterns), m)
        shift = np.full(1 << _TABLE_BITS, m - b + 1, dtype=np.int64)
        last = np.empty(0, np.int64)
        for end in range(b, m + 1):
            last = _block_hash(np.ascontiguousarray(heads[:, end - b : end]))
            np.minimum.at(shift, last, m - end)
        members = np.argsort(last, kind="stable")
        bucket = np.searchsorted(last[members], np.arange((1 << _TABLE_BITS) + 1))
        return cls(patterns, m, b, shift, bucket, members)

    def find(self, text: np.ndarray) -> Iterator[tuple[int, int]]:
        """Start and pattern of every occurrence in ``text``, in no order.

        The ends of possible first-m-byte matches are walked by many cursors at once, each over a stretch of
        its own: the block before a cursor gives its shift; a shift of zero names a bucket of patterns, which
        are compared byte by byte, and moves on by one.
        """
        n = len(text)
        if n < self.m:
            return
        raw = text.tobytes()
        grid = np.lib.stride_tricks.sliding_window_view(text, self.b)
        step = max(256, n // 8192)
        at = np.arange(self.m, n + 1, step)
        stop = np.minimum(at + step, n + 1)
        while len(at):
            block = _block_hash(grid[at - self.b])
            move = self.shift[block]
            hit = move == 0
            if hit.any():
                for end, h in zip(at[hit].tolist(), block[hit].tolist()):
                    start = end - self.m
                    for k in self.members[self.bucket[h] : self.bucket[h + 1]].tolist():
                        if raw.startswith(self.patterns[k], start):
                            yield start, k
            at = at + np.maximum(move, 1)
            live = at < stop
            at, stop = at[live], stop[live]


def _block_hash(rows: np.ndarray) -> np.ndarray:
    value = np.zeros(len(rows), dtype=np.uint64)
    for k in range(rows.shape[1]):
        value = (value << np.uint64(8)) | rows[:, k].astype(np.uint64)
    return ((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


class Searcher:
    """The windows of a block of benchmark items, ready to search texts for."""

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            for window in windows_of(text, width):
                owners.setdefault(window, set()).add(item)
        self.owners = owners
        parts = [[w for w in owners if len(w) >= LONG], [w for w in owners if len(w) < LONG]]
        self.machines = [Machine.build(sorted(p)) for p in parts if p]

    def scan(self, texts: list[bytes]) -> tuple[np.ndarray, list[list[list[int]]], list[list[str]]]:
        """Per text: its words, the merged spans [first, end) of words inside windows, the items found."""
        plain = [plain_words(t) for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in plain])])
        text = np.frombuffer(b"".join(plain), dtype=np.uint8)
        blanks = np.concatenate([[0], np.cumsum(text == 32)])
        n_words = blanks[offsets[1:]] - blanks[offsets[:-1]] - 1
        spans: list[list[list[int]]] = [[] for _ in texts]
        items: list[set[str]] = [set() for _ in texts]
        for machine in self.machines:
            found = list(machine.find(text))
            rows = np.searchsorted(offsets, [f[0] for f in found], side="right") - 1
            for (start, k), row in zip(found, rows.tolist()):
                pattern = machine.patterns[k]
                word = int(blanks[start] - blanks[offsets[row]])
                spans[row].append([word, word + pattern.count(b" ") - 1])
                items[row] |= self.owners[pattern]
        return n_words, [merged(s) for s in spans], [sorted(i) for i in items]


def merged(spans: list[list[int]]) -> list[list[int]]:
    """The union of spans as runs in order; touching ones join."""
    out: list[list[int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return out


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", width: int = 13
) -> DataFrame:
    """All columns of ``docs``, then n_words (long), spans (array of [first, end) word ranges inside windows) and items.

    Words are runs of ASCII letters, digits and characters beyond ASCII, with A-Z lower-cased. An item
    of fewer than ``width`` words, but not none, is one window. Null and empty texts have no words, hence no
    hits and no windows; repeated items count once by id, items with null id are left out. Whole texts are
    searched; a repeated row gets its own result. A column named like a result gives way to it.

    The benchmark is dealt into blocks of about ``PATTERN_BYTES`` by a hash of the item; one block at a time is collected,
    made into tables and broadcast, and all rows are searched for it where they lie.
    """
    plain = Plain(docs, "n_words", "spans", "items")
    docs, text = plain.rows, plain.of(text)
    known = benchmark.filter(F.col(item).isNotNull() & F.col(item_text).isNotNull()).select(
        F.col(item).cast("string").alias("item"), F.encode(F.col(item_text), "UTF-8").alias("text")
    )
    # one item is whole in one block, so a block is as large as the longest item at least
    total = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // PATTERN_BYTES))
    schema = docs.select("*", F.lit(0).cast("long").alias("n_words"), F.array(F.array(F.lit(0))).alias("spans"), F.array(F.lit("")).alias("items")).schema
    out = docs
    for block in range(count):
        rows = known.filter(F.pmod(F.xxhash64("item"), F.lit(count)) == block).collect()
        searcher = docs.sparkSession.sparkContext.broadcast(Searcher([(r["item"], bytes(r["text"])) for r in rows], width))
        out = out.mapInArrow(_scan_with(searcher, text, block > 0), schema)
        if block + 1 < count:
            out = stage(out, "searched")
    return out.select(*plain.rest, "n_words", "spans", "items")


def _scan_with(searcher, column: str, add: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = pc.fill_null(batch.column(column).cast(pa.large_binary()), b"")
            offsets = np.concatenate([[0], np.cumsum(pc.binary_length(body).to_numpy(zero_copy_only=False))])
            words, spans, items = [], [], []
            for first, end in cuts(offsets):
                n, s, i = searcher.value.scan(body.slice(first, end - first).to_pylist())
                words.append(n)
                spans += s
                items += i
            plain = batch
            if add:
                old_spans, old_items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
                spans = [merged(a + b) for a, b in zip(old_spans, spans)]
                items = [sorted({*a, *b}) for a, b in zip(old_items, items)]
                plain = batch.drop_columns(["n_words", "spans", "items"])
            n_words = np.concatenate(words) if words else np.empty(0, np.int64)
            more = [
                pa.array(n_words, pa.int64()),
                pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                pa.array(items, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([*plain.columns, *more], [*plain.schema.names, "n_words", "spans", "items"])

    return scan


def verdict(least_percent: int = 5) -> list:
    """n_hit, n_items, items_sha256 and contaminated, from the columns of ``find_benchmark``."""
    n_hit = F.aggregate("spans", F.lit(0), lambda s, x: s + x[1] - x[0]).cast("long")
    return [
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join(F.array_sort("items"), ","), "UTF-8"), 256).alias("items_sha256"),
        ((n_hit > 0) & (100 * n_hit >= least_percent * F.col("n_words"))).alias("contaminated"),
    ]
