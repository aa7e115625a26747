"""What the operators share: staged tables and vectorised bytes, words and fingerprints."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: Bytes of text that one numpy pass takes at once; a longer text makes a pass of its own.
BLOCK_BYTES = 1 << 20
#: Upper to lower case for the ASCII letters, everything else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that belong to a word: all but the blank and 0x09 to 0x0D.
WORD_BYTE = np.ones(256, dtype=bool)
WORD_BYTE[[32, *range(9, 14)]] = False

_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the folder that all executors share and read on from there.

    Later steps then scan columns instead of recomputing, and a lost executor costs no more than a re-read.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Plain:
    """``docs`` under names of our own, so that no name of theirs can clash with one of ours.

    ``rows`` is the frame, ``of`` finds a column in it, and ``rest`` gives the columns their names back, but for those
    named like one of ``results``: there the result takes the place of the column.
    """

    def __init__(self, docs: DataFrame, *results: str):
        taken = {name.lower() for name in results}
        inner = [f"c{i}" for i in range(len(docs.columns))]
        self.rows = docs.toDF(*inner)
        self._inner = {name.lower(): c for name, c in zip(docs.columns, inner)}
        self.rest = [F.col(c).alias(name) for name, c in zip(docs.columns, inner) if name.lower() not in taken]

    def of(self, name: str) -> str:
        return self._inner[name.lower()]


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task; at its end, what it has freed goes back to the system.

    A Python worker stays for the next tasks, also those of other stages, and what its allocators hold would count beside theirs.
    """
    yield from batches
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim is not None:
        trim(0)


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column on end and the offsets of its rows; null counts as empty."""
    arr = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset : arr.offset + len(arr) + 1]
    if not len(arr) or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    data = np.frombuffer(arr.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def cuts(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows, first and end, that hold about ``size`` bytes."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end
        first = end


def blocks(batch: pa.RecordBatch, column: str, size: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and row offsets of each run of rows with about ``size`` bytes of text."""
    data, offsets = byte_column(batch.column(column))
    for first, end in cuts(offsets, size):
        yield first, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n + 1).bit_length())
    if size not in _powers:
        _powers.clear()
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _powers[size] = (both[0], both[1])
    return _powers[size]


class Spans:
    """64-bit fingerprints of any byte ranges of one block, from running sums."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power(len(data))
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def word_bounds(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray = WORD_BYTE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block, and the number of the first word of each row (one more at the end)."""
    n = len(data)
    if not n:
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = word_byte[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of each of ``first[-1]`` items, from the number of each row's first item."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
