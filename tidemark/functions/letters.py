"""Runs of ASCII letters of whole text columns, in numpy: the words of ``text.tokenize``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that one pass takes at once; a longer text makes a pass of its own.
BLOCK_BYTES = 1 << 20
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n + 1, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_UP, _DOWN = (_powers(base, BLOCK_BYTES) for base in (_BASE, pow(_BASE, -1, 1 << 64)))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """The words of a block of rows: lower-cased bytes, starts, sizes, rows, and 64-bit fingerprints."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, n = LOWER[data], len(data)
        inside = LETTER[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before = np.concatenate([[False], inside[:-1]]) if n else inside
        after = np.concatenate([inside[1:], [False]]) if n else inside
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.sizes = ends - self.starts
        self.row = np.searchsorted(offsets, self.starts, side="right") - 1
        up, down = (_UP, _DOWN) if n <= BLOCK_BYTES else (_powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n))
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.data * up[:n], out=sums[1:])
        self.print = _mix((sums[ends] - sums[self.starts]) * down[self.starts] + self.sizes.astype(np.uint64))

    def text(self, at: np.ndarray) -> pa.Array:
        """The words numbered ``at``, as strings."""
        sizes = self.sizes[at]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        spots = np.repeat(self.starts[at] - offsets[:-1], sizes) + np.arange(offsets[-1])
        parts = pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(self.data[spots])
        return pa.StringArray.from_buffers(len(at), *parts)


def word_blocks(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """First row, end and words of runs of rows with about ``BLOCK_BYTES`` of text; null counts as empty."""
    arr = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    first = 0
    while first < len(arr):
        end = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, side="right")) - 1
        end = min(max(end, first + 1), len(arr))
        yield first, end, Words(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first])
        first = end
