"""Blocks of arrays that the steps of a fit read again and again, from files beside the tasks.

Each of as many tasks as there are cores writes its blocks to one file in the local folders of its executor, and only the file's path and
layout are cached. Steps run where that is cached and read the file block by block, so blocks neither pass between Spark and Python again
nor fill the memory of either. A task that runs elsewhere may not reach the file; then the step reads the source instead.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from typing import TypeVar

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.errors import PySparkException
from py4j.protocol import Py4JError

T = TypeVar("T")
# Parts of a block start at multiples of so many bytes.
ALIGNED = 64
# What a task says whose file is out of reach.
OUT_OF_REACH = "blocks out of reach:"


def _folder() -> str:
    """The first local folder of the executor, which Spark deletes with the executor."""
    named = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    return named if os.path.isdir(named) else tempfile.gettempdir()


def _written(blocks: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[str, list]]:
    """Path and layout of one file with all blocks: per block its bytes, and the type, start and length of each part."""
    path, layout = f"{_folder()}/blocks-{uuid.uuid4().hex}", []
    with open(path, "wb") as file:
        for block in blocks:
            parts, end = [], 0
            for part in block:
                parts.append((part.dtype.str, end, len(part)))
                data = part.tobytes()
                end += file.write(data + bytes(-len(data) % ALIGNED))
            layout.append((end, parts))
    yield path, layout


def _opened(files: Iterable[tuple[str, list]]) -> Iterator[tuple[np.ndarray, ...]]:
    for path, layout in files:
        try:
            file = open(path, "rb", buffering=0)
        except FileNotFoundError:
            raise RuntimeError(f"{OUT_OF_REACH} {path}") from None
        with file:
            for size, parts in layout:
                data = file.read(size)
                yield tuple(np.frombuffer(data, kind, n, start) for kind, start, n in parts)


def _removed(files: Iterable[tuple[str, list]]) -> None:
    for path, _ in files:
        if os.path.exists(path):
            os.remove(path)


class Blocks:
    """The blocks of an RDD of tuples of arrays, in files, for as many steps as need them."""

    def __init__(self, source: RDD):
        self.context = source.context
        self.source = source.coalesce(self.context.defaultParallelism)
        self.files = self.source.mapPartitions(_written).persist(StorageLevel.MEMORY_AND_DISK)
        self.files.count()

    def getNumPartitions(self) -> int:
        return self.source.getNumPartitions()

    def mapPartitions(self, f: Callable) -> RDD:
        """As of an RDD of the blocks, in one stage."""
        return self.files.mapPartitions(lambda files: f(_opened(files)))

    def run(self, job: Callable[[Blocks | RDD], T]) -> T:
        """A job over the blocks. Where a task cannot reach its file, the job runs again over the source."""
        try:
            return job(self)
        except (PySparkException, Py4JError) as error:
            if OUT_OF_REACH not in str(error):
                raise
            return job(self.source)

    def clear(self) -> None:
        self.files.foreachPartition(_removed)
        self.files.unpersist()


@contextmanager
def held(source: RDD) -> Iterator[Blocks]:
    """``Blocks`` whose files go at the end."""
    blocks = Blocks(source)
    try:
        yield blocks
    finally:
        blocks.clear()
