"""Exact nearest neighbours by a block matrix join: int8 tiles bound the distances, what survives is computed in double.

Queries and candidates are packed into blocks of some thousand vectors, and the blocks are dealt to the cells of a grid, so each task
holds one bounded group of queries and one of candidates. A vector x is kept as s * a with integers a from -127 to 127 and
the error e = |x - s * a|; a tile of integer products gives the distance of two such vectors, and the true one lies within the sum of their
errors of it. Pairs whose lower bound is above the k-th best upper bound of their query are out; the others are measured on the original vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage

#: Bytes of double-precision vectors in a cell of the grid, for the candidates and for the queries.
CANDIDATE_BYTES, QUERY_BYTES = 32 << 20, 16 << 20
#: Vectors of a block, and of the sides of a tile, at most.
BLOCK = 1024
TILE = 1024
#: One part in so many of the candidate blocks is searched first; its k-th best distances bound the rest.
FIRST_PARTS = 64
#: Integer products of so many components are exact in single precision.
EXACT = 1 << 24
_LAST = 1 << 63

PACK = "dim int, block long, rows array<bigint>, ids array<bigint>, vectors binary, bounds array<double>"
FOUND = "query_row bigint, query_id bigint, vec_id bigint, score double"


def clean_vectors(table: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """row, vec_id, v (array of double) of the vectors that take part: not null, not zero, and all components finite."""
    v = F.col(vector).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.forall(v, finite) & F.exists(v, lambda x: x != 0)
    rows = table.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("bigint").alias("vec_id"), v.alias("v"), usable.alias("usable"))
    return stage(rows.filter("usable").drop("usable"), "vectors")


def _packed(column: pa.Array) -> np.ndarray:
    """The vectors of equal length of a list column, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _pack(size: int, bounded: bool):
    """Blocks of at most ``size`` vectors of one length; those of a partition share no number with any other's."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        n = TaskContext.get().partitionId() << 33
        held: dict[int, list[pa.RecordBatch]] = {}

        def block(dim: int) -> pa.RecordBatch:
            nonlocal n
            n += 1
            part = pa.Table.from_batches(held.pop(dim)).combine_chunks().to_batches()[0]
            bounds = part.column("bound") if bounded else pa.nulls(len(part), pa.float64())
            lists = [pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), c) for c in (part.column("row"), part.column("vec_id"), bounds)]
            data = pa.array([_packed(part.column("v")).tobytes()], pa.binary())
            columns = [pa.array([dim], pa.int32()), pa.array([n], pa.int64()), lists[0], lists[1], data, lists[2]]
            return pa.RecordBatch.from_arrays(columns, ["dim", "block", "rows", "ids", "vectors", "bounds"])

        for batch in batches:
            lengths = pc.list_value_length(batch.column("v"))
            for dim in pc.unique(lengths).to_pylist():
                own = batch.filter(pc.equal(lengths, dim))
                while len(own):
                    room = size - sum(map(len, held.get(dim, [])))
                    held.setdefault(dim, []).append(own.slice(0, room))
                    own = own.slice(room)
                    if sum(map(len, held[dim])) == size:
                        yield block(dim)
        for dim in list(held):
            yield block(dim)

    return pack


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale and error of each row; the error is rounded up."""
    most = np.abs(x).max(axis=1, initial=0)
    scale = np.where(most > 0, most / 127, 1.0)
    scale = np.where(scale > 0, scale, most + (most == 0))  # so small that a 127th of it is no number
    codes = np.rint(x / scale[:, None]).clip(-127, 127).astype(np.int8)
    rest = x - scale[:, None] * codes
    largest = np.abs(rest).max(axis=1, initial=0)
    error = largest * np.sqrt(((rest / np.where(largest > 0, largest, 1)[:, None]) ** 2).sum(axis=1))
    return codes, scale, error * (1 + 1e-9) + 1e-12 * most * x.shape[1] ** 0.5


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of all rows of a and b. Single precision holds them exactly for a thousand components at a time."""
    width = EXACT // (127 * 127)
    out = np.zeros((len(a), len(b)))
    for first in range(0, a.shape[1], width):
        out += a[:, first : first + width].astype(np.float32) @ b[:, first : first + width].astype(np.float32).T
    return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distance of each row of a to that of b; squares are summed from the first component on, which makes equal vectors tie."""
    return np.sqrt(np.cumsum((a - b) ** 2, axis=1)[:, -1])


class Nearest:
    """The k nearest found so far of each query: a heap by distance and id, the worst on top, and a bound on the k-th best distance."""

    def __init__(self, n: int, k: int, bounds: np.ndarray):
        self.k, self.heaps = k, [[] for _ in range(n)]
        self.bounds = np.where(np.isnan(bounds), np.inf, bounds)

    def add(self, query: int, found: list[tuple[float, int]]) -> None:
        heap = self.heaps[query]
        for distance, vec in found:
            entry = (-distance, -vec)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
        if len(heap) == self.k:
            self.bounds[query] = min(self.bounds[query], -heap[0][0])


def search_tiles(queries: dict, candidates: list[dict], k: int, tile: int = TILE) -> Nearest:
    """The k nearest candidates of each query within its bound, the query's own row left out."""
    with np.errstate(over="ignore", invalid="ignore"):
        return _search_tiles(queries, candidates, k, tile)


def _search_tiles(queries: dict, candidates: list[dict], k: int, tile: int) -> Nearest:
    found = Nearest(len(queries["rows"]), k, queries["bounds"])
    q = queries["vectors"]
    q_codes, q_scale, q_error = quantise(q)
    q_square = (q_codes.astype(np.int64) ** 2).sum(axis=1) * q_scale**2
    for block in candidates:
        for c0 in range(0, len(block["rows"]), tile):
            c = block["vectors"][c0 : c0 + tile]
            rows, ids = block["rows"][c0 : c0 + tile], block["ids"][c0 : c0 + tile]
            c_codes, c_scale, c_error = quantise(c)
            c_square = (c_codes.astype(np.int64) ** 2).sum(axis=1) * c_scale**2
            for q0 in range(0, len(q), tile):
                part = slice(q0, q0 + tile)
                square = q_square[part, None] + c_square - 2 * q_scale[part, None] * c_scale * _products(q_codes[part], c_codes)
                # the sum cancels for near vectors: what it may be off by goes to the bounds
                off = 1e-12 * (q_square[part, None] + c_square)
                error = q_error[part, None] + c_error
                lower = np.sqrt(np.maximum(square - off, 0)) * (1 - 1e-12) - error
                own = queries["rows"][part, None] == rows
                bounds = found.bounds[part].copy()
                if len(rows) > k:
                    upper = np.sqrt(np.maximum(square + off, 0)) * (1 + 1e-12) + error
                    upper[own] = np.inf
                    bounds = np.minimum(bounds, np.partition(upper, k - 1, axis=1)[:, k - 1])
                # sums beyond the range of doubles are no numbers: such pairs are measured, too
                at, other = np.nonzero(~(lower > bounds[:, None]) & ~own)
                if not len(at):
                    continue
                exact = distances(q[part][at], c[other])
                first = np.searchsorted(at, np.arange(len(bounds) + 1)).tolist()
                pairs = list(zip(exact.tolist(), ids[other].tolist()))
                for i in np.unique(at).tolist():
                    found.add(q0 + i, pairs[first[i] : first[i + 1]])
    return found


def _blocks(table: pa.Table) -> list[dict]:
    out = []
    for row in table.to_batches():
        for i in range(len(row)):
            one = {c: row.column(c)[i].values for c in ("rows", "ids", "bounds")}
            ids = [_LAST if x is None else x for x in one["ids"].to_pylist()]
            vectors = np.frombuffer(row.column("vectors")[i].as_py(), dtype=np.float64).reshape(len(ids), -1)
            bounds = one["bounds"].to_numpy(zero_copy_only=False).astype(np.float64)
            out.append({"rows": one["rows"].to_numpy(), "ids": np.array(ids, dtype=object), "vectors": vectors, "bounds": bounds})
    return out


def _search(k: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        columns: list[list] = [[], [], [], []]
        candidates = _blocks(right)
        for queries in _blocks(left):
            found = search_tiles(queries, candidates, k)
            for row, vec, heap in zip(queries["rows"].tolist(), queries["ids"], found.heaps):
                for distance, other in heap:
                    values = (row, None if vec == _LAST else vec, None if other == -_LAST else -other, -distance)
                    for column, value in zip(columns, values):
                        column.append(value)
        kinds = [pa.int64()] * 3 + [pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_row", "query_id", "vec_id", "score"])

    return search


def _grid(queries: DataFrame, candidates: DataFrame, lines: int, columns: int, k: int) -> DataFrame:
    """Each line of query blocks meets each column of candidate blocks in a cell of its own."""
    left = queries.withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
    right = candidates.withColumn("line", F.explode(F.sequence(F.lit(0), F.lit(lines - 1))))
    return left.groupBy("dim", "line", "column").cogroup(right.groupBy("dim", "line", "column")).applyInArrow(_search(k), FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy("score", F.col("vec_id").asc_nulls_last()))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, is_query: str, k: int = 10, candidate_bytes: int = CANDIDATE_BYTES, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """query_row, query_id, rank, vec_id, score: the k nearest rows of each row for which the SQL condition ``is_query`` holds.

    ``vectors`` is a result of ``clean_vectors``. Distances are Euclidean in double precision, ties go to the smaller id, null ids last. A row is
    never its own neighbour, but another row of its id may be; each of several query rows of one id has its own neighbours. Vectors of other
    lengths are not compared. Fewer candidates than k give fewer rows, an empty table gives none. Every candidate is weighed; k-th best distances among the first part of
    the blocks and, tile by tile, upper bounds decide what is measured.
    """
    dims = vectors.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.expr(is_query)).alias("queries"))
    widest = dims.agg(F.max(F.col("n") * F.col("dim")), F.max(F.col("queries") * F.col("dim")), F.max("dim")).first()
    if not widest[1]:
        return vectors.sparkSession.createDataFrame([], "query_row long, query_id long, rank int, vec_id long, score double")
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = max(parts, -(-widest[0] * 8 // candidate_bytes))
    size = max(1, min(BLOCK, candidate_bytes // (8 * widest[2])))
    packed = stage(vectors.select("row", "vec_id", "v").mapInArrow(_pack(size, False), PACK), "blocks")
    candidates = packed.withColumn("column", F.pmod(F.hash("block", F.lit(1)), F.lit(columns)))
    early = F.pmod(F.hash("block", F.lit(2)), F.lit(FIRST_PARTS)) == 0
    asked = vectors.filter(is_query).withColumn("bound", F.lit(None).cast("double"))
    lines = max(1, -(-widest[1] * 8 // query_bytes))

    def groups(rows: DataFrame) -> DataFrame:
        dealt = rows.repartition(lines, F.hash("row"))
        return dealt.mapInArrow(_pack(BLOCK, True), PACK).withColumn("line", F.shiftright("block", 33).cast("int"))

    first = stage(_best(_grid(stage(groups(asked), "queries"), candidates.filter(early), lines, columns, k), k), "first")
    bounds = first.filter(F.col("rank") == k).select(F.col("query_row").alias("row"), F.col("score").alias("told"))
    bounded = asked.join(bounds, "row", "left").withColumn("bound", F.col("told")).drop("told")
    rest = _grid(stage(groups(bounded), "queries"), candidates.filter(~early), lines, columns, k)
    both = first.drop("rank").unionByName(rest)
    return _best(both, k).select("query_row", "query_id", "rank", "vec_id", "score")
