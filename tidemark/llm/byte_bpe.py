"""Byte-level BPE with a hierarchical-bitmap queue of merge ranks."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Plain, cuts, released

#: Bytes of text whose new pieces are encoded together.
TEXT_BYTES = 4 << 20


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a base64 token and its rank per line."""
    pairs = (line.split() for line in data.splitlines())
    return {base64.b64decode(p[0]): int(p[1]) for p in pairs if len(p) == 2}


#: Each word of the bitmap has 2 ** WORD bits, so two levels serve 65,536 ranks.
WORD = 8
_LOW = (1 << WORD) - 1


class RankQueue:
    """A priority queue over small integer ranks that hands out positions, lowest rank first.

    Each rank has a bucket of positions. Which buckets hold something is kept in levels of words, each bit
    of a level telling whether a word below it is non-zero; the lowest set bit of each level leads to the lowest rank.
    """

    def __init__(self, ranks: int):
        self.levels: list[list[int]] = []
        size = max(1, ranks)
        while not self.levels or size > 1:
            size = (size + _LOW) >> WORD
            self.levels.append([0] * size)
        self.buckets: dict[int, list[np.ndarray]] = {}

    def push(self, rank: int, positions: np.ndarray) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(positions)
            return
        self.buckets[rank] = [positions]
        for words in self.levels:
            place = rank >> WORD
            old = words[place]
            words[place] = old | 1 << (rank & _LOW)
            if old:
                return
            rank = place

    def pop(self) -> tuple[int, np.ndarray]:
        """The lowest rank and all its positions; the queue must hold some."""
        rank = 0
        for words in reversed(self.levels):
            word = words[rank]
            rank = rank << WORD | (word & -word).bit_length() - 1
        bit = rank
        for words in self.levels:
            place = bit >> WORD
            word = words[place] ^ 1 << (bit & _LOW)
            words[place] = word
            if word:
                break
            bit = place
        bucket = self.buckets.pop(rank)
        return rank, bucket[0] if len(bucket) == 1 else np.concatenate(bucket)


class Encoder:
    """Encodes text by ``ranks``, splitting it by ``pattern`` first, and decodes ids.

    The pieces of many texts lie in one linked list with walls between them, so one queue serves them all:
    the pieces do not touch each other, and within each the merges come in the order of their ranks.
    """

    #: Pieces whose codes are remembered, beside those of the last texts; results do not depend on it.
    REMEMBERED = 150_000
    #: Bytes of pieces that share a queue; a longer piece has a queue of its own.
    QUEUE_BYTES = 256 << 10

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.size = max(ranks.values(), default=0) + 1
        self.names = [str(i) for i in range(self.size)]
        self.bytes_of = {str(rank): token for token, rank in ranks.items()}
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int32)
        if (self.byte_ids < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        # two neighbours merge if their bytes make a token; its rank is that of the merge
        pairs = [
            (left * self.size + right, rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None
        ]
        table = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        self.pair, self.rank = table[:, 0], table[:, 1]
        # tokens that may merge on by a lower rank than their own: then only the leftmost place of a piece may go first
        part = np.concatenate([self.pair // self.size, self.pair % self.size])
        self.hasty = np.zeros(self.size, dtype=bool)
        self.hasty[part[np.tile(self.rank, 2) <= part]] = True
        self.codes: dict[str, str] = {}

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each two neighbours, -1 where they do not merge."""
        if not len(self.pair):
            return np.full(len(left), -1)
        wanted = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair, wanted), len(self.pair) - 1)
        return np.where(self.pair[at] == wanted, self.rank[at], -1)

    def _push(self, queue: RankQueue, ranks: np.ndarray, places: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        first = np.flatnonzero(np.concatenate([[True], ranks[1:] != ranks[:-1]]))
        for rank, a, b in zip(ranks[first].tolist(), first.tolist(), [*first[1:].tolist(), len(ranks)]):
            queue.push(rank, places[a:b])

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece: lowest rank first, the leftmost of equal ones.

        The queue holds the left place of every pair that can merge; an entry is stale when its
        place is gone or its pair has another rank by now, and is skipped. A bucket is merged at once, every other place
        of a run of overlapping pairs; each place is pushed at most twice per merge beside it.
        """
        out: list[list[int]] = [[] for _ in pieces]
        whole = [self.ranks.get(p) for p in pieces]
        rest = [k for k, rank in enumerate(whole) if rank is None and pieces[k]]
        for k, rank in enumerate(whole):
            if rank is not None:
                out[k] = [rank]
        if not rest:
            return out
        sizes = np.array([len(pieces[k]) for k in rest])
        ends = np.cumsum(sizes)
        n = int(ends[-1])
        ids = self.byte_ids[np.frombuffer(b"".join([pieces[k] for k in rest]), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(rest), dtype=np.int32), sizes)
        # one place beyond the last stands for every wall
        after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        after[ends - 1] = n
        before[ends - sizes] = n
        ids = np.append(ids, np.int32(-1))
        rank_at = np.full(n + 1, -1, dtype=np.int32)
        inner = np.flatnonzero(after[:n] < n)
        rank_at[inner] = self._pair_ranks(ids[inner], ids[inner + 1])
        queue = RankQueue(self.size)
        inner = inner[rank_at[inner] >= 0]
        if len(inner):
            self._push(queue, rank_at[inner], inner)
        while queue.buckets:
            rank, places = queue.pop()
            places = places[rank_at[places] == rank]
            if not len(places):
                continue
            if len(places) > 1:
                places = np.unique(places)
                if self.hasty[rank]:
                    leftmost = np.concatenate([[True], owner[places[1:]] != owner[places[:-1]]])
                    if not leftmost.all():
                        queue.push(rank, places[~leftmost])
                        places = places[leftmost]
                else:
                    free = np.concatenate([[True], after[places[:-1]] != places[1:]])
                    if not free.all():
                        nth = np.arange(len(places))
                        places = places[(nth - np.maximum.accumulate(np.where(free, nth, 0))) % 2 == 0]
            gone = after[places]
            beyond = after[gone]
            ids[places], ids[gone] = rank, -1
            rank_at[gone] = -1
            after[places] = beyond
            before[beyond] = places
            ahead = before[places]
            left = np.concatenate([ahead, places])
            right = np.concatenate([places, beyond])
            inside = (left < n) & (right < n)
            rank_at[places] = -1
            left, right = left[inside], right[inside]
            if len(left):
                new = self._pair_ranks(ids[left], ids[right])
                rank_at[left] = new
                can = new >= 0
                if can.any():
                    self._push(queue, new[can], left[can])
        live = ids[:n] >= 0
        found, starts = ids[:n][live].tolist(), np.concatenate([[0], np.cumsum(np.bincount(owner[live], minlength=len(rest)))]).tolist()
        for nth, k in enumerate(rest):
            out[k] = found[starts[nth] : starts[nth + 1]]
        return out

    def encode_all(self, texts: list[str]) -> list[str]:
        """Per text its ids in decimal, joined by single blanks."""
        codes, same = self.codes, {}
        split_texts = []
        for text in texts:
            pieces = self.split(text)
            split_texts.append(list(map(same.setdefault, pieces, pieces)))
        new = [piece for piece in same if piece not in codes]
        raw = [piece.encode() for piece in new]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        names = self.names
        for first, end in cuts(offsets, self.QUEUE_BYTES):
            for piece, ids in zip(new[first:end], self.encode_pieces(raw[first:end])):
                codes[piece] = " ".join([names[i] for i in ids])
        out = [" ".join(map(codes.__getitem__, pieces)) for pieces in split_texts]
        if len(codes) > self.REMEMBERED:
            self.codes = {piece: codes[piece] for piece in same}  # those of the last texts come again most likely
        return out

    def encode(self, text: str) -> str:
        return self.encode_all([text])[0]

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.split(" "))) if ids else b""


#: The encoder that a Python worker keeps for its next tasks, by vocabulary and pattern.
_kept: dict[tuple, Encoder] = {}


def kept_encoder(data: bytes, pattern: str) -> Encoder:
    key = (hashlib.sha256(data).digest(), pattern)
    if key not in _kept:
        _kept.clear()
        _kept[key] = Encoder(read_ranks(data), pattern)
    return _kept[key]


def vocabulary_bytes(df: DataFrame, path: str) -> bytes:
    """The vocabulary file, read by the driver; its size is that of a vocabulary, not of the data."""
    with open(path, "rb") as file:
        return file.read()


def encode_texts(docs: DataFrame, path: str, pattern: str, text: str = "text", arrays: bool = True) -> DataFrame:
    """All columns of ``docs``, then n_tokens, ids_text (decimal ids joined by blanks), decoded (binary, from those ids), ids (array of int).

    Every match of ``pattern`` is merged by itself; there are no special tokens. Null and empty texts have no ids.
    Each row is encoded alone and whole, repeated rows alike; no shuffle. A column named like a result gives way to it. Without ``arrays`` ids is left out.
    """
    more = [("n_tokens", "bigint"), ("ids_text", "string"), ("decoded", "binary")] + [("ids", "array<int>")] * arrays

    def rows(encoder: Encoder, codes: list[str]) -> list[pa.Array]:
        out = [
            pa.array([c.count(" ") + 1 if c else 0 for c in codes], pa.int64()),
            pa.array(codes, pa.string()),
            pa.array([encoder.decode(c) for c in codes], pa.binary()),
        ]
        if arrays:
            ids = [np.fromstring(c, dtype=np.int32, sep=" ") for c in codes]
            ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids))))
        return out

    return _encoded(docs, path, pattern, text, more, rows)


def _encoded(docs: DataFrame, path: str, pattern: str, text: str, more: list[tuple[str, str]], rows: Callable) -> DataFrame:
    names = [name for name, _ in more]
    plain = Plain(docs, *names)
    docs, text = plain.rows, plain.of(text)
    data = docs.sparkSession.sparkContext.broadcast(vocabulary_bytes(docs, path))
    schema = docs.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in more]).schema

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(data.value, pattern)
        for batch in batches:
            sizes = pc.binary_length(pc.fill_null(batch.column(text), "")).to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            for first, end in cuts(offsets, TEXT_BYTES):
                part = batch.slice(first, end - first)
                texts = pc.fill_null(part.column(text), "").to_pylist()
                columns = rows(encoder, encoder.encode_all(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *names])

    return docs.mapInArrow(lambda batches: released(encode(batches)), schema).select(*plain.rest, *names)
