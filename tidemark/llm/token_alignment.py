"""Two tokenizers over the same bytes: overlapping tokens, groups between common ends, and how documents link ids."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Plain, cuts, stage

#: Bytes of text that are aligned at once; a longer text makes a batch of its own.
TEXT_BYTES = 1 << 20
#: Id pairs that are looked up in a broadcast table, at most; rarer pairs are looked up in a join. It decides nothing else.
HEAD_PAIRS = 1 << 20


def _plain_bytes() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: itself where it prints, else the next code point from 256."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(kept)]
    return {chr(c): b for c, b in [*zip(kept, kept), *zip(range(256, 256 + len(other)), other)]}


class ByteTokens:
    """A byte-level BPE vocabulary file; the strings of its special tokens are plain text here.

    Such a file merges by its list of merges; where the ids follow that list, as checked here, they are ranks.
    """

    def __init__(self, data: bytes, pattern: str):
        told = json.loads(data)
        special = {t["content"] for t in told["added_tokens"]}
        stands = _plain_bytes()
        ids = {bytes(map(stands.__getitem__, token)): i for token, i in told["model"]["vocab"].items() if token not in special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"]]
        merged = [ids[bytes(map(stands.__getitem__, a + b))] for a, b in pairs]
        if merged != sorted(merged) or len(merged) + 256 != len(ids) or max(ids[bytes([b])] for b in range(256)) >= min(merged, default=256):
            raise ValueError("the ids of this vocabulary are not in the order of its merges")
        self.codec = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ids, special_tokens={})
        self.bytes_of = [b""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            self.bytes_of[i] = token

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.codec.encode_ordinary(" " + text) for text in texts]


class PieceTokens:
    """A sentencepiece model, which puts the blank in front itself."""

    def __init__(self, data: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.bytes_of = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def piece_count(path: str) -> int:
    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()


def _covering(starts: pd.DataFrame, others: pd.DataFrame) -> np.ndarray:
    """For each token of ``starts`` the token of the other side, in the same document, that covers its first byte."""
    return pd.merge_asof(starts, others, on="at", by="doc", suffixes=("", "_other"))["token_other"].to_numpy(np.int64)


class Aligner:
    def __init__(self, left, right):
        self.left, self.right = left, right
        self.names = []
        # the text of an id and what comes after it: within a side, or at its end
        for side, last in ((left, "|"), (right, ";")):
            ids = [str(i) for i in range(len(side.bytes_of))]
            self.names += [f"{i}," for i in ids] + [f"{i}{last}" for i in ids]
        self.lengths = [np.array([len(b) for b in side.bytes_of], dtype=np.int64) for side in (left, right)]

    def _tokens(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of both sides; none where a side's bytes are not the blank and the text."""
        some = [k for k, text in enumerate(texts) if text]
        found: tuple[list[list[int]], ...] = ([[] for _ in texts], [[] for _ in texts])
        chosen = [texts[k] for k in some]
        whole = [b" " + text.encode() for text in chosen]
        both = [side.encode(chosen) if chosen else [] for side in (self.left, self.right)]
        for k, want, a, b in zip(some, whole, *both):
            if all(b"".join(map(side.bytes_of.__getitem__, ids)) == want for side, ids in ((self.left, a), (self.right, b))):
                found[0][k], found[1][k] = a, b
        return found

    def __call__(self, texts: list[str]) -> list[pa.Array]:
        """n_a, n_b, n_groups, n_links, groups, pairs, times of each text."""
        sides = self._tokens(texts)
        n = len(texts)
        counts = [np.array([len(t) for t in side], dtype=np.int64) for side in sides]
        ids, docs, at = [], [], []
        for side, count, lengths in zip(sides, counts, self.lengths):
            flat = np.fromiter((i for t in side for i in t), dtype=np.int64, count=int(count.sum()))
            end = np.cumsum(lengths[flat])
            ids.append(flat)
            docs.append(np.repeat(np.arange(n), count))
            at.append(end - lengths[flat])  # both sides of a text have as many bytes, so the offsets of a batch agree
        frames = [pd.DataFrame({"at": a, "doc": d, "token": np.arange(len(a))}) for a, d in zip(at, docs)]
        over_a, over_b = _covering(frames[0], frames[1]), _covering(frames[1], frames[0])
        # tokens that start together are found from both sides
        alone = at[0][over_b] != at[1]
        link_a = np.concatenate([np.arange(len(over_a)), over_b[alone]])
        link_b = np.concatenate([over_a, np.flatnonzero(alone)])
        starts_a = at[1][over_a] == at[0]
        out = [counts[0], counts[1], self._per_text(docs[0][starts_a], n), self._per_text(docs[0][link_a], n)]
        groups = self._groups(ids, docs, starts_a, ~alone, n)
        return [*map(pa.array, out), groups, *self._pairs(docs[0][link_a], ids[0][link_a], ids[1][link_b], n)]

    @staticmethod
    def _per_text(doc: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(doc, minlength=n).astype(np.int64)

    def _groups(self, ids, docs, starts_a: np.ndarray, starts_b: np.ndarray, n: int) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3`` of each text; a group begins where tokens of both sides start together."""
        group = [np.cumsum(starts_a), np.cumsum(starts_b)]
        n_names = 0
        codes = []
        for side, g in zip((0, 1), group):
            last = np.append(g[1:] != g[:-1], True)[: len(g)]
            size = len(self.lengths[side])
            codes.append(n_names + last * size + ids[side])
            n_names += 2 * size
        # the left tokens of a group, then the right ones: each comes after all tokens of the other side in groups before
        before_a = np.searchsorted(group[1], group[0], side="left")
        before_b = np.searchsorted(group[0], group[1], side="right")
        order = np.empty(len(codes[0]) + len(codes[1]), dtype=np.int64)
        order[np.arange(len(before_a)) + before_a] = codes[0]
        order[np.arange(len(before_b)) + before_b] = codes[1]
        ends = np.cumsum(sum(np.bincount(d, minlength=n) for d in docs)).tolist()
        words, out, first = list(map(self.names.__getitem__, order.tolist())), [], 0
        for end in ends:
            out.append("".join(words[first:end])[:-1])
            first = end
        return pa.array(out, pa.large_string())

    def _pairs(self, doc: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
        """The distinct id pairs of each text, as a * size of B + b, and how often each is linked."""
        key = a * len(self.lengths[1]) + b
        order = np.lexsort((key, doc))
        doc, key = doc[order], key[order]
        new = np.append(True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]))[: len(key)]
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(key)))
        ends = np.append(0, np.cumsum(np.bincount(doc[first], minlength=n)))
        lists = [pa.LargeListArray.from_arrays(pa.array(ends), pa.array(v)) for v in (key[first], times.astype(np.int64))]
        return lists[0], lists[1]


#: The aligner that a Python worker keeps for its next tasks, by its vocabularies.
_kept: dict[int, Aligner] = {}


def align_tokens(docs: DataFrame, left: str, right: str, pattern: str, text: str = "text") -> DataFrame:
    """All columns of ``docs``, then n_a, n_b, n_groups, n_links, groups, pairs, times.

    ``left`` is a byte-level BPE file (A), ``right`` a sentencepiece model (B); both tokenize the blank and the text, A's pieces
    by ``pattern``. Tokens link where their bytes overlap; bytes at which tokens of both sides end cut the text into
    groups, written ``a1,a2|b1;a3|b2,b3``. ``pairs`` holds the distinct linked id pairs as a * (size of B) + b, ascending, ``times`` how
    often each is linked. Null and empty texts, and those that a tokenizer does not give back byte by byte, have no tokens.

    Each row is aligned whole and alone, repeated rows alike; no shuffle. A column named like a result gives way to it. An empty table gives no rows.
    """
    results = {"n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint"}
    results |= {"groups": "string", "pairs": "array<bigint>", "times": "array<bigint>"}
    plain = Plain(docs, *results)
    rows, text = plain.rows, plain.of(text)
    files = []
    for path in (left, right):
        with open(path, "rb") as file:  # vocabularies, read by the driver
            files.append(file.read())
    data = docs.sparkSession.sparkContext.broadcast(files)
    schema = rows.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in results.items()]).schema
    kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hash((*data.value, pattern))
        if known not in _kept:
            _kept.clear()
            _kept[known] = Aligner(ByteTokens(data.value[0], pattern), PieceTokens(data.value[1]))
        for batch in batches:
            sizes = pc.binary_length(pc.fill_null(batch.column(text), "")).to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            for first, end in cuts(offsets, TEXT_BYTES):
                part = batch.slice(first, end - first)
                columns = _kept[known](pc.fill_null(part.column(text), "").to_pylist())
                columns = [c.cast(kind) for c, kind in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *results])

    return rows.mapInArrow(align, schema).select(*plain.rest, *results)


def pair_counts(aligned: DataFrame, right_size: int) -> DataFrame:
    """pair, n (rows of ``aligned`` that hold it), best (no pair of the same A id is held by more)."""
    counts = stage(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pairs")
    a = F.expr(f"pair div {right_size}").alias("a")
    most = counts.groupBy(a).agg(F.max("n").alias("most"))
    return counts.select("pair", "n", a).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def with_link_counts(aligned: DataFrame, right_size: int, head: int = HEAD_PAIRS) -> DataFrame:
    """``aligned`` without pairs and times, with n_best (links whose pair is the most frequent of its A id) and count_sum (pair counts over links).

    Pairs that many rows hold are at most ``head`` and are broadcast; any other pair is held by few rows, so a join by pair has no hot key.
    Rows are told apart by their place in the written table, so repeated and null ids do no harm.
    """
    aligned = stage(aligned.withColumn("_place", F.monotonically_increasing_id()), "aligned")
    counts = stage(pair_counts(aligned, right_size), "counts")
    # one row per power of two
    tiers = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("tier")).count().collect()
    room, least = head, 64
    for tier in sorted(tiers, key=lambda t: -t["tier"]):
        if tier["count"] > room:
            break
        room, least = room - tier["count"], tier["tier"]
    frequent = F.col("n") >= F.pow(F.lit(2.0), F.lit(least))
    links = aligned.select("_place", F.explode(F.arrays_zip("pairs", "times")).alias("l"))
    links = links.select("_place", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    common = F.broadcast(counts.filter(frequent))  # at most ``head`` rows of 17 bytes
    rare = links.join(common.select("pair"), "pair", "left_anti").join(counts.filter(~frequent), "pair")
    told = [
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("times")).alias("count_sum"),
    ]
    parts = [side.groupBy("_place").agg(*told) for side in (links.join(common, "pair"), rare)]
    sums = parts[0].unionByName(parts[1]).groupBy("_place").agg(F.sum("n_best").alias("_best"), F.sum("count_sum").alias("_sum"))
    zero = F.lit(0).cast("long")
    rest = [c for c in aligned.columns if c not in ("pairs", "times", "_place", "n_best", "count_sum")]
    return aligned.select("_place", *rest).join(sums, "_place", "left").select(
        *rest, F.coalesce("_best", zero).alias("n_best"), F.coalesce("_sum", zero).alias("count_sum")
    )
