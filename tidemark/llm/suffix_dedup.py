"""Removal of repeated byte strings, by refining buckets of sampled suffixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Spans, blocks, byte_column, cuts, mix, stage

#: Groups of suffixes up to this size meet in one task; the windows of larger ones are counted before they are shuffled.
LIGHT = 2000
#: Tasks that share the anchors of one bucket when they learn whether it is large.
SALTS = 16
#: Bytes of text that are refined at once; small, as each byte takes some arrays of 64-bit numbers.
TEXT_BYTES = 1 << 19

_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _refined(first: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Bucket identifiers of longer strings, from those at a place and at a later offset."""
    h = (first ^ (first >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + later * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(29))


def buckets(data: np.ndarray, width: int) -> dict[int, np.ndarray]:
    """Bucket identifiers of the strings of 1, 2, 4 .. bytes that start at each place, and of ``width`` bytes.

    Each length is refined from half of it by the identifier half its length on, and the refined
    identifiers are used again for the next; the identifiers are 64-bit fingerprints, so they mean the same in every task.
    """
    level = {1: _BYTES[data]}
    size = 1
    while size * 2 <= width:
        h = level[size]
        level[size * 2] = _refined(h[:-size], h[size:]) if len(h) > size else h[:0]
        size *= 2
    done = size
    whole = level[size]
    while done < width:
        size = 1 << (width - done).bit_length() - 1
        n = max(0, len(data) - done - size + 1)
        whole = _refined(whole[:n], level[size][done : done + n])
        done += size
    level[width] = whole
    return level


def seed_width(width: int) -> int:
    """Length of the strings that name the first buckets: a power of two of about a third of ``width``."""
    return 1 << max(0, (width // 3).bit_length() - 1)


def window_anchors(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """Starts of all windows of ``width`` bytes within a text, the anchor of each, and the bucket identifiers.

    The anchor is the place in the window whose first bucket has the least identifier, the leftmost
    of equals. It depends on the window's bytes alone, so equal windows have anchors at the same offset and in the same bucket.
    """
    q = seed_width(width)
    level = buckets(data, width)
    n = len(data)
    change = np.zeros(n + 1, dtype=np.int32)
    np.add.at(change, offsets[:-1], 1)
    np.add.at(change, np.maximum(offsets[1:] - width + 1, offsets[:-1]), -1)
    starts = np.flatnonzero(np.cumsum(change[:n]) > 0)
    if not len(starts):
        return starts, starts, level
    seeds = level[q]
    least = (seeds >> np.uint64(32) << np.uint64(32)) | np.arange(len(seeds), dtype=np.uint64)
    reach, size = width - q + 1, 1
    while size * 2 <= reach:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    anchors = np.minimum(least[starts], least[starts + reach - size]) & np.uint64(0xFFFFFFFF)
    return starts, anchors.astype(np.int64), level


def _anchor_rows(text: str, width: int):
    """Per anchor: key, pos, seed (its first bucket), around (all bytes that its windows can reach, and its place in them), direct.

    Anchors of a bucket that has several in one batch are ``direct``: they are known as shared. Other batches hear of
    the bucket by one row without place (pos -1), so a bucket that very many texts share makes one such row per batch.
    """
    q = seed_width(width)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            parts = []
            for row, data, offsets in blocks(batch, text, TEXT_BYTES):
                _, anchors, level = window_anchors(data, offsets, width)
                at = np.unique(anchors)
                of = np.searchsorted(offsets, at, side="right") - 1
                left = np.maximum(offsets[of], at - (width - q))
                right = np.minimum(offsets[of + 1], at + width)
                around = mix(Spans(data)(left, right) + (at - left).astype(np.uint64))
                parts.append((keys[row + of], (at - offsets[of]).astype(np.int32), level[q][at].view(np.int64), around.view(np.int64)))
            if not parts:
                continue
            key, pos, seed, around = (np.concatenate(x) for x in zip(*parts))
            values, back, times = np.unique(seed, return_inverse=True, return_counts=True)
            heard = values[times > 1]
            none = np.zeros(len(heard), np.int64)
            columns = [
                np.append(key, none),
                np.append(pos, none.astype(np.int32) - 1),
                np.append(seed, heard),
                np.append(around, none),
                np.append(times[back] > 1, none > 0),
            ]
            for a in range(0, len(columns[0]), 1 << 16):
                cut = [pa.array(c[a : a + (1 << 16)]) for c in columns]
                yield pa.RecordBatch.from_arrays(cut, ["key", "pos", "seed", "around", "direct"])

    return find


def _owned(batch: pa.RecordBatch, text: str, places: str, width: int) -> Iterator[tuple]:
    """Per block with wanted anchors: key of each row, offsets, bytes, starts and anchors of the windows of the wanted ones, identifiers."""
    keys = batch.column("key").to_numpy()
    lists = batch.column(places)
    flat = lists.flatten().to_numpy()
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
    for row, data, offsets in blocks(batch, text, TEXT_BYTES):
        n = len(offsets) - 1
        wanted = np.zeros(len(data) + 1, dtype=bool)
        base = np.repeat(offsets[:-1], np.diff(ends[row : row + n + 1]))
        wanted[base + flat[ends[row] : ends[row + n]]] = True
        if wanted.any():
            starts, anchors, level = window_anchors(data, offsets, width)
            own = wanted[anchors]
            yield keys[row : row + n], offsets, data, starts[own], anchors[own], level


def _window_rows(text: str, places: str, width: int):
    """The windows whose anchors are among a row's ``places``: whole (the bucket of all their bytes), key, first, last, direct.

    Windows that one batch holds several times are repeated whatever the others hold: they leave as ``direct`` runs from first to last
    of a text, and other batches hear of them by one row without place. All others are rows of one window.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for keys, offsets, _, at, _, level in _owned(batch, text, places, width):
                of = np.searchsorted(offsets, at, side="right") - 1
                parts.append((level[width][at].view(np.int64), keys[of], (at - offsets[of]).astype(np.int32)))
            if not parts:
                continue
            whole, key, start = (np.concatenate(x) for x in zip(*parts))
            values, back, times = np.unique(whole, return_inverse=True, return_counts=True)
            alone, heard = times[back] == 1, values[times > 1]
            run_key, run_start = key[~alone], start[~alone]
            fresh = np.concatenate([[True], (run_key[1:] != run_key[:-1]) | (run_start[1:] != run_start[:-1] + 1)]) if len(run_key) else ~alone[:0]
            first = np.flatnonzero(fresh)
            last = np.append(first[1:], len(run_key)) - 1 if len(first) else first
            none = np.zeros(len(heard), np.int64)
            columns = [
                np.concatenate([whole[alone], heard, np.zeros(len(first), np.int64)]),
                np.concatenate([key[alone], none, run_key[first]]),
                np.concatenate([start[alone], none - 1, run_start[first]]).astype(np.int32),
                np.concatenate([start[alone], none - 1, run_start[last]]).astype(np.int32),
                np.arange(alone.sum() + len(heard) + len(first)) >= alone.sum() + len(heard),
            ]
            for a in range(0, len(columns[0]), 1 << 16):
                cut = [pa.array(c[a : a + (1 << 16)]) for c in columns]
                yield pa.RecordBatch.from_arrays(cut, ["whole", "key", "first", "last", "direct"])

    return find


def _stretch_rows(text: str, places: str, width: int):
    """Per anchor among a row's ``places`` the bytes that its windows span: seed, key, start of the first window, body."""
    q = seed_width(width)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, offsets, data, at, anchors, level in _owned(batch, text, places, width):
                # the windows of an anchor start at places in a row
                first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]])) if len(at) else np.empty(0, np.int64)
                begin, end = at[first], at[np.append(first[1:], len(at)) - 1] + width if len(at) else at
                of = np.searchsorted(offsets, begin, side="right") - 1
                size = np.concatenate([[0], np.cumsum(end - begin)])
                inside = np.arange(size[-1]) + np.repeat(begin - size[:-1], end - begin)
                buffers = [None, pa.py_buffer(size.astype(np.int32).tobytes()), pa.py_buffer(data[inside].tobytes())]
                bodies = pa.Array.from_buffers(pa.binary(), len(first), buffers)
                columns = [level[q][anchors[first]].view(np.int64), keys[of], (begin - offsets[of]).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in columns], bodies], ["seed", "key", "start", "body"])

    return find


def _repeated_runs(width: int):
    """Over stretches in the order of their seeds: runs (key, first, last) of the starts of windows that occur twice.

    Equal windows have the same seed, so only the rows of one seed are kept until the next batch.
    """

    def runs(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = byte_column(batch.column("body"))
        whole = buckets(data, width)[width]
        windows = np.diff(offsets) - width + 1
        row = np.repeat(np.arange(len(windows)), windows)
        ends = np.cumsum(windows)
        nth = np.arange(len(row)) - (ends - windows)[row]
        _, back, times = np.unique(whole[offsets[:-1][row] + nth], return_inverse=True, return_counts=True)
        hit = times[back] > 1
        new = np.concatenate([[True], row[1:] != row[:-1]]) if len(row) else hit
        first = np.flatnonzero(hit & (new | ~np.concatenate([[False], hit[:-1]])))
        last = np.flatnonzero(hit & np.concatenate([new[1:] | ~hit[1:], [True]])) if len(hit) else first
        keys, starts = batch.column("key").to_numpy(), batch.column("start").to_numpy()
        columns = [keys[row[first]], (starts[row[first]] + nth[first]).astype(np.int32), (starts[row[last]] + nth[last]).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "first", "last"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = batch if kept is None else pa.concat_batches([kept, batch])
            seeds = whole.column("seed").to_numpy()
            done = int(np.searchsorted(seeds, seeds[-1]))
            if done:
                yield runs(whole.slice(0, done))
            kept = whole.slice(done)
        if kept is not None:
            yield runs(kept)

    return find


def _parts(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The batches in slices with about ``TEXT_BYTES`` of text."""
    for batch in batches:
        _, offsets = byte_column(batch.column(text))
        for first, end in cuts(offsets, TEXT_BYTES):
            yield batch.slice(first, end - first)


def _cut(text: str, width: int):
    """Remove what the windows from ``firsts`` to ``lasts`` and the surroundings of the ``covered`` anchors span."""
    q = seed_width(width)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, text):
            data, offsets = byte_column(batch.column(text))
            n = batch.num_rows
            change = np.zeros(len(data) + 1, dtype=np.int32)
            for begins, ends, back in (("firsts", "lasts", 0), ("covered", "covered", width - q)):
                lengths = batch.column(begins).value_lengths().to_numpy()
                first, end = np.repeat(offsets[:-1], lengths), np.repeat(offsets[1:], lengths)
                np.add.at(change, np.maximum(first + batch.column(begins).flatten().to_numpy() - back, first), 1)
                np.add.at(change, np.minimum(first + batch.column(ends).flatten().to_numpy() + width, end), -1)
            gone = np.cumsum(change[:-1]) > 0
            # runs of removed bytes, which end with their text
            before = np.concatenate([[False], gone[:-1]])
            inner = offsets[:-1][offsets[:-1] < len(data)]
            before[inner] = False
            run_starts = np.flatnonzero(gone & ~before)
            last = np.concatenate([~gone[1:], [True]]) if len(gone) else gone
            ends_here = offsets[1:][offsets[1:] > 0] - 1
            last[ends_here] = True
            run_ends = np.flatnonzero(gone & last) + 1
            of = np.searchsorted(offsets, run_starts, side="right") - 1
            per_row = np.searchsorted(run_starts, offsets).astype(np.int32)
            pairs = np.stack([run_starts - offsets[of], run_ends - offsets[of]], axis=1).ravel().astype(np.int32)
            inside = pa.ListArray.from_arrays(pa.array(np.arange(0, len(pairs) + 1, 2, dtype=np.int32)), pa.array(pairs))
            spans = pa.ListArray.from_arrays(pa.array(per_row), inside)
            kept = data[~gone]
            size = np.concatenate([[0], np.cumsum(~gone)])[offsets]
            buffers = [None, pa.py_buffer(size.astype(np.int32).tobytes()), pa.py_buffer(kept.tobytes())]
            keeps = pa.Array.from_buffers(pa.binary(), n, buffers)
            names = [name for name in batch.schema.names if name not in ("firsts", "lasts", "covered")]
            yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in names], spans, keeps], [*names, "spans", "kept"])

    return cut


def remove_repeats(docs: DataFrame, width: int = 200, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, text, spans (array of removed [start, end) byte ranges) and kept (the other bytes).

    A byte goes if a string of ``width`` bytes over it also starts at any other place of any row,
    its own included; strings are judged on the input, overlapping ones count, none crosses rows. Null texts count
    as empty and stay null in ``text``; equal rows are different places, so they lose everything from ``width`` bytes on. Other
    columns are left out, so their names cannot clash.

    Not all suffixes are bucketed but one anchor per window, about one in (width - q) / 2 bytes:
    1. Anchors go into buckets by their first q bytes (a power of two of about ``width`` / 3); the only one of a bucket leaves.
    2. Buckets are refined by all that the windows of an anchor can reach. Anchors with the same
       surroundings are covered; one of each such class goes on for the others.
    3. The windows of what is left are refined to ``width`` bytes, the identifiers of each length giving those
       of the double; windows in a bucket with another one are repeated.
    For step 3 small buckets of step 1 come together with the bytes that their windows span, in the order of the buckets; the
    windows of large ones are counted before the shuffle and joined back, which Spark may split. Otherwise only
    fingerprints move, but for one exchange of the texts, which the plan uses again.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"), F.xxhash64(F.col(key), F.col(text)).alias("key"), F.col(text).alias("text")
    )
    kinds = "key bigint, pos int, seed bigint, around bigint, direct boolean"
    anchors = rows.select("key", "text").mapInArrow(_anchor_rows("text", width), kinds)
    # direct rows need no company, so they are dealt out by themselves
    deal = F.when(F.col("direct"), F.xxhash64("key", "pos")).otherwise(F.col("seed"))
    holders = F.sum(F.when(F.col("direct"), 0).otherwise(1)).over(Window.partitionBy("deal"))
    known = F.col("direct") | ((F.col("pos") >= 0) & (F.col("holders") > 1))
    shared = stage(
        anchors.withColumn("deal", deal).withColumn("holders", holders).filter(known).select("key", "pos", "seed", "around"), "anchors"
    )
    classes = shared.groupBy("around").agg(F.count("*").alias("n"), F.min("key").alias("speaker")).filter("n > 1")
    goes_on = F.col("n").isNull() | (F.col("key") == F.col("speaker"))
    told = stage(
        shared.join(classes, "around", "left").select("key", "pos", "seed", F.col("n").isNotNull().alias("twin"), goes_on.alias("goes_on")), "told"
    )
    groups = told.filter("goes_on").groupBy("seed").agg(F.count("*").alias("n"))
    # only anchors that go on ask for the size of their bucket, dealt out so that no bucket is one task; few buckets are large
    salts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt")
    large = groups.filter(F.col("n") > LIGHT).select("seed", F.lit(True).alias("large"), salts)
    salt = F.pmod(F.xxhash64("key", "pos"), F.lit(SALTS)).cast("int")
    asking = told.filter("goes_on").withColumn("salt", salt).join(large, ["seed", "salt"], "left").drop("salt")
    sized = asking.unionByName(told.filter("not goes_on").withColumn("large", F.lit(None).cast("boolean")))
    pick = lambda c: F.collect_set(F.when(c, F.col("pos")))
    lists = stage(
        sized.groupBy("key").agg(
            pick(F.col("goes_on") & F.col("large").isNull()).alias("light"),
            pick(F.col("goes_on") & F.col("large").isNotNull()).alias("heavy"),
            pick(F.col("twin")).alias("covered"),
        ),
        "places",
    )
    open_rows = rows.join(lists.drop("covered"), "key")
    stretches = open_rows.mapInArrow(_stretch_rows("text", "light", width), "seed bigint, key bigint, start int, body binary")
    runs = stretches.repartition("seed").sortWithinPartitions("seed").mapInArrow(_repeated_runs(width), "key bigint, first int, last int")
    heavy = open_rows.filter(F.size("heavy") > 0).mapInArrow(
        _window_rows("text", "heavy", width), "whole bigint, key bigint, first int, last int, direct boolean"
    )
    single = heavy.filter("not direct")
    twice = single.groupBy("whole").agg(F.count("*").alias("n")).filter("n > 1").select("whole")
    again = single.filter("first >= 0").join(twice, "whole")
    runs = runs.union(heavy.filter("direct").select("key", "first", "last")).union(again.select("key", "first", "last"))
    found = runs.groupBy("key").agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    none = F.array().cast("array<int>")
    whole = rows.join(lists.select("key", "covered"), "key", "left").join(found, "key", "left")
    whole = whole.select(
        "doc_id",
        "text",
        F.coalesce("runs.first", none).alias("firsts"),
        F.coalesce("runs.last", none).alias("lasts"),
        F.coalesce("covered", none).alias("covered"),
    )
    schema = whole.select("doc_id", "text", F.array(F.array(F.lit(0))).alias("spans"), F.encode(F.lit(""), "UTF-8").alias("kept")).schema
    return whole.mapInArrow(_cut("text", width), schema)
