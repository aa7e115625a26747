"""Conversations that lost their structure: faults by row, and the cheapest edits that give ``(s?(ua)+)?``.

The edits of a conversation come from a dynamic programme over four states (nothing yet, after system, user, assistant).
Its backward cost vectors are stored at checkpoints alone: a conversation of n rows is cut into about sqrt(n) blocks of about
sqrt(n) rows, the costs of crossing a block are a 4 x 4 matrix, and the vectors at the cuts are min-plus products of those. Each block is
then computed again from the vector at its end and walked forward from each state, and the walks are put on end. So no task holds
more than sqrt(n) rows or checkpoints of a conversation, however long; only its digest, a sequential hash, reads
its blocks in one stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: Rows of a block, at least; a longer conversation has blocks of the square root of its rows.
BLOCK_ROWS = 64
#: Block rows that are walked at once.
WALK_ROWS = 1 << 18

_NONE, _S, _U, _A = range(4)
_INF = 1 << 40
#: The state that a user or assistant turn, whichever may come, leads to.
_NEXT = np.array([_U, _U, _A, _U])
#: The state that a kept row of role class r leads to from each state; -1: it may not come.
_KEPT = np.full((4, 4), -1)
_KEPT[[_NONE, _NONE, _S, _A, _U], [_S, _U, _U, _U, _A]] = [_S, _U, _U, _U, _A]
#: Inserts that end a conversation from each state, and their cost.
_ENDING = ["", "IJ", "J", ""]
_END = np.array([INSERT * len(e) for e in _ENDING], dtype=np.int64)

BLANK = "[^\\x20\\x09-\\x0D]"
ENDED = "[.!?][\\x20\\x09-\\x0D]*\\z"


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, each row damaged as crc32 of ``conv_id:turn`` decides; nulls in role, text and that key count as one blank.

    Modulo 20: 0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4 makes it a user's.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    how = F.crc32(F.encode(key, "UTF-8")) % 20
    text = F.coalesce(F.col("text"), blank)
    text = F.when(how == 1, "").when(how == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(how == 4, "user").otherwise(F.coalesce(F.col("role"), blank))
    copies = F.explode(F.when(how == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.filter(how != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


@dataclass
class Repair:
    """``summary``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. ``blocks``: conv_id, block, edits, one row a block."""

    summary: DataFrame
    ordered: DataFrame
    blocks: DataFrame

    def turns(self) -> DataFrame:
        """conv_id, block, place, turns (array of edit, role, text): what each row has become, with the turns put in before it.

        The last block of a conversation has one more row, without a place, for turns put in at its end.
        """
        piece = F.regexp_extract_all("edits", F.lit("([IJ]*[DKRS])"), 1)
        own = self.blocks.select("conv_id", "block", F.explode(F.arrays_zip("places", piece.alias("piece"))).alias("p"))
        own = own.select("conv_id", "block", F.col("p.places").alias("place"), F.col("p.piece").alias("piece"))
        rows = own.join(self.ordered.select("place", "role", "text"), "place")
        last = self.blocks.filter("last").select(
            "conv_id", "block", F.lit(None).cast("long").alias("place"), F.regexp_extract("edits", "([IJ]*)$", 1).alias("piece"),
            F.lit("").alias("role"), F.lit("").alias("text"),
        )
        letter = lambda x: F.when(x.isin("R", "S"), "R").when(x.isin("I", "J"), "I").otherwise(x)
        role = lambda x: F.when(x.isin("I", "R"), "user").when(x.isin("J", "S"), "assistant").otherwise(F.col("role"))
        turn = lambda x: F.struct(
            letter(x).alias("edit"), role(x).alias("role"), F.when(x.isin("I", "J"), "").otherwise(F.col("text")).alias("text")
        )
        letters = F.filter(F.split("piece", ""), lambda x: ~x.isin("D", ""))
        every = rows.select("conv_id", "block", "place", "piece", "role", "text").unionByName(last)
        return every.select("conv_id", "block", "place", F.transform(letters, turn).alias("turns"))

    def digests(self) -> DataFrame:
        """conv_id, repaired_sha256 of ``role:text`` lines; only conversations that keep a turn."""
        line = lambda t: F.concat(t["role"], F.lit(":"), t["text"])
        lines = F.sort_array(F.collect_list(F.struct(F.col("place").isNull().alias("end"), "place", F.transform("turns", line).alias("lines"))))
        texts = self.turns().filter(F.size("turns") > 0).groupBy("conv_id", "block").agg(lines.alias("rows"))
        texts = texts.select("conv_id", "block", F.array_join(F.flatten("rows.lines"), "\n").alias("text"))
        kind = self.ordered.schema["conv_id"].dataType.simpleString()
        dealt = texts.repartition("conv_id").sortWithinPartitions("conv_id", "block").select("conv_id", "text")
        return dealt.mapInArrow(_hash_streams, f"conv_id {kind}, repaired_sha256 string")


def _hash_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each run of rows with one id; at most a batch of text is held."""
    schema, run, state = None, None, None
    for batch in batches:
        ids, out = batch.column(0), ([], [])
        schema = pa.schema([("conv_id", ids.type), ("repaired_sha256", pa.string())])
        for conv, text in zip(ids.to_pylist(), batch.column(1)):
            if state is None or conv != run:
                if state is not None:
                    out[0].append(run)
                    out[1].append(state.hexdigest())
                run, state = conv, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(text.as_py().encode())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, schema.types)], schema=schema)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(([run], [state.hexdigest()]), schema.types)], schema=schema)


def _order(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, print, place: places ascend with conversation, turn (nulls first), role and print of the text."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blank = F.lit(" ")
    plain = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    plain = plain.withColumn("print", F.sha2(F.encode("text", "UTF-8"), 256)).withColumn("_row", F.monotonically_increasing_id())
    keys = ["conv_id", "turn", "role", "print", "_row"]
    dealt = plain.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return stage(dealt.drop("_row").withColumn("place", F.monotonically_increasing_id()), "turns")


def _same(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Join by keys that may be null."""
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = [left[k].eqNullSafe(right[f"_{k}"]) for k in keys]
    return left.join(right, on, how).drop(*[f"_{k}" for k in keys])


def _coded(ordered: DataFrame) -> DataFrame:
    """conv_id, turn, place, part, blank, duplicate, truncated, code of each row."""
    first = ordered.groupBy("conv_id", "role", "print").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    blank = ~F.col("text").rlike(BLANK)
    initial = F.substring("role", 1, 1)
    rows = ordered.select(
        "conv_id",
        "turn",
        "place",
        F.shiftright("place", 33).alias("part"),
        F.when(initial == "s", _S).when(initial == "u", _U).when(initial == "a", _A).otherwise(_NONE).alias("class"),
        blank.alias("blank"),
        F.col("text").rlike(ENDED).alias("ended"),
    ).join(first, "place", "left")
    duplicate = ~F.col("blank") & F.col("first").isNull()
    truncated = ~F.col("blank") & F.col("first").isNotNull() & ~F.col("ended")
    fault = F.when(F.col("blank") | F.col("first").isNull(), 2).when(~F.col("ended"), 1).otherwise(0)
    code = F.char(F.lit(97) + 3 * F.col("class") + fault)
    return rows.select("conv_id", "turn", "place", "part", "blank", duplicate.alias("duplicate"), truncated.alias("truncated"), code.alias("code"))


def _blocks(coded: DataFrame, least: int) -> DataFrame:
    """conv_id, block, last, places and codes of its rows in order. A partition holds a conversation's rows of one range, so starts need one row per range."""
    runs = coded.groupBy("conv_id", "part").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("conv_id")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "conv_id", "part", (F.col("start") - F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("zero"), F.sum("n").over(whole).alias("all")
    )
    size = F.greatest(F.lit(least), F.ceil(F.sqrt("all")))
    numbered = _same(coded.select("conv_id", "part", "place", "code"), runs, "conv_id", "part")
    numbered = numbered.select(
        "conv_id", F.floor((F.col("place") - F.col("zero")) / size).cast("long").alias("block"), F.floor((F.col("all") - 1) / size).cast("long").alias("end"), "place", "code"
    )
    rows = F.sort_array(F.collect_list(F.struct("place", "code")))
    found = numbered.groupBy("conv_id", "block").agg(F.max("end").alias("end"), rows.alias("rows"))
    codes = F.array_join(F.col("rows.code"), "")
    return found.select("conv_id", "block", (F.col("block") == F.col("end")).alias("last"), F.col("rows.place").alias("places"), codes.alias("codes"))


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Role class and fault of each row of each block, filled up with -1, and the numbers of rows."""
    texts = column.to_pylist()
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    grid = np.full((len(texts), int(sizes.max(initial=0))), -1, dtype=np.int64)
    grid[np.arange(grid.shape[1]) < sizes[:, None]] = np.frombuffer("".join(texts).encode(), dtype=np.uint8) - 97
    return np.where(grid < 0, -1, grid // 3), np.where(grid < 0, -1, grid % 3), sizes


def _back(after: np.ndarray, role: np.ndarray, fault: np.ndarray) -> np.ndarray:
    """Costs before a row of each block from those after it: (blocks, 4) or, for several ends, (blocks, 4, ends)."""
    shape = (-1,) + (1,) * (after.ndim - 2)
    extra = np.where(fault == 1, TRUNCATED, 0).reshape(shape)
    barred = np.where(fault == 2, _INF, 0).reshape(shape)
    out = np.empty_like(after)
    every = np.arange(len(after))
    for state in range(4):
        to = _KEPT[state][role]
        keep = after[every, np.maximum(to, 0)] + extra + barred + np.where(to < 0, _INF, 0).reshape(shape)
        turned = after[:, _NEXT[state]] + REROLE + extra + barred
        out[:, state] = np.minimum(np.minimum(after[:, state] + DELETE, keep), turned)
    for _ in range(2):  # more than two turns put in at one place never pay
        out = np.minimum(out, out[:, _NEXT] + INSERT)
    out = np.minimum(out, _INF)
    absent = (role < 0).reshape((-1,) + (1,) * (after.ndim - 1))
    return np.where(absent, after, out)


def _chunks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of blocks whose grid has about WALK_ROWS cells."""
    first = 0
    while first < len(sizes):
        widest = np.maximum.accumulate(sizes[first:]) * np.arange(1, len(sizes) - first + 1)
        end = first + max(1, int(np.searchsorted(widest, WALK_ROWS, side="right")))
        yield first, end
        first = end


def _lengths(column: pa.Array) -> np.ndarray:
    return np.array([len(t) for t in column.to_pylist()], dtype=np.int64)


def _with(batch: pa.RecordBatch, drop: tuple[str, ...] = (), **new: pa.Array) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n not in drop]
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], *new.values()], [*kept, *new])


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list of equal length per row."""
    width = rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width), pa.array(rows.reshape(-1), kind))


def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cost matrix of each block, the classes of its first and last row, and its illegal neighbours."""
    for batch in batches:
        for first, end in _chunks(_lengths(batch.column("codes"))):
            part = batch.slice(first, end - first)
            role, fault, sizes = _codes(part.column("codes"))
            costs = np.where(np.eye(4, dtype=bool), 0, _INF)[None].repeat(len(sizes), axis=0)
            for i in range(role.shape[1] - 1, -1, -1):
                costs = _back(costs, role[:, i], fault[:, i])
            wrong = (_illegal(role[:, :-1], role[:, 1:]) & (role[:, 1:] >= 0)).sum(axis=1)
            last = role[np.arange(len(sizes)), sizes - 1]
            new = {"moves": _lists(costs.reshape(len(sizes), 16), pa.int64())}
            new |= {n: pa.array(v.astype(np.int64)) for n, v in (("opens", role[:, 0]), ("closes", last), ("illegal", wrong))}
            yield _with(part, ("codes",), **new)


def _illegal(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    legal = ((before == _S) & (after == _U)) | ((before == _U) & (after == _A)) | ((before == _A) & (after == _U))
    return ~legal


def _checkpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation its cost, illegal neighbours and the cost vector at the end of each block."""
    for batch in batches:
        costs, wrong, vectors = [], [], []
        for moves, opens, closes, illegal in zip(*[batch.column(n).to_pylist() for n in ("moves", "opens", "closes", "illegal")]):
            ends = np.empty((len(moves), 4), dtype=np.int64)
            vector = _END
            for b in range(len(moves) - 1, -1, -1):
                ends[b] = vector
                vector = (np.array(moves[b]).reshape(4, 4) + vector).min(axis=1)
            costs.append(int(vector[_NONE]))
            wrong.append(sum(illegal) + int(_illegal(np.array(closes[:-1]), np.array(opens[1:])).sum()))
            vectors.append(ends.tolist())
        new = {"cost": pa.array(costs, pa.int64()), "illegal": pa.array(wrong, pa.int64())}
        yield _with(batch, ("moves", "opens", "closes", "illegal"), **new, ends=pa.array(vectors, pa.list_(pa.list_(pa.int64()))))


def _pieces() -> np.ndarray:
    """The letters of a row's edits by state before, turns put in, and edit (D, K, R); I, J and R, S put in or rename a user, an assistant."""
    out = np.empty((4, 3, 3), dtype=object)
    for state in range(4):
        now, put = state, ""
        for n in range(3):
            out[state, n] = [put + "D", put + "K", put + ("S" if now == _U else "R")]
            put += "J" if now == _U else "I"
            now = _NEXT[now]
    return out


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ASCII-least tight edits of each block from each state, and the states that they lead to."""
    pieces = _pieces()
    for batch in batches:
        for first, end in _chunks(_lengths(batch.column("codes"))):
            part = batch.slice(first, end - first)
            role, fault, sizes = _codes(part.column("codes"))
            n, width = role.shape
            costs = np.empty((width + 1, n, 4), dtype=np.int64)
            costs[width] = np.array(part.column("ends").to_pylist(), dtype=np.int64)
            for i in range(width - 1, -1, -1):
                costs[i] = _back(costs[i + 1], role[:, i], fault[:, i])
            walks, exits = [], []
            every = np.arange(n)
            for start in range(4):
                state = np.full(n, start)
                letters = np.empty((n, width), dtype=object)
                for i in range(width):
                    here, after, before = costs[i], costs[i + 1], state
                    put = np.zeros(n, dtype=np.int64)
                    for _ in range(2):
                        now = here[every, state]
                        tight = (now != DELETE + after[every, state]) & (now == INSERT + here[every, _NEXT[state]]) & (role[:, i] >= 0)
                        state = np.where(tight, _NEXT[state], state)
                        put += tight
                    now, extra = here[every, state], np.where(fault[:, i] == 1, TRUNCATED, 0)
                    to = _KEPT[state, role[:, i]]
                    keep = (to >= 0) & (fault[:, i] < 2) & (now == extra + after[every, np.maximum(to, 0)])
                    edit = np.where(now == DELETE + after[every, state], 0, np.where(keep, 1, 2))
                    letters[:, i] = pieces[before, put, edit]
                    state = np.where(role[:, i] < 0, before, np.choose(edit, [state, np.maximum(to, 0), _NEXT[state]]))
                walks.append(["".join(row[:size]) for row, size in zip(letters.tolist(), sizes.tolist())])
                exits.append(state)
            new = {"walks": pa.array(list(map(list, zip(*walks))), pa.list_(pa.string())), "exits": _lists(np.stack(exits, axis=1), pa.int32())}
            yield _with(part, ("codes", "ends"), **new)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation the state before each block, and the state at its end."""
    for batch in batches:
        entries, final = [], []
        for exits in batch.column("exits").to_pylist():
            states = [_NONE]
            for block in exits:
                states.append(block[states[-1]])
            entries.append(states[:-1])
            final.append(states[-1])
        yield _with(batch, ("exits",), entries=pa.array(entries, pa.list_(pa.int32())), final=pa.array(final, pa.int32()))


def repair(rows: DataFrame, least: int = BLOCK_ROWS) -> Repair:
    """Faults and cheapest edits of ``conv_id, turn, role, text``; other columns are left out.

    Rows go by turn, nulls first, equal ones by role and SHA-256 of the text. A null conv_id is a conversation, null roles and texts count as one blank,
    repeated rows as duplicates. Each row's first fault counts: blank, duplicate (role and text were seen earlier), truncated (its last character but
    blanks is none of ``.!?``). illegal counts neighbours whose role initials are not su, ua or au.

    Edits: keep a row (0), make it the user's or assistant's (3), delete it (4; the only one for blank and duplicate rows), put in an empty user or
    assistant turn (3); a truncated row that stays costs 3 more. audit is the ASCII-least of the cheapest edits by initials. An empty table gives no rows.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    ordered = _order(rows)
    coded = stage(_coded(ordered), "coded")
    blocks = stage(_blocks(coded, least), "blocks")
    crossed = blocks.select("conv_id", "block", "codes").mapInArrow(
        _cross, f"conv_id {kind}, block long, moves array<bigint>, opens long, closes long, illegal long"
    )
    # at most sqrt(n) rows of a conversation of n rows
    listed = F.sort_array(F.collect_list(F.struct("block", "moves", "opens", "closes", "illegal")))
    crossed = crossed.groupBy("conv_id").agg(listed.alias("b"))
    crossed = crossed.select("conv_id", *[F.col(f"b.{c}").alias(c) for c in ("moves", "opens", "closes", "illegal")])
    costs = stage(crossed.mapInArrow(_checkpoints, f"conv_id {kind}, cost long, illegal long, ends array<array<bigint>>"), "checkpoints")
    ends = costs.select("conv_id", F.posexplode("ends").alias("block", "ends")).withColumn("block", F.col("block").cast("long"))
    asked = _same(blocks.select("conv_id", "block", "codes"), ends, "conv_id", "block")
    walked = stage(asked.mapInArrow(_walk, f"conv_id {kind}, block long, walks array<string>, exits array<int>"), "walks")
    chained = walked.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "exits"))).alias("b"))
    chained = chained.select("conv_id", F.col("b.exits").alias("exits")).mapInArrow(_chain, f"conv_id {kind}, entries array<int>, final int")
    entries = chained.select("conv_id", "final", F.posexplode("entries").alias("block", "entry")).withColumn("block", F.col("block").cast("long"))
    found = _same(_same(blocks.select("conv_id", "block", "last", "places"), walked, "conv_id", "block"), entries, "conv_id", "block")
    ending = F.element_at(F.array(*map(F.lit, _ENDING)), F.col("final") + 1)
    edits = F.concat(F.element_at("walks", F.col("entry") + 1), F.when(F.col("last"), ending).otherwise(""))
    edited = stage(found.select("conv_id", "block", "last", "places", edits.alias("edits")), "edits")
    parts = F.sort_array(F.collect_list(F.struct("block", "edits")))
    audit = edited.groupBy("conv_id").agg(parts.alias("p"))
    audit = audit.select("conv_id", F.translate(F.array_join(F.col("p.edits"), ""), "JS", "IR").alias("audit"))
    faults = coded.groupBy("conv_id").agg(*[F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")])
    turns = coded.groupBy("conv_id", "turn").agg(F.lit(1)).filter("turn IS NOT NULL")
    span = (F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).cast("long")
    gaps = turns.groupBy("conv_id").agg(span.alias("gaps"))
    summary = _same(_same(_same(faults, costs.select("conv_id", "cost", "illegal"), "conv_id"), audit, "conv_id"), gaps, "conv_id", how="left")
    summary = summary.select(
        "conv_id", F.coalesce("gaps", F.lit(0).cast("long")).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )
    return Repair(summary, ordered, edited)


def repair_report(original: DataFrame, repaired: Repair) -> DataFrame:
    """One row per conv_id of ``original``: the summary and the digest of its repaired lines; zeros and empty texts where no row is left."""
    ids = original.select("conv_id").distinct()
    found = _same(_same(ids, repaired.summary, "conv_id", how="left"), repaired.digests(), "conv_id", how="left")
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return found.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
