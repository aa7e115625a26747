"""Word counts and dictionaries."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.functions.letters import word_blocks
from tidemark.operators.numbering import row_numbers
from tidemark.operators.trips import count_by, top_k
from tidemark.session import BROADCAST_BYTES, cut, small_side

# Fixed value: words kept in a dictionary.
DICTIONARY_SIZE = 20_000
# Words that a dictionary beyond the broadcast bound still broadcasts.
HEAD = 1 << 20
# Tasks that share one of its other words.
SALTS = 8
# Words that a task's summary holds, and bytes of words that are counted before they are merged into it.
SUMMARY_SIZE = 1 << 20
SUMMARY_BYTES = 64 * 1024 * 1024
# Characters of text whose pieces are numbered together.
PIECE_CHARS = 8 * 1024 * 1024
# Bytes of a broadcast row of fingerprints.
ROW_BYTES = 64
# Blocks of a Bloom filter in one row, a power of two.
CHUNK = 256
PRINTS = ["h1", "h2"]


def words_of(docs: DataFrame, tokens: Column, key: str = "doc_id", keep: list[str] = ()) -> DataFrame:
    """One row per token occurrence: ``key, *keep, word``."""
    return docs.select(key, *keep, F.explode(tokens).alias("word"))


def word_counts(words: DataFrame) -> DataFrame:
    """Occurrences per word; partial sums run before the shuffle, so frequent words do no harm."""
    return count_by(words, "word", name="cnt")


def line_word_counts(lines: DataFrame, text: str = "value") -> DataFrame:
    """Word count over single-space splits; empty tokens count."""
    return word_counts(lines.select(F.explode(T.split_on_space(F.col(text))).alias("word")))


def dictionary(words: DataFrame, f: int = DICTIONARY_SIZE) -> DataFrame:
    """The f most frequent words with their rank: ``word, pos, cnt``, pos from 0.

    Equal counts go by the word. A corpus with fewer words gives a shorter
    dictionary. The count of the f-th word is found first, from the numbers of words by
    count, so that only f words and those tied with the last one are ordered.
    """
    return _ranked(word_counts(words), f)


def _reach(counts: DataFrame, f: int, cnt: str = "cnt") -> DataFrame:
    """One row ``reach``: the f-th largest count, null with fewer words."""
    # How many words are at least as frequent, by count: one row per distinct count.
    tallies = counts.groupBy(cnt).agg(F.count(F.lit(1)).alias("n"))
    reached = F.sum("n").over(Window.orderBy(F.col(cnt).desc()))
    return tallies.withColumn("reached", reached).filter(F.col("reached") >= f).agg(F.max(cnt).alias("reach"))


def _ranked(counts: DataFrame, f: int) -> DataFrame:
    """The f rows with the largest counts, numbered; the numbers of a long dictionary come from ranges, not from one task."""
    at_least = counts.filter(F.col("cnt") >= F.coalesce(_reach(counts, f).scalar(), F.lit(0)))
    if f > HEAD:
        numbered = row_numbers(at_least, F.col("cnt").desc(), F.col("word"), name="pos").filter(F.col("pos") < f)
        return numbered.select("word", F.col("pos").cast("int").alias("pos"), "cnt")
    rank = F.row_number().over(Window.orderBy(F.col("cnt").desc(), "word")) - 1
    return top_k(at_least, f, "cnt", "word").select("word", rank.alias("pos"), "cnt")


def _summaries(size: int):
    """Per task: at most ``size`` words with a count that is too low by no more than ``lost``, which ends the task's rows.

    What was counted since the last merge is added to the words held; if these are more than ``size``, the count of the first
    word beyond them is taken off all counts, and words left without a count go.
    """

    def merged(parts: list[pa.Table]) -> tuple[pa.Table, int]:
        held = pa.concat_tables(parts).combine_chunks().group_by("word").aggregate([("cnt", "sum")])
        counts = held.column("cnt_sum").to_numpy()
        off = 0
        if len(counts) > size:
            off = int(np.partition(counts, len(counts) - size - 1)[len(counts) - size - 1])
        above = counts > off
        return pa.table({"word": held.column("word").filter(pa.array(above)), "cnt": counts[above] - off}), off

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        lost = 0
        for batch in batches:
            pairs = pc.value_counts(batch.column(0).cast(pa.large_string()))
            parts.append(pa.table({"word": pairs.field("values"), "cnt": pairs.field("counts")}))
            if sum(len(p) for p in parts[1:]) >= size or sum(p.nbytes for p in parts[1:]) > SUMMARY_BYTES:
                held, off = merged(parts)
                parts, lost = [held], lost + off
        if parts:
            held, off = merged(parts)
            none = pa.nulls(len(held), pa.int64())
            rows = pa.table({"word": held.column("word").cast(pa.string()), "cnt": held.column("cnt"), "lost": none})
            yield from rows.to_batches(max_chunksize=1 << 16)
            end = [pa.nulls(1, pa.string()), pa.array([0], pa.int64()), pa.array([lost + off], pa.int64())]
            yield pa.RecordBatch.from_arrays(end, ["word", "cnt", "lost"])

    return summarise


def frequent_words(words: DataFrame, f: int = DICTIONARY_SIZE, size: int = SUMMARY_SIZE) -> DataFrame:
    """The rows of ``dictionary``, from Misra-Gries summaries of each task: for corpora with far more words than ``size``.

    1. Each task keeps ``size`` words with counts that are too low by at most what the task took off; the sums of these counts
       are too low by at most ``lost``, the sum over the tasks. No more than tasks x ``size`` rows are shuffled.
    2. Words whose count may reach the f-th largest sum are candidates, and only they are counted again, behind a Bloom filter;
       what else passes the filter is counted rightly too, so it does no harm.
    Where no task took anything off, the sums are the counts. Where ``lost`` is not below the f-th largest sum, a
    word that no summary holds might belong in: then all words are counted as in ``dictionary``. The result is the same each time.
    """
    found = cut(words.select("word").mapInArrow(_summaries(size), "word string, cnt bigint, lost bigint"))
    held = found.filter(F.col("lost").isNull()).groupBy("word").agg(F.sum("cnt").alias("cnt"))
    lost = found.agg(F.coalesce(F.sum("lost"), F.lit(0)).alias("lost")).scalar()
    lost, reach = _reach(held, f).select(lost.alias("lost"), "reach").first()
    if lost == 0:
        return _ranked(held, f)
    if reach is None or reach <= lost:
        return dictionary(words, f)
    candidates = cut(held.filter(F.col("cnt") + lost >= reach).select(*_prints()))
    passed = _may_hold(words.select("word", *_prints()), candidates).select("word")
    return _ranked(word_counts(passed), f)


def term_counts(
    words: DataFrame, vocab: DataFrame, f: int = DICTIONARY_SIZE, key: str = "doc_id", head: int | None = None
) -> DataFrame:
    """Dictionary words per document: ``key, pos, cnt``.

    Documents without a dictionary word vanish. A document adds at most f rows
    to the shuffle, however often its words repeat.
    """
    return count_by(known_words(words, vocab, f, head), key, "pos", name="cnt")


def _letter_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: words and their counts, added up while they are fewer than ``SUMMARY_SIZE`` and ``SUMMARY_BYTES`` long."""
    parts: list[pa.Table] = []

    def added() -> pa.Table:
        held = pa.concat_tables(parts).combine_chunks().group_by("word").aggregate([("cnt", "sum")])
        return pa.table({"word": held.column("word"), "cnt": held.column("cnt_sum")})

    for batch in batches:
        for _, _, found in word_blocks(batch.column(0)):
            _, at, cnt = np.unique(found.print, return_index=True, return_counts=True)
            parts.append(pa.table({"word": found.text(at), "cnt": cnt.astype(np.int64)}))
            if sum(len(p) for p in parts[1:]) >= SUMMARY_SIZE or sum(p.nbytes for p in parts[1:]) > SUMMARY_BYTES:
                parts = [added()]
                if len(parts[0]) >= SUMMARY_SIZE // 2 or parts[0].nbytes > SUMMARY_BYTES // 2:
                    yield from parts.pop().to_batches(max_chunksize=1 << 16)
    if parts:
        yield from added().to_batches(max_chunksize=1 << 16)


def letter_dictionary(docs: DataFrame, f: int = DICTIONARY_SIZE, text: str = "text") -> DataFrame:
    """``dictionary`` of the runs of ASCII letters of ``text``, lower-cased: those of ``text.tokenize``, counted in the tasks that read them."""
    counts = docs.select(text).mapInArrow(_letter_counts, "word string, cnt bigint")
    return _ranked(counts.groupBy("word").agg(F.sum("cnt").alias("cnt")), f)


def _word_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprint and ``pos`` of each word; a word of a dictionary is one run of letters."""
    for batch in batches:
        for first, end, found in word_blocks(batch.column("word")):
            yield pa.RecordBatch.from_arrays([pa.array(found.print.view(np.int64)), batch.column("pos").slice(first, end - first)], ["print", "pos"])


class _Positions:
    """Positions by fingerprint: a slot per upper bits, and a search where words of the dictionary share a slot."""

    def __init__(self, prints: np.ndarray, pos: np.ndarray):
        order = np.argsort(prints)
        self.prints, self.pos = prints[order], pos[order]
        self.shift = np.uint64(64 - max(1, (8 * len(prints)).bit_length()))
        slots = (self.prints >> self.shift).astype(np.int64)
        self.at = np.zeros(1 << int(64 - self.shift), dtype=np.int32)
        self.at[slots] = np.arange(len(slots))
        self.shared = np.bincount(slots, minlength=len(self.at)) > 1

    def __call__(self, prints: np.ndarray) -> np.ndarray:
        """The position of each fingerprint, -1 for none."""
        if not len(self.prints):
            return np.full(len(prints), -1)
        slot = (prints >> self.shift).astype(np.int64)
        at = self.at[slot]
        many = np.flatnonzero(self.shared[slot])
        at[many] = np.minimum(np.searchsorted(self.prints, prints[many]), len(self.prints) - 1)
        return np.where(self.prints[at] == prints, self.pos[at], -1)


def _letter_term_counts(positions, f: int, key: str, mark: int | None):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _Positions(*positions.value)
        for batch in batches:
            for first, end, found in word_blocks(batch.column(1)):
                ids = batch.column(0).slice(first, end - first).dictionary_encode(null_encoding="encode")
                pos = find(found.print)
                known = np.flatnonzero(pos >= 0)
                own = ids.indices.to_numpy(zero_copy_only=False).astype(np.int64)[found.row[known]]
                cells, cnt = np.unique(own * f + pos[known], return_counts=True)
                doc = ids.dictionary.take(pa.array(cells // f))
                yield pa.RecordBatch.from_arrays([doc, pa.array((cells % f).astype(np.int32)), pa.array(cnt.astype(np.int64))], [key, "pos", "cnt"])
                if mark is not None:
                    each = np.full(len(ids.dictionary), mark, np.int32), np.zeros(len(ids.dictionary), np.int64)
                    yield pa.RecordBatch.from_arrays([ids.dictionary, *map(pa.array, each)], [key, "pos", "cnt"])

    return count


def letter_term_counts(
    docs: DataFrame, vocab: DataFrame, f: int = DICTIONARY_SIZE, key: str = "doc_id", text: str = "text", mark: int | None = None
) -> DataFrame:
    """``term_counts`` of the runs of ASCII letters of ``text``, lower-cased, counted in the tasks that read the texts.

    The dictionary goes to the tasks as 64-bit fingerprints and positions; one beyond the broadcast bound is joined as in ``term_counts``. Rows meet
    by ``key`` alone, so a later window or join by it needs no further shuffle; an id with very many lines adds a row per position and block of
    text. With a ``mark`` each document also has a row of count 0 at that position, so none vanishes.
    """
    if f * ROW_BYTES > BROADCAST_BYTES:
        counts = term_counts(words_of(docs, T.tokenize(F.col(text)), key), vocab, f, key)
        marks = docs.select(key, F.lit(mark).cast("int").alias("pos"), F.lit(0).cast("bigint").alias("cnt")).distinct()
        return counts if mark is None else counts.unionByName(marks)
    side = vocab.filter(F.col("pos") < f).select("word", "pos").mapInArrow(_word_prints, "print bigint, pos int").toArrow()
    pairs = side["print"].to_numpy().view(np.uint64), side["pos"].to_numpy()
    rows = docs.select(key, text)
    schema = rows.select(key, F.lit(0).alias("pos"), F.lit(0).cast("bigint").alias("cnt")).schema
    counted = rows.mapInArrow(_letter_term_counts(docs.sparkSession.sparkContext.broadcast(pairs), f, key, mark), schema)
    return counted.repartition(key).groupBy(key, "pos").agg(F.sum("cnt").alias("cnt"))


def _piece_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: pieces between blanks (those of ``text.BLANKS`` are Python's) and their counts, added up while they are few and short."""
    found: Counter[str] = Counter()
    held, chars = 0, 0

    def rows() -> Iterator[pa.RecordBatch]:
        table = pa.table({"piece": pa.array(list(found), pa.string()), "cnt": pa.array(list(found.values()), pa.int64())})
        found.clear()
        yield from table.to_batches(max_chunksize=1 << 16)

    for batch in batches:
        for text in batch.column(0).to_pylist():
            found.update((text or "").split())
            if len(found) > held:  # a new piece is no longer than its text
                held, chars = len(found), chars + len(text)
                if held >= SUMMARY_SIZE or chars > SUMMARY_BYTES:
                    yield from rows()
                    held, chars = 0, 0
    yield from rows()


def piece_dictionary(docs: DataFrame, text: Column, word: Callable[[Column], Column], f: int = DICTIONARY_SIZE) -> DataFrame:
    """``dictionary`` of the words that ``word`` makes of the pieces of ``text`` between blanks; null for none.

    Pieces are counted in the tasks that read the texts, so a word is worked out once a task and piece, not once an occurrence.
    """
    pieces = docs.select(text.alias("text")).mapInArrow(_piece_counts, "piece string, cnt bigint")
    counts = pieces.select(word(F.col("piece")).alias("word"), "cnt").filter(F.col("word").isNotNull())
    return _ranked(counts.groupBy("word").agg(F.sum("cnt").alias("cnt")), f)


def _piece_rows(key: pa.Array, texts: list[str | None]) -> Iterator[pa.RecordBatch]:
    """Each piece between spaces of a run of texts, with the keys of its texts and its counts there."""
    number: defaultdict[str, int] = defaultdict(count().__next__)
    parts = [np.fromiter(map(number.__getitem__, (text or "").split(" ")), np.int64) for text in texts]
    row = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    cells, cnt = np.unique(np.concatenate(parts) * len(texts) + row, return_counts=True)
    ends = pa.array(np.searchsorted(cells, np.arange(len(number) + 1) * len(texts)).astype(np.int32))
    keys = pa.ListArray.from_arrays(ends, key.take(pa.array(cells % len(texts))))
    yield from pa.table(
        {"piece": pa.array(list(number), pa.string()), "keys": keys, "counts": pa.ListArray.from_arrays(ends, pa.array(cnt.astype(np.int64)))}
    ).to_batches(max_chunksize=1 << 16)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        runs = np.cumsum(sizes) // PIECE_CHARS
        starts = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(runs)]
        for first, end in zip(starts, starts[1:]):
            if first < end:
                part = batch.slice(first, end - first)
                yield from _piece_rows(part.column(0), part.column(1).to_pylist())


def piece_term_counts(
    docs: DataFrame, text: Column, word: Callable[[Column], Column], vocab: DataFrame, f: int = DICTIONARY_SIZE, key: str = "doc_id"
) -> DataFrame:
    """``term_counts`` of the words that ``word`` makes of the pieces of ``text`` between spaces; null for none.

    Tasks gather the texts of each piece from ``PIECE_CHARS`` of text. A word is worked out and meets the dictionary once a run and
    piece, and only known words are dealt out to their texts again.
    """
    rows = docs.select(key, text.alias("text"))
    one = F.array(F.col(key)).alias("keys"), F.array(F.lit(0).cast("bigint")).alias("counts")
    schema = rows.select(F.lit("").alias("piece"), *one).schema
    pieces = rows.mapInArrow(_pieces, schema)
    words = pieces.select("keys", "counts", word(F.col("piece")).alias("word")).filter(F.col("word").isNotNull())
    known = known_words(words, vocab, f).select("pos", F.explode(F.arrays_zip("keys", "counts")).alias("cell"))
    return known.groupBy(F.col("cell.keys").alias(key), "pos").agg(F.sum("cell.counts").alias("cnt"))


def known_words(words: DataFrame, vocab: DataFrame, f: int = DICTIONARY_SIZE, head: int | None = None) -> DataFrame:
    """The rows of ``words`` whose word is in the dictionary, with its ``pos`` in the word's place.

    Words meet the dictionary by 128 bits of fingerprint, so the side that is broadcast has f rows of numbers,
    whatever the words' lengths. A dictionary beyond the broadcast bound is split: its ``head`` most frequent words (a number also given
    to split a shorter one) are broadcast, so no frequent word is shuffled. What is left passes a Bloom filter of the
    other words and meets these in a shuffle, in which ``SALTS`` tasks share a word, dealt by the other columns: a word that is
    frequent in ``words`` and rare in the dictionary is no single task either.
    """
    side = vocab.filter(F.col("pos") < f).select(*_prints(), "pos")
    others = [c for c in words.columns if c != "word"]
    rows = words.select(*others, *_prints())
    if head is None and f * ROW_BYTES <= BROADCAST_BYTES:
        return rows.join(small_side(side, f, ROW_BYTES), PRINTS).select(*others, "pos")
    head = HEAD if head is None else head
    side = cut(side)
    heads = small_side(side.filter(F.col("pos") < head), head, ROW_BYTES)
    tails = side.filter(F.col("pos") >= head)
    near = rows.join(heads, PRINTS).select(*others, "pos")
    rest = _may_hold(rows.join(heads, PRINTS, "left_anti"), tails)
    salt = F.pmod(F.xxhash64(*others), F.lit(SALTS)).cast("int") if others else F.lit(0)
    salts = F.array(*[F.lit(i) for i in range(SALTS if others else 1)])
    tails = tails.withColumn("salt", F.explode(salts))
    far = rest.withColumn("salt", salt).join(tails.hint("shuffle_merge"), [*PRINTS, "salt"]).select(*others, "pos")
    return near.union(far)


def _prints() -> list[Column]:
    return [F.xxhash64("word").alias("h1"), F.xxhash64(F.lit(1), F.col("word")).alias("h2")]


def _may_hold(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The ``rows`` whose fingerprints ``h1, h2`` may be among those of ``keys``, a staged table.

    A Bloom filter in blocks of 64 bits, of which a key sets up to four, with two bytes a key: ``h1`` names the block, ``h2`` the bits. It is
    broadcast in chunks of ``CHUNK`` blocks; a filter beyond the broadcast bound is left out, as it only saves shuffled rows.
    """
    blocks = max(CHUNK, 1 << (keys.count() // 4).bit_length())
    if blocks * 8 > BROADCAST_BYTES:
        return rows
    block = F.pmod("h1", F.lit(blocks))
    bits = F.expr(" | ".join(f"shiftleft(1L, cast(shiftright(h2, {6 * i}) & 63 as int))" for i in range(4)))
    empty = keys.sparkSession.range(blocks).select(F.col("id").alias("block"), F.lit(0).cast("bigint").alias("bits"))
    filled = keys.select(block.alias("block"), bits.alias("bits")).union(empty).groupBy("block").agg(F.bit_or("bits").alias("bits"))
    in_order = F.array_sort(F.collect_list(F.struct("block", "bits")))
    chunks = filled.groupBy(F.expr(f"block div {CHUNK}").alias("chunk")).agg(in_order["bits"].alias("filter"))
    asked = rows.withColumns({"chunk": F.expr(f"pmod(h1, {blocks}L) div {CHUNK}"), "block": F.pmod("h1", F.lit(CHUNK)), "bits": bits})
    met = asked.join(F.broadcast(chunks), "chunk")
    hit = F.get("filter", F.col("block").cast("int")).bitwiseAND(F.col("bits")) == F.col("bits")
    return met.filter(hit).select(*rows.columns)
