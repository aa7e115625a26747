"""Jaccard similarity join of word shingles, heavy and light sets apart, and its connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from tidemark.llm.common import LOWER, Plain, Spans, blocks, mix, stage, word_bounds
from tidemark.llm.components import components

#: A bucket of more sets is split by the sizes of its pairs.
CROWD = 4
#: Sizes of a class lie within this ratio; linked sets are at most so many classes apart.
CLASS_RATIO = 1.05
CLASSES = math.ceil(math.log(4 / 3) / math.log(CLASS_RATIO)) + 1
#: Hubs of a bucket in the first round, and how many times more the next ones have.
FIRST_HUBS, MORE_HUBS = 4, 8
_NULL_ID = -(1 << 63)
#: Columns of 64 parity bits each that sum up a set.
SIGNS = [f"sign{i}" for i in range(8)]


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted fingerprints of its distinct shingles of ``width`` words (all words where they are fewer)."""
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets)
    words = Spans(data)(starts, ends)
    n = len(words)
    whole = np.zeros(max(0, n - width + 1), dtype=np.uint64)
    for k in range(width if n >= width else 0):
        whole = mix(whole * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(whole)])
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            yield np.unique(whole[a : b - width + 1])
        elif b > a:
            h = np.array([b - a], dtype=np.uint64)
            for k in range(a, b):
                h = mix(h * np.uint64(0x85EBCA6B9E3779B9) + words[k : k + 1])
            yield h
        else:
            yield whole[:0]


def set_id(tokens: np.ndarray) -> int:
    """64 bits that know a set of shingles."""
    total = mix(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return int(mix(np.array([total]))[0].view(np.int64))


def signs(tokens: np.ndarray) -> np.ndarray:
    """Parity bits of a set: bit i tells whether an odd number of its shingles falls on i.

    A shingle that only one of two sets holds changes one bit, so their bits differ at no more places than there are such shingles.
    """
    bits = 64 * len(SIGNS)
    odd = np.bincount((tokens % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def least_overlap(size):
    """How many shingles a set must share with any set that it links to: 75 percent of its own."""
    return -(-3 * size // 4)


def _slack(size):
    """How many shared shingles the least-hash prefix of a set must show; a longer prefix rules out more."""
    return 1 + size // 16


def _rows_of(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    row = 0
    for _, data, offsets in blocks(batch, "text", 1 << 20):
        for tokens in shingle_hashes(data, offsets, width):
            yield row, tokens
            row += 1


def _items(width: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(len(t), set_id(t) if len(t) else None) for _, t in _rows_of(batch, width)]
            more = [pa.array([s[0] for s in sets], pa.int64()), pa.array([s[1] for s in sets], pa.int64())]
            names = ["doc", "doc_id", "text_key"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *more], [*names, "n_shingles", "set_id"])

    return find


def _prefixes(width: int):
    """The least-hash prefix of each set: token, doc, n, direct.

    A token of several sets of one batch is known as shared there: its sets get the number of such tokens in one
    ``direct`` row each, and other batches hear of it by one row without doc. So a token that very many sets
    hold makes one row per batch.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("doc").to_numpy()
            known, parts, own = set(), [], []
            for row, tokens in _rows_of(batch, width):
                size = len(tokens)
                if not size or (of := set_id(tokens)) in known:
                    continue
                known.add(of)
                parts.append(tokens[: size - least_overlap(size) + min(_slack(size), least_overlap(size))])
                own.append(row)
            if not parts:
                continue
            tokens = np.concatenate(parts)
            owner = np.repeat(np.arange(len(own)), [len(p) for p in parts])
            values, back, times = np.unique(tokens, return_inverse=True, return_counts=True)
            alone = times[back] == 1
            here = docs[np.array(own)]
            shared = np.bincount(owner[~alone], minlength=len(own))
            some = np.flatnonzero(shared)
            heard = values[times > 1]
            token = np.concatenate([tokens[alone], heard, mix(some.astype(np.uint64) + np.uint64(1))]).view(np.int64)
            doc = np.concatenate([here[owner[alone]], np.zeros(len(heard), np.int64), here[some]])
            count = np.concatenate([np.ones(alone.sum(), np.int32), np.zeros(len(heard), np.int32), shared[some].astype(np.int32)])
            direct = np.zeros(len(token), dtype=bool)
            direct[len(token) - len(some) :] = True
            for a in range(0, len(token), 1 << 16):
                part = slice(a, a + (1 << 16))
                columns = [token[part], doc[part], count[part], direct[part]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "doc", "n", "direct"])

    return find


def _whole_sets(width: int):
    """Set id, size, tokens and signs of the sets of rows whose ``set_id`` is that of their text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("set_id").to_numpy()
            found: dict[int, np.ndarray] = {}
            for row, tokens in _rows_of(batch, width):
                if len(tokens) and (of := set_id(tokens)) == wanted[row]:
                    found[of] = tokens
            if found:
                arrays = [pa.array(list(found), pa.int64()), pa.array([len(t) for t in found.values()], pa.int64())]
                ends = np.concatenate([[0], np.cumsum([len(t) for t in found.values()])]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(list(found.values())).view(np.int64)))
                bits = np.stack([signs(t) for t in found.values()], axis=1)
                yield pa.RecordBatch.from_arrays([*arrays, tokens, *map(pa.array, bits)], ["set_id", "size", "tokens", *SIGNS])

    return find


def _sql_least(size: str = "size") -> Column:
    return F.expr(f"(3 * {size} + 3) div 4")


def similar_candidates(docs: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """set_id, size, tokens and signs of the sets that may link to another one, each once.

    Two linked sets share at least ``least_overlap`` shingles, so among the shingles of least hash, all but
    that many plus a slack, each shows at least the smaller one's slack of shared ones. Sets without them leave.
    """
    rows = docs.mapInArrow(_prefixes(width), "token bigint, doc bigint, n int, direct boolean")
    heard = F.sum(F.when(F.col("direct"), 0).otherwise(1)).over(Window.partitionBy("token"))
    shared = (
        rows.withColumn("holders", heard)
        .filter("direct or (holders > 1 and n > 0)")
        .groupBy("doc")
        .agg(F.sum("n").alias("shared"))
    )
    slack = F.expr("1 + ((3 * n_shingles + 3) div 4) div 16")
    speakers = stage(
        items.filter("set_id is not null")
        .join(shared, "doc")
        .filter(F.col("shared") >= slack)
        .groupBy("set_id")
        .agg(F.min(F.struct("doc", "text_key")).alias("one"))
        .select("set_id", "one.doc", "one.text_key"),
        "speakers",
    )
    schema = ", ".join(["set_id bigint, size bigint, tokens array<bigint>", *[f"{c} bigint" for c in SIGNS]])
    # texts and ids meet in a shuffle at every size; the text's hash keeps rows of one id apart
    spoken = docs.withColumn("text_key", F.xxhash64("text")).join(speakers.hint("merge"), ["doc", "text_key"]).select("text", "set_id")
    return stage(spoken.mapInArrow(_whole_sets(width), schema), "sets")


def size_boundary(rare: DataFrame) -> int:
    """Sets up to this size enumerate pairs of shingles, larger ones scan lists, whichever is less work in all.

    Work is counted in rows: enumerating writes one for each pair of a set's prefix; scanning writes one for each
    shingle of the prefix and meets the first hubs of its list. Both are summed by size class of a tenth of a
    power of two, and the cut with the least sum is taken.
    """
    prefix = F.col("size") - _sql_least()
    scan = 1 + F.least(F.col("holders") - 1, F.lit(FIRST_HUBS))
    cost = (
        rare.groupBy(F.floor(F.log2("size") * 10).alias("class"))
        .agg(
            F.max("size").alias("size"),
            F.sum(F.when(F.col("last"), (prefix + 2) * (prefix + 1) / 2).otherwise(0)).alias("pairs"),
            F.sum(F.when(F.col("nth") <= prefix + 1, scan).otherwise(0)).alias("lists"),
        )
        .orderBy("class")
        .collect()
    )
    total = sum(c["lists"] for c in cost)
    best, boundary, enumerated, scanned = total, 0, 0.0, total
    for c in cost:
        enumerated += c["pairs"]
        scanned -= c["lists"]
        if enumerated + scanned < best:
            best, boundary = enumerated + scanned, c["size"]
    return boundary


def buckets(sets: DataFrame) -> DataFrame:
    """Rows (bucket, set_id, size, scans, side, holders) and signs: linked sets meet in one bucket at least.

    Shingles are ordered by how many sets hold them, the rarest first, ties by hash. Linked sets share one
    of their first size - least_overlap + 1 shingles and two of one more than that. Small sets meet by
    pairs of the latter; large sets look up the lists of the former, in which small ones of nearly their size are, too. In a list one
    set of a pair scans, in the bucket of a pair of shingles ``scans`` is null. Crowded buckets are split, see ``_split``.
    """
    tokens = sets.select("set_id", "size", F.explode("tokens").alias("token"))
    held = tokens.groupBy("token").agg(F.count("*").alias("holders")).filter("holders > 1")
    # a shingle that no other set holds comes first in its set's order and meets nobody
    common = tokens.join(held, "token")
    own = Window.partitionBy("set_id")
    nth = F.row_number().over(own.orderBy("holders", "token")) + F.col("size") - F.count("*").over(own)
    common = common.withColumn("nth", nth).withColumn("last", F.col("nth") == F.least(F.col("size"), F.col("size") - _sql_least() + 2))
    rare = stage(common.filter(F.col("nth") <= F.col("size") - _sql_least() + 2), "rare")
    boundary = size_boundary(rare)
    first = rare.filter(F.col("nth") <= F.col("size") - _sql_least() + 1)
    lists = first.filter(4 * F.col("size") >= 3 * (boundary + 1)).select(
        F.xxhash64("token").alias("bucket"), "set_id", "size", "nth", (F.col("size") > boundary).alias("scans")
    )
    small = rare.filter(F.col("size") <= boundary)
    # both shingles of a pair are in the set's list, which is as long as a small set at most
    listed = small.groupBy("set_id", "size").agg(F.sort_array(F.collect_list(F.struct("token", "nth"))).alias("own"))
    both = lambda x, y: F.struct(F.xxhash64(x["token"], y["token"], F.lit(2)).alias("bucket"), (F.greatest(x["nth"], y["nth"]) - 1).alias("nth"))
    pairs = listed.select(
        "set_id",
        "size",
        F.explode(F.flatten(F.transform("own", lambda x, i: F.transform(F.slice("own", i + 2, F.size("own")), lambda y: both(x, y))))).alias("p"),
    ).select("p.bucket", "set_id", "size", "p.nth", F.lit(None).cast("boolean").alias("scans"))
    rows = lists.union(pairs).withColumn("side", F.lit(None).cast("int"))
    rows = stage(_shared(rows), "shared")
    crowded = F.col("holders") > CROWD
    split = _shared(_split(rows.filter(crowded).drop("holders")))
    every = rows.filter(~crowded).unionByName(split).drop("nth")
    return stage(every.join(sets.select("set_id", *SIGNS), "set_id"), "buckets")


def _shared(rows: DataFrame) -> DataFrame:
    """The rows of buckets in which a pair can meet, with the number of their sets as ``holders``."""
    sizes = rows.groupBy("bucket").agg(
        F.count("*").alias("holders"), F.max(F.coalesce("scans", F.lit(True))).alias("any"), F.min("side").alias("low"), F.max("side").alias("high")
    )
    alive = sizes.filter((F.col("holders") > 1) & F.col("any") & (F.col("low").isNull() | (F.col("low") != F.col("high"))))
    return rows.join(alive.select("bucket", "holders"), "bucket")


def _split(rows: DataFrame) -> DataFrame:
    """Crowded buckets by the size classes of the two sets of a pair: ``side`` 0 and 1 hold the smaller and the larger sets, null both.

    Sets of sizes a and b link when they share 3/7 (a + b) shingles at least, mostly more than 75 percent of either. So with
    the other's class known the prefix in which they must meet is shorter, and where sets share a passage but not enough, the shingles of their own, which
    come first, fill it: such sets meet nowhere, however many they are.
    """
    step = math.log(CLASS_RATIO)
    own = F.floor(F.log("size") / step).cast("int")
    other = F.explode(F.sequence(own - CLASSES, own + CLASSES))
    rows = rows.withColumn("own", own).withColumn("other", other)
    # a bound from below of the sizes in that class, whatever way logarithms round
    low = F.greatest(F.ceil(F.pow(F.lit(CLASS_RATIO), F.col("other"))) - 1, F.lit(1))
    needed = F.floor((3 * (F.col("size") + low) + 6) / 7)
    rows = rows.filter(F.col("nth") <= F.col("size") - needed + 1)
    side = F.when(F.col("own") < F.col("other"), 0).when(F.col("own") > F.col("other"), 1)
    key = F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))
    return rows.select(key.alias("bucket"), "set_id", "size", "nth", "scans", side.cast("int").alias("side"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar: 100 times what both hold is at least 75 times what either holds.

    Only the sets of the pairs meet them.
    """
    pairs = stage(pairs, "pairs")
    ids = stage(pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct(), "ids")
    sets = sets.join(ids, "set_id", "left_semi")
    left = sets.select(F.col("set_id").alias("a"), F.col("size").alias("size_a"), F.col("tokens").alias("tokens_a"))
    right = sets.select(F.col("set_id").alias("b"), F.col("size").alias("size_b"), F.col("tokens").alias("tokens_b"))
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return pairs.join(left, "a").join(right, "b").filter(175 * both >= 75 * (F.col("size_a") + F.col("size_b"))).select("a", "b")


def link_sets(sets: DataFrame) -> DataFrame:
    """(set_id, label) of all sets with a link; equal labels are connected.

    All pairs of a bucket are settled, but not all are compared: a pair that is connected by now needs no look. At first each
    set meets one other, the most central set of its fullest bucket: the one whose shingles most others hold, to which the
    others of a group of near copies are closest. In each round then some sets
    of each bucket, drawn by hash, are hubs and meet the other sets of it in other components; the next
    round has ``MORE_HUBS`` times as many, until each set was one. A group of many similar sets joins one
    component by its first hubs, and those beside it that link to none are ruled out by their signs, so it never makes all its pairs.
    """
    rows = buckets(sets)
    most = rows.agg(F.max("holders")).first()[0] or 0
    low, high = 0, FIRST_HUBS
    draw = F.pmod(F.xxhash64("set_id"), F.lit(1 << 40)) / float(1 << 40)
    rows = rows.withColumn("draw", draw).withColumn("place", F.col("draw") * F.col("holders"))
    links = stage(verified(_first_pairs(rows), sets), "links")
    labels = None if links.isEmpty() else _merged(None, links)
    while low < most:
        now = rows
        if labels is None:
            now = now.withColumn("label", F.col("set_id"))
        else:
            now = now.join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
            # buckets that are in one component are settled
            open_ones = now.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x != y")
            now = now.join(open_ones.select("bucket"), "bucket")
        hubs = now.filter((F.col("place") >= low) & (F.col("place") < high)).select(
            "bucket", *[F.col(c).alias("hub_" + c) for c in ("set_id", "size", "scans", "side", "draw", "label", *SIGNS)]
        )
        meet = now.filter(F.col("place") >= low).join(hubs, "bucket").filter(
            (F.struct("hub_draw", "hub_set_id") < F.struct("draw", "set_id")) & (F.col("hub_label") != F.col("label")) & _may_link()
        )
        pairs = meet.select(*_ordered()).distinct()
        links = stage(verified(pairs, sets), "links")
        if not links.isEmpty():
            labels = _merged(labels, links)
        low, high = high, high * MORE_HUBS
    return labels if labels is not None else sets.select("set_id", F.col("set_id").alias("label")).limit(0)


def _may_link() -> Column:
    """A set and a hub of like size and signs, on two sides of a bucket that has two, and of which one scans unless they met by a pair of shingles.

    Sets link when no more than a seventh of their sizes' sum are shingles that only one holds, which is the same bound as
    75 percent of the union; their signs cannot differ more.
    """
    alike = 4 * F.least("size", "hub_size") >= 3 * F.greatest("size", "hub_size")
    apart = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"hub_{c}"))) for c in SIGNS), F.lit(0))
    across = F.coalesce(F.col("side") != F.col("hub_side"), F.lit(True))
    return alike & across & (7 * apart <= F.col("size") + F.col("hub_size")) & F.coalesce(F.col("scans") | F.col("hub_scans"), F.lit(True))


def _ordered() -> list[Column]:
    return [F.least("set_id", "hub_set_id").alias("a"), F.greatest("set_id", "hub_set_id").alias("b")]


def _first_pairs(rows: DataFrame) -> DataFrame:
    """Each set with the most central set in its bucket of most holders: one pair a set at most.

    A set is the more central the more sets share its buckets, for its size.
    """
    names = ("set_id", "size", "scans", "side", *SIGNS)
    own = rows.groupBy("set_id").agg(
        F.max(F.struct(F.col("side").isNull(), "holders", "bucket"))["bucket"].alias("fullest"), (F.sum("holders") / F.first("size")).alias("central")
    )
    rows = rows.join(own, "set_id")
    hubs = rows.groupBy("bucket").agg(F.max_by(F.struct(*names), F.struct("central", "set_id")).alias("hub"))
    hubs = hubs.select("bucket", *[F.col(f"hub.{c}").alias(f"hub_{c}") for c in names])
    meet = rows.filter(F.col("bucket") == F.col("fullest")).join(hubs, "bucket")
    return meet.filter((F.col("set_id") != F.col("hub_set_id")) & _may_link()).select(*_ordered()).distinct()


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """The labels after these links: the components of the components."""
    if labels is None:
        return components(links).select(F.col("node").alias("set_id"), "label")
    a, b = (labels.select(F.col("set_id").alias(c), F.col("label").alias(f"label_{c}")) for c in "ab")
    between = links.join(a, "a", "left").join(b, "b", "left").select(
        F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")
    )
    joined = components(between.distinct())
    old = labels.join(joined.select(F.col("node").alias("label"), F.col("label").alias("new")), "label", "left").select(
        "set_id", F.coalesce("new", "label").alias("label")
    )
    fresh = joined.join(labels.select(F.col("set_id").alias("node")), "node", "left_anti")
    # a component's label is itself one of its sets and may not be listed yet
    return stage(old.union(fresh.select(F.col("node").alias("set_id"), "label")).distinct(), "labels")


def _labelled_items(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """Per row: doc, doc_id, text_key, n_shingles, and label, equal for rows that links connect (null without words)."""
    texts = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(_NULL_ID)).alias("doc"),
        F.col(key).cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        F.col(text).alias("text"),
    )
    kinds = "doc bigint, doc_id bigint, text_key bigint, n_shingles bigint, set_id bigint"
    items = stage(texts.mapInArrow(_items(width), kinds), "items")
    labels = link_sets(similar_candidates(texts.select("doc", "text"), items, width))
    return items.join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))


def join_similar(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id that links lead to, itself included).

    A set is the distinct shingles of ``width`` lower-cased (A-Z) words, or the whole sequence as one where the words are
    fewer; two rows link when their sets' Jaccard similarity is 0.75 or more. Null and wordless texts have no
    set, link with nothing and have their own doc_id. Equal sets are one set with several rows, so copies are never
    paired; rows that share a doc_id are rows of their own. A null doc_id is passed over for component_id, which
    is null only if all the component's are. The key is an integer column. Shingles and sets are known by 64-bit fingerprints.
    """
    found = _labelled_items(docs, key, text, width)
    least = found.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return found.join(least, "label", "left").select(
        "doc_id", "n_shingles", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5) -> DataFrame:
    """The rows of ``docs``, but of each group that links connect only one of the smallest key.

    A null key counts as the smallest. Among rows of that key the text of the least hash stays, and one of equal rows. Rows
    without words are in no group and all stay.
    """
    plain = Plain(docs)
    docs, key, text = plain.rows, plain.of(key), plain.of(text)
    found = _labelled_items(docs, key, text, width)
    first = found.filter("label is not null").groupBy("label").agg(F.min(F.struct("doc", "text_key")).alias("one"))
    bare = found.filter("label is null").select("doc", "text_key").distinct()
    stay = first.select("one.doc", "one.text_key", F.lit(True).alias("_worded")).union(bare.select("*", F.lit(False)))
    marked = docs.withColumn("_doc", F.coalesce(F.col(key).cast("long"), F.lit(_NULL_ID))).withColumn("_text_key", F.xxhash64(text))
    kept = marked.join(stay.withColumnsRenamed({"doc": "_doc", "text_key": "_text_key"}), ["_doc", "_text_key"])
    other = [f.name for f in docs.schema if f.name != text and isinstance(f.dataType, (NumericType, StringType, BooleanType))]
    nth = F.row_number().over(Window.partitionBy("_doc", "_text_key").orderBy(*other, F.lit(0)))
    return kept.withColumn("_nth", nth).filter("_nth = 1 or not _worded").select(*plain.rest)
