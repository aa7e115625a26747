"""Similarity search with a category vote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators.features import term_frequency, weigh
from tidemark.operators.numbering import row_numbers
from tidemark.operators.words import DICTIONARY_SIZE, term_counts, words_of
from tidemark.session import cut

# Documents of a range, whose largest and smallest weights per word are kept.
RANGE_DOCS = 4
# The ranges of a query that are scored first, per row asked for; their documents give its bound.
FIRST_RANGES = 3
# Scores are compared at this many decimals, so that the order of summation cannot
# decide between documents with equal words.
SCORE_DECIMALS = 12


def query_vectors(
    queries: DataFrame, vocab: DataFrame, idf: DataFrame, f: int = DICTIONARY_SIZE
) -> DataFrame:
    """``query_id, pos, x`` for ``query_id, text``; a text without a dictionary word gives no row."""
    words = words_of(queries, T.tokenize(F.col("text")), key="query_id")
    tf = term_frequency(term_counts(words, vocab, f, key="query_id"), key="query_id")
    return weigh(tf, idf, f).select("query_id", "pos", F.col("tfidf").alias("x"))


def _scaled(features: DataFrame, vectors: DataFrame, metric: str) -> tuple[DataFrame, DataFrame]:
    """Documents as they are and query words as ``query_id, pos, qx``; for the cosine both of length 1."""
    if metric not in ("dot", "cosine"):
        raise ValueError(f"unknown metric {metric!r}")
    asked = vectors.select("query_id", "pos", F.col("x").alias("qx"))
    if metric == "cosine":
        length = F.sqrt(F.sum(F.col("qx") * F.col("qx")).over(Window.partitionBy("query_id")))
        asked = asked.withColumn("qx", F.try_divide(F.col("qx"), length))
        own = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("doc_id")))
        features = features.withColumn("x", F.try_divide(F.col("x"), own))
    return features, asked


def similarities(features: DataFrame, vectors: DataFrame, metric: str = "dot") -> DataFrame:
    """``query_id, doc_id, score`` of the queries and documents that share a word.

    All other scores are zero and get no row. The words of the queries are postings that meet the documents' words, in one
    pass for any number of queries; the products are summed where the documents lie.
    """
    features, asked = _scaled(features, vectors, metric)
    shared = features.join(asked, "pos")
    return shared.groupBy("query_id", "doc_id").agg(F.sum(F.col("x") * F.col("qx")).alias("score"))


def ranged(features: DataFrame, size: int = RANGE_DOCS) -> DataFrame:
    """``range, doc_id, pos, x``: documents of the same weightiest word lie together, the heaviest first.

    So the weights within a range are alike, and its largest ones say much about each of its documents.
    """
    weight = F.coalesce("x", F.lit(0.0))
    docs = features.groupBy("doc_id").agg(F.max(F.struct(weight.alias("x"), -F.col("pos"))).alias("top"))
    docs = docs.select("doc_id", (-F.col("top.col2")).alias("word"), (-F.col("top.x")).alias("light"))
    numbered = row_numbers(docs, "word", "light", "doc_id").select("doc_id", F.floor(F.col("n") / size).cast("long").alias("range"))
    return features.join(numbered, "doc_id").select("range", "doc_id", "pos", "x")


def range_weights(postings: DataFrame) -> DataFrame:
    """``range, pos, high, low``: no document of the range, with the word or without, has a weight beyond these."""
    weight = F.coalesce("x", F.lit(0.0))
    return postings.groupBy("range", "pos").agg(
        F.greatest(F.max(weight), F.lit(0.0)).alias("high"), F.least(F.min(weight), F.lit(0.0)).alias("low")
    )


def range_reach(weights: DataFrame, asked: DataFrame) -> DataFrame:
    """``query_id, range, reach``: the best score that a document of the range can have."""
    most = F.greatest(F.col("qx") * F.col("high"), F.col("qx") * F.col("low"))
    return weights.join(asked, "pos").groupBy("query_id", "range").agg(F.sum(most).alias("reach"))


def _range_scores(postings: DataFrame, asked: DataFrame, chosen: DataFrame) -> DataFrame:
    """``query_id, doc_id, score`` for the documents of the ``chosen`` ranges of each query that share a word with it."""
    scale = float(10**SCORE_DECIMALS)
    wanted = asked.join(chosen.select("query_id", "range"), "query_id")
    pairs = postings.join(wanted, ["range", "pos"]).groupBy("query_id", "doc_id")
    return pairs.agg((F.rint(F.sum(F.col("x") * F.col("qx")) * scale) / scale).alias("score"))


def _best(df: DataFrame, k: int, *order) -> DataFrame:
    """The first k rows per query with their rank. Spark cuts to k in each task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k)


def nearest_rows(
    features: DataFrame,
    links: DataFrame,
    vectors: DataFrame,
    k: int,
    metric: str = "dot",
) -> DataFrame:
    """The k best (document, category) rows per query: ``query_id, rank, doc_id, category, score``.

    Documents repeat once per category; equal scores go by category, then document.
    Queries without a dictionary word get no rows; documents have a word each.

    Only documents with a category count. Documents lie in ranges with the largest and smallest weight of each word, which bound
    the scores of a whole range. The ranges that can reach most are scored first; the k-th best score there is a
    bound that none of the k best of all falls short of, so of the other ranges only those that can reach it are scored, and categories are joined
    only to scores that reach it. Documents without a shared word score zero; they are ranked only for queries with fewer than k documents above zero.
    """
    features, asked_words = _scaled(features, vectors, metric)
    words = asked_words.select("pos").distinct()
    postings = cut(ranged(features).join(words, "pos", "left_semi"))
    reach = cut(range_reach(range_weights(postings), asked_words))
    score = F.col("score").desc_nulls_last()
    first = _best(reach, FIRST_RANGES * k, F.col("reach").desc(), "range").select("query_id", "range")
    some = cut(_range_scores(postings, asked_words, first).join(links, "doc_id", "left_semi"))
    bounds = _best(some, k, score).filter((F.col("rank") == k) & (F.col("score") > 0))
    bounds = bounds.select("query_id", F.col("score").alias("bound"))
    # sums in another order may differ in their last digits
    near = F.col("reach") + F.abs("reach") * 1e-9 + 10.0**-SCORE_DECIMALS
    open_ranges = reach.join(bounds, "query_id", "left").filter(F.col("bound").isNull() | (near >= F.col("bound")))
    rest = _range_scores(postings, asked_words, open_ranges.join(first, ["query_id", "range"], "left_anti"))
    scored = some.unionByName(rest.join(links, "doc_id", "left_semi"))
    reached = F.col("bound").isNull() | (F.col("score") >= F.col("bound"))
    found = cut(scored.join(bounds, "query_id", "left").filter(reached).drop("bound"))
    asked = vectors.select("query_id").distinct()
    above = found.filter("score > 0").groupBy("query_id").agg(F.count(F.lit(1)).alias("above"))
    seen = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("seen"))
    short = cut(
        asked.join(above, "query_id", "left").join(seen, "query_id", "left")
        .filter(F.coalesce("above", F.lit(0)) < k)
        .select("query_id", F.coalesce("seen", F.lit(0)).alias("seen"))
    )
    most = short.agg(F.max("seen")).first()[0]
    if most is not None:
        found = found.unionByName(_zero_rows(features, links, found, short, k + most))
    rows = links.join(_first_categories(found, links, k, score), "doc_id")
    return _best(rows, k, score, "category", "doc_id").select("query_id", "rank", "doc_id", "category", "score")


def _first_categories(found: DataFrame, links: DataFrame, k: int, score: Column) -> DataFrame:
    """The k best documents per query by score, first category and id: only they can hold the k best rows."""
    firsts = links.groupBy("doc_id").agg(F.min("category").alias("first_category"))
    best = _best(found.join(firsts, "doc_id"), k, score, "first_category", "doc_id")
    return best.select("query_id", "doc_id", "score")


def _zero_rows(features: DataFrame, links: DataFrame, found: DataFrame, short: DataFrame, enough: int) -> DataFrame:
    """Score 0 for the documents that come first by category and id and share no word with a ``short`` query.

    Of the first ``enough`` documents at least k share none: ``found`` holds all documents that share a word with a
    query that is short of hits, as it has no bound.
    """
    firsts = links.join(features.select("doc_id").distinct(), "doc_id", "left_semi")
    firsts = firsts.groupBy("doc_id").agg(F.min("category").alias("first_category"))
    early = firsts.orderBy("first_category", "doc_id").limit(enough).select("doc_id")
    ids = short.agg(F.collect_set("query_id").alias("ids")).scalar()
    pairs = early.select(F.explode(ids).alias("query_id"), "doc_id")
    return pairs.join(found, ["query_id", "doc_id"], "left_anti").withColumn("score", F.lit(0.0))


def category_vote(rows: DataFrame, k: int) -> DataFrame:
    """Votes per category among the nearest rows: ``query_id, category, votes, rank``, the k largest."""
    votes = rows.groupBy("query_id", "category").agg(F.sum(F.lit(1)).alias("votes"))
    return _best(votes, k, F.col("votes").desc(), "category")
