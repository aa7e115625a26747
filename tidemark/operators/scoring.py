"""Dot products of sparse documents with a block of dense weight vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.words import DICTIONARY_SIZE
from tidemark.session import small_side


def dot_products(
    features: DataFrame,
    weights: DataFrame,
    k: int,
    f: int = DICTIONARY_SIZE,
    key: str = "doc_id",
    keep: list[Column] = (),
) -> DataFrame:
    """``key, score_0 .. score_{k-1}`` for ``features`` (key, pos, x) and ``weights`` (pos, w ARRAY of k).

    Each feature row meets one weight row, so nothing fans out with k: the k scores
    are k sums of one aggregation. It needs no shuffle when ``features`` is already
    partitioned by the key. Positions without weights add zero.
    """
    side = small_side(weights.select("pos", "w"), f, row_bytes=8 * k + 64)
    sums = [F.expr(f"coalesce(sum(x * w[{j}]), 0D) AS score_{j}") for j in range(k)]
    return features.join(side, "pos", "left").groupBy(key).agg(*sums, *keep)


def single_weights(weights: DataFrame) -> DataFrame:
    """``pos, weight`` as a block of one vector."""
    return weights.select("pos", F.array(F.col("weight").cast("double")).alias("w"))


def linear_scores(features: DataFrame, weights: DataFrame, f: int = DICTIONARY_SIZE, key: str = "doc_id") -> DataFrame:
    """``key, score, prediction``: negative scores predict 0, all others 1."""
    scored = dot_products(features, single_weights(weights), 1, f, key)
    return scored.select(
        key,
        F.col("score_0").alias("score"),
        F.when(F.col("score_0") < 0, 0).otherwise(1).alias("prediction"),
    )


def top_coefficients(weights: DataFrame, vocab: DataFrame, k: int) -> DataFrame:
    """``word, pos, weight`` of the k largest weights."""
    return (
        weights.join(vocab.select("pos", "word"), "pos")
        .orderBy(F.col("weight").desc(), "pos")
        .limit(k)
        .select("word", "pos", "weight")
    )
