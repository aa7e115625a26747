"""Multinomial naive Bayes as aggregations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scoring import dot_products
from tidemark.operators.words import DICTIONARY_SIZE
from tidemark.session import small_side


def word_likelihoods(
    data: DataFrame,
    vocab: DataFrame,
    smoothing: float = 1.0,
    classes: tuple = (0, 1),
    f: int = DICTIONARY_SIZE,
) -> DataFrame:
    """``pos, w``: per position the ln probability in each class, in class order.

    ``data`` holds label, pos, x with x >= 0. Every dictionary position gets a row,
    so unseen words carry the smoothing mass.
    """
    by_pos = data.groupBy("pos").agg(*[
        F.sum(F.when(F.col("label") == c, F.col("x"))).alias(f"s{j}") for j, c in enumerate(classes)
    ])
    table = vocab.select("pos").join(small_side(by_pos, f), "pos", "left")
    mass = [F.coalesce(F.col(f"s{j}"), F.lit(0.0)) + smoothing for j in range(len(classes))]
    total = table.agg(F.array(*[F.sum(m) for m in mass]).alias("t")).scalar()
    return table.select("pos", F.array(*[F.log(m / total[j]) for j, m in enumerate(mass)]).alias("w"))


def class_priors(labels: DataFrame, smoothing: float = 1.0, classes: tuple = (0, 1)) -> DataFrame:
    """One row ``prior ARRAY``: the ln prior of each class."""
    sizes = [F.count(F.when(F.col("label") == c, 1)) for c in classes]
    known = reduce(lambda a, b: a + b, sizes)
    priors = [F.log((s + smoothing) / (known + smoothing * len(classes))) for s in sizes]
    return labels.agg(F.array(*priors).alias("prior"))


def classify(
    features: DataFrame,
    likelihoods: DataFrame,
    priors: DataFrame,
    classes: tuple = (0, 1),
    f: int = DICTIONARY_SIZE,
) -> DataFrame:
    """``doc_id, scores, prediction``: ln prior + x · ln likelihood per class; equal scores go to the first class."""
    prior = priors.scalar()
    scored = dot_products(features, likelihoods, len(classes), f)
    scores = F.array(*[F.col(f"score_{j}") + prior[j] for j in range(len(classes))])
    best = F.array_position(F.col("scores"), F.array_max("scores")) - 1
    labels = F.array(*[F.lit(c) for c in classes])
    return scored.select("doc_id", scores.alias("scores")).select(
        "doc_id", "scores", F.get(labels, best.cast("int")).alias("prediction")
    )
