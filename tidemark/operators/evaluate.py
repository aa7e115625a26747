"""Held-out evaluation for two classes. Input columns: ``label`` and ``prediction``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import bucket


def split_rows(df: DataFrame, key: str = "doc_id", seed: int = 7, parts: int = 3) -> DataFrame:
    """Add ``part`` 1..parts, fixed by key and seed. Parts 1 and 2 train, part 3 tests."""
    return df.withColumn("part", bucket(F.col(key), buckets=parts, seed=seed))


def training_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("part") < 3)


def held_out_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("part") == 3)


def _cell(label: float, prediction: float) -> Column:
    hit = (F.col("label") == label) & (F.col("prediction") == prediction)
    return F.count(F.when(hit, 1))


def _share(top: Column, bottom: Column) -> Column:
    """A ratio that is 0 when undefined."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, classes: tuple = (0, 1)) -> DataFrame:
    """``label, prediction, n`` for every cell, empty ones included; one aggregation."""
    grid = [(a, p) for a in classes for p in classes]
    row = df.agg(*[_cell(a, p).alias(f"n{i}") for i, (a, p) in enumerate(grid)])
    cells = F.array(*[
        F.struct(F.lit(a).alias("label"), F.lit(p).alias("prediction"), F.col(f"n{i}").alias("n"))
        for i, (a, p) in enumerate(grid)
    ])
    return row.select(F.explode(cells).alias("c")).select("c.label", "c.prediction", "c.n")


def class_report(df: DataFrame, classes: tuple = (0, 1)) -> DataFrame:
    """``label, precision, recall, f1, support`` per class; undefined ratios are 0."""
    names = [(c, f"both{i}", f"said{i}", f"real{i}") for i, c in enumerate(classes)]
    counts = []
    for c, both, said, real in names:
        counts.append(_cell(c, c).alias(both))
        counts.append(F.count(F.when(F.col("prediction") == c, 1)).alias(said))
        counts.append(F.count(F.when(F.col("label") == c, 1)).alias(real))
    lines = F.array(*[
        F.struct(
            F.lit(c).alias("label"),
            _share(F.col(both), F.col(said)).alias("precision"),
            _share(F.col(both), F.col(real)).alias("recall"),
            _share(2 * F.col(both), F.col(said) + F.col(real)).alias("f1"),
            F.col(real).alias("support"),
        )
        for c, both, said, real in names
    ])
    return df.agg(*counts).select(F.explode(lines).alias("r")).select("r.*")


def f1_binary(df: DataFrame, positive: int = 1) -> DataFrame:
    """F1 of the positive class: 2 TP / (2 TP + FP + FN)."""
    said = F.count(F.when(F.col("prediction") == positive, 1))
    real = F.count(F.when(F.col("label") == positive, 1))
    return df.agg(_share(2 * _cell(positive, positive), said + real).alias("f1"))


def f1_weighted(df: DataFrame, classes: tuple = (0, 1)) -> DataFrame:
    """F1 per class, averaged by support."""
    return class_report(df, classes).agg(
        _share(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1")
    )


def false_positives(
    scored: DataFrame, features: DataFrame, top_words: DataFrame, k: int = 3, positive: int = 1
) -> DataFrame:
    """The first k wrongly positive documents, each with its feature at every top word.

    ``scored`` holds doc_id, label, prediction; ``top_words`` holds word, pos (a handful
    of rows). Words a document lacks show 0.
    """
    wrong = scored.filter((F.col("prediction") == positive) & (F.col("label") != positive))
    first = wrong.orderBy("doc_id").limit(k).select("doc_id")
    words = top_words.agg(F.collect_list(F.struct("pos", "word")).alias("words")).scalar()
    wanted = first.select("doc_id", F.explode(words).alias("t")).select("doc_id", "t.pos", "t.word")
    found = features.join(first, "doc_id", "left_semi")
    return wanted.join(found, ["doc_id", "pos"], "left").select(
        "doc_id", "word", "pos", F.coalesce(F.col("x"), F.lit(0.0)).alias("x")
    )
