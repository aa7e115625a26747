"""Term weights in sparse long form: one row per (document, dictionary position)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.words import DICTIONARY_SIZE
from tidemark.session import small_side


def row_count(df: DataFrame) -> Column:
    """The number of rows as a scalar subquery, computed with the query that uses it."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def term_frequency(counts: DataFrame, key: str = "doc_id") -> DataFrame:
    """``tf`` = count / dictionary words in the document. A window group holds at most f rows."""
    total = F.sum("cnt").over(Window.partitionBy(key))
    return counts.withColumn("tf", F.col("cnt") / total)


def document_frequency(counts: DataFrame) -> DataFrame:
    """Documents per position: ``pos, df``, a sum of presences.

    It reads ``cnt``, so a query that also uses the counts shares their shuffle.
    """
    return counts.groupBy("pos").agg(F.sum(F.when(F.col("cnt") > 0, 1).otherwise(0)).alias("df"))


def inverse_document_frequency(df: DataFrame, n_docs: Column | int, smooth: bool = False) -> DataFrame:
    """``idf`` = ln(N / df), or ln(N / (df + 1)) when smooth; the smooth form is negative at df = N."""
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    seen = F.col("df") + 1 if smooth else F.col("df")
    return df.select("pos", "df", F.log(n / seen).alias("idf"))


def weigh(tf: DataFrame, idf: DataFrame, f: int = DICTIONARY_SIZE) -> DataFrame:
    """``tfidf`` = tf * idf. The idf side has one row per position, so at most f."""
    return tf.join(small_side(idf.select("pos", "idf"), f), "pos").withColumn(
        "tfidf", F.col("tf") * F.col("idf")
    )


def features(
    counts: DataFrame,
    n_docs: Column | int,
    weighting: str = "tfidf",
    smooth: bool = True,
    idf: DataFrame | None = None,
    f: int = DICTIONARY_SIZE,
    key: str = "doc_id",
) -> DataFrame:
    """``key, pos, x`` from term counts.

    ``weighting`` is ``count``, ``tf`` or ``tfidf``. Give the training ``idf`` to weigh held-out
    documents with it; without one it is fitted on these documents.
    """
    if weighting == "count":
        return counts.select(key, "pos", F.col("cnt").cast("double").alias("x"))
    tf = term_frequency(counts, key)
    if weighting == "tf":
        return tf.select(key, "pos", F.col("tf").alias("x"))
    if weighting != "tfidf":
        raise ValueError(f"unknown weighting {weighting!r}")
    if idf is None:
        idf = inverse_document_frequency(document_frequency(counts), n_docs, smooth)
    return weigh(tf, idf, f).select(key, "pos", F.col("tfidf").alias("x"))


def class_shares(
    docs: DataFrame, tokens: Column, labels: DataFrame, chosen: list[str], key: str = "doc_id"
) -> DataFrame:
    """Share of a class's documents that hold each chosen word: ``label, word, share``.

    Words no document holds get a share of 0. The denominator counts documents with a token at least.
    Each line becomes one row of flags before anything is shuffled; lines that share an id are
    one document, and several labels of an id count as the largest. Documents without a label leave before the shuffle.
    """
    labels = labels.groupBy(key).agg(F.max("label").alias("label"))
    docs = docs.join(labels, key, "left_semi")
    flagged = docs.select(key, tokens.alias("tokens")).filter(F.size("tokens") > 0)
    flagged = flagged.select(
        key, *[F.array_contains("tokens", w).cast("int").alias(f"w{i}") for i, w in enumerate(chosen)]
    )
    once = flagged.groupBy(key).agg(*[F.max(f"w{i}").alias(f"w{i}") for i in range(len(chosen))])
    docs = once.join(labels, key)
    totals = [F.sum(f"w{i}").alias(f"w{i}") for i in range(len(chosen))]
    classes = docs.groupBy("label").agg(F.count(F.lit(1)).alias("size"), *totals)
    pairs = F.array(*[
        F.struct(F.lit(w).alias("word"), F.col(f"w{i}").alias("df")) for i, w in enumerate(chosen)
    ])
    return classes.select("label", "size", F.explode(pairs).alias("p")).select(
        "label", F.col("p.word").alias("word"), (F.col("p.df") / F.col("size")).alias("share")
    )
