"""Train a document classifier on one corpus, score it on another."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import classify, evaluate, vectors
from tidemark.operators import features as feat
from tidemark.operators.scoring import linear_scores, top_coefficients
from tidemark.operators.words import DICTIONARY_SIZE, dictionary, letter_dictionary, letter_term_counts, words_of
from tidemark.session import cut, keep
from tidemark.sources import readers

# Fixed value: ids of the positive class hold this mark.
POSITIVE_MARK = "AU"


def label_of(doc_id: str = "doc_id", mark: str = POSITIVE_MARK) -> Column:
    """1 when the id holds the mark anywhere, case-sensitive, else 0.

    A function of the id alone, so lines that share an id are one document with one label.
    """
    return F.when(F.contains(F.col(doc_id), F.lit(mark)), 1).otherwise(0)


@dataclass
class Report:
    """What a run leaves: bounded frames, except the scored documents."""

    top_words: DataFrame
    trace: DataFrame
    scored: DataFrame
    confusion: DataFrame
    f1: DataFrame
    false_positives: DataFrame


def train_and_score(
    train_lines: DataFrame,
    test_lines: DataFrame,
    fit: Callable[[DataFrame, int], classify.Fit],
    weighting: str = "tfidf",
    refit_idf: bool = False,
    top: int = 10,
    f: int = DICTIONARY_SIZE,
    mark: str = POSITIVE_MARK,
) -> Report:
    """Dictionary and weights from the training lines, evaluation on the test lines.

    Lines that share an id are one document. ``fit`` gets the training table and the number of all training lines. Test
    documents use the training dictionary, and the training idf unless
    ``refit_idf`` asks for their own. Documents without a dictionary word vanish.
    """
    spark = train_lines.sparkSession
    n_train = train_lines.count()
    train, test = readers.parse_documents(train_lines), readers.parse_documents(test_lines)
    vocab = cut(letter_dictionary(train, f))
    counts = keep(letter_term_counts(train, vocab, f))
    try:
        idf = cut(feat.inverse_document_frequency(feat.document_frequency(counts), n_train, smooth=True))
        x = feat.features(counts, n_train, weighting, idf=idf, f=f)
        with classify.training_table(x.withColumn("label", label_of(mark=mark))) as data:
            fitted = fit(data, n_train)
    finally:
        counts.unpersist()
    weights = fitted.weights_frame(spark)
    best = cut(top_coefficients(weights, vocab, top))
    x_test = cut(
        feat.features(
            letter_term_counts(test, vocab, f),
            feat.row_count(test_lines),
            weighting,
            idf=None if refit_idf else idf,
            f=f,
        )
    )
    scored = cut(linear_scores(x_test, weights, f).withColumn("label", label_of(mark=mark)))
    return Report(
        top_words=best,
        trace=fitted.trace_frame(spark),
        scored=scored,
        confusion=evaluate.confusion(scored),
        f1=evaluate.f1_binary(scored),
        false_positives=evaluate.false_positives(scored, x_test, best),
    )


def logistic(data: DataFrame, n_docs: int) -> classify.Fit:
    """Penalised logistic regression by gradient descent."""
    return classify.fit_logistic(data)


def svm(data: DataFrame, n_docs: int) -> classify.Fit:
    """SVM by subgradient."""
    return classify.fit_svm(data, n_docs)


def weighted_svm(data: DataFrame, n_docs: int) -> classify.Fit:
    """SVM with class weights from the share of positives among all lines."""
    share = data.filter("label = 1").count() / n_docs
    return classify.fit_weighted_svm(data, share)


def lbfgs_report(
    train_lines: DataFrame,
    test_lines: DataFrame,
    iterations: int = 100,
    f: int = DICTIONARY_SIZE,
    mark: str = POSITIVE_MARK,
) -> tuple[DataFrame, DataFrame]:
    """Confusion and F1 of L-BFGS logistic regression on term frequencies."""
    train, test = readers.parse_documents(train_lines), readers.parse_documents(test_lines)
    vocab = dictionary(words_of(train, T.tokenize(F.col("text"))), f)
    words = [r["word"] for r in vocab.orderBy("pos").select("word").toLocalIterator()]
    shape = vectors.vectorizer(words)

    def ready(docs: DataFrame) -> DataFrame:
        label = label_of(mark=mark).cast("double").alias("label")
        rows = docs.select(label, T.tokenize(F.col("text")).alias("tokens"))
        return shape.transform(rows).select("label", "features")

    model = vectors.fit_lbfgs(ready(train), iterations)
    told = cut(model.transform(ready(test)).select("label", "prediction"))
    return evaluate.confusion(told, (0.0, 1.0)), evaluate.f1_binary(told, 1)
