"""Review sentiment: reviews in, models and reports out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.functions.numeric import is_number, to_number
from tidemark.operators import bayes, classify, evaluate, vectors
from tidemark.operators import features as feat
from tidemark.operators.scoring import linear_scores
from tidemark.operators.words import DICTIONARY_SIZE, dictionary, term_counts, words_of
from tidemark.session import cut

# Fixed value: the points from which a review is positive.
GOOD_POINTS = 88


def clean_reviews(reviews: DataFrame, drop_incomplete: bool = False) -> DataFrame:
    """``doc_id, label, tokens`` of the usable reviews.

    Usable: the row number and the points are numeric and the variety is given.
    ``drop_incomplete`` also drops rows with any of the six columns missing.
    """
    if drop_incomplete:
        reviews = reviews.dropna()
    kept = reviews.filter(
        is_number(F.col("_c0")) & F.col("variety").isNotNull() & is_number(F.col("points"))
    )
    label = F.when(to_number(F.col("points")) < GOOD_POINTS, 0).otherwise(1)
    tokens = T.without_stop_words(T.tokenize(F.col("description")))
    return kept.select(F.col("_c0").alias("doc_id"), label.alias("label"), tokens.alias("tokens"))


#: The models by name; L-BFGS and SGD are logistic regressions, the SVM is trained by SGD.
MODELS = ("lbfgs", "sgd", "svm", "bayes")


@dataclass
class Prepared:
    """Reviews split in training and held-out part, with dictionary, idf and weights of their words."""

    rows: DataFrame
    known: DataFrame
    vocab: DataFrame
    idf: DataFrame
    x: DataFrame
    f: int


def prepare(reviews: DataFrame, f: int = DICTIONARY_SIZE, seed: int = 7, drop_incomplete: bool = False) -> Prepared:
    """About two thirds of the reviews train; the split is fixed by review id and seed.

    Reviews that share an id are one for the word weights, with the larger label.
    """
    rows = cut(evaluate.split_rows(clean_reviews(reviews, drop_incomplete), seed=seed))
    known = cut(rows.groupBy("doc_id").agg(F.max("label").alias("label"), F.max("part").alias("part")))
    words = words_of(rows, F.col("tokens"))
    vocab = cut(dictionary(words, f))
    counts = cut(term_counts(words, vocab, f))
    n_docs = rows.count()
    idf = cut(feat.inverse_document_frequency(feat.document_frequency(counts), n_docs, smooth=True))
    return Prepared(rows, known, vocab, idf, cut(feat.features(counts, n_docs, idf=idf, f=f)), f)


def told_by(made: Prepared, name: str, iterations: int | None = None) -> DataFrame:
    """``label, prediction`` of the held-out reviews by the model trained on the others.

    The default iterations are 300 for both logistic regressions and 200 for the SVM.
    """
    spark = made.rows.sparkSession
    if name == "lbfgs":
        return cut(_lbfgs(made.rows, made.vocab, made.idf, iterations or 300))
    train, test = evaluate.training_rows(made.known), evaluate.held_out_rows(made.known)
    truth = test.select("doc_id", "label")
    held_out = made.x.join(truth, "doc_id", "left_semi")
    rows = classify.with_labels(made.x, train)
    if name == "bayes":
        likelihoods = bayes.word_likelihoods(rows, made.vocab, f=made.f)
        found = bayes.classify(held_out, likelihoods, bayes.class_priors(train), f=made.f)
    elif name in ("sgd", "svm"):
        loss, steps = (classify.LOGISTIC, 300) if name == "sgd" else (classify.HINGE, 200)
        with classify.training_table(rows) as data:
            fit = classify.fit_sgd(data, loss, made.f, iterations or steps)
        found = linear_scores(held_out, fit.weights_frame(spark), made.f)
    else:
        raise ValueError(f"unknown model {name!r}")
    return cut(found.join(truth, "doc_id").select("label", "prediction"))


@dataclass
class Reports:
    """Per model name: class report, weighted F1 and confusion on the held-out part."""

    reports: dict[str, DataFrame]
    f1: dict[str, DataFrame]
    confusion: dict[str, DataFrame]


def review_models(
    reviews: DataFrame,
    f: int = DICTIONARY_SIZE,
    seed: int = 7,
    lbfgs_iterations: int = 300,
    sgd_iterations: int = 300,
    svm_iterations: int = 200,
) -> Reports:
    """Train all models on the same part of the reviews and report on the rest."""
    made = prepare(reviews, f, seed)
    steps = {"lbfgs": lbfgs_iterations, "sgd": sgd_iterations, "svm": svm_iterations, "bayes": None}
    told = {name: told_by(made, name, steps[name]) for name in MODELS}
    return Reports(
        reports={n: evaluate.class_report(df) for n, df in told.items()},
        f1={n: evaluate.f1_weighted(df) for n, df in told.items()},
        confusion={n: evaluate.confusion(df) for n, df in told.items()},
    )


def _lbfgs(rows: DataFrame, vocab: DataFrame, idf: DataFrame, iterations: int) -> DataFrame:
    """Held-out ``label, prediction`` of L-BFGS logistic regression on tf-idf vectors."""
    table = vocab.join(idf, "pos", "left").orderBy("pos").select("word", F.coalesce("idf", F.lit(0.0)))
    words, scale = zip(*[(r[0], r[1]) for r in table.collect()])
    shaped = vectors.vectorizer(words, scale).transform(rows)
    data = shaped.select(F.col("label").cast("double").alias("label"), "features", "part")
    model = vectors.fit_lbfgs(evaluate.training_rows(data), iterations)
    scored = model.transform(evaluate.held_out_rows(data))
    return scored.select(F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))
