"""The operators as queries: each takes a session and a table folder and returns a frame."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.catalog import inputs as I
from tidemark.functions import text as T
from tidemark.functions.numeric import bucket, is_number, uniform
from tidemark.operators import bayes, classify, evaluate, mixture, regression, similarity, vectors
from tidemark.operators import features as feat
from tidemark.operators import trips as trip
from tidemark.operators import words as word
from tidemark.operators.numbering import row_numbers
from tidemark.operators.scoring import linear_scores, top_coefficients
from tidemark.plans import clusters as cluster_plan
from tidemark.plans import courts as court_plan
from tidemark.plans import search as search_plan
from tidemark.plans import sentiment as sentiment_plan
from tidemark.session import cut, scratch_path
from tidemark.sources import readers, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
NEIGHBOURS = 10


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


# Shared pieces


def _words(spark, d):
    return word.words_of(I.documents(spark, d), T.tokenize(F.col("text")))


def _vocab(spark, d):
    return word.letter_dictionary(I.documents(spark, d))


def _counts(spark, d, vocab=None):
    return word.letter_term_counts(I.documents(spark, d), cut(_vocab(spark, d)) if vocab is None else vocab)


def _n_docs(spark, d):
    return feat.row_count(I.table(spark, d, "documents"))


def _idf(spark, d, smooth=False):
    df = feat.document_frequency(_counts(spark, d))
    return feat.inverse_document_frequency(df, _n_docs(spark, d), smooth)


def _tfidf(spark, d, smooth=False, vocab=None):
    counts = _counts(spark, d, vocab)
    return feat.features(counts, _n_docs(spark, d), "tfidf", smooth)


def _fixed_weights(spark, d, vocab=None):
    """A weight for every dictionary position, given by a formula."""
    value = ((F.col("pos") * 7919) % 2001 - 1000) / F.lit(1000.0)
    return (_vocab(spark, d) if vocab is None else vocab).select("pos", value.alias("weight"))


def _scored(spark, d, vocab=None, x=None):
    """doc_id, label, score, prediction under the fixed weights."""
    vocab = cut(_vocab(spark, d)) if vocab is None else vocab
    x = _tfidf(spark, d, smooth=True, vocab=vocab) if x is None else x
    return classify.with_labels(linear_scores(x, _fixed_weights(spark, d, vocab)), I.labels(spark, d))


def _trips(spark, d):
    return readers.parse_trips(I.trip_lines(spark, d))


def _scaled_items(spark, d):
    """Line items with every column near 1."""
    c = F.col
    return I.table(spark, d, "lineitem").select(
        (c("l_quantity") / 50).alias("quantity"),
        (c("l_discount") * 10).alias("discount"),
        (c("l_tax") * 10).alias("tax"),
        (c("l_linenumber") / 7).alias("line"),
        (c("l_extendedprice") / 100000).alias("price"),
    )


# Trip records

TRIP_COLUMNS = ["taxi", "driver", "pickup", "duration", "distance", "fare", "surcharge", "tolls", "amount"]


@query
def clean_trips(spark, d):
    return trip.basic_trips(_trips(spark, d)).select(*TRIP_COLUMNS)


@query
def regular_trips(spark, d):
    return trip.regular_trips(_trips(spark, d)).select(*TRIP_COLUMNS, "duration_seconds")


@query
def number_check(spark, d):
    """Rows per (field count, numeric distance) over raw trip lines."""
    fields = readers.split_fields(I.trip_lines(spark, d))
    checked = fields.select(
        F.size("fields").cast("bigint").alias("n_fields"),
        is_number(F.get("fields", F.lit(5))).alias("numeric_distance"),
    )
    return trip.count_by(checked, "n_fields", "numeric_distance")


@query
def topk_count(spark, d):
    counts = trip.count_by(trip.basic_trips(_trips(spark, d)), "taxi", name="trips")
    return trip.top_k(counts, 10, "trips", "taxi")


@query
def trip_files(spark, d):
    """Trip lines written as bzip2 text, read back and ranked."""
    path = scratch_path(spark, "trips")
    I.trip_lines(spark, d).write.option("compression", "bzip2").text(path)
    counts = trip.count_by(trip.basic_trips(readers.read_trips(spark, path)), "taxi", name="trips")
    return trip.top_k(counts, 10, "trips", "taxi")


@query
def bottomk_count(spark, d):
    counts = trip.count_by(trip.basic_trips(_trips(spark, d)), "taxi", name="trips")
    return trip.bottom_k(counts, 10, "trips", "taxi")


@query
def topk_driver_rate(spark, d):
    paid = trip.paid_trips(_trips(spark, d))
    rates = trip.ratio_by(paid, "driver", F.col("amount"), F.col("duration"), 60.0, "per_minute")
    return rounded(trip.top_k(rates, 10, "per_minute", "driver"), 6, "per_minute")


@query
def topk_ratio_by_key(spark, d):
    items = I.table(spark, d, "lineitem").filter("l_quantity != 0 AND l_extendedprice != 0")
    rates = trip.ratio_by(
        items, "l_suppkey", F.col("l_extendedprice"), F.col("l_quantity"), 60.0, "per_minute"
    )
    return rounded(trip.top_k(rates, 10, "per_minute", "l_suppkey"), 6, "per_minute")


@query
def topk_hour_ratio(spark, d):
    charged = trip.surcharged_trips(_trips(spark, d)).withColumn("hour", T.hour_of(F.col("pickup")))
    ratios = trip.ratio_by(charged, "hour", F.col("surcharge"), F.col("distance"))
    return rounded(trip.top_k(ratios, 10, "ratio", "hour"), 9, "ratio")


@query
def event_hour_ratio(spark, d):
    events = I.table(spark, d, "events").select(F.date_format("ts", "HH").alias("hour"), "value")
    ratios = trip.ratio_by(events, "hour", F.col("value"), F.lit(1))
    return rounded(trip.top_k(ratios, 10, "ratio", "hour"), 9, "ratio")


@query
def lines_round_trip(spark, d):
    """Events written as text lines, read back and split."""
    path = scratch_path(spark, "lines")
    writers.write_lines(I.table(spark, d, "events").select("event_id", "event_type", "user_id"), path)
    fields = readers.split_fields(readers.read_lines(spark, path))
    return trip.count_by(
        fields.select(F.get("fields", F.lit(1)).alias("event_type"), F.size("fields").cast("bigint").alias("n_fields")),
        "event_type",
        "n_fields",
    )


# Linear regression


@query
def line_sums(spark, d):
    items = I.table(spark, d, "lineitem")
    sums = regression.line_sums(items, "l_quantity", "l_extendedprice")
    return rounded(sums, 2, "sum_x", "sum_y", "sum_xx", "sum_xy")


@query
def ols_line(spark, d):
    return rounded(regression.ols_line(I.table(spark, d, "lineitem"), "l_quantity", "l_extendedprice"), 6, "m", "b")


@query
def ols_trip_line(spark, d):
    return rounded(regression.ols_line(trip.regular_trips(_trips(spark, d)), "distance", "fare"), 6, "m", "b")


@query
def gd_line_trace(spark, d):
    trace = regression.descend_line(_scaled_items(spark, d), "quantity", "price", method="moments")
    return rounded(longs(trace, "iteration"), 9, "cost", "b", "m")


@query
def gd_multi_trace(spark, d):
    xs = ["quantity", "discount", "tax", "line"]
    trace = regression.descend_plane(_scaled_items(spark, d), xs, "price", method="moments")
    return rounded(longs(trace, "iteration"), 9, "cost", "b", "w0", "w1", "w2", "w3")


@query
def gd_multi_passes(spark, d):
    """The residual form, one job per iteration."""
    xs = ["quantity", "discount", "tax", "line"]
    trace = regression.descend_plane(_scaled_items(spark, d), xs, "price")
    return rounded(longs(trace, "iteration"), 9, "cost", "b", "w0", "w1", "w2", "w3")


@query
def gd_multi_factors(spark, d):
    """The same trace from triangular factors of the rows, which are read once."""
    xs = ["quantity", "discount", "tax", "line"]
    trace = regression.descend_plane(_scaled_items(spark, d), xs, "price", method="factors")
    return rounded(longs(trace, "iteration"), 9, "cost", "b", "w0", "w1", "w2", "w3")


def _shown(trace, *columns):
    """Four significant digits as text."""
    shown = {c: F.format_string("%.3e", F.col(c)) for c in columns}
    return longs(trace, "iteration").withColumns(shown)


@query
def gd_line_raw(spark, d):
    """Fare over distance as they are, in the residual form."""
    regular = trip.regular_trips(_trips(spark, d))
    return _shown(regression.descend_line(regular, "distance", "fare", iterations=50), "cost", "b", "m")


@query
def gd_trip_raw(spark, d):
    """Amount over four raw columns, in the residual form."""
    xs = ["duration", "distance", "fare", "surcharge"]
    trace = regression.descend_plane(trip.regular_trips(_trips(spark, d)), xs, "amount")
    return _shown(trace, "cost", "b", "w0", "w1", "w2", "w3")


@query
def gd_trip_trace(spark, d):
    """Standardised trip columns against the amount in thousands."""
    regular = trip.regular_trips(_trips(spark, d)).withColumn("amount", F.col("amount") / 1000)
    xs = ["duration", "distance", "fare", "surcharge"]
    trace = regression.descend_plane(regular, xs, "amount", method="moments", standardize=True)
    return rounded(longs(trace, "iteration"), 6, "cost", "b", "w0", "w1", "w2", "w3")


# Words and features


@query
def word_count(spark, d):
    return word.line_word_counts(I.documents(spark, d), "text")


@query
def token_counts(spark, d):
    return word.word_counts(_words(spark, d))


@query
def stop_word_counts(spark, d):
    kept = T.without_stop_words(T.tokenize(F.col("text")))
    return word.word_counts(word.words_of(I.documents(spark, d), kept))


@query
def document_count(spark, d):
    lines = I.tagged_lines(spark, d)
    valid = readers.valid_documents(lines)
    return lines.agg(F.count(F.lit(1)).alias("all_lines")).select(
        "all_lines", feat.row_count(valid).alias("valid_lines")
    )


@query
def vocab_topf(spark, d):
    return longs(_vocab(spark, d), "pos")


@query
def vocab_summaries(spark, d):
    """The dictionary's 500 most frequent words by summaries that hold fewer words than a task reads."""
    return longs(word.frequent_words(_words(spark, d), 500, size=1000), "pos")


@query
def term_count(spark, d):
    return longs(_counts(spark, d), "pos")


@query
def term_count_split(spark, d):
    """Counts over a dictionary too long to be broadcast: all words, of which the 64 most frequent ones are not shuffled."""
    words, f = _words(spark, d), 1 << 23
    return longs(word.term_counts(words, word.dictionary(words, f), f, head=64), "pos")


@query
def term_frequency(spark, d):
    return longs(feat.term_frequency(_counts(spark, d)).select("doc_id", "pos", "tf"), "pos")


@query
def document_frequency(spark, d):
    return longs(feat.document_frequency(_counts(spark, d)), "pos")


@query
def idf_plain(spark, d):
    return rounded(longs(_idf(spark, d), "pos"), 10, "idf")


@query
def idf_smooth(spark, d):
    return rounded(longs(_idf(spark, d, smooth=True), "pos"), 10, "idf")


@query
def tfidf(spark, d):
    return rounded(longs(_tfidf(spark, d), "pos"), 10, "x")


@query
def tfidf_smooth(spark, d):
    return rounded(longs(_tfidf(spark, d, smooth=True), "pos"), 10, "x")


@query
def class_df_share(spark, d):
    chosen = ["applicant", "and", "attack", "protein", "court", "the", "in"]
    return longs(feat.class_shares(I.documents(spark, d), T.tokenize(F.col("text")), I.labels(spark, d), chosen), "label")


# Text parsing


@query
def tagged_documents(spark, d):
    return readers.parse_documents(I.tagged_lines(spark, d).select("value"))


@query
def tagged_files(spark, d):
    """Tagged lines written to text files, read back, counted in tokens."""
    path = scratch_path(spark, "tagged")
    I.tagged_lines(spark, d).select("value").write.text(path)
    docs = readers.read_documents(spark, path)
    return docs.select("doc_id", F.size(T.tokenize(F.col("text"))).cast("bigint").alias("tokens"))


@query
def headers(spark, d):
    return I.tagged_lines(spark, d).select("doc_id", T.header(F.col("value")).alias("header"))


@query
def bodies(spark, d):
    return I.tagged_lines(spark, d).select("doc_id", T.body(F.col("value")).alias("body"))


@query
def stripped_pages(spark, d):
    pages = I.table(spark, d, "pages")
    return pages.select("page_id", T.strip_tags(F.col("html")).alias("text"))


@query
def corpus_vocab(spark, d):
    lines = I.tagged_lines(spark, d)
    return longs(word.dictionary(word.words_of(lines, T.corpus_tokens(F.col("value")))), "pos")


@query
def corpus_term_counts(spark, d):
    """Corpus dictionary with one tokenizer, counts with the other."""
    lines = I.tagged_lines(spark, d)
    body = T.body(F.col("value"))
    vocab = word.piece_dictionary(lines, body, T.corpus_word)
    return longs(word.piece_term_counts(lines, body, T.counted_word, vocab), "pos")


@query
def plain_links(spark, d):
    """Category lines cut at every comma."""
    docs = I.table(spark, d, "documents")
    lines = docs.select(F.format_string('"%d","%s,%s"', "doc_id", "source", "lang").alias("value"))
    return readers.parse_links(lines)


@query
def csv_links(spark, d):
    """Category lines read as CSV: the comma stays in the name."""
    path = scratch_path(spark, "links")
    docs = I.table(spark, d, "documents")
    docs.select(F.format_string('"%d","%s,%s"', "doc_id", "source", "lang").alias("value")).write.text(path)
    return readers.read_links(spark, path)


# Similarity search


def _neighbours(spark, d, metric="dot"):
    with search_plan.search_index(I.documents(spark, d), None, _n_docs(spark, d)) as index:
        return index.nearest(I.links(spark, d), I.queries(spark, d), NEIGHBOURS, metric)


@query
def knn_scores(spark, d):
    """Scores of the pairs that share a word; all others are zero."""
    vocab = cut(_vocab(spark, d))
    counts = _counts(spark, d, vocab)
    idf = cut(feat.inverse_document_frequency(feat.document_frequency(counts), _n_docs(spark, d)))
    vectors_ = similarity.query_vectors(I.queries(spark, d), vocab, idf)
    return rounded(similarity.similarities(feat.features(counts, _n_docs(spark, d), idf=idf), vectors_), 9, "score")


@query
def knn_dot(spark, d):
    return longs(_neighbours(spark, d), "rank")


@query
def knn_cosine(spark, d):
    return longs(_neighbours(spark, d, "cosine"), "rank")


@query
def knn_vote(spark, d):
    votes = similarity.category_vote(_neighbours(spark, d), NEIGHBOURS)
    return longs(votes.withColumnRenamed("rank", "place"), "place", "votes")


# Scoring and evaluation under fixed weights


@query
def linear_score(spark, d):
    vocab = cut(_vocab(spark, d))
    scores = linear_scores(_tfidf(spark, d, smooth=True, vocab=vocab), _fixed_weights(spark, d, vocab))
    return rounded(longs(scores, "prediction"), 9, "score")


@query
def top_words_by_weight(spark, d):
    return longs(top_coefficients(_fixed_weights(spark, d), _vocab(spark, d), 10), "pos")


@query
def confusion_matrix(spark, d):
    return longs(evaluate.confusion(_scored(spark, d)), "label", "prediction")


@query
def f1_binary(spark, d):
    return rounded(evaluate.f1_binary(_scored(spark, d)), 12, "f1")


@query
def f1_weighted(spark, d):
    return rounded(evaluate.f1_weighted(_scored(spark, d)), 12, "f1")


@query
def class_report(spark, d):
    return rounded(longs(evaluate.class_report(_scored(spark, d)), "label"), 12, "precision", "recall", "f1")


@query
def false_positives(spark, d):
    vocab = cut(_vocab(spark, d))
    best = top_coefficients(_fixed_weights(spark, d, vocab), vocab, 10).select("pos", "word")
    x = cut(_tfidf(spark, d, smooth=True, vocab=vocab))
    found = evaluate.false_positives(cut(_scored(spark, d, vocab, x)), x, best)
    return rounded(longs(found, "pos"), 10, "x")


@query
def split_hash(spark, d):
    return longs(evaluate.split_rows(I.labels(spark, d)).select("doc_id", "part"), "part")


@query
def positive_share(spark, d):
    """Class by a mark inside the document id, and its share of all lines."""
    docs = I.table(spark, d, "documents")
    marked = docs.select(F.concat_ws("-", F.upper("lang"), F.col("doc_id")).alias("doc_id"))
    label = F.when(F.contains("doc_id", F.lit("EN")), 1).otherwise(0)
    return marked.agg(F.avg(label).alias("share"), F.sum(label).alias("positives"))


# Gradients and fits


def _led_labels(spark, d, weighting="tfidf", vocab=None):
    counts = _counts(spark, d, vocab)
    x = feat.features(counts, _n_docs(spark, d), weighting, smooth=True)
    return classify.labelled(classify.with_labels(x, I.labels(spark, d)))


def _gradient(spark, d, loss):
    vocab = cut(_vocab(spark, d))
    table = classify.loss_pass(_led_labels(spark, d, vocab=vocab), _fixed_weights(spark, d, vocab), loss)
    return rounded(longs(table, "pos"), 9, "gradient", "cost")


@query
def logistic_gradient(spark, d):
    return _gradient(spark, d, classify.LOGISTIC)


@query
def hinge_gradient(spark, d):
    return _gradient(spark, d, classify.HINGE)


@query
def weighted_hinge_gradient(spark, d):
    return _gradient(spark, d, classify.weighted_hinge(0.25, 0.75))


def _fitted(spark, d, fit, weighting="tf"):
    x = feat.features(_counts(spark, d), _n_docs(spark, d), weighting, smooth=True)
    with classify.training_table(classify.with_labels(x, I.labels(spark, d))) as data:
        return fit(data)


def _trace(spark, fit):
    trace = longs(fit.trace_frame(spark), "iteration")
    return rounded(rounded(trace, 6, "cost", "norm"), 9, "rate")


@query
def logit_l2_gd(spark, d):
    """Every step of a whole fit; its sums are exact, so the adaptive rate takes the same branch everywhere."""
    fit = _fitted(spark, d, lambda data: classify.fit_logistic(data), "tfidf")
    return _trace(spark, fit)


@query
def logit_sgd(spark, d):
    fit = _fitted(spark, d, lambda data: classify.fit_sgd(data, classify.LOGISTIC, iterations=300), "tfidf")
    return _trace(spark, fit)


@query
def svm_hinge(spark, d):
    n = I.table(spark, d, "documents").count()
    fit = _fitted(spark, d, lambda data: classify.fit_svm(data, n))
    return _trace(spark, fit)


@query
def svm_sgd(spark, d):
    fit = _fitted(spark, d, lambda data: classify.fit_sgd(data, classify.HINGE, iterations=200), "tfidf")
    return _trace(spark, fit)


@query
def svm_weighted(spark, d):
    share = I.labels(spark, d).agg(F.avg("label")).first()[0]
    fit = _fitted(spark, d, lambda data: classify.fit_weighted_svm(data, share))
    return _trace(spark, fit)


@query
def naive_bayes_likelihoods(spark, d):
    rows = classify.with_labels(feat.features(_counts(spark, d), _n_docs(spark, d), "tf"), I.labels(spark, d))
    table = bayes.word_likelihoods(rows, _vocab(spark, d))
    return rounded(
        longs(table.select("pos", F.col("w")[0].alias("w0"), F.col("w")[1].alias("w1")), "pos"), 9, "w0", "w1"
    )


@query
def naive_bayes(spark, d):
    """Predictions for all documents from the labelled ones, on counts."""
    x = feat.features(_counts(spark, d), _n_docs(spark, d), "count")
    rows = classify.with_labels(x, I.labels(spark, d))
    table = bayes.word_likelihoods(rows, _vocab(spark, d))
    found = bayes.classify(x, table, bayes.class_priors(I.labels(spark, d)))
    return longs(found.select("doc_id", "prediction"), "prediction")


def _vector_report(spark, d, fit):
    """Train on parts 1 and 2, report on part 3."""
    words = [r["word"] for r in _vocab(spark, d).orderBy("pos").select("word").toLocalIterator()]
    docs = classify.with_labels(I.documents(spark, d), I.labels(spark, d))
    rows = docs.select("doc_id", F.col("label").cast("double").alias("label"), T.tokenize(F.col("text")).alias("tokens"))
    data = evaluate.split_rows(vectors.vectorizer(words).transform(rows)).select("label", "features", "part")
    data = data.persist()
    try:
        model = fit(evaluate.training_rows(data))
        told = model.transform(evaluate.held_out_rows(data)).select("label", "prediction")
        lines = evaluate.class_report(told, (0.0, 1.0)).collect()
    finally:
        data.unpersist()
    schema = "label DOUBLE, precision DOUBLE, recall DOUBLE, f1 DOUBLE, support BIGINT"
    return rounded(spark.createDataFrame(lines, schema), 12, "precision", "recall", "f1")


@query
def logit_lbfgs(spark, d):
    return _vector_report(spark, d, vectors.fit_lbfgs)


@query
def linear_svc(spark, d):
    return _vector_report(spark, d, lambda data: vectors.fit_linear_svc(data, iterations=200))


@query
def naive_bayes_ml(spark, d):
    return _vector_report(spark, d, vectors.fit_naive_bayes)


# Mixture of multinomials

CLUSTERS = 6
BETA = 0.1


def _fixed_clusters(spark, d):
    cluster = (bucket(F.col("doc_id"), buckets=CLUSTERS, seed=5) - 1).alias("cluster")
    return I.table(spark, d, "documents").select("doc_id", cluster)


def _count_rows(spark, d, vocab):
    """Counts of dictionary words, worked out once: a query reads them twice."""
    return cut(mixture.count_rows(I.documents(spark, d), T.tokenize(F.col("text")), vocab))


def _cluster_counts(spark, d, rows):
    return mixture.cluster_word_counts(mixture.led_counts(rows), _fixed_clusters(spark, d))


def _cluster_log_mu(spark, d, rows):
    """Mean word probabilities of the fixed clusters, as ``pos, w``."""
    by_pos = _cluster_counts(spark, d, rows).filter(F.col("pos") != mixture.NO_WORD).groupBy("pos").agg(*[
        F.sum(F.when(F.col("cluster") == j, F.col("cnt"))).alias(f"c{j}") for j in range(CLUSTERS)
    ])
    mass = [F.coalesce(F.col(f"c{j}"), F.lit(0.0)) + BETA for j in range(CLUSTERS)]
    total = by_pos.agg(F.array(*[F.sum(m) for m in mass]).alias("t")).scalar()
    return by_pos.select("pos", F.array(*[F.log(m / total[j]) for j, m in enumerate(mass)]).alias("w"))


def _probabilities(spark, d):
    rows = _count_rows(spark, d, _vocab(spark, d))
    data = mixture.led_counts(rows)
    return mixture.document_probabilities(data, _cluster_log_mu(spark, d, rows), [0.0] * CLUSTERS, word.DICTIONARY_SIZE)


@query
def cluster_word_counts(spark, d):
    return longs(_cluster_counts(spark, d, _count_rows(spark, d, _vocab(spark, d))), "cluster", "pos")


@query
def cluster_sizes(spark, d):
    return longs(mixture.cluster_sizes(_fixed_clusters(spark, d)).orderBy("cluster"), "cluster")


@query
def mixture_probabilities(spark, d):
    p = _probabilities(spark, d)
    return p.select("doc_id", *[F.round(F.col("probabilities")[j], 6).alias(f"p{j}") for j in range(CLUSTERS)])


@query
def mixture_draw(spark, d):
    return longs(mixture.draw_labels(_probabilities(spark, d), CLUSTERS, sweep=3, seed=7), "cluster")


@query
def uniform_draw(spark, d):
    docs = I.table(spark, d, "documents")
    return docs.select("doc_id", uniform(F.col("doc_id"), F.lit(3), seed=7).alias("u"))


@query
def cluster_top_words(spark, d):
    vocab = cut(_vocab(spark, d))
    counts = _cluster_counts(spark, d, _count_rows(spark, d, vocab)).filter(F.col("pos") != mixture.NO_WORD)
    best = mixture.top_words(counts, vocab, 100, by="cnt")
    return longs(best, "cluster", "rank")


@query
def cluster_purity(spark, d):
    found = readers.parse_clusters(I.news_lines(spark, d))
    return longs(mixture.purity(found), "rank")


@query
def gibbs_step(spark, d):
    """One sweep from the word probabilities of the fixed clusters: counts by cluster and position, documents at -1."""
    rows = _count_rows(spark, d, _vocab(spark, d))
    table = _cluster_log_mu(spark, d, rows).toArrow()
    log_mu = np.zeros((CLUSTERS, table.num_rows))
    log_mu[:, table["pos"].to_numpy()] = np.stack(table["w"].to_numpy()).T
    with mixture.sweep_table(rows) as data:
        counts = cut(mixture.sweep_counts(data, log_mu, np.zeros(CLUSTERS), sweep=3, seed=7))
    return longs(counts, "cluster", "pos")


def _fitted_clusters(spark, docs, tokens, vocab_tokens, clusters, sweeps):
    """Sizes after each sweep, the top words of each cluster, and the documents' last clusters, as kind, cluster, place, name, value."""
    sizes, words, labels = cluster_plan.cluster_documents(docs, tokens, vocab_tokens, clusters=clusters, sweeps=sweeps)
    none = F.lit("")
    told = [
        sizes.select(F.lit("size").alias("kind"), "cluster", F.col("sweep").alias("place"), none.alias("name"), F.col("n").cast("double").alias("value")),
        words.select(F.lit("word"), "cluster", "rank", "word", F.round("weight", 6)),
        labels.select(F.lit("label"), "cluster", F.lit(0), F.col("doc_id").cast("string"), F.lit(0.0)),
    ]
    return longs(told[0].union(told[1]).union(told[2]), "cluster", "place")


@query
def fitted_clusters(spark, d):
    """Three sweeps from the first draw; dictionary and counts come from two tokenizers."""
    lines = I.tagged_lines(spark, d)
    return _fitted_clusters(spark, lines, T.counted_tokens(F.col("value")), T.corpus_tokens(F.col("value")), CLUSTERS, 3)


@query
def gibbs_mixture(spark, d):
    """Two hundred sweeps of twenty clusters."""
    return _fitted_clusters(spark, I.documents(spark, d), None, None, 20, 200)


def _clustered(spark, d):
    """cluster, header of every tagged line, by the fixed clusters."""
    lines = I.tagged_lines(spark, d)
    return lines.join(_fixed_clusters(spark, d), "doc_id").select("cluster", T.header(F.col("value")).alias("header"))


@query
def cluster_files(spark, d):
    """Assignments written as sorted text lines, read back and counted; in_order: after all lines of smaller clusters."""
    path = scratch_path(spark, "clusters")
    writers.write_clusters(_clustered(spark, d), path)
    cluster = F.regexp_extract("value", "^\\((\\d+), ", 1).alias("cluster")
    place = F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line"))
    found = readers.read_lines(spark, path).select(cluster, place.alias("place")).groupBy("cluster")
    sizes = found.agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"), F.max("place").alias("last"))
    before = F.lag("last").over(Window.orderBy(F.col("cluster").cast("int")))  # one row per cluster
    in_order = F.coalesce(before < F.col("first"), F.lit(True))
    return sizes.select("cluster", "n", in_order.alias("in_order"))


@query
def zipped_clusters(spark, d):
    """Two frames without a common key, the headers and their clusters, put side by side by row number."""
    lines = I.tagged_lines(spark, d)
    heads = row_numbers(lines.select("doc_id", T.header(F.col("value")).alias("header")), "doc_id").select("n", "header")
    drawn = row_numbers(_fixed_clusters(spark, d), "doc_id").select("n", "cluster")
    return longs(heads.join(drawn, "n"), "cluster")


@query
def report_file(spark, d):
    """A top-k report written as one CSV file and read back."""
    path = scratch_path(spark, "report")
    writers.write_report(topk_count(spark, d), path)
    return spark.read.schema("taxi STRING, trips BIGINT").option("header", True).csv(path)


@query
def table_file(spark, d):
    """Term counts written as a table and read back."""
    path = scratch_path(spark, "table")
    writers.write_table(_counts(spark, d), path)
    return feat.document_frequency(spark.read.parquet(path)).withColumn("pos", F.col("pos").cast("bigint"))


def _validation(spark, d, fit, weighting="tfidf", refit_idf=False, doc_id=None):
    """Class by a mark in the document id; two thirds of the lines train, the rest test."""
    docs = evaluate.split_rows(I.documents(spark, d, "lang"))
    own = F.concat(F.upper("lang"), F.col("doc_id").cast("string")) if doc_id is None else doc_id
    one_line = F.regexp_replace("text", "[\\r\\n]+", " ")
    line = F.format_string('<doc id="%s" url="u">%s</doc>', own, one_line).alias("value")
    train, test = evaluate.training_rows(docs), evaluate.held_out_rows(docs)
    return court_plan.train_and_score(train.select(line), test.select(line), fit, weighting, refit_idf, mark="EN")


@query
def train_and_validate(spark, d):
    return longs(_validation(spark, d, court_plan.logistic).confusion, "label", "prediction")


@query
def validate_svm(spark, d):
    return longs(_validation(spark, d, court_plan.svm, "tf").confusion, "label", "prediction")


@query
def validate_weighted_svm(spark, d):
    return longs(_validation(spark, d, court_plan.weighted_svm, "tf").confusion, "label", "prediction")


@query
def fitted_words(spark, d):
    """Top words of a real fit, and their weights in the first false positives, with the test documents' own idf."""
    report = _validation(spark, d, court_plan.logistic, refit_idf=True)
    best = report.top_words.select(
        F.lit("top word").alias("kind"), "word", F.lit("").alias("doc_id"), F.round("weight", 4).alias("value")
    )
    wrong = report.false_positives.select(
        F.lit("false positive").alias("kind"), "word", "doc_id", F.round("x", 8).alias("value")
    )
    return best.unionByName(wrong)


@query
def repeated_ids_report(spark, d):
    """As ``train_and_validate``, but a third of the lines share one id: each id is one document."""
    own = F.concat(F.upper("lang"), F.col("doc_id").cast("string"))
    folded = F.when(F.col("doc_id") % 3 == 0, "EN").otherwise(own)
    report = _validation(spark, d, court_plan.logistic, doc_id=folded)
    f1 = rounded(report.f1, 12, "f1")
    return longs(report.confusion, "label", "prediction").select("*", f1.select("f1").scalar().alias("f1"))


@query
def lbfgs_optimum(spark, d):
    """L-BFGS with an L2 term, where the optimum is unique: its heaviest words on either side."""
    fit = _fitted(spark, d, lambda data: classify.fit_lbfgs(data))
    weights = fit.weights_frame(spark).withColumn("weight", F.round("weight", 4))
    rows = weights.join(_vocab(spark, d), "pos").select("word", "pos", "weight")
    heavy = rows.orderBy(F.col("weight").desc(), "pos").limit(50)
    light = rows.orderBy("weight", "pos").limit(50)
    return longs(heavy.unionByName(light), "pos")


@query
def lbfgs_held_out(spark, d):
    """L-BFGS with an L2 term on parts 1 and 2 of the labelled documents, reported on part 3."""
    marks = evaluate.split_rows(I.labels(spark, d))
    x = cut(feat.features(_counts(spark, d), _n_docs(spark, d), "tf"))
    with classify.training_table(classify.with_labels(x, evaluate.training_rows(marks))) as data:
        fit = classify.fit_lbfgs(data)
    told = linear_scores(classify.with_labels(x, evaluate.held_out_rows(marks)).drop("label"), fit.weights_frame(spark))
    told = classify.with_labels(told, marks).select("label", "prediction")
    return rounded(longs(evaluate.class_report(told), "label"), 12, "precision", "recall", "f1")


# Reviews


def _review_report(spark, d, name):
    told = sentiment_plan.told_by(sentiment_plan.prepare(I.reviews(spark, d)), name)
    return rounded(longs(evaluate.class_report(told), "label"), 12, "precision", "recall", "f1")


@query
def review_sgd(spark, d):
    return _review_report(spark, d, "sgd")


@query
def review_svm(spark, d):
    return _review_report(spark, d, "svm")


@query
def review_bayes(spark, d):
    return _review_report(spark, d, "bayes")


@query
def review_lbfgs(spark, d):
    return _review_report(spark, d, "lbfgs")


@query
def review_complete(spark, d):
    """Only reviews without a missing column."""
    rows = sentiment_plan.clean_reviews(I.reviews(spark, d), drop_incomplete=True)
    return longs(rows.select("doc_id", "label", F.size("tokens").alias("tokens")), "label", "tokens")


@query
def review_labels(spark, d):
    rows = sentiment_plan.clean_reviews(I.reviews(spark, d))
    return longs(rows.select("doc_id", "label", F.size("tokens").alias("tokens")), "label", "tokens")


@query
def review_word_counts(spark, d):
    rows = sentiment_plan.clean_reviews(I.reviews(spark, d))
    words = rows.select("label", F.explode("tokens").alias("word"))
    return longs(trip.count_by(words, "label", "word"), "label")


@query
def review_files(spark, d):
    """Reviews written as CSV with a header, read back and cleaned."""
    path = scratch_path(spark, "reviews")
    I.reviews(spark, d).write.option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    rows = sentiment_plan.clean_reviews(readers.read_reviews(spark, path, multi_line=True))
    return longs(rows.select("doc_id", "label", F.size("tokens").alias("tokens")), "label", "tokens")
