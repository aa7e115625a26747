"""Whole jobs over small files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plans_util import outer_plan
from tidemark.functions import text as T
from tidemark.operators import classify, mixture
from tidemark.plans import courts, sentiment
from tidemark.plans import trips as trip_plans
from tidemark.plans.clusters import cluster_documents


def trip_line(taxi, driver, hour, duration, distance, fare, surcharge, tolls, amount):
    row = [taxi, driver, f"2013-01-01 {hour}:05:00", "", duration, distance, "", "", "", "", "", fare, surcharge, "", "", tolls, amount]
    return ",".join(map(str, row))


@pytest.fixture(scope="module")
def trip_file(tmp_path_factory):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        distance = round(rng.uniform(1, 20), 2)
        fare = round(3 + 2.5 * distance, 2)
        rows.append(
            trip_line(f"t{i % 13}", f"d{i % 7}", f"{i % 24:02d}", 120 + i, distance, fare, i % 3 / 2, 4.0, fare + 5)
        )
    path = tmp_path_factory.mktemp("trips") / "trips.csv"
    path.write_text("\n".join(rows + ["broken,line"]))
    return str(path), [r.split(",") for r in rows]


def test_trip_reports(spark, trip_file):
    path, rows = trip_file
    top = trip_plans.busiest_taxis(spark, path, 3).collect()
    assert [r.trips for r in top] == [24, 23, 23]
    assert [r.taxi for r in top] == ["t0", "t1", "t10"]
    rates = {}
    for r in rows:
        a, b = rates.get(r[1], (0, 0))
        rates[r[1]] = (a + float(r[16]), b + float(r[4]))
    best = trip_plans.best_drivers(spark, path, 1).first()
    assert best.per_minute == pytest.approx(max(a / b * 60 for a, b in rates.values()))
    hours = {}
    for r in rows:
        if float(r[12]):
            a, b = hours.get(r[2][11:13], (0, 0))
            hours[r[2][11:13]] = (a + float(r[12]), b + float(r[5]))
    best = trip_plans.best_hours(spark, path, 1).first()
    assert best.ratio == pytest.approx(max(a / b for a, b in hours.values()))


def test_trip_lines(spark, trip_file):
    path, _ = trip_file
    line = trip_plans.fare_line(spark, path).first()
    assert line.m == pytest.approx(2.5, abs=1e-2) and line.b == pytest.approx(3, abs=0.05)
    trace = trip_plans.fare_line_trace(spark, path).orderBy("iteration").collect()
    assert len(trace) == 100 and trace[-1].cost < trace[0].cost
    steps = trip_plans.amount_trace(spark, path, iterations=20, standardize=True, rate=0.1).orderBy("iteration").collect()
    assert steps[-1].cost < steps[0].cost


@pytest.fixture(scope="module")
def corpora(spark):
    rng = np.random.default_rng(6)
    court, other = "court judge appeal law applicant".split(), "river town music football station".split()
    shared = "the and of in".split()

    def lines(n, start):
        out = []
        for i in range(start, start + n):
            own = court if i % 3 == 0 else other
            text = " ".join(list(rng.choice(own, 12)) + list(rng.choice(shared, 8)))
            out.append((f'<doc id="{"AU" if i % 3 == 0 else ""}{i}" url="u" title="t">{text}</doc>',))
        return spark.createDataFrame(out + [("no document",)], "value STRING")

    return lines(60, 0), lines(30, 1000)


@pytest.mark.parametrize("name", ["logistic", "svm", "weighted"])
def test_train_and_score(spark, corpora, name):
    fits = {
        "logistic": (lambda data, n: classify.fit_logistic(data, f=40, max_iterations=20), "tfidf"),
        "svm": (lambda data, n: classify.fit_svm(data, n, f=40, c=0.01, max_iterations=20), "tf"),
        "weighted": (lambda data, n: classify.fit_weighted_svm(data, 0.3, f=40, max_iterations=10), "tf"),
    }
    fit, weighting = fits[name]
    report = courts.train_and_score(*corpora, fit, weighting, top=5, f=40)
    assert report.scored.count() == 30
    assert report.f1.first().f1 > 0.9
    assert sum(r.n for r in report.confusion.collect()) == 30
    assert {r.word for r in report.top_words.collect()} <= set("court judge appeal law applicant".split())
    assert report.trace.count() >= 1


def test_lbfgs_report(corpora):
    cells, f1 = courts.lbfgs_report(*corpora, iterations=20, f=40)
    assert f1.first().f1 > 0.9
    assert sum(r.n for r in cells.collect()) == 31 - 1


def review(i, points, variety="Merlot", text="nice ripe wine", number=None):
    return (str(i) if number is None else number, text, "d", points, None, variety)


COLUMNS = "_c0 STRING, description STRING, designation STRING, points STRING, region_1 STRING, variety STRING"


def test_clean_reviews(spark):
    rows = [
        review(1, "87.9"), review(2, "88"), review(3, "x"), review(4, None), review(5, "90", variety=None),
        review(6, "90", number="n6"), review(7, "95", text=None), review(8, "70", text="I was the Best best"),
    ]
    got = {r.doc_id: (r.label, r.tokens) for r in sentiment.clean_reviews(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert {k: v[0] for k, v in got.items()} == {"1": 0, "2": 1, "7": 1, "8": 0}
    assert got["8"][1] == ["the", "best", "best"] and got["7"][1] == []
    full = spark.createDataFrame([review(1, "90")[:4] + ("r", "v"), review(2, "90")], COLUMNS)
    assert [r.doc_id for r in sentiment.clean_reviews(full, drop_incomplete=True).collect()] == ["1"]


def test_review_models(spark):
    rng = np.random.default_rng(8)
    good, bad = "ripe lush elegant fine".split(), "thin sour flat dull".split()
    rows = []
    for i in range(120):
        words = good if i % 2 else bad
        rows.append(review(i, "92" if i % 2 else "80", text=" ".join(list(rng.choice(words, 8)) + ["wine", f"w{i % 5}x"])))
    made = sentiment.review_models(
        spark.createDataFrame(rows, COLUMNS), f=30, lbfgs_iterations=10, sgd_iterations=10, svm_iterations=10
    )
    assert set(made.f1) == {"lbfgs", "sgd", "svm", "bayes"}
    sizes = set()
    for name in made.f1:
        assert made.f1[name].first().f1 > 0.9, name
        sizes.add(sum(r.n for r in made.confusion[name].collect()))
        assert made.reports[name].count() == 2
    assert len(sizes) == 1


def test_clusters_with_two_tokenizers(spark):
    lines = [(i, f'<doc id="20_newsgroups/g/{i:05d}" url="u">Alpha, beta! gamma ({"delta" if i % 2 else "omega"}) it</doc>') for i in range(30)]
    docs = spark.createDataFrame(lines, "doc_id INT, value STRING")
    sizes, words, labels = cluster_documents(
        docs, T.counted_tokens(F.col("value")), T.corpus_tokens(F.col("value")), clusters=2, sweeps=3
    )
    assert labels.count() == 30 and sizes.count() == 6
    # The dictionary keeps words the counting tokenizer never emits.
    assert "it" in {r.word for r in words.collect()}


def test_mixture_rows_stay_by_document(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"))
    tokens = T.tokenize(F.col("text"))
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "word STRING, pos INT")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with mixture.counts_table(mixture.count_rows(docs, tokens, vocab, 2)) as data:
            log_mu = mixture.log_mu_frame(spark, np.log(np.full((2, 2), 0.5)))
            given = mixture.document_probabilities(data, log_mu, [0.0, 0.0], 2)
            table = mixture.cluster_word_counts(data, mixture.draw_labels(given, 2, 0, 1))
            plan = outer_plan(table)
        assert "Exchange hashpartitioning(cluster" in plan
        assert "Exchange hashpartitioning(doc_id" not in plan
        assert plan.count("Scan ExistingRDD") == 0 and plan.count("InMemoryTableScan") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
