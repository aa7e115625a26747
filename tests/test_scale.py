"""Plans and skew: what must hold when the tables grow."""

import os

import pytest
from pyspark.sql import functions as F

import compare
from plans_util import outer_plan
from tidemark import session
from tidemark.catalog.queries import QUERIES
from tidemark.functions import text as T
from tidemark.operators import features as feat
from tidemark.operators import mixture, words
from tidemark.operators import trips as trip


def test_filters_and_columns_reach_the_scan(spark, tables):
    plan = outer_plan(QUERIES["topk_ratio_by_key"](spark, tables))
    assert "l_quantity" in plan.split("PushedFilters")[1].split("]")[0]
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert schema == "struct<l_suppkey:bigint,l_quantity:double,l_extendedprice:double>"
    assert "TakeOrderedAndProject" in plan and plan.count("Exchange hashpartitioning") == 1


#: Plans in which Spark joins a few rows to a few others (a report's cells, a top-k).
FITS = {"gibbs_mixture", "gibbs_step", "linear_svc", "logit_lbfgs", "naive_bayes_ml"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITS))
def test_no_query_has_a_cross_join_or_a_python_row_function(spark, tables, name):
    if name.startswith(("logit_", "svm_", "review_s", "review_b", "review_l", "gd_", "fitted_", "train_", "validate_", "repeated_")):
        pytest.skip("its plan is that of a finished report; the parts are below")
    plan = outer_plan(QUERIES[name](spark, tables))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert word not in plan


@pytest.mark.parametrize("name", ["topk_count", "tfidf", "knn_vote", "mixture_draw", "cluster_top_words"])
def test_same_rows_for_any_number_of_partitions(spark, tables, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    try:
        for n in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.append(compare.frame_rows(QUERIES[name](spark, tables)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]


def test_one_key_with_a_third_of_all_rows(spark):
    """A repeated document id and a repeated word collapse before the shuffle and keep their counts."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("doc_id")
    docs = spark.range(9000).select(hot, F.concat(F.lit("the the cat w"), F.lit(" x")).alias("text"))
    w = words.words_of(docs, T.tokenize(F.col("text")))
    vocab = words.dictionary(w, 10)
    counts = words.term_counts(w, vocab, 10)
    the = vocab.filter("word = 'the'").first()
    assert the.cnt == 18000 and the.pos == 0
    assert counts.filter("doc_id = -1 AND pos = 0").first().cnt == 6000
    assert feat.document_frequency(counts).filter("pos = 0").first().df == 6001
    top = trip.top_k(trip.count_by(docs, "doc_id"), 1, "n", "doc_id").first()
    assert tuple(top) == (-1, 3000)


def test_top_k_per_group_cuts_before_the_shuffle(spark):
    weights = spark.range(1000).selectExpr("cast(id % 2 as int) cluster", "cast(id as int) pos", "cast(id as double) weight")
    vocab = weights.select("pos", F.col("pos").cast("string").alias("word"))
    assert outer_plan(mixture.top_words(weights, vocab, 3)).count("WindowGroupLimit") == 2


def test_broadcast_only_below_the_bound(spark):
    df = spark.range(10)
    assert session.small_side(df, 20_000) is not df
    assert session.small_side(df, 10**9) is df


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "a").startswith(session.shared_dir(spark))


def test_cut_leaves_no_lineage_and_can_be_cleared(spark):
    df = session.cut(spark.range(100).groupBy((F.col("id") % 3).alias("k")).count())
    assert "Aggregate" not in outer_plan(df) and df.count() == 3
    path = df.inputFiles()[0].removeprefix("file://")
    before = list(session._made)
    session._made[:] = [p for p in before if p in path]
    assert os.path.exists(path) and len(session._made) == 1
    session.clear_scratch(spark)
    assert not os.path.exists(path) and not session._made
    session._made[:] = [p for p in before if p not in path]
