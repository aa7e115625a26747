"""Dictionary, weights and similarity search against brute force on small texts."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.catalog import inputs
from tidemark.functions import text as T
from tidemark.operators import features as feat
from tidemark.operators import similarity, words
from tidemark.operators.numbering import row_numbers
from tidemark.operators.scoring import dot_products, linear_scores, top_coefficients
from tidemark.plans.search import search_categories, search_index

TEXTS = {
    "d1": "apple banana apple cherry",
    "d2": "banana banana date",
    "d3": "cherry date egg fig apple",
    "d4": "fig fig fig",
    "d5": "!!! 123",
    "d6": "banana banana date",
    "d7": "egg grape",
}
LINKS = [("d1", "fruit"), ("d1", "red"), ("d2", "yellow"), ("d3", "mixed"), ("d4", "purple"), ("d6", "yellow"), ("d6", "a"), ("d9", "none")]
QUERIES = {0: "apple cherry", 1: "Banana date!", 2: "unknown", 3: "fig apple apple"}
F_MAX = 6


def tokens(text):
    return re.sub("[^a-zA-Z]", " ", text).lower().split()


class Plain:
    """The same features as dense arrays."""

    def __init__(self, f=F_MAX, smooth=False, n_docs=None):
        totals = Counter(w for t in TEXTS.values() for w in tokens(t))
        self.vocab = [w for w, _ in sorted(totals.items(), key=lambda p: (-p[1], p[0]))[:f]]
        self.n = len(TEXTS) if n_docs is None else n_docs
        tf = {d: self.tf(t) for d, t in TEXTS.items()}
        self.tfs = {d: v for d, v in tf.items() if v is not None}
        self.df = sum((v > 0).astype(int) for v in self.tfs.values())
        self.idf = np.log(self.n / (self.df + (1 if smooth else 0)))
        self.x = {d: v * self.idf for d, v in self.tfs.items()}

    def tf(self, text):
        v = np.zeros(len(self.vocab))
        for w in tokens(text):
            if w in self.vocab:
                v[self.vocab.index(w)] += 1
        return v / v.sum() if v.sum() else None

    def nearest(self, text, k, cosine=False):
        q = self.tf(text)
        if q is None:
            return []
        q = q * self.idf
        rows = []
        for doc, category in LINKS:
            if doc in self.x:
                s = float(self.x[doc] @ q)
                if cosine:
                    s /= np.linalg.norm(self.x[doc]) * np.linalg.norm(q)
                rows.append((-round(s, 12), category, doc))
        return sorted(rows)[:k]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(TEXTS.items()), "doc_id STRING, text STRING").repartition(3)


@pytest.fixture(scope="module")
def parts(spark, docs):
    w = words.words_of(docs, T.tokenize(F.col("text")))
    vocab = words.dictionary(w, F_MAX)
    return w, vocab, words.term_counts(w, vocab, F_MAX)


def test_dictionary(parts):
    got = {r.pos: r.word for r in parts[1].collect()}
    assert [got[i] for i in range(F_MAX)] == Plain().vocab


def test_short_corpus_gives_short_dictionary(parts):
    assert words.dictionary(parts[0], 1000).count() == len({w for t in TEXTS.values() for w in tokens(t)})


def _zipf(spark, n=40_000, distinct=3000, seed=5):
    """Words with counts that fall with their number, a third of them one word, over eight partitions."""
    draw = F.pow(F.lit(float(distinct)), F.rand(seed)).cast("int")
    word = F.when(F.col("id") % 3 == 0, F.lit("w0")).otherwise(F.concat(F.lit("w"), draw.cast("string")))
    return spark.range(0, n, 1, 8).select((F.col("id") % 500).alias("doc_id"), word.alias("word"))


@pytest.mark.parametrize("size", [1, 20, 400, 1500, 100_000])
def test_summaries_give_the_dictionary(spark, size):
    """Few held words fall back to all, some give candidates that are counted again, many hold all: always the same rows."""
    rows = _zipf(spark)
    wanted = [tuple(r) for r in words.dictionary(rows, 50).orderBy("pos").collect()]
    assert [tuple(r) for r in words.frequent_words(rows, 50, size).orderBy("pos").collect()] == wanted


@pytest.mark.parametrize("size,counted", [(20, "all"), (400, "candidates"), (100_000, "none")])
def test_summaries_shuffle_no_more_than_they_hold(spark, monkeypatch, size, counted):
    seen = []
    for name in ("dictionary", "_may_hold"):
        inner = getattr(words, name)
        monkeypatch.setattr(words, name, lambda *a, n=name, i=inner: seen.append(n) or i(*a))
    rows = _zipf(spark)
    words.frequent_words(rows, 50, size).collect()
    assert seen == {"all": ["dictionary"], "candidates": ["_may_hold"], "none": []}[counted]
    held = rows.select("word").mapInArrow(words._summaries(size), "word string, cnt bigint, lost bigint").collect()
    true = Counter(r.word for r in rows.collect())
    low = Counter()
    for r in held:
        low[r.word] += r.cnt if r.lost is None else 0
    lost = sum(r.lost or 0 for r in held)
    assert sum(r.lost is None for r in held) <= 8 * size
    assert all(0 <= true[w] - low[w] <= lost for w in true) and lost <= sum(true.values()) / size


def test_summaries_of_nothing_ties_and_short_corpora(spark):
    none = spark.createDataFrame([], "doc_id STRING, word STRING")
    assert words.frequent_words(none, 5, 2).count() == 0
    tied = spark.createDataFrame([("d", w) for w in "edcbaedcba"], "doc_id STRING, word STRING")
    for size in (1, 3, 10):
        assert [tuple(r) for r in words.frequent_words(tied, 3, size).orderBy("pos").collect()] == [("a", 0, 2), ("b", 1, 2), ("c", 2, 2)]
        assert words.frequent_words(tied, 100, size).count() == 5


@pytest.mark.parametrize("head", [0, 1, 40, 10_000])
def test_split_dictionary_gives_the_same_counts(spark, head):
    rows = _zipf(spark)
    vocab = words.dictionary(rows, 300)
    wanted = sorted(tuple(r) for r in words.term_counts(rows, vocab, 300).collect())
    assert sorted(tuple(r) for r in words.term_counts(rows, vocab, 300, head=head).collect()) == wanted


def test_long_dictionaries_are_numbered_by_ranges(spark, monkeypatch):
    rows = _zipf(spark)
    wanted = sorted(tuple(r) for r in words.dictionary(rows, 300).collect())
    monkeypatch.setattr(words, "HEAD", 100)
    assert sorted(tuple(r) for r in words.dictionary(rows, 300).collect()) == wanted


def test_filter_keeps_every_key_and_few_others(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("word")).select(*words._prints())
    rows = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("word")).select("word", *words._prints())
    kept = {r.word for r in words._may_hold(rows, keys).collect()}
    assert {f"k{i}" for i in range(5000)} <= kept and len(kept) < 5000 + 15_000 * 0.05


@pytest.mark.parametrize("head", [10, 0])
def test_word_with_a_third_of_all_rows_is_no_single_task(spark, head):
    """In the head it is not shuffled; a word that only the held-out rows repeat is dealt over several tasks."""
    rows = _zipf(spark)
    vocab = words.dictionary(rows, 300)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        met = words.known_words(rows, vocab, 300, head)
        sizes = sorted(r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sizes[-1] < 2 * sizes[len(sizes) // 2]


def test_empty_tokens_count(spark):
    df = spark.createDataFrame([("a  b",), ("",)], "value STRING")
    assert {r.word: r.cnt for r in words.line_word_counts(df).collect()} == {"a": 1, "b": 1, "": 2}


@pytest.mark.parametrize("weighting,smooth", [("tf", False), ("tfidf", False), ("tfidf", True), ("count", False)])
def test_features(parts, docs, weighting, smooth):
    plain = Plain(smooth=smooth)
    wanted = plain.tfs if weighting == "tf" else plain.x
    rows = feat.features(parts[2], feat.row_count(docs), weighting, smooth, f=F_MAX).collect()
    assert {r.doc_id for r in rows} == set(plain.tfs)
    if weighting == "count":
        assert sum(r.x for r in rows) == sum(w in plain.vocab for t in TEXTS.values() for w in tokens(t))
    else:
        for r in rows:
            assert r.x == pytest.approx(wanted[r.doc_id][r.pos])


def test_tf_sums_to_one_and_df_is_bounded(parts, docs):
    sums = feat.term_frequency(parts[2]).groupBy("doc_id").agg(F.sum("tf").alias("s")).collect()
    assert all(r.s == pytest.approx(1) for r in sums)
    assert max(r.df for r in feat.document_frequency(parts[2]).collect()) <= len(TEXTS)


def test_training_idf_is_used_when_given(spark, parts, docs):
    idf = feat.inverse_document_frequency(feat.document_frequency(parts[2]), 7, smooth=True)
    one = spark.createDataFrame([("t", "apple fig")], "doc_id STRING, text STRING")
    counts = words.term_counts(words.words_of(one, T.tokenize(F.col("text"))), parts[1], F_MAX)
    plain = Plain(smooth=True)
    got = {r.pos: r.x for r in feat.features(counts, 1, idf=idf, f=F_MAX).collect()}
    assert got == {p: pytest.approx(0.5 * plain.idf[p]) for p in (plain.vocab.index("apple"), plain.vocab.index("fig"))}
    own = {r.pos: r.x for r in feat.features(counts, 1, f=F_MAX).collect()}
    assert all(v == pytest.approx(0.5 * math.log(1 / 2)) for v in own.values())


def test_df_shares_the_shuffle_of_the_counts(parts, docs):
    df = feat.features(parts[2], feat.row_count(docs), f=F_MAX)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_unknown_weighting(parts):
    with pytest.raises(ValueError):
        feat.features(parts[2], 1, "x")


def test_class_shares(spark, docs):
    """d5 has no word, so it is in no denominator."""
    labels = spark.createDataFrame([("d1", 1), ("d3", 1), ("d2", 0), ("d4", 0), ("d5", 0)], "doc_id STRING, label INT")
    got = {(r.label, r.word): r.share for r in feat.class_shares(docs, T.tokenize(F.col("text")), labels, ["apple", "banana", "zebra"]).collect()}
    assert got == {
        (1, "apple"): 1.0, (1, "banana"): 0.5, (1, "zebra"): 0.0,
        (0, "apple"): 0.0, (0, "banana"): 0.5, (0, "zebra"): 0.0,
    }


@pytest.mark.parametrize("metric", ["dot", "cosine"])
@pytest.mark.parametrize(("first", "size"), [(1, 1), (1, 3), (3, 4)])
def test_nearest_rows(spark, docs, metric, first, size, monkeypatch):
    monkeypatch.setattr(similarity, "FIRST_RANGES", first)
    monkeypatch.setattr(similarity.ranged, "__defaults__", (size,))
    links = spark.createDataFrame(LINKS, "doc_id STRING, category STRING")
    queries = spark.createDataFrame(list(QUERIES.items()), "query_id INT, text STRING")
    with search_index(docs, T.tokenize(F.col("text")), len(TEXTS), f=F_MAX) as index:
        rows = index.nearest(links, queries, 4, metric).collect()
    plain = Plain()
    for q, text in QUERIES.items():
        got = [(-r.score, r.category, r.doc_id) for r in sorted(rows, key=lambda r: r["rank"]) if r.query_id == q]
        wanted = plain.nearest(text, 4, metric == "cosine")
        assert [g[1:] for g in got] == [w[1:] for w in wanted]
        np.testing.assert_allclose([g[0] for g in got], [w[0] for w in wanted], atol=1e-11)


def test_vote_over_files(spark, tmp_path):
    folder = tmp_path / "docs"
    folder.mkdir()
    lines = [f'<doc id="{d}" url="u">{t}</doc>' for d, t in TEXTS.items()] + ["no document"]
    (folder / "a.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "links.csv").write_text("".join(f'"{d}","{c}"\n' for d, c in LINKS))
    got = search_categories(spark, str(folder), str(tmp_path / "links.csv"), list(QUERIES.values()), k=4, f=F_MAX)
    plain = Plain(n_docs=len(TEXTS) + 1)
    for q, text in QUERIES.items():
        votes = Counter(c for _, c, _ in plain.nearest(text, 4))
        wanted = sorted(votes.items(), key=lambda p: (-p[1], p[0]))
        rows = sorted((r["rank"], r.category, r.votes) for r in got.collect() if r.query_id == q)
        assert [(c, n) for _, c, n in rows] == wanted


def test_linear_scores_and_coefficients(spark, parts, docs):
    x = feat.features(parts[2], feat.row_count(docs), f=F_MAX)
    weights = spark.createDataFrame([(0, -1.0), (1, 2.0), (2, 2.0)], "pos INT, weight DOUBLE")
    plain = Plain(smooth=True)
    w = np.array([-1, 2, 2, 0, 0, 0.0])
    rows = linear_scores(x, weights, F_MAX).collect()
    assert {r.doc_id for r in rows} == set(plain.x)
    for r in rows:
        s = plain.x[r.doc_id] @ w
        assert r.score == pytest.approx(s, abs=1e-12) and r.prediction == (0 if r.score < 0 else 1)
    assert [r.word for r in top_coefficients(weights, parts[1], 2).orderBy("pos").collect()] == plain.vocab[1:3]


def test_scoring_needs_no_shuffle_by_document(parts, docs, spark):
    x = feat.features(parts[2], feat.row_count(docs), f=F_MAX)
    weights = spark.createDataFrame([(0, [1.0])], "pos INT, w ARRAY<DOUBLE>")
    plan = dot_products(x, weights, 1, F_MAX)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(doc_id") == x._jdf.queryExecution().executedPlan().toString().count(
        "Exchange hashpartitioning(doc_id"
    )


def test_ranked_rows_stay_near_k(spark, monkeypatch):
    """Of 4,000 documents that share a word with each query, few reach the bound and are ranked."""
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("the "), F.repeat(F.lit("cat "), (F.col("id") % 50 + 1).cast("int")), F.repeat(F.lit("dog "), ((F.col("id") * 7) % 90).cast("int"))).alias("text"),
    )
    links = docs.select("doc_id", F.lit("c").alias("category"))
    queries = spark.createDataFrame([(i, t) for i, t in enumerate(["cat", "dog", "cat dog"])], "query_id BIGINT, text STRING")
    seen = []
    monkeypatch.setattr(similarity, "_zero_rows", lambda *a: pytest.fail("every query has k hits"))
    best = similarity._first_categories
    monkeypatch.setattr(similarity, "_first_categories", lambda found, *a: seen.append(found) or best(found, *a))
    with search_index(docs, T.tokenize(F.col("text")), 5000, f=5) as index:
        rows = index.nearest(links, queries, 10)
        assert dict(rows.dtypes)["query_id"] == "bigint" and rows.count() == 30
        assert seen[0].count() < 3 * 4000 / 4


def scored_pairs(monkeypatch):
    """The frames of pairs that are scored from now on."""
    seen, score = [], similarity._range_scores
    monkeypatch.setattr(similarity, "_range_scores", lambda *a: seen.append(score(*a)) or seen[-1])
    return seen


@pytest.mark.parametrize("metric", ["dot", "cosine"])
def test_few_pairs_are_scored(spark, monkeypatch, metric):
    """Of the pairs with a common word in 10,000 documents less than a tenth is scored, and none twice."""
    folder = "/root/testdata/sf0.1"
    docs, queries = inputs.documents(spark, folder), inputs.queries(spark, folder)
    with search_index(docs, T.tokenize(F.col("text")), 10_000) as index:
        vectors = similarity.query_vectors(queries, index.vocab, index.idf)
        everything = similarity.similarities(index.features, vectors, metric).cache()
        seen = scored_pairs(monkeypatch)
        rows = index.nearest(docs.select("doc_id", F.lit("c").alias("category")), queries, 10, metric)
        pairs = seen[0].unionByName(seen[1]).select("query_id", "doc_id").cache()
        assert len(seen) == 2 and pairs.count() == pairs.distinct().count() < everything.count() / 10
        scale = 10.0**similarity.SCORE_DECIMALS
        exact = everything.withColumn("score", F.rint(F.col("score") * scale) / scale)
        best = similarity._best(exact, 10, F.col("score").desc_nulls_last(), "doc_id").filter("score > 0")
        assert best.select("query_id", "rank", "doc_id").exceptAll(rows.select("query_id", "rank", "doc_id")).count() == 0
        everything.unpersist()
        pairs.unpersist()


@pytest.mark.parametrize("metric", ["dot", "cosine"])
def test_search_with_negative_weights(spark, metric):
    """Words that nearly all documents hold weigh less than nothing, and two such weights make a positive score."""
    draw = random.Random(3)
    texts = [(i, " ".join(["cat"] * draw.randint(0, 9) + ["dog"] * draw.randint(0, 9) + draw.choices(["emu", "fox", "gnu"], k=draw.randint(0, 3)))) for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id BIGINT, text STRING")
    queries = spark.createDataFrame(list(enumerate(["cat cat dog", "dog emu", "cat fox fox gnu"])), "query_id BIGINT, text STRING")
    # so few documents that the idf of cat and dog is negative
    with search_index(docs, T.tokenize(F.col("text")), 150, f=5) as index:
        vectors = similarity.query_vectors(queries, index.vocab, index.idf, 5)
        assert vectors.filter("x < 0").count() > 0
        every = similarity.similarities(index.features, vectors, metric).filter("score > 0")
        want = similarity._best(every.withColumn("score", F.round("score", 11)), 10, F.col("score").desc(), "doc_id")
        rows = index.nearest(docs.select("doc_id", F.lit("c").alias("category")), queries, 10, metric)
        got = [(r.query_id, r["rank"], r.doc_id) for r in rows.orderBy("query_id", "rank").collect()]
        assert got == [(r.query_id, r["rank"], r.doc_id) for r in want.orderBy("query_id", "rank").collect()] and len(got) == 30


def test_ranges_bound_their_documents(spark):
    x = spark.range(400).select((F.col("id") % 90).alias("doc_id"), F.floor(F.col("id") / 90).cast("int").alias("pos"), F.sin("id").alias("x"))
    postings = similarity.ranged(x, 7)
    sizes = postings.select("range", "doc_id").distinct().groupBy("range").count().orderBy("range")
    assert [r["count"] for r in sizes.collect()] == [7] * 12 + [6]
    asked = spark.createDataFrame([(q, p, (q - 1) * (p + 0.5)) for q in range(3) for p in range(5)], "query_id INT, pos INT, qx DOUBLE")
    reach = similarity.range_reach(similarity.range_weights(postings), asked)
    scores = postings.join(asked, "pos").groupBy("query_id", "range", "doc_id").agg(F.sum(F.col("x") * F.col("qx")).alias("score"))
    assert scores.join(reach, ["query_id", "range"]).filter("score > reach + 1e-12").count() == 0


@pytest.mark.parametrize("parts", ["1", "7"])
def test_row_numbers(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.range(500).select((F.col("id") * 7 % 50).alias("a"), F.when(F.col("id") % 3 == 0, 1).alias("b"), "id")
        rows = sorted(map(tuple, row_numbers(df, F.col("a").desc(), "b").collect()), key=lambda r: r[3])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r[3] for r in rows] == list(range(500))
    assert [r[:2] for r in rows] == sorted((r[:2] for r in rows), key=lambda r: (-r[0], r[1] is not None))
    assert row_numbers(df.limit(0), "a").count() == 0
    hot = row_numbers(spark.range(3000).select(F.lit(1).alias("a")), "a")
    assert hot.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first() == (0, 2999, 3000)


def test_unlinked_documents_take_no_place(spark):
    """600 documents without a category score highest; the k rows come from the linked ones, zeros included."""
    docs = spark.range(620).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") >= 20, "cat cat emu emu").when(F.col("id") < 3, "cat dog dog emu dog dog").otherwise("cat dog dog").alias("text"),
    )
    links = docs.filter("doc_id < 20").select("doc_id", F.lit("c").alias("category"))
    queries = spark.createDataFrame([(0, "cat"), (1, "emu")], "query_id BIGINT, text STRING")
    with search_index(docs, T.tokenize(F.col("text")), 5000, f=5) as index:
        rows = sorted((r.query_id, r["rank"], r.doc_id, r.score > 0) for r in index.nearest(links, queries, 10).collect())
    assert rows == [(0, i + 1, i + 3, True) for i in range(10)] + [(1, i + 1, i, i < 3) for i in range(10)]


def test_dictionary_orders_few_words(spark):
    """Only the words from the count of the f-th one on reach the ordering, for any number of partitions."""
    text = spark.range(5000).select(F.explode(F.array_repeat(F.concat(F.lit("w"), F.col("id")), F.when(F.col("id") < 40, 3).otherwise(1).cast("int"))).alias("word"))
    for n in (1, 200):
        vocab = words.dictionary(text.repartition(n), 30)
        got = [r.word for r in vocab.orderBy("pos").collect()]
        assert got == sorted(f"w{i}" for i in range(40))[:30]
        kept = vocab._jdf.queryExecution().optimizedPlan().toString()
        assert "scalar-subquery" in kept and "Filter" in kept
