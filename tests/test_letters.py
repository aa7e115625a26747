"""Words counted in the tasks that read the texts are those of the tokenizer."""

import pytest
from pyspark.sql import functions as F

from plans_util import outer_plan
from tidemark.catalog.queries import QUERIES
from tidemark.functions import letters
from tidemark.functions import text as T
from tidemark.operators import words

TEXTS = ["The cat, the CAT's hat", None, "", "12 ... \n", "éKelvin naïve X", "a" * 3000 + " b", "cat", "x y" * 900, "tail", "head"]


@pytest.mark.parametrize("block", [1, 64, 1 << 20])
def test_dictionary_and_counts(spark, monkeypatch, block):
    monkeypatch.setattr(letters, "BLOCK_BYTES", block)
    rows = [(None if i == 8 else f"d{i % 7}", t) for i, t in enumerate(TEXTS * 3)]
    docs = spark.createDataFrame(rows, "doc_id STRING, text STRING").repartition(3)
    found = words.words_of(docs, T.tokenize(F.col("text")))
    for f in (5, 100):
        vocab = words.letter_dictionary(docs, f)
        assert vocab.collect() == words.dictionary(found, f).collect()
        got, wanted = words.letter_term_counts(docs, vocab, f), words.term_counts(found, vocab, f)
        assert got.count() == wanted.count() and not got.exceptAll(wanted).count()


def test_fingerprints_that_share_a_slot(spark):
    import numpy as np

    prints = np.array([1, 2, 3, 1 << 63, (1 << 63) + 5], dtype=np.uint64)
    find = words._Positions(prints, np.arange(5))
    assert find(np.array([3, 4, 1 << 63, 2, 1, 0, (1 << 63) + 5], dtype=np.uint64)).tolist() == [2, -1, 3, 1, 0, -1, 4]


def test_weights_need_one_shuffle_of_the_counts(spark, tables):
    plan = outer_plan(QUERIES["tfidf"](spark, tables))
    assert "Exchange hashpartitioning(doc_id" in plan and not any("hashpartitioning(doc_id" in p and "pos" in p for p in plan.split("\n"))


def test_search_index_by_letters_and_by_tokens(spark):
    from tidemark.plans.search import search_index

    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(0, "cat tail")], "doc_id INT, text STRING")
    found = []
    for tokens in (None, T.tokenize(F.col("text"))):
        with search_index(docs, tokens, len(TEXTS), f=50) as index:
            found.append((index.vocab.collect(), sorted(index.idf.collect()), sorted(index.features.collect())))
    assert found[0] == found[1]
