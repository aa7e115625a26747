"""Words worked out once a piece are those of the tokens."""

import pytest
from pyspark.sql import functions as F

from tidemark.catalog.queries import QUERIES
from tidemark.functions import text as T
from tidemark.operators import words

BLANKS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
TEXTS = [
    "The cat, the CAT's (hat)  hat", None, "", "  ", "12 a1_ ...ab... xéİ ΣΟΣ Straße naïve", "a" * 3000 + " bb",
    "aa".join(BLANKS), "᠎aa ﻿bb ​cc", "cat " * 900, "tail", "head-",
]


@pytest.mark.parametrize("chars, size", [(1, 2), (50, 7), (1 << 23, 1 << 20)])
def test_dictionary_and_counts(spark, monkeypatch, chars, size):
    monkeypatch.setattr(words, "PIECE_CHARS", chars)
    monkeypatch.setattr(words, "SUMMARY_SIZE", size)
    line = F.concat(F.lit("<d>"), "text", F.lit("</doc>"))
    rows = [(None if i == 8 else f"d{i % 7}", t) for i, t in enumerate(TEXTS * 3)]
    docs = spark.createDataFrame(rows, "doc_id STRING, text STRING").repartition(3).select("doc_id", line.alias("value"))
    value = F.col("value")
    wanted = words.dictionary(words.words_of(docs, T.corpus_tokens(value)), 20)
    vocab = words.piece_dictionary(docs, T.body(value), T.corpus_word, 20)
    assert vocab.collect() == wanted.collect() and vocab.dtypes == wanted.dtypes
    got = words.piece_term_counts(docs, T.body(value), T.counted_word, vocab, 20)
    wanted = words.term_counts(words.words_of(docs, T.counted_tokens(value)), vocab, 20)
    assert got.dtypes == wanted.dtypes and got.count() == wanted.count() > 0 and not got.exceptAll(wanted).count()


def test_no_row_per_occurrence(spark, tables):
    """Texts are cut in the tasks that read them; what is exploded are the texts of known words."""
    plan = QUERIES["corpus_term_counts"](spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "split(" not in plan and "MapInArrow" in plan
