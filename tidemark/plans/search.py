"""Category search: documents, category links and query texts in, nearest rows and votes out."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from tidemark.operators import features as feat
from tidemark.operators import similarity
from tidemark.operators.words import DICTIONARY_SIZE, dictionary, letter_dictionary, letter_term_counts, term_counts, words_of
from tidemark.session import cut, keep
from tidemark.sources import readers


@dataclass
class SearchIndex:
    """Dictionary, idf and document vectors, cached while queries run."""

    vocab: DataFrame
    idf: DataFrame
    features: DataFrame
    f: int

    def nearest(self, links: DataFrame, queries: DataFrame, k: int = 10, metric: str = "dot") -> DataFrame:
        """The k nearest (document, category) rows per query, computed now: at most k rows per query."""
        vectors = similarity.query_vectors(queries, self.vocab, self.idf, self.f)
        return cut(similarity.nearest_rows(self.features, links, cut(vectors), k, metric))


@contextmanager
def search_index(
    docs: DataFrame,
    tokens: Column | None,
    n_docs: Column | int,
    smooth: bool = False,
    f: int = DICTIONARY_SIZE,
) -> Iterator[SearchIndex]:
    """Index ``docs``: every later query reads the cached vectors instead of the texts.

    Without ``tokens`` the words are those of ``text.tokenize``, counted in the tasks that read the texts: then the counts are shuffled once, by
    document, and the vectors are made where they lie.
    """
    if tokens is None:
        vocab = cut(letter_dictionary(docs, f))
        counts = keep(letter_term_counts(docs, vocab, f))
    else:
        words = words_of(docs, tokens)
        vocab = cut(dictionary(words, f))
        counts = keep(term_counts(words, vocab, f).repartition("doc_id"))
    try:
        idf = cut(feat.inverse_document_frequency(feat.document_frequency(counts), n_docs, smooth))
        x = keep(feat.features(counts, n_docs, idf=idf, f=f))
    finally:
        counts.unpersist()
    try:
        yield SearchIndex(vocab, idf, x, f)
    finally:
        x.unpersist()


def search_categories(
    spark: SparkSession,
    documents_path: str,
    links_path: str,
    texts: list[str],
    k: int = 10,
    f: int = DICTIONARY_SIZE,
) -> DataFrame:
    """``query_id, category, votes, rank`` for query texts over tagged document files and a category file.

    The document count takes in all lines, valid or not.
    """
    lines = readers.read_lines(spark, documents_path)
    docs = readers.parse_documents(lines)
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id INT, text STRING")
    with search_index(docs, None, feat.row_count(lines), f=f) as index:
        rows = index.nearest(readers.read_links(spark, links_path), queries, k)
    return similarity.category_vote(rows, k)
