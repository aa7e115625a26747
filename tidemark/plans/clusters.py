"""Document clustering: lines in, cluster words, assignments and a purity report out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import mixture
from tidemark.operators.words import DICTIONARY_SIZE, dictionary, letter_dictionary, letter_term_counts, words_of
from tidemark.session import cut, keep


def cluster_documents(
    docs: DataFrame,
    tokens: Column | None = None,
    vocab_tokens: Column | None = None,
    clusters: int = 20,
    sweeps: int = 200,
    f: int = DICTIONARY_SIZE,
    seed: int = 7,
    resample_pi: bool = True,
    check: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Gibbs sampling over ``docs`` (doc_id and text columns).

    Returns sizes (sweep, cluster, n), top words (cluster, rank, word, weight) and
    the last labels (doc_id, cluster). The dictionary may use another tokenizer. Without ``tokens`` the words are those of
    ``text.tokenize``, counted in the tasks that read the texts.
    """
    spark = docs.sparkSession
    by_letters = tokens is None and vocab_tokens is None
    tokens = T.tokenize(F.col("text")) if tokens is None else tokens
    words = words_of(docs, tokens if vocab_tokens is None else vocab_tokens)
    vocab = keep(letter_dictionary(docs, f) if by_letters else dictionary(words, f))
    try:
        size = vocab.count()
        counts = letter_term_counts(docs, vocab, f, mark=mixture.NO_WORD) if by_letters else mixture.count_rows(docs, tokens, vocab, f)
        with mixture.sweep_table(counts) as data:
            state, labels = mixture.fit_mixture(
                data, size, k=clusters, sweeps=sweeps, seed=seed, resample_pi=resample_pi, check=check
            )
            labels = cut(labels)
        log_mu = mixture.log_mu_frame(spark, state.log_mu)
        weights = log_mu.select("pos", F.posexplode("w").alias("cluster", "weight"))
        words = spark.createDataFrame(
            mixture.top_words(weights, vocab).collect(),
            "cluster INT, rank INT, word STRING, weight DOUBLE",
        )
    finally:
        vocab.unpersist()
    sizes = [(s, j, int(n)) for s, row in enumerate(state.sizes) for j, n in enumerate(row)]
    return spark.createDataFrame(sizes, "sweep INT, cluster INT, n BIGINT"), words, labels
