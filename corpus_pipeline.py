"""The corpus pipeline: toxicity, line dedup, near duplicates, benchmark decontamination, byte-level BPE."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, decontaminate, line_dedup, ngram_join, toxicity
from tidemark.llm.common import stage, table


class Carried:
    """The columns that an operator needs, and the others out of its way: no result of it can take their place."""

    def __init__(self, docs: DataFrame, *needed: str):
        self.names, self.needed = docs.columns, needed
        rest = [F.col(c) for c in docs.columns if c not in needed]
        self.rows = docs.select(*needed, F.struct(*rest).alias("row"))

    def of(self, name: str) -> Column:
        return F.col(name) if name in self.needed else F.col("row")[name]

    def columns(self, **new: Column) -> list[Column]:
        """All columns as they were, but for the new ones."""
        return [new.get(c, self.of(c)).alias(c) for c in self.names]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches their language's threshold go; the columns stay."""
    net = toxicity.train(docs, table(spark, sf_dir, "labels"))
    carried = Carried(docs, "text", "lang")
    scored = toxicity.score_texts(carried.rows, net)
    return scored.filter(~F.col("rejected")).select(*carried.columns())


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated line windows go from the texts, and documents that lose all their words; n_chars follows the text."""
    carried = Carried(docs, "doc_id", "text")
    found = line_dedup.dedup_lines(carried.rows)
    cut = F.col("n_removed") > 0
    found = found.filter(~cut | F.col("kept_text").rlike(line_dedup.HAS_WORD))
    length = F.char_length("kept_text").cast("long")
    new = {
        "text": F.when(cut, F.col("kept_text")).otherwise(F.col("text")),
        "n_chars": F.when(cut, length).otherwise(carried.of("n_chars")),
    }
    return found.select(*carried.columns(**new))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays, that of the smallest doc_id; wordless ones stay."""
    return ngram_join.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover a twentieth of the words or more go."""
    carried = Carried(docs, "text")
    found = decontaminate.find_benchmark(carried.rows, table(spark, sf_dir, "benchmark"))
    contaminated = decontaminate.verdict()[-1]
    return found.withColumn("contaminated", contaminated).filter(~F.col("contaminated")).select(*carried.columns())


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, the ids, their digest and that of the decoded bytes."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = byte_bpe.encode_texts(docs.select("doc_id", "lang", "source", "text"), path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.encode("ids_text", "UTF-8"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("byte-level BPE", encode),
]

#: A trained classifier and a tokenizer are beyond SQL. The tests hold the stages after the first against brute force, and run() against its stages in turn.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each written as Parquet below the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
