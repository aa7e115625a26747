"""The operators as queries over whole test tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    byte_bpe,
    conversations,
    decontaminate,
    line_dedup,
    lm_scoring,
    nearest_vectors,
    ngram_join,
    oracle,
    quality_rules,
    sharding,
    suffix_dedup,
    token_alignment,
    toxicity,
    url_filter,
)
from tidemark.llm.common import table

RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, host="source")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sharding.shard_by_bytes(docs, shards=24).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_removed", "n_spans", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256")
    )


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_similar(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", lm_scoring.held_out())
    model, words = lm_scoring.train(docs.filter(~F.col("held_out")))
    return lm_scoring.score_texts(docs, model, words)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encode_texts(docs, path, public_tokenizers.PATTERN, arrays=False).select(
        "doc_id",
        "n_tokens",
        F.sha2(F.encode("ids_text", "UTF-8"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs, width=200).select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.aggregate("spans", F.lit(0), lambda s, x: s + x[1] - x[0]).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, RULES).drop("url")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_texts(docs.select("doc_id", "text", "lang"), net)
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "threshold",
        "rejected",
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_benchmark(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", *decontaminate.verdict())


def op11_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = nearest_vectors.clean_vectors(table(spark, sf_dir, "embeddings"))
    return nearest_vectors.nearest(vectors, "vec_id % 100 = 0", k=10).drop("query_row")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.repair_report(rows, conversations.repair(conversations.damage(rows)))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left, right = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = token_alignment.align_tokens(docs, left, right, public_tokenizers.PATTERN)
    digest = F.when(F.col("n_groups") > 0, F.sha2(F.encode("groups", "UTF-8"), 256)).otherwise("").alias("groups_sha256")
    aligned = aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "times")
    return token_alignment.with_link_counts(aligned, token_alignment.piece_count(right))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_sharding": op2_sharding,
    "op3_line_dedup": op3_line_dedup,
    "op4_ngram_join": op4_ngram_join,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_toxicity": op9_toxicity,
    "op10_decontaminate": op10_decontaminate,
    "op11_nearest_vectors": op11_nearest_vectors,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE = {
    "op1_quality_rules": oracle.QUALITY_RULES,
    "op3_line_dedup": oracle.LINE_DEDUP,
    "op4_ngram_join": oracle.NGRAM_JOIN,
    "op10_decontaminate": oracle.DECONTAMINATE,
    "op11_nearest_vectors": oracle.NEAREST_VECTORS,
    "op12_conversation_repair": oracle.CONVERSATION_REPAIR,
}
