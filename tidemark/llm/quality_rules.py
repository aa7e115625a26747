"""Host-level quality rules: failures counted by host, shrunk by a beta prior, joined back to the documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Plain, stage

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all long) to each row.

    A null text counts as empty; an empty one has zero of everything. Repeated words are the words of
    three-word windows that the text holds twice or more: the windows are fingerprinted (64 bits), sorted
    within the row, and their covered positions merged, so a row costs n log n and nothing is shuffled. A column
    named like a result gives way to it.
    """
    plain = Plain(docs, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    n = F.size("_words")
    three = lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2))
    twin = lambda x, j: F.coalesce(F.get("_sorted", j)["h"] == x["h"], F.lit(False))
    out = plain.rows.withColumn("_text", F.coalesce(F.col(plain.of(text)), F.lit("")))
    out = out.withColumn("_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))
    out = out.withColumn(
        "_sorted",
        F.sort_array(
            F.when(
                n >= 3,
                F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(three(i).alias("h"), i.alias("i"))),
            ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
        ),
    )
    out = out.withColumn(
        "_starts",
        F.sort_array(F.transform(F.filter("_sorted", lambda x, j: twin(x, j - 1) | twin(x, j + 1)), lambda x: x["i"])),
    )
    out = out.withColumn("_lines", F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD)))
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum")),
        lambda s, i: F.struct((i + 3).alias("end"), (s["sum"] + i + 3 - F.greatest(i, s["end"])).alias("sum")),
        lambda s: s["sum"],
    )
    return out.select(
        *plain.rest,
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("_text", SYMBOLS, "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
    )


def base_failed(least_words: int = 50, most_repeated: int = 50) -> Column:
    """Too short, or more than ``most_repeated`` percent of the words repeat."""
    n = F.col("n_words")
    return (n < least_words) | (100 * F.col("n_repeat_words") > most_repeated * n)


def host_rates(measured: DataFrame, host: str) -> DataFrame:
    """One row per host: n_docs, n_failed, and rate, the failure rate shrunk towards that of all hosts.

    The beta prior is fitted by moments: its mean is the share of failures over all documents, its strength
    follows from the variance between hosts beyond what their sizes explain. Without such variance every
    host gets the mean. Failures are counted before the shuffle, so a host with a third of all rows
    moves one row per task. Rows without a host take no part.
    """
    hosts = (
        measured.filter(F.col(host).isNotNull())
        .groupBy(host)
        .agg(F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    )
    # sums of n, f, f^2/n over all hosts give the weighted variance of the rates
    total = hosts.agg(
        F.sum("n_docs").alias("n"),
        F.sum("n_failed").alias("f"),
        F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")).alias("ff"),
        F.count("*").alias("h"),
    ).first()
    if not total["n"]:
        return hosts.withColumn("rate", F.lit(None).cast("double"))
    mean = total["f"] / total["n"]
    between = total["ff"] / total["n"] - mean * mean - mean * (1 - mean) * total["h"] / total["n"]
    if between <= 1e-12:
        return hosts.withColumn("rate", F.lit(mean))
    strength = max(mean * (1 - mean) / between - 1, 0.0)
    rate = (F.col("n_failed") + mean * strength) / (F.col("n_docs") + strength)
    return hosts.withColumn("rate", rate)


def judge(docs: DataFrame, host: str = "source", text: str = "text", key: str = "doc_id", most_failed: float = 0.5) -> DataFrame:
    """Per row: key, host, the five measures, base_failed, host_rate (six decimals), host_failed, kept.

    A host whose shrunk failure rate is over ``most_failed`` takes all its documents along. A row without a
    host is judged by itself (host_rate null). Other columns are left out, so their names cannot clash.
    Repeated rows are judged one by one; an empty table gives an empty result. The measures are staged, so the
    texts are read once; the hosts come back by a join that Spark may broadcast or split by size.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text"))
    measured = stage(measure(rows).drop("text").withColumn("base_failed", base_failed()), "quality")
    rates = host_rates(measured, "host").select(
        F.col("host").alias("_host"),
        F.round("rate", 6).alias("host_rate"),
        (F.col("rate") > most_failed).alias("host_failed"),
    )
    failed = F.coalesce("host_failed", F.lit(False))
    return (
        measured.join(rates, F.col("host") == F.col("_host"), "left")
        .drop("_host")
        .withColumn("host_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))
    )
