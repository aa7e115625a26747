"""Inputs in the shapes the operators expect, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """``doc_id, text`` and any further columns."""
    return table(spark, folder, "documents").select("doc_id", "text", *columns)


def labels(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, label``: quality is the class."""
    return table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))


def queries(spark: SparkSession, folder: str) -> DataFrame:
    """``query_id, text``."""
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def links(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, category``: the language and the source of each document."""
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", F.col("lang").alias("category")).unionByName(
        docs.select("doc_id", F.col("source").alias("category"))
    )


def trip_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items written as 17-field trip lines.

    Rows with line number 7 have 16 fields, returned rows with line number 6 have
    no numeric distance, and a quantity of 50 gives a duration of 0.
    """
    c = F.col
    text = lambda col: col.cast("string")
    hour = F.lpad(text(c("l_orderkey") % 24), 2, "0")
    pickup = F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(" "), hour, F.lit(":15:00"))
    broken = (c("l_returnflag") == "R") & (c("l_linenumber") == 6)
    fields = [
        text(c("l_partkey")),
        text(c("l_suppkey")),
        pickup,
        F.date_format("l_shipdate", "yyyy-MM-dd"),
        text(((c("l_quantity") % 50) * 100).cast("int")),
        F.when(broken, "abc").otherwise(text(c("l_quantity"))),
        *[F.lit("0")] * 5,
        text(c("l_extendedprice") / 1000),
        text(c("l_discount")),
        F.lit("x"),
        F.lit("0"),
        text(c("l_tax") * 100),
        F.when(c("l_linenumber") != 7, text(c("l_extendedprice"))),
    ]
    return table(spark, folder, "lineitem").select(F.concat_ws(",", *fields).alias("value"))


def tagged_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as one-line tagged text; line breaks become blanks, Spanish ones lack the url."""
    one_line = F.regexp_replace("text", "[\\r\\n]+", " ")
    tag = F.format_string('<doc id="%d" url="u/%s" title="t">', F.col("doc_id"), F.col("source"))
    bare = F.format_string('<doc nid="%d">', F.col("doc_id"))
    opened = F.when(F.col("lang") == "es", bare).otherwise(tag)
    docs = documents(spark, folder, "lang", "source")
    return docs.select("doc_id", F.concat(opened, one_line, F.lit("</doc>")).alias("value"))


def news_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as cluster lines: cluster by draw, group by language."""
    docs = table(spark, folder, "documents")
    from tidemark.functions.numeric import bucket

    cluster = bucket(F.col("doc_id"), buckets=6, seed=5) - 1
    line = F.format_string(
        '(%d, \'<doc id="20_newsgroups/%s/%05d" url="u">\')',
        cluster, F.col("lang"), F.col("doc_id") % 100000,
    )
    return docs.select(line.alias("value"))


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as reviews, all text: points from the length, no variety for source 3, some points not numeric."""
    c = F.col
    points = F.when(c("doc_id") % 11 == 0, "n/a").otherwise((c("n_chars") % 21 + 80).cast("string"))
    docs = documents(spark, folder, "lang", "source", "n_chars")
    return docs.select(
        c("doc_id").cast("string").alias("_c0"),
        c("text").alias("description"),
        c("lang").alias("designation"),
        points.alias("points"),
        F.lit("r").alias("region_1"),
        F.when(c("source") != "src3", c("source")).alias("variety"),
    )
