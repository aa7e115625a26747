"""Scans and line parsers. Every parser takes a frame with a ``value`` column of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions import text as T
from tidemark.functions.numeric import to_integer, to_number

# Positions of the named trip fields among 17.
TRIP_FIELDS = 17
TRIP_TEXT = {"taxi": 0, "driver": 1, "pickup": 2}
TRIP_NUMBERS = {"duration": 4, "distance": 5, "fare": 11, "surcharge": 12, "tolls": 15, "amount": 16}

# The review columns in use.
REVIEW_COLUMNS = ["_c0", "description", "designation", "points", "region_1", "variety"]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as ``value``; compressed input is recognised by its extension."""
    return spark.read.text(path)


def split_fields(lines: DataFrame, separator: str = ",") -> DataFrame:
    """Plain split on a separator, quotes not respected: ``fields ARRAY<STRING>``.

    The one-element explode keeps later filters from repeating the split for every
    field they look at.
    """
    pattern = "\\Q" + separator + "\\E"
    return lines.select(F.explode(F.array(F.split("value", pattern, -1))).alias("fields"))


def parse_trips(lines: DataFrame) -> DataFrame:
    """Trip records from comma-separated lines.

    Numbers that do not parse are NULL. ``duration_seconds`` is NULL unless the field is
    an integer. Every field is a column of its own, so only those that a query uses are parsed.
    """
    fields = F.col("fields")
    columns = [F.size(fields).alias("n_fields")]
    columns += [F.get(fields, F.lit(at)).alias(name) for name, at in TRIP_TEXT.items()]
    columns += [to_number(F.get(fields, F.lit(at))).alias(name) for name, at in TRIP_NUMBERS.items()]
    seconds = to_integer(F.get(fields, F.lit(TRIP_NUMBERS["duration"])))
    return split_fields(lines).select(*columns, seconds.alias("duration_seconds"))


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Trip records from comma-separated text files without a header."""
    return parse_trips(read_lines(spark, path))


def valid_documents(lines: DataFrame) -> DataFrame:
    """Lines that look like tagged documents: they hold ``id`` and ``url=``."""
    return lines.filter(F.col("value").contains("id") & F.col("value").contains("url="))


def parse_documents(lines: DataFrame) -> DataFrame:
    """``doc_id, text`` out of ``<doc id="ID" url="URL" ...>TEXT</doc>`` lines."""
    line = F.col("value")
    opened = F.locate('">', line) + 2
    size = F.greatest(F.length(line) - opened - 5, F.lit(0))
    return valid_documents(lines).select(
        F.regexp_extract(line, '(?s)id="(.*?)" url=', 1).alias("doc_id"),
        F.substr(line, opened, size).alias("text"),
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Tagged documents, one per line."""
    return parse_documents(read_lines(spark, path))


def parse_links(lines: DataFrame) -> DataFrame:
    """``doc_id, category`` by plain split and quote removal; a comma ends the category."""
    parts = F.split(T.unquote(F.col("value")), ",", -1)
    return lines.select(
        F.get(parts, F.lit(0)).alias("doc_id"), F.get(parts, F.lit(1)).alias("category")
    )


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, category`` from CSV without a header; quoted commas belong to the category."""
    reader = spark.read.schema("doc_id STRING, category STRING").option("escape", '"')
    return reader.csv(path)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, first, record`` of CSV files: whole records, line breaks inside quotes kept; ``first`` marks that of each file.

    Files are read in byte ranges by as many tasks as Spark deals them to. A line begins a record where the quotes before it
    in its file are even in number: ranges count theirs, a running sum over the ranges of a file gives the parity at each start,
    and each range numbers its own records. Only a record that runs on into another range is put together from pieces. Quotes must be doubled
    inside quoted text and occur nowhere else, as CSV writers do it. Empty lines between records are left out.
    """
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    lines = spark.read.option("lineSep", "\n").text(path).select(
        *place, F.monotonically_increasing_id().alias("line"), "value", (F.length("value") - F.length(F.replace("value", F.lit('"')))).alias("quotes")
    )
    # one row per range
    ranges = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("file", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).alias("open"))
    inside = Window.partitionBy("file", "block").orderBy("line")
    after = F.col("open") + F.sum("quotes").over(inside)
    told = lines.join(ranges, ["file", "block"]).withColumn("after", after % 2)
    begins = (F.lag("after", 1).over(inside).isNull() & (F.col("open") == 0)) | (F.lag("after", 1).over(inside) == 0)
    told = told.withColumn("record", F.sum(F.when(begins, 1).otherwise(0)).over(inside))
    text = F.array_join(F.sort_array(F.collect_list(F.struct("line", "value")))["value"], "\n").alias("text")
    pieces = told.groupBy("file", "block", "record").agg(text, F.max_by("after", "line").alias("after"))
    begun = F.col("record") > 0
    whole = begun & (F.col("after") == 0)
    # at most two pieces of a range
    order = Window.partitionBy("file").orderBy("block", "record")
    split = pieces.filter(~whole).withColumn("owner", F.sum(F.when(begun, 1).otherwise(0)).over(order))
    joined = F.array_join(F.sort_array(F.collect_list(F.struct("block", "record", "text")))["text"], "\n").alias("text")
    split = split.groupBy("file", "owner").agg(joined, F.min(F.struct("block", "record")).alias("start"))
    split = split.select("file", F.col("start.block").alias("block"), F.col("start.record").alias("record"), "text")
    every = pieces.filter(whole).select("file", "block", "record", "text").unionByName(split)
    first = (F.col("block") == 0) & (F.col("record") == 1)
    return every.filter(F.col("text") != "").select("file", first.alias("first"), F.col("text").alias("record"))


def read_reviews(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The six review columns as text, from CSV with a header.

    Set ``multi_line`` when quoted text holds line breaks: records then go through one shuffle, see ``csv_records``.
    """
    options = {"escape": '"', "lineSep": "\n"}  # line ends inside quotes stay as they are
    frame = spark.read.options(header=True, multiLine=multi_line, **options).csv(path)
    if multi_line:
        # the names come from the head of one file
        names = StructType([StructField(name, StringType()) for name in frame.columns])
        records = csv_records(spark, path).filter(~F.col("first"))
        frame = records.select(F.from_csv("record", names.simpleString(), options).alias("r")).select("r.*")
    # A nameless first column is the row number.
    first = frame.columns[0]
    if first != "_c0" and "_c0" not in frame.columns:
        frame = frame.withColumnRenamed(first, "_c0")
    return frame.select(*REVIEW_COLUMNS)


def parse_clusters(lines: DataFrame) -> DataFrame:
    """``cluster, group`` out of ``(CLUSTER, '<doc id="20_newsgroups/GROUP/NNNNN" url=...`` lines."""
    line = F.col("value")
    return lines.select(
        F.regexp_extract(line, "(?s)\\((.*?).{3}<doc", 1).alias("cluster"),
        F.regexp_extract(line, '(?s)20_newsgroups/(.*?).{6}" url="', 1).alias("group"),
    )


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """Cluster assignments written as text lines."""
    return parse_clusters(read_lines(spark, path))
