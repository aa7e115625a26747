"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Rows of a report, at most.
REPORT_ROWS = 1_000_000


def write_report(df: DataFrame, path: str, fmt: str = "csv", most: int = REPORT_ROWS) -> None:
    """One part file. For bounded results only (a top-k, a trace, a model report): more than ``most`` rows fail the job."""
    n = F.monotonically_increasing_id()  # the place of the row, as one task holds them all
    held = F.when(n < most, True).otherwise(F.raise_error(F.lit(f"a report has at most {most} rows")).cast("boolean"))
    writer = df.limit(most + 1).coalesce(1).filter(held).write.mode("errorifexists")
    (writer.option("header", True).csv(path) if fmt == "csv" else writer.format(fmt).save(path))


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One part file per partition."""
    df.write.mode("errorifexists").format(fmt).save(path)


def write_lines(df: DataFrame, path: str) -> None:
    """Columns joined by commas, one text line per row, natural partitions."""
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns])
    df.select(line.alias("value")).write.mode("errorifexists").text(path)


def write_clusters(assigned: DataFrame, path: str) -> None:
    """``(cluster, 'header')`` lines from ``cluster, header``, sorted by cluster across the files."""
    line = F.format_string("(%d, '%s')", F.col("cluster").cast("int"), F.col("header"))
    assigned.orderBy("cluster", "header").select(line.alias("value")).write.mode(
        "errorifexists"
    ).text(path)
