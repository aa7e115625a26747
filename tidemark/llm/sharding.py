"""Contiguous shards of near equal bytes, cut from a global prefix sum."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage


def shard_by_bytes(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text", overhead: int = 8) -> DataFrame:
    """Per row: key, size, text_crc32, shard, slot (all rows in key order, cut at equal shares of the bytes).

    size is the UTF-8 length of the text (null: none) plus ``overhead``. A row goes to the shard in whose
    share its middle byte lies, so a shard misses its target by less than the largest row. slot counts
    from 0 without gaps within the shard. Rows of equal key, null keys included, keep the order
    in which they were read; that order is written down, so it holds when a task runs again. An empty table
    gives an empty result, and other columns are left out.

    Rows are dealt out by range of (key, place read), which no repeated key can skew; the totals of
    the partitions are summed up front, and each partition adds only its own running sum to its start.
    """
    body = F.col(text)
    sized = stage(
        docs.select(
            F.col(key).alias("doc_id"),
            (F.coalesce(F.octet_length(body), F.lit(0)).cast("long") + overhead).alias("size"),
            F.crc32(F.encode(F.coalesce(body, F.lit("")), "UTF-8")).cast("long").alias("text_crc32"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "sizes",
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stage(
        sized.repartitionByRange(parts, "doc_id", "_row").withColumn("_part", F.spark_partition_id()), "dealt"
    )
    # one row per partition
    totals = dealt.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(every).alias("_all"),
    )
    inside = Window.partitionBy("_part").orderBy("doc_id", "_row")
    start = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = (
        dealt.withColumn("_start", start)
        .withColumn("_nth", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), "_part")  # one row per shuffle partition
        .withColumn("_middle", 2 * (F.col("_start") + F.col("_bytes_before")) + F.col("size"))
        .withColumn("shard", F.expr(f"cast(least({shards} - 1, (_middle * {shards}) div (2 * _all)) as int)"))
        .withColumn("_nth", F.col("_nth") + F.col("_rows_before"))
        .select("doc_id", "size", "text_crc32", "shard", "_nth")
    )
    first = placed.groupBy("shard").agg(F.min("_nth").alias("_first"))
    return (
        placed.join(F.broadcast(first), "shard")  # one row per shard
        .withColumn("slot", (F.col("_nth") - F.col("_first")).cast("long"))
        .select("doc_id", "size", "text_crc32", "shard", "slot")
    )
