"""Row numbers over a whole frame, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut

# monotonically_increasing_id puts the partition above this many bits.
_PLACE_BITS = 33


def row_numbers(df: DataFrame, *order: str | Column, name: str = "n") -> DataFrame:
    """``df`` with the 0-based number of each row by ``order``; equal rows go by the place they were read from.

    Rows are dealt out by range and sorted where they lie, the partitions are counted, and each row adds its place to
    the number of rows in earlier partitions. The dealt rows are written once, so that places hold when a task runs again.
    """
    read = "_read"
    keys = [*order, read]
    dealt = df.withColumn(read, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = cut(dealt.drop(read).withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", _PLACE_BITS).alias("_part")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_place").bitwiseAND((1 << _PLACE_BITS) - 1)
    numbered = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return numbered.withColumn(name, place + F.col("_before")).drop("_part", "_place", "_before")
