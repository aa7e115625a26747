"""Sessions, shared folders and the broadcast size check."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Paths that scratch_path has given out.
_made: list[str] = []

# A side is broadcast only when its proven bound stays below this many bytes.
BROADCAST_BYTES = 256 * 1024 * 1024


def local_session(
    cores: int | str = 8, shuffle_partitions: int = 8, name: str = "tidemark", **config: str
) -> SparkSession:
    """A single-JVM session for tests and the bench; clusters bring their own.

    ``config`` holds further settings, with ``__`` for dots.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in config.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, as the session names it in ``spark.checkpoint.dir``.

    Where that is not set, a folder below the warehouse, which executors share too; never a
    temporary folder of one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this driver has staged; frames that read it are of no use afterwards."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(hadoop).delete(path, True)


def small_side(df: DataFrame, rows: int, row_bytes: int = 64) -> DataFrame:
    """Mark ``df`` for broadcast when its proven bound of ``rows`` fits, else leave it to the optimizer.

    ``rows`` must hold by construction (a LIMIT, or a key with that many values), and the columns
    must be numbers that fit ``row_bytes``.
    """
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table below the shared folder and read on from there.

    Later scans prune columns and push filters, and a lost executor costs a re-read of
    these files, not a recomputation from the raw text. ``clear_scratch`` deletes them.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep(df: DataFrame) -> DataFrame:
    """Cache ``df`` and fill the cache, so that its partitioning and order are known to later steps."""
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    cached.write.format("noop").mode("overwrite").save()
    return cached
