"""Line deduplication by overlapping windows of consecutive lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Plain, stage

HAS_WORD = r"[^\x20\x09-\x0D]"
_NULL_ID = -(1 << 63)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _worded(lines: str) -> Column:
    """Positions of the lines that hold a word."""
    flagged = F.transform(lines, lambda x, i: F.when(x.rlike(HAS_WORD), i))
    return F.filter(flagged, lambda i: i.isNotNull())


def line_windows(docs: DataFrame, key: str, text: str, width: int = 3) -> DataFrame:
    """One row per window: doc, text_key, at (number of its first line among those with a word), h1, h2, again.

    A window is ``width`` consecutive lines with a word, known by 128 bits. ``again``: an earlier window of
    the same row is equal; found by sorting within the row, so only first occurrences meet other documents.
    """
    line = lambda j, k: F.get("lines", F.get("worded", j + k))
    hashes = lambda j: (F.xxhash64(*[line(j, k) for k in range(width)]), F.xxhash64(F.lit(1), *[line(j, k) for k in range(width)]))

    def window(j: Column) -> Column:
        h1, h2 = hashes(j)
        return F.struct(h1.alias("h1"), h2.alias("h2"), j.alias("at"))

    n = F.size("worded")
    none = F.array().cast("array<struct<h1:bigint,h2:bigint,at:int>>")
    every = F.when(n >= width, F.transform(F.sequence(F.lit(0), n - width), window)).otherwise(none)
    before = lambda x, k: F.get("windows", k - 1)
    return (
        docs.select(
            F.coalesce(F.col(key).cast("long"), F.lit(_NULL_ID)).alias("doc"),
            F.xxhash64(F.col(text)).alias("text_key"),
            _lines(F.col(text)).alias("lines"),
        )
        .withColumn("worded", _worded("lines"))
        .withColumn("windows", F.sort_array(every))
        .select(
            "doc",
            "text_key",
            F.inline(
                F.transform(
                    "windows",
                    lambda x, k: F.struct(
                        x["h1"].alias("h1"),
                        x["h2"].alias("h2"),
                        x["at"].alias("at"),
                        F.coalesce(
                            (before(x, k)["h1"] == x["h1"]) & (before(x, k)["h2"] == x["h2"]), F.lit(False)
                        ).alias("again"),
                    ),
                )
            ),
        )
    )


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """All columns of ``docs``, with kept_text, n_lines, n_removed and n_spans (long) after them.

    Of the equal windows of ``width`` consecutive lines (lines without a word are passed over and always
    stay) the first stays, by key and place; every later one goes. Removed lines are the union of the later
    windows, so overlapping ones merge and a first window that a later one overlaps loses those lines.
    n_spans counts the runs of removed lines with no kept worded line between them. Fewer than ``width``
    worded lines make no window. A null text counts as empty (kept_text is then empty), a null key as the
    smallest. Rows that share a key count as one document between which nothing repeats: each is judged against smaller
    keys and itself. The key is an integer column.
    A column named like a result gives way to it.

    Windows are counted before they are shuffled; the ones found are joined back with a plain join, which
    Spark splits where one window holds many rows.
    """
    plain = Plain(docs, "kept_text", "n_lines", "n_removed", "n_spans")
    docs, key, text = plain.rows, plain.of(key), plain.of(text)
    windows = stage(line_windows(docs, key, text, width), "windows")
    firsts = windows.filter(~F.col("again")).select("doc", "text_key", "at", "h1", "h2")
    repeated = (
        firsts.groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.min("doc").alias("first_doc"))
        .filter("n > 1")
        .select("h1", "h2", "first_doc")
    )
    later = firsts.join(repeated, ["h1", "h2"]).filter("doc > first_doc").select("doc", "text_key", "at")
    gone = (
        later.union(windows.filter("again").select("doc", "text_key", "at"))
        .groupBy("doc", "text_key")
        .agg(F.collect_set("at").alias("_at"))
        .select(F.col("doc").alias("_doc"), F.col("text_key").alias("_text_key"), "_at")
    )
    found = docs.withColumn("_k", F.coalesce(F.col(key).cast("long"), F.lit(_NULL_ID))).withColumn("_h", F.xxhash64(F.col(text)))
    joined = found.join(gone, (F.col("_k") == F.col("_doc")) & (F.col("_h") == F.col("_text_key")), "left")
    empty = F.array().cast("array<int>")
    covered = F.array_distinct(F.flatten(F.transform("_at", lambda j: F.sequence(j, j + (width - 1)))))
    out = (
        joined.withColumn("_lines", _lines(F.col(text)))
        .withColumn("_worded", F.when(F.col("_at").isNotNull(), _worded("_lines")))
        .withColumn("_covered", F.when(F.col("_at").isNotNull(), F.sort_array(covered)).otherwise(empty))
        .withColumn("_gone", F.transform("_covered", lambda c: F.get("_worded", c)))
        .withColumn(
            "_left", F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_gone")
        )
    )
    rest = F.array_join(F.transform("_left", lambda i: F.get("_lines", i)), "\n")
    spans = F.size(F.filter("_covered", lambda c, i: F.coalesce(F.get("_covered", i - 1) != c - 1, F.lit(True))))
    return out.select(
        *plain.rest,
        F.when(F.size("_covered") > 0, rest).otherwise(F.coalesce(F.col(text), F.lit(""))).alias("kept_text"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size("_covered").cast("long").alias("n_removed"),
        spans.cast("long").alias("n_spans"),
    )
