"""URL filter: host rules first, then logistic regression on hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, Plain, Spans, byte_column, mix, row_of

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

# A small labelled table, fixed values: names of sites to keep and to block. Each makes one url under
# every ending and prefix, with the same paths for both kinds, so that only the names tell them apart.
ORDINARY = (
    "encyclopedia wiki dailynews library university docs tutorial gardening weather recipes kitchen museum forum "
    "linuxusers citycouncil science journal sports hospital bookstore travel madrid motherland thenorth thetransit "
    "theatre tradition nationhood weathering anderson theory institute feathers thinkers reunion errands statistics "
    "hosting project farmers-market freedom-press windmill adulthood-studies railway-tracks cheapside-history "
    "better-health maps poetry shop school-board new-england ninth-street thirteen another leather thunder nations "
    "stations other-ways the-end tin-sheds heron-marsh blessed-earth oration edition thread needle answers orient "
    "hand-tools in-the-round enable ringing"
).split()
BLOCKED = (
    "best-casino casino-online casino-bonus win-casino casino-slots poker-win win-big win-cash jackpot-win slots-win "
    "free-spins free-bets-now bets-today sports-bets live-bets free-bet free-casino cheap-meds cheap-viagra "
    "pills-shop pharmacy-pills cheap-pharmacy buy-pills diet-pills cheap-cialis adult-video adult-cams xxx-adult "
    "adult-chat free-adult adult-xxx adult-dating porn-tube free-porn x-rated spam-links link-farm content-farm "
    "seo-spam spam-mail spam-site click-farm like-farm ads-click ads-server pop-ads banner-ads click-track "
    "track-ads ad-tracker pixel-track user-track payday-loan quick-loans cheap-loans replica-watches lottery-win"
).split()
PREFIXES = ("", "www.", "m.", "blog.")
ENDINGS = ("com", "net", "org")
PATHS = ("en/123", "fr/45/", "de/6789?page=2", "es/77#top", "en/8.html", "fr/90210?utm_source=feed", "de/310", "es/5512/")


def labelled() -> list[tuple[str, int]]:
    """The table above: url and label, 1 for blocked."""
    return [
        (f"https://{prefix}{name}.example.{ending}/{PATHS[(i + 4 * j + k) % len(PATHS)]}", label)
        for label, names in ((0, ORDINARY), (1, BLOCKED))
        for i, name in enumerate(names)
        for j, prefix in enumerate(PREFIXES)
        for k, ending in enumerate(ENDINGS)
    ]


def split_url(url: str) -> tuple[str, str]:
    """Host and path as the query cuts them, for the labelled table."""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    rest = rest.split("#")[0].split("?")[0]
    host, slash, path = rest.partition("/")
    return host, slash + path


def grams(column: pa.Array, salt: int, bits: int, lengths: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of each text (marked at both ends), and its row."""
    data, offsets = byte_column(column)
    rows = row_of(offsets)
    n = len(offsets) - 1
    # a mark before and after each text
    marked = np.full(len(data) + 2 * n, 1, dtype=np.uint8)
    marked[np.arange(len(data)) + 2 * rows + 1] = LOWER[data]
    ends = offsets[1:] + 2 * np.arange(1, n + 1)
    owner = np.repeat(np.arange(n), np.diff(offsets) + 2)
    spans = Spans(marked)
    buckets, of = [], []
    for length in lengths:
        start = np.arange(len(marked))
        start = start[start + length <= ends[owner]] if n else start
        # mixed again, so that host and path have buckets of their own
        salted = mix(spans(start, start + length) ^ np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64)))
        buckets.append((salted >> np.uint64(64 - bits)).astype(np.int64))
        of.append(owner[start])
    return np.concatenate(buckets), np.concatenate(of)


@dataclass
class UrlModel:
    """Weights of hashed n-grams of host and path; those of each part count by the root of their number."""

    weights: np.ndarray
    offset: float
    bits: int
    lengths: tuple[int, ...]

    def _features(self, hosts: pa.Array, paths: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets, their rows and their values: one over the root of the n-grams that the row's host or path has."""
        parts = []
        for salt, column in ((1, hosts), (2, paths)):
            bucket, row = grams(column, salt, self.bits, self.lengths)
            size = np.bincount(row, minlength=len(column))
            parts.append((bucket, row, 1 / np.sqrt(np.maximum(1, size))[row]))
        bucket, row, value = (np.concatenate(x) for x in zip(*parts))
        return bucket, row, value

    def logit(self, hosts: pa.Array, paths: pa.Array) -> np.ndarray:
        bucket, row, value = self._features(hosts, paths)
        return np.bincount(row, weights=self.weights[bucket] * value, minlength=len(hosts)) + self.offset

    @classmethod
    def fit(cls, rows: Sequence[tuple[str, int]], bits: int = 16, lengths: tuple[int, ...] = (3, 4, 5), steps: int = 400, rate: float = 10.0, shrink: float = 1e-4) -> UrlModel:
        """Gradient descent on the mean log loss plus ``shrink`` times the squared weights; the table is small."""
        model = cls(np.zeros(1 << bits), 0.0, bits, lengths)
        parts = [split_url(url) for url, _ in rows]
        hosts, paths = pa.array([p[0] for p in parts], pa.string()), pa.array([p[1] for p in parts], pa.string())
        y = np.array([label for _, label in rows], dtype=float)
        bucket, row, value = model._features(hosts, paths)
        for _ in range(steps):
            z = np.bincount(row, weights=model.weights[bucket] * value, minlength=len(y)) + model.offset
            error = (1 / (1 + np.exp(-z)) - y) / len(y)
            change = np.bincount(bucket, weights=error[row] * value, minlength=1 << bits)
            model.weights -= rate * (change + shrink * model.weights)
            model.offset -= rate * error.sum()
        return model


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    labels: Sequence[tuple[str, int]] | None = None,
    url: str = "url",
    threshold: float = 0.5,
) -> DataFrame:
    """All columns of ``pages``, then host, path, rule, score and verdict (allow or block).

    The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased, the
    path what follows up to ``?``, ``#`` or the end; a null url, or one without ``://``, has empty ones. ``rules``
    are (verdict, host, path): a rule fits its host and all subdomains if the url's path starts with its path; of
    several the longest (host and path together) wins, the first of equally long ones. Without a rule, the
    model trained on ``labels`` (url, 1 for blocked) blocks at ``threshold``; score is its probability in any case.
    Repeated rows get the same verdict; no shuffle. A column named like a result gives way to it.
    """
    plain = Plain(pages, "host", "path", "rule", "score", "verdict")
    pages, url = plain.rows, plain.of(url)
    address = F.coalesce(F.col(url), F.lit(""))
    cut = pages.withColumn("host", F.translate(F.regexp_extract(address, PARTS, 1), UPPER, UPPER.lower()))
    cut = cut.withColumn("path", F.regexp_extract(address, PARTS, 2))
    rule = F.lit(None).cast("string")
    given = F.lit(None).cast("string")
    for verdict, host, path in sorted(reversed(rules), key=lambda r: len(r[1]) + len(r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, given = F.when(fits, host + path).otherwise(rule), F.when(fits, verdict).otherwise(given)
    model = pages.sparkSession.sparkContext.broadcast(UrlModel.fit(labelled() if labels is None else labels))
    schema = cut.select("*", F.lit(0.0).alias("score")).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = model.value.logit(batch.column("host"), batch.column("path"))
            chance = pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, chance], [*batch.schema.names, "score"])

    scored = cut.mapInArrow(score, schema).withColumn("rule", rule)
    judged = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce(given, judged)).select(*plain.rest, "host", "path", "rule", "score", "verdict")
