"""Trip reports: text files in, bounded tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import regression
from tidemark.operators import trips as trip
from tidemark.sources.readers import read_trips


def busiest_taxis(spark: SparkSession, path: str, k: int = 10) -> DataFrame:
    """``taxi, trips``."""
    counts = trip.count_by(trip.basic_trips(read_trips(spark, path)), "taxi", name="trips")
    return trip.top_k(counts, k, "trips", "taxi")


def best_drivers(spark: SparkSession, path: str, k: int = 10) -> DataFrame:
    """``driver, per_minute``: amount earned per minute of driving."""
    paid = trip.paid_trips(read_trips(spark, path))
    rates = trip.ratio_by(paid, "driver", F.col("amount"), F.col("duration"), 60.0, "per_minute")
    return trip.top_k(rates, k, "per_minute", "driver")


def best_hours(spark: SparkSession, path: str, k: int = 10) -> DataFrame:
    """``hour, ratio``: surcharge per distance by hour of pickup."""
    charged = trip.surcharged_trips(read_trips(spark, path))
    by_hour = charged.withColumn("hour", T.hour_of(F.col("pickup")))
    return trip.top_k(trip.ratio_by(by_hour, "hour", F.col("surcharge"), F.col("distance")), k, "ratio", "hour")


def fare_line(spark: SparkSession, path: str) -> DataFrame:
    """``m, b, n``: fare over distance, closed form."""
    return regression.ols_line(trip.regular_trips(read_trips(spark, path)), "distance", "fare")


def fare_line_trace(spark: SparkSession, path: str, **kw) -> DataFrame:
    """Fare over distance by gradient descent, one row per iteration."""
    return regression.descend_line(trip.regular_trips(read_trips(spark, path)), "distance", "fare", **kw)


def amount_trace(spark: SparkSession, path: str, **kw) -> DataFrame:
    """Amount over duration, distance, fare and surcharge by gradient descent.

    Raw columns differ so much in size that the descent stops without converging;
    ``standardize=True`` makes it converge.
    """
    regular = trip.regular_trips(read_trips(spark, path))
    return regression.descend_plane(regular, ["duration", "distance", "fare", "surcharge"], "amount", **kw)
