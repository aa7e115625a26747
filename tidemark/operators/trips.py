"""Trip filters, grouped counts and ratios, top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import ratio
from tidemark.sources.readers import TRIP_FIELDS


def basic_trips(trips: DataFrame) -> DataFrame:
    """17 fields, with distance and fare numeric."""
    return trips.filter(
        (F.col("n_fields") == TRIP_FIELDS) & F.col("distance").isNotNull() & F.col("fare").isNotNull()
    )


def paid_trips(trips: DataFrame) -> DataFrame:
    """Basic trips with a duration and an amount other than zero."""
    return basic_trips(trips).filter((F.col("duration") != 0) & (F.col("amount") != 0))


def surcharged_trips(trips: DataFrame) -> DataFrame:
    """Paid trips with a distance and a surcharge other than zero."""
    return paid_trips(trips).filter((F.col("distance") != 0) & (F.col("surcharge") != 0))


def regular_trips(trips: DataFrame) -> DataFrame:
    """Basic trips of 2 to 60 minutes, fare 3 to 200, distance 1 to 50, tolls of 3 or more."""
    tolls = F.col("tolls")
    return basic_trips(trips).filter(
        F.col("duration_seconds").between(120, 3600)
        & F.col("fare").between(3, 200)
        & F.col("distance").between(1, 50)
        & (tolls >= 3)
        & ~F.isnan(tolls)
    )


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def ratio_by(
    df: DataFrame, key: str, top: Column, bottom: Column, factor: float = 1.0, name: str = "ratio"
) -> DataFrame:
    """sum(top) / sum(bottom) * factor per key; both sums come from one partial aggregation."""
    value = ratio(F.sum(top), F.sum(bottom)) * F.lit(factor)
    return df.groupBy(key).agg(value.alias(name))


def top_k(df: DataFrame, k: int, by: str, *ties: str) -> DataFrame:
    """The k rows with the largest ``by``; equal values go by the tie columns, ascending."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(t).asc() for t in ties]).limit(k)


def bottom_k(df: DataFrame, k: int, by: str, *ties: str) -> DataFrame:
    """The k rows with the smallest ``by``."""
    return df.orderBy(F.col(by).asc_nulls_last(), *[F.col(t).asc() for t in ties]).limit(k)
