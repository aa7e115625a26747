"""Number parsing, ratios and seeded draws as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(text: Column) -> Column:
    """The DOUBLE a text spells, NULL when it spells none.

    Java also reads a trailing type letter (``1.0d``); such text is no number here.
    Underscores between digits are allowed.
    """
    joined = F.regexp_replace(text, "(?<=[0-9])_(?=[0-9])", "")
    plain = F.when(text.contains("_"), joined).otherwise(text)
    return F.when(~text.rlike("[0-9.][dDfF]\\s*$"), plain.try_cast("double"))


def is_number(text: Column) -> Column:
    """True when the text spells a number."""
    return F.coalesce(to_number(text).isNotNull(), F.lit(False))


def to_integer(text: Column) -> Column:
    """The BIGINT a text spells; ``120.0`` is no integer."""
    return text.try_cast("bigint")


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, NULL on a zero divisor."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def uniform(*keys: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by the keys and the seed, whatever the partitioning.

    52 bits of an md5 digest, so that any SQL engine can reproduce the draw.
    """
    digest = F.md5(F.concat_ws(":", *[k.cast("string") for k in keys], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def bucket(*keys: Column, buckets: int, seed: int) -> Column:
    """A bucket number 1..buckets fixed by the keys and the seed."""
    return (F.floor(uniform(*keys, seed=seed) * buckets) + 1).cast("int")
