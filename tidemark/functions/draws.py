"""Gamma draws as column expressions, fixed by their keys, so that any SQL engine can repeat them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Proposals per draw. Each is taken with a chance of 0.95 or more, so hardly one draw in three million takes the middle of its law instead.
TRIES = 5


def _part(digest: Column, first: int, digits: int) -> Column:
    """A number in (0, 1) from so many hexadecimal digits."""
    whole = F.conv(F.substring(digest, first, digits), 16, 10).cast("double")
    return (whole + 0.5) / F.lit(float(16**digits))


def log_gamma(shape: Column, *keys: Column, seed: int) -> Column:
    """ln of a gamma draw with that shape (above 0) and scale 1, by squeezing a cubed normal.

    A proposal takes one md5 digest: two numbers of 52 bits make a normal, 24 bits decide. A shape below 1 is drawn
    from shape + 1 and scaled by a power of a further number.
    """
    name = [k.cast("string") for k in keys]
    digest = lambda n: F.md5(F.concat_ws(":", *name, n.cast("string"), F.lit(str(seed))))
    low = shape < 1
    d = F.when(low, shape + 1).otherwise(shape) - F.lit(1.0) / 3
    # each step names what the next one uses more than once
    digests = F.transform(F.sequence(F.lit(0), F.lit(TRIES - 1)), digest)
    normal = lambda h: F.sqrt(-2 * F.log(_part(h, 1, 13))) * F.cos(F.lit(6.283185307179586) * _part(h, 14, 13))
    normals = F.transform(digests, lambda h: F.struct(normal(h).alias("x"), F.log(_part(h, 27, 6)).alias("u")))
    roots = F.transform(normals, lambda p: F.struct(p["x"].alias("x"), p["u"].alias("u"), (1 + p["x"] / F.sqrt(9 * d)).alias("root")))
    cubes = F.transform(roots, lambda p: F.struct(p["x"].alias("x"), p["u"].alias("u"), (p["root"] * p["root"] * p["root"]).alias("cube")))
    taken = F.filter(cubes, lambda p: (p["cube"] > 0) & (p["u"] < p["x"] * p["x"] / 2 + d - d * p["cube"] + d * F.log(p["cube"])))
    scale = F.when(low, F.log(_part(digest(F.lit(TRIES)), 1, 13)) / shape).otherwise(0.0)
    return F.log(d) + F.coalesce(F.log(F.get(taken, F.lit(0))["cube"]), F.lit(0.0)) + scale
