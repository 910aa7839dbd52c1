"""A weighted sample that every run repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A hash of 13 hexadecimal digits is a number below 2^52.
HASH_DIGITS = 13


def city_weight(population: Column) -> Column:
    """Population times the whole part of its square root."""
    return population * F.floor(F.sqrt(population))


def evacuating(population: Column) -> Column:
    """The quarter that leaves, rounded down."""
    return F.floor(population / 4).cast("bigint")


def weighted_sample(df: DataFrame, weight: Column, k: int, seed: int, id: str) -> DataFrame:
    """k rows without replacement, each draw in proportion to weight.

    Every row gets the key -ln(u) / weight with u from a hash of seed and id, and the k
    smallest keys win (Efraimidis and Spirakis, 2006). Each task keeps its own k.
    """
    text = F.concat(F.lit(f"{seed}:"), F.col(id).cast("string"))
    digits = F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("bigint")
    u = (digits + F.lit(0.5)) / F.lit(float(16**HASH_DIGITS))
    key = -F.ln(u) / weight
    return df.filter(weight > 0).orderBy(key, id).limit(k)
