"""What becomes of the updates: cities joined on, latest values, intensities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodplan.sources import schemas

LARGE_POPULATION = 400_000
# Copies of a city's row among which its updates are dealt.
PARTS = 32


def parse_updates(messages: DataFrame) -> DataFrame:
    """Updates of JSON texts in ``value``; further columns pass through.

    Messages that are no update, or state a negative number, are skipped. City and
    change may be missing.
    """
    rest = [c for c in messages.columns if c not in ("key", "value")]
    parsed = messages.select(*rest, F.from_json("value", schemas.UPDATE).alias("update"))
    return parsed.select(*rest, "update.*").filter(
        (F.col("refugees") >= 0)
        & (F.col("city_id").isNull() | (F.col("city_id") >= 0))
        & (F.col("change").isNull() | (F.col("change") >= 0))
    )


def large_cities(cities: DataFrame, min_population: int = LARGE_POPULATION) -> DataFrame:
    """Cities above a population."""
    return cities.filter(F.col("population") > min_population)


def enrich_updates(updates: DataFrame, cities: DataFrame, parts: int = PARTS) -> DataFrame:
    """Each update with its city's columns, NULL if the city is unknown or missing.

    A city's updates, and those without a city, are dealt to ``parts`` copies of its row by
    a hash of their columns, in a stream too, where nothing is split at run time. Both sides
    are shuffled: Spark judges the city side by its files and its columns' types, without
    the copies, and would broadcast millions of them through the driver.
    """
    renamed = updates.withColumnRenamed("refugees", "count").drop("city_name")
    dealt = renamed.withColumn("_part", F.pmod(F.xxhash64(*renamed.columns), F.lit(parts)).cast("int"))
    copies = cities.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return dealt.join(copies.hint("merge"), ["city_id", "_part"], "left").drop("_part")


def latest_by_city(updates: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Each city's latest count, and its latest change that is not missing."""
    seq = F.struct(*order)
    return updates.groupBy("city_id").agg(
        F.max_by("city_name", seq).alias("city_name"),
        F.max_by("refugees", seq).alias("refugees"),
        F.max_by("change", F.when(F.col("change").isNotNull(), seq)).alias("change"),
    )


def intensity(latest: DataFrame, largest: Column) -> DataFrame:
    """Count relative to the largest city's, change relative to the city's own count."""
    return latest.filter(F.col("refugees") > 0).select(
        "*",
        (F.col("refugees") / largest).alias("count_scale"),
        F.coalesce(F.try_divide("change", "refugees"), F.lit(0.0)).alias("change_scale"),
    )


def city_intensity(latest: DataFrame) -> DataFrame:
    """The intensities of a finite table of latest values.

    The largest count is a single number, found by a partial maximum in every task.
    """
    return intensity(latest, latest.agg(F.max("refugees")).scalar())
