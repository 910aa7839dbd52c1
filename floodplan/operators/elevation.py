"""Elevation per cell, and which places a rise floods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floodplan.functions.grid import FINE_RES, cell
from floodplan.functions.parsing import parse_population, parse_size
from floodplan.operators.skew import spread_join


def min_elevation(
    samples: DataFrame,
    res: int = FINE_RES,
    lon0: float = 0.0,
    method: str = "groupby",
    sheets: int = 1,
) -> DataFrame:
    """The lowest sample of every cell.

    ``groupby`` keeps a running minimum per cell in each task and shuffles one row per
    task and cell, so a cell with a third of all samples is no heavier than another.
    ``window`` ranks the samples of a cell instead. Spark limits each task to its first
    row per cell before the shuffle, but has to sort every sample for it; it is the
    slower equal.
    """
    at = cell(F.col("lat"), F.col("lon"), res, lon0, sheets)
    placed = samples.select(at.alias("cell"), "elevation")
    if method == "groupby":
        return placed.groupBy("cell").agg(F.min("elevation").alias("elevation"))
    if method == "window":
        lowest = Window.partitionBy("cell").orderBy(F.asc_nulls_last("elevation"))
        return (
            placed.withColumn("row", F.row_number().over(lowest))
            .filter(F.col("row") == 1)
            .drop("row")
        )
    raise ValueError(f"method must be 'groupby' or 'window', not {method!r}")


def with_elevation(places: DataFrame, lowest: DataFrame, method: str = "spread") -> DataFrame:
    """Places with the lowest elevation of their cell; places without samples go.

    ``spread`` cuts cells with many places into parts. ``bucketed`` is for two tables
    stored in the same buckets of the cell, which meet without a shuffle.
    """
    if method == "spread":
        sizes = places.groupBy("cell").agg(F.count("*").alias("n"))
        return spread_join(places, lowest, ["cell"], "id", sizes)
    if method == "bucketed":
        return places.join(lowest, "cell")
    raise ValueError(f"method must be 'spread' or 'bucketed', not {method!r}")


def at_rises(elevated: DataFrame, rises: list[int]) -> DataFrame:
    """One copy of every place per rise, to plan for several rises in one run."""
    return elevated.withColumn("rise", F.explode(F.array(*[F.lit(r) for r in rises])))


def first_rise(elevation: Column) -> Column:
    """The first whole rise, from 0 on, that floods an elevation."""
    return F.greatest(F.ceil(elevation), F.lit(0)).cast("int")


def flooded_by_rise(elevated: DataFrame, top: int) -> DataFrame:
    """Named places that some rise up to ``top`` floods, and the first that does."""
    return (
        flooded(elevated.withColumn("first_rise", first_rise(F.col("elevation"))), top, "first_rise")
        .filter(F.col("first_rise") <= top)
    )


def cities_by_height(elevated: DataFrame, top: int) -> DataFrame:
    """Named cities that are safe at rise 0, and the first rise that floods them, up to top + 1."""
    height = F.least(first_rise(F.col("elevation")), F.lit(top + 1))
    return safe_cities(elevated.withColumn("height", height), 0, "height")


def _level(rise: int | str) -> Column:
    return F.col(rise) if isinstance(rise, str) else F.lit(rise)


def flooded(elevated: DataFrame, rise: int | str, *more: str) -> DataFrame:
    """Named places at or below the rise (a number, or the name of a column)."""
    scope = [rise] if isinstance(rise, str) else []
    return elevated.filter(
        (F.col("elevation") <= _level(rise)) & F.col("name").isNotNull()
    ).select(
        *scope,
        F.col("name").alias("place"),
        F.col("id").alias("flood_id"),
        parse_population(F.col("population")).alias("num_evacuees"),
        "cell",
        "rough",
        *more,
    )


def safe_cities(elevated: DataFrame, rise: int | str, *more: str) -> DataFrame:
    """Named cities above the rise (a number, or the name of a column)."""
    scope = [rise] if isinstance(rise, str) else []
    return elevated.filter(
        (F.col("elevation") > _level(rise))
        & (F.col("place") == "city")
        & F.col("name").isNotNull()
    ).select(
        *scope,
        F.col("name").alias("destination"),
        F.col("id").alias("destination_id"),
        parse_size(F.col("population")).alias("safe_population"),
        "cell",
        "rough",
        *more,
    )
