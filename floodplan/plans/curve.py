"""The plans of all rises at once.

A city is a refuge below its elevation and a place is flooded from its own on. One search gives
each place its nearest refuges as steps over rises, so the work grows with the steps and not
with the number of rises that are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodplan.functions.checks import MAX_RISE_COUNTRY, check_rise
from floodplan.operators.elevation import cities_by_height, flooded_by_rise
from floodplan.operators.nearest import Search, Target, nearest_by_rise
from floodplan.plans.evacuation import relocation_plan

RANGE = ("low", "high")


def options_by_rise(
    places: DataFrame, harbours: DataFrame, top: int = MAX_RISE_COUNTRY, place_key: str = "name"
) -> DataFrame:
    """As ``refuge_options``, with the rises from ``low`` to ``high`` that each row holds for.

    ``places`` have their elevation. A place has one row for every rise at which it is flooded
    and a city is left, of ranges that don't overlap. Which of a place's nodes are flooded
    changes with the rise, and with it the nearest.
    """
    if place_key not in ("name", "id"):
        raise ValueError(f"place_key must be 'name' or 'id', not {place_key!r}")
    key = "place" if place_key == "name" else "flood_id"
    city = Target(
        cities_by_height(places, top), "destination_id", "destination", "safe_population", Search(), "height"
    )
    harbour = Target(harbours, "harbour_id", "harbour", None, Search(), str(top + 1))
    found = nearest_by_rise(flooded_by_rise(places, top), {"city": city, "harbour": harbour})

    def refuge(step: Column, name: str) -> Column:
        best = F.struct(
            step["distance"].alias("distance"), "flood_id", step["target"].alias("target"), "num_evacuees", "place"
        )
        return best if name == "city" else step["distance"]

    ranges = None
    for name in ("city", "harbour"):
        step = F.col("step")
        each = found.withColumn("step", F.explode(name)).select(
            F.col(key).alias("key"),
            F.greatest(step["low"], F.col("first_rise")).alias("low"),
            step["high"].alias("high"),
            *[(refuge(step, n) if n == name else F.lit(None)).alias(n) for n in ("city", "harbour")],
        )
        ranges = each if ranges is None else ranges.unionByName(each)
    # Rises are bounded, so a place has a bounded number of different ranges whatever its nodes.
    least = (
        ranges.filter("low <= high")
        .groupBy("key", *RANGE)
        .agg(F.min("city").alias("city"), F.min("harbour").alias("harbour"))
        .groupBy("key")
        .agg(F.collect_list(F.struct(*RANGE, "city", "harbour")).alias("steps"))
    )
    bounds = F.array_sort(
        F.array_distinct(F.concat(F.col("steps.low"), F.transform("steps.high", lambda h: h + 1)))
    )
    cut = least.select("key", "steps", bounds.alias("bounds")).select(
        "steps", F.explode(F.arrays_zip(F.col("bounds").alias("low"), F.slice("bounds", 2, top + 2).alias("next"))).alias("b")
    )
    low = F.col("b.low")
    valid = F.filter("steps", lambda s: (s["low"] <= low) & (s["high"] >= low))
    best = cut.filter("b.next IS NOT NULL").select(
        low.alias("low"),
        (F.col("b.next") - 1).alias("high"),
        F.array_min(F.transform(valid, lambda s: s["city"])).alias("city"),
        F.array_min(F.transform(valid, lambda s: s["harbour"])).alias("harbour_distance"),
    )
    return best.filter("city IS NOT NULL").select(
        *RANGE,
        "city.place",
        "city.flood_id",
        "city.num_evacuees",
        F.col("city.target.name").alias("destination"),
        F.col("city.target.id").alias("destination_id"),
        F.col("city.target.population").alias("safe_population"),
        F.col("city.distance").alias("city_distance"),
        "harbour_distance",
    )


def plans_by_rise(
    places: DataFrame,
    harbours: DataFrame,
    top: int = MAX_RISE_COUNTRY,
    place_key: str = "name",
    missing_harbour: str = "far",
) -> DataFrame:
    """The relocation plans of all whole rises from 0 to ``top``; each row holds from low to high."""
    top = check_rise(top)
    return relocation_plan(options_by_rise(places, harbours, top, place_key), missing_harbour, RANGE)


def evacuation_curve(plans: DataFrame, top: int = MAX_RISE_COUNTRY) -> DataFrame:
    """Total evacuees of every whole rise from 0 to ``top``, 0 where nobody has to leave.

    Sums are taken by range first, of which there are no more than pairs of rises.
    """
    sums = plans.groupBy(*RANGE).agg(F.sum("num_evacuees").alias("sum"))
    by_rise = sums.select(F.explode(F.sequence("low", "high")).alias("rise"), "sum")
    every = plans.sparkSession.range(top + 1).select(F.col("id").cast("int").alias("rise"))
    return (
        every.join(by_rise.groupBy("rise").agg(F.sum("sum").alias("sum")), "rise", "left")
        .select("rise", F.coalesce("sum", F.lit(0.0)).alias("total_evacuees"))
    )
