"""The batch plan from raw inputs to its outputs, and a job to submit."""

from __future__ import annotations

import argparse
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodplan.functions.checks import MAX_RISE_COUNTRY, MAX_RISE_PLANET, check_rise
from floodplan.functions.grid import FINE_RES, ROUGH_RES
from floodplan.operators.elevation import (
    at_rises,
    flooded,
    min_elevation,
    safe_cities,
    with_elevation,
)
from floodplan.operators.nearest import Finder, Search, nearest_targets, refuge_options
from floodplan.operators.planet import SHEETS, nearest_on_earth
from floodplan.operators.places import (
    PLACE_TYPES,
    complete_places,
    extract_tags,
    split_harbours,
    with_cells,
)
from floodplan.plans.evacuation import destination_change, relocation_plan, total_evacuees
from floodplan.session import forget, settle
from floodplan.sources.files import (
    read_elevation,
    read_nodes,
    write_destinations,
    write_plan,
)


@dataclass(frozen=True)
class Terrain:
    """What does not depend on the rise: places with their elevation, and harbours."""

    places: DataFrame
    harbours: DataFrame


def survey_terrain(
    elements: DataFrame,
    samples: DataFrame,
    place_types: tuple[str, ...] = PLACE_TYPES,
    res: int = FINE_RES,
    rough_res: int = ROUGH_RES,
    lon0: float = 0.0,
    sheets: int = 1,
) -> Terrain:
    """Read both inputs once and keep what every later step shares.

    Map and samples are each scanned a single time. What is settled is the complete
    places and harbours, a tiny part of the map, and one row per place.
    """
    tagged = complete_places(extract_tags(elements), place_types)
    complete = settle(with_cells(tagged, res, rough_res, lon0, sheets))
    places, harbours = split_harbours(complete)
    elevated = with_elevation(places, min_elevation(samples, res, lon0, sheets=sheets))
    return Terrain(settle(elevated), harbours)


# Everywhere for both kinds, or neighbouring rough cells and everywhere for cities only.
EXHAUSTIVE = (Search("exhaustive"), Search("exhaustive"))
RING = (Search("ring"), Search("ring", fallback=False))


def evacuation_plan(
    terrain: Terrain,
    rise: int,
    searches: tuple[Search, Search] = EXHAUSTIVE,
    place_key: str = "name",
    missing_harbour: str = "far",
    find: Finder = nearest_targets,
) -> DataFrame:
    """The relocation plan for one rise.

    For the whole earth survey the terrain in ``planet.SHEETS`` sheets and give
    ``planet.nearest_on_earth`` as ``find``; distances are metres then.
    """
    rise = check_rise(rise)
    options = refuge_options(
        flooded(terrain.places, rise),
        safe_cities(terrain.places, rise),
        terrain.harbours,
        *searches,
        place_key=place_key,
        find=find,
    )
    return relocation_plan(options, missing_harbour)


def evacuation_totals(
    terrain: Terrain,
    rises: list[int],
    searches: tuple[Search, Search] = EXHAUSTIVE,
    place_key: str = "name",
) -> DataFrame:
    """Total evacuees for each of several rises, planned in one run; 0 where there are none."""
    rises = [check_rise(rise) for rise in rises]
    scope = ("rise",)
    places = at_rises(terrain.places, rises)
    options = refuge_options(
        flooded(places, "rise"),
        safe_cities(places, "rise"),
        at_rises(terrain.harbours, rises),
        *searches,
        place_key=place_key,
        scope=scope,
    )
    asked = terrain.places.sparkSession.createDataFrame([(r,) for r in sorted(set(rises))], "rise int")
    totals = total_evacuees(relocation_plan(options, scope=scope), scope)
    return asked.join(totals, "rise", "left").select(
        "rise", F.coalesce("total_evacuees", F.lit(0.0)).alias("total_evacuees")
    )


def run(
    spark: SparkSession,
    nodes_path: str,
    elevation_path: str,
    rise: int,
    plan_path: str,
    destinations_path: str,
    searches: tuple[Search, Search] = RING,
    place_key: str = "name",
    max_rise: int = MAX_RISE_PLANET,
    missing_harbour: str = "far",
    place_types: tuple[str, ...] = PLACE_TYPES,
    lon0: float = 0.0,
    planet: bool = False,
) -> DataFrame:
    """Plan for one rise, write both outputs and return the total as a one-row frame."""
    rise = check_rise(rise, max_rise)
    nodes, samples = read_nodes(spark, nodes_path), read_elevation(spark, elevation_path)
    terrain = survey_terrain(nodes, samples, place_types, lon0=lon0, sheets=SHEETS if planet else 1)
    find = partial(nearest_on_earth, lon0=lon0) if planet else nearest_targets
    searches = EXHAUSTIVE if planet else searches
    plan = settle(evacuation_plan(terrain, rise, searches, place_key, missing_harbour, find))
    write_plan(plan, plan_path)
    write_destinations(destination_change(plan, place_key), destinations_path)
    return total_evacuees(plan)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Plan the evacuation for a sea level rise.")
    parser.add_argument("nodes", help="map nodes, ORC")
    parser.add_argument("elevation", help="elevation samples, Parquet, may be a glob")
    parser.add_argument("rise", help="rise of the sea level in metres")
    parser.add_argument("plan", help="where to write the relocation plan, ORC")
    parser.add_argument("destinations", help="where to write the destinations' change, ORC")
    parser.add_argument("--search", choices=["exhaustive", "ring"], default="ring")
    parser.add_argument("--place-key", choices=["name", "id"], default="name")
    parser.add_argument("--country", action="store_true", help=f"rise up to {MAX_RISE_COUNTRY}")
    parser.add_argument("--missing-harbour", choices=["far", "nearest"], default="far")
    parser.add_argument("--place-types", nargs="+", default=list(PLACE_TYPES))
    parser.add_argument("--lon0", type=float, default=0.0, help="central meridian of the region")
    parser.add_argument("--planet", action="store_true", help="nearest by great circles, without edges")
    given = parser.parse_args(arguments)
    max_rise = MAX_RISE_COUNTRY if given.country else MAX_RISE_PLANET
    rise = check_rise(given.rise, max_rise)
    spark = SparkSession.builder.appName("floodplan").getOrCreate()
    searches = EXHAUSTIVE if given.search == "exhaustive" else RING
    total = run(
        spark,
        given.nodes,
        given.elevation,
        rise,
        given.plan,
        given.destinations,
        searches,
        given.place_key,
        max_rise,
        given.missing_harbour,
        tuple(given.place_types),
        given.lon0,
        given.planet,
    )
    print(f"sea level rise {rise} m, total evacuees {total.first()['total_evacuees']}")
    forget(spark)
    spark.stop()


if __name__ == "__main__":
    main()
