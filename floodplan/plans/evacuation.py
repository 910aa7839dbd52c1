"""From refuge options to the relocation plan and what it does to destinations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodplan.operators.skew import spread_join

# Where harbours send people, and the shares of the two ways.
SEA_DESTINATION = "Waterworld"
SEA_SHARE = 0.25
LAND_SHARE = 0.75


def nearer_to_harbour(missing_harbour: str = "far") -> Column:
    """True if the harbour is no farther than the city.

    A missing harbour is infinitely ``"far"``; ``"nearest"`` counts it as nearest.
    """
    if missing_harbour not in ("far", "nearest"):
        raise ValueError(f"missing_harbour must be 'far' or 'nearest', not {missing_harbour!r}")
    nearer = F.col("harbour_distance") <= F.col("city_distance")
    return F.coalesce(nearer, F.lit(missing_harbour == "nearest"))


def split_by_refuge(
    options: DataFrame, missing_harbour: str = "far"
) -> tuple[DataFrame, DataFrame]:
    """(places nearer to a harbour, places nearer to a city)."""
    nearer = nearer_to_harbour(missing_harbour)
    return options.filter(nearer), options.filter(~nearer)


def relocation_plan(
    options: DataFrame, missing_harbour: str = "far", scope: tuple[str, ...] = ()
) -> DataFrame:
    """One row per place and destination.

    Near a city everyone goes there. Near a harbour three quarters do, and a quarter
    goes out to sea. Each place becomes its one or two rows in place: the options are
    read once, and nothing is shuffled or united.
    """

    def share(name: Column, id: Column, population: Column, part: float) -> Column:
        return F.struct(
            (F.col("num_evacuees") * F.lit(part)).alias("num_evacuees"),
            name.alias("destination"),
            id.cast("bigint").alias("destination_id"),
            population.alias("safe_population"),
        )

    city = (F.col("destination"), F.col("destination_id"), F.col("safe_population"))
    sea = (F.lit(SEA_DESTINATION), F.lit(None), F.lit(0.0))
    shares = F.when(
        nearer_to_harbour(missing_harbour),
        F.array(share(*city, LAND_SHARE), share(*sea, SEA_SHARE)),
    ).otherwise(F.array(share(*city, 1.0)))
    return options.select(*scope, "place", "flood_id", F.inline(shares))


def destination_change(
    plan: DataFrame, place_key: str = "name", scope: tuple[str, ...] = ()
) -> DataFrame:
    """Population of every destination before and after."""
    by = ["destination"] if place_key == "name" else ["destination", "destination_id"]
    return (
        plan.groupBy(*scope, *by)
        .agg(
            F.avg("safe_population").alias("old_population"),
            F.sum("num_evacuees").alias("received"),
        )
        .select(
            *scope,
            *by,
            "old_population",
            (F.col("old_population") + F.col("received")).alias("new_population"),
        )
    )


def total_evacuees(plan: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """The sum over the whole plan: one row, or one per scope."""
    return plan.groupBy(*scope).agg(F.sum("num_evacuees").alias("total_evacuees"))


def unassigned(
    flooded: DataFrame, plan: DataFrame, place_key: str = "name", scope: tuple[str, ...] = ()
) -> DataFrame:
    """Flooded rows that the plan sends nowhere."""
    keys = [*scope, "place" if place_key == "name" else "flood_id"]
    sizes = flooded.groupBy(*keys).agg(F.count("*").alias("n"))
    planned = plan.select(*keys).distinct()
    return spread_join(flooded, planned, keys, "flood_id", sizes, "left_anti")
