"""Map nodes to complete places and harbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodplan.functions.grid import FINE_RES, ROUGH_RES, cell

# The tags that are read, and the place types that count. "halmet" is
# spelt this way on purpose: hamlets do not count unless a caller asks for them.
TAG_KEYS = ("name", "place", "population", "harbour")
PLACE_TYPES = ("city", "town", "village", "halmet")


def only_nodes(elements: DataFrame) -> DataFrame:
    """Drop ways and relations; the filter reaches the ORC or Parquet scan."""
    return elements.filter(F.col("type") == "node")


def tag_rows(elements: DataFrame, keys: tuple[str, ...] = TAG_KEYS) -> DataFrame:
    """One row per wanted tag of a node: id, lat, lon, key, value."""
    return (
        only_nodes(elements)
        .select("id", "lat", "lon", F.explode("tags"))
        .filter(F.col("key").isin(*keys))
    )


def extract_tags(
    elements: DataFrame, keys: tuple[str, ...] = TAG_KEYS, method: str = "lookup"
) -> DataFrame:
    """One row per node with any wanted tag, and a column per tag.

    ``lookup`` reads the map in place and moves no row. ``pivot`` explodes the map and
    groups it again, which shuffles every tag; it is the slower equal.
    """
    if method == "lookup":
        return (
            only_nodes(elements)
            .select("id", "lat", "lon", *[F.col("tags")[key].alias(key) for key in keys])
            .filter(F.coalesce(*keys).isNotNull())
        )
    if method == "pivot":
        return (
            tag_rows(elements, keys)
            .groupBy("id", "lat", "lon")
            .pivot("key", list(keys))
            .agg(F.first("value"))
        )
    raise ValueError(f"method must be 'lookup' or 'pivot', not {method!r}")


def complete_places(tagged: DataFrame, place_types: tuple[str, ...] = PLACE_TYPES) -> DataFrame:
    """Keep harbours, and places of a wanted type that state a population."""
    is_place = F.col("place").isin(*place_types) & F.col("population").isNotNull()
    return tagged.filter(is_place | (F.col("harbour") == "yes"))


def with_cells(
    df: DataFrame,
    res: int = FINE_RES,
    rough_res: int = ROUGH_RES,
    lon0: float = 0.0,
    sheets: int = 1,
) -> DataFrame:
    """Add the fine and the rough cell of the position."""
    lat, lon = F.col("lat"), F.col("lon")
    return df.withColumns(
        {
            "cell": cell(lat, lon, res, lon0, sheets),
            "rough": cell(lat, lon, rough_res, lon0, sheets),
        }
    )


def harbours(complete: DataFrame) -> DataFrame:
    """Nodes tagged as a harbour, as possible refuges."""
    return complete.filter(F.col("harbour") == "yes").select(
        F.col("id").alias("harbour_id"), F.col("name").alias("harbour"), "cell", "rough"
    )


def places(complete: DataFrame) -> DataFrame:
    """Nodes without any harbour tag, one per id.

    Ids are unique in a map; should one repeat, its smallest row is kept, so that a
    recomputed task keeps the same one.
    """
    columns = ["name", "population", "place", "cell", "rough"]
    return (
        complete.filter(F.col("harbour").isNull())
        .groupBy("id")
        .agg(F.min(F.struct(*columns)).alias("row"))
        .select("id", *[F.col("row")[c].alias(c) for c in columns])
    )


def split_harbours(complete: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(places, harbours). A place with any other harbour tag is in neither."""
    return places(complete), harbours(complete)
