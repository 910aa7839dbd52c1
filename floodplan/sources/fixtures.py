"""Map nodes, elevation samples, arrivals and cities derived from the given tables.

Each text is valid in Spark and in DuckDB; ``{table}`` marks an input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OSM_FLAT = """
SELECT c_custkey AS id,
  CASE WHEN c_custkey % 11 = 10 THEN 'way' ELSE 'node' END AS type,
  ((c_nationkey * 37) % 100) - 48 + CAST((c_custkey * 7919) % 4000 AS DOUBLE) / 1000 AS lat,
  -160 + c_nationkey * 13 + CAST((c_custkey * 104729) % 4000 AS DOUBLE) / 1000 AS lon,
  CASE WHEN c_custkey % 97 = 5 THEN NULL ELSE concat('Place ', CAST(c_custkey - CASE WHEN c_custkey % 10 = 9 THEN 1 ELSE 0 END AS STRING)) END AS name,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN CASE WHEN c_nationkey % 4 = 3 THEN 'town' ELSE 'city' END
    WHEN 'BUILDING' THEN 'town' WHEN 'FURNITURE' THEN 'village' WHEN 'HOUSEHOLD' THEN 'hamlet' ELSE 'halmet' END AS place,
  CASE WHEN c_custkey % 13 = 4 THEN NULL WHEN c_custkey % 17 = 3 THEN '1,234' WHEN c_custkey % 19 = 6 THEN '1234.5'
    ELSE CAST(100 + (c_custkey * 7) % 90000 AS STRING) END AS population,
  CASE WHEN c_custkey % 29 = 0 THEN 'yes' WHEN c_custkey % 31 = 0 THEN 'no' ELSE NULL END AS harbour
FROM {customer}
UNION ALL
SELECT 100000000 + s_suppkey, 'node',
  ((s_nationkey * 37) % 100) - 48 + CAST((s_suppkey * 7919) % 4000 AS DOUBLE) / 1000,
  -160 + s_nationkey * 13 + CAST((s_suppkey * 104729) % 4000 AS DOUBLE) / 1000,
  concat('Harbour ', CAST(s_suppkey AS STRING)), NULL, NULL,
  CASE WHEN s_nationkey % 3 = 2 OR s_suppkey % 4 = 3 THEN 'no' ELSE 'yes' END
FROM {supplier}
"""

ELEVATION = """
SELECT f.lat, f.lon, CAST((o_custkey * 53) % 60 - 5 + o_orderkey % 4 AS INT) AS elevation
FROM {orders} JOIN {osm_flat} f ON f.id = o_custkey
"""

REFUGEE_EVENTS = """
SELECT event_id, ts, user_id AS city_id, concat('City ', CAST(user_id AS STRING)) AS city_name,
  CAST(round(value * 100) AS BIGINT) AS refugees FROM {events}
"""

CITIES = """
SELECT CAST(c_custkey AS STRING) AS geoname_id, concat('City ', CAST(c_custkey AS STRING)) AS name,
  CAST((c_custkey * 7919) % 1000000 AS BIGINT) AS population FROM {customer}
"""

TAGS = """
SELECT id, type, lat, lon,
  map_filter(map('name', name, 'place', place, 'population', population, 'harbour', harbour, 'note', 'x'),
    (k, v) -> v IS NOT NULL) AS tags
FROM {osm_flat}
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def osm_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        OSM_FLAT,
        customer=_table(spark, sf_dir, "customer"),
        supplier=_table(spark, sf_dir, "supplier"),
    )


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map nodes, ways and relations with their tags in a map."""
    return spark.sql(TAGS, osm_flat=osm_flat(spark, sf_dir))


def elevation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        ELEVATION,
        orders=_table(spark, sf_dir, "orders"),
        osm_flat=osm_flat(spark, sf_dir),
    )


def refugee_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(REFUGEE_EVENTS, events=_table(spark, sf_dir, "events"))


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CITIES, customer=_table(spark, sf_dir, "customer"))
