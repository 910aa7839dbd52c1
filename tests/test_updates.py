import json

import pytest
from pyspark.sql import functions as F

from floodplan.operators.sample import city_weight, evacuating, weighted_sample
from floodplan.sources.files import read_city_features, read_city_records
from floodplan.streaming import updates as U
from floodplan.streaming.tracker import encode_updates, parse_events

UPDATES = "city_id bigint, city_name string, refugees bigint, change bigint, seq bigint"

# Messages as a producer sends them; one has nobody in it, one a name beyond ASCII.
ARRIVALS = [
    '{"timestamp":1700000000123,"city_id":11,"city_name":"Upper Mill","refugees":17}',
    '{"timestamp":1700000000456,"city_id":12,"city_name":"Lower Mill","refugees":2040}',
    '{"timestamp":1700000000789,"city_id":13,"city_name":"Kõrgemäe","refugees":0}',
]
MALFORMED = ["", "no json", "[]", '{"timestamp":1,"city_id":2,"city_name":"x"}', None, "{}"]


def test_malformed_arrivals_are_set_aside(spark):
    texts = spark.createDataFrame([(t,) for t in ARRIVALS + MALFORMED], "value string")
    good, bad = parse_events(texts)
    assert {(r["city_name"], r["refugees"]) for r in good.collect()} >= {
        ("Kõrgemäe", 0),
        ("Lower Mill", 2040),
    }
    assert good.count() == 3 and bad.count() == len(MALFORMED)
    millis = good.filter("city_id = 11").select(F.unix_millis("ts")).first()[0]
    assert millis == 1700000000123


def test_updates_round_trip_and_filter(spark):
    updates = spark.createDataFrame(
        [(1, "a", 5, 5, 0), (2, "b", 5, None, 1), (3, "c", -1, 0, 2), (4, "d", 5, -1, 3)], UPDATES
    )
    messages = encode_updates(updates)
    assert messages.columns == ["key", "value", "seq"]
    assert {r["key"] for r in messages.collect()} == {"1", "2", "3", "4"}
    junk = spark.createDataFrame([("5", "no json", 9)], "key string, value string, seq bigint")
    parsed = U.parse_updates(messages.unionByName(junk)).collect()
    assert {(r["city_id"], r["refugees"], r["change"]) for r in parsed} == {(1, 5, 5), (2, 5, None)}


def test_enrich_latest_intensity(spark):
    updates = spark.createDataFrame(
        [
            (1, "a", 5, 5, 0),
            (1, "a", 10, None, 1),
            (2, "b", 20, 4, 2),
            (3, "c", 0, 0, 3),
            (None, None, 7, 7, 4),
        ],
        UPDATES,
    )
    cities = spark.createDataFrame([(1, "A")], "city_id bigint, name string")
    enriched = U.enrich_updates(updates, cities).collect()
    assert len(enriched) == 5
    assert {(r["city_id"], r["name"]) for r in enriched} == {
        (1, "A"),
        (2, None),
        (3, None),
        (None, None),
    }
    latest = U.latest_by_city(updates.filter("city_id IS NOT NULL"), ("seq",))
    assert {(r["city_id"], r["refugees"], r["change"]) for r in latest.collect()} == {
        (1, 10, 5),
        (2, 20, 4),
        (3, 0, 0),
    }
    scales = U.city_intensity(latest).collect()
    assert {(r["city_id"], r["count_scale"], r["change_scale"]) for r in scales} == {
        (1, 0.5, 0.5),
        (2, 1.0, 0.2),
    }


def test_copies_of_cities_pass_no_driver(spark, capsys):
    """However small Spark believes the cities to be, their copies are shuffled."""
    updates = spark.createDataFrame([(1, "a", 5, 5, 0), (2, "b", 6, 6, 1)], UPDATES)
    cities = spark.range(1, 4).select(F.col("id").alias("city_id"), F.lit("A").alias("name"))
    enriched = U.enrich_updates(updates, cities)
    enriched.explain()
    plan = capsys.readouterr().out
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert {(r["city_id"], r["name"]) for r in enriched.collect()} == {(1, "A"), (2, "A")}


def test_features(spark, tmp_path):
    features = [
        '{"properties": {"geoname_id": "1", "name": "a", "population": 500000}, '
        '"geometry": {"type": "Point", "coordinates": [1.0, 2.0]}}',
        '{"properties": {"geoname_id": "x", "name": "b", "population": 5}}',
        '{"properties": {"geoname_id": "2", "population": 5}}',
        '{"properties": {"geoname_id": "3", "name": "c"}}',
        '{"properties": null}',
        '{"properties": {"geoname_id": "4", "name": "d", "population": 400000}}',
    ]
    text = '{"type": "FeatureCollection",\n "features": [' + ",\n".join(features) + "]}"
    path = tmp_path / "cities.geojson"
    path.write_text(text)
    cities = read_city_features(spark, str(path))
    assert {(r["city_id"], r["name"]) for r in cities.collect()} == {(1, "a"), (4, "d")}
    large = U.large_cities(cities).collect()
    assert [(r["city_id"], r["feature"].toPython()["geometry"]["coordinates"]) for r in large] == [
        (1, [1.0, 2.0])
    ]
    path.write_text(text[:-1])
    with pytest.raises(Exception):
        read_city_features(spark, str(path)).collect()
    path.write_text('{"type": "Topology", "features": []}')
    with pytest.raises(Exception, match="no FeatureCollection but Topology"):
        read_city_features(spark, str(path)).collect()


def record(k, **more):
    return json.dumps(
        {
            "type": "Feature",
            "properties": {"geoname_id": str(k), "name": f"c\n{k}", "population": k, **more},
            "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [k, 1], [0, 0]]]},
        }
    )


def test_records_are_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "cities.ndjson"
    path.write_text("".join(record(k, wiki={"en": [k]}) + "\n" for k in range(3000)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        cities = read_city_records(spark, str(path))
        parts = cities.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(parts) > 4 and sum(r["count"] for r in parts) == 3000
    city = cities.filter("city_id = 77").first()
    feature = city["feature"].toPython()
    assert city["name"] == "c\n77" and feature["properties"]["wiki"] == {"en": [77]}
    assert feature["geometry"]["coordinates"][0][1] == [77, 1]


def test_records_with_separators(spark, tmp_path):
    path = tmp_path / "cities.geojsons"
    wide = json.dumps(json.loads(record(5)), indent=1)
    path.write_text("\x1e" + record(1) + "\n\x1e" + wide + "\n")
    found = read_city_records(spark, str(path), "\x1e").collect()
    assert [(r["city_id"], r["name"]) for r in found] == [(1, "c\n1"), (5, "c\n5")]


@pytest.mark.parametrize("broken", ['{"type": "Feature"', '{"type": "Point"}', "[1]"])
def test_broken_records_are_errors(spark, tmp_path, broken):
    path = tmp_path / "cities.ndjson"
    path.write_text(record(1) + "\n" + broken + "\n")
    with pytest.raises(Exception):
        read_city_records(spark, str(path)).collect()


def test_weighted_sample(spark):
    cities = spark.range(1, 2001).select("id", (F.col("id") * 100).alias("population"))
    weight = city_weight(F.col("population"))
    draws = [weighted_sample(cities, weight, 200, seed, "id") for seed in (1, 1, 2)]
    ids = [sorted(r["id"] for r in d.collect()) for d in draws]
    assert ids[0] == ids[1] != ids[2]
    assert len(set(ids[0])) == 200
    # Large cities are drawn more often: the mean id lies well above the middle.
    assert sum(ids[0]) / 200 > 1200
    assert cities.filter("id = 1").select(evacuating(F.lit(103))).first()[0] == 25
    nobody = spark.createDataFrame([(1, 0)], "id bigint, population bigint")
    assert weighted_sample(nobody, city_weight(F.col("population")), 5, 1, "id").count() == 0
