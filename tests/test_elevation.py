import pytest
from pyspark.sql import functions as F

from floodplan.operators import elevation as E
from floodplan.sources import fixtures

SF_DIR = "/root/testdata/sf0.001"
PLACES = "id bigint, name string, population string, place string, cell bigint, rough bigint, elevation int"


def test_groupby_equals_window(spark):
    samples = fixtures.elevation(spark, SF_DIR)
    frames = [E.min_elevation(samples, method=m) for m in ("groupby", "window")]
    assert frames[0].exceptAll(frames[1]).count() == 0 == frames[1].exceptAll(frames[0]).count()
    with pytest.raises(ValueError):
        E.min_elevation(samples, method="x")


def test_missing_samples_do_not_count(spark):
    samples = spark.createDataFrame(
        [(1.0, 1.0, None), (1.0, 1.0, 7), (1.0, 1.0, 9)], "lat double, lon double, elevation int"
    )
    for method in ("groupby", "window"):
        assert [r["elevation"] for r in E.min_elevation(samples, method=method).collect()] == [7]


def test_places_without_samples_go(spark):
    places = spark.createDataFrame([(1, 10), (2, 20)], "id bigint, cell bigint")
    lowest = spark.createDataFrame([(10, 3)], "cell bigint, elevation int")
    for method in ("spread", "bucketed"):
        found = E.with_elevation(places, lowest, method).select("id", "elevation").collect()
        assert [tuple(r) for r in found] == [(1, 3)]


def test_flooded_and_safe(spark):
    elevated = spark.createDataFrame(
        [
            (1, "a", "12.7", "city", 1, 1, 20),
            (2, "b", "1,2", "town", 1, 1, -3),
            (3, None, "5", "city", 1, 1, 0),
            (4, "d", "77", "city", 1, 1, 21),
            (5, "e", "x", "city", 1, 1, 90),
            (6, None, "5", "city", 1, 1, 90),
            (7, "g", "5", "town", 1, 1, 90),
        ],
        PLACES,
    )
    flooded = E.flooded(elevated, 20).collect()
    assert sorted((r["flood_id"], r["num_evacuees"]) for r in flooded) == [(1, 12), (2, None)]
    safe = E.safe_cities(elevated, 20).collect()
    assert sorted((r["destination_id"], r["safe_population"]) for r in safe) == [
        (4, 77.0),
        (5, None),
    ]
    several = E.at_rises(elevated, [0, 20, 100])
    counts = E.flooded(several, "rise").groupBy("rise").agg(F.count("*")).collect()
    assert {tuple(r) for r in counts} == {(0, 1), (20, 2), (100, 5)}
