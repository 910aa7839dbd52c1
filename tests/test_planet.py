"""The search over the whole earth against great circles between all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from floodplan.functions import grid
from floodplan.operators import nearest as N
from floodplan.operators.planet import SHEETS, nearest_on_earth

FLOOD = "flood_id long, place string, num_evacuees int, lat double, lon double, rise int"
TARGET = "destination_id long, destination string, safe_population double, lat double, lon double, rise int"


def celled(spark, rows, schema):
    table = spark.createDataFrame(rows, schema)
    at = grid.cell(F.col("lat"), F.col("lon"), sheets=SHEETS)
    lat, lon = grid.centre(at, sheets=SHEETS)
    return table.withColumn("cell", at).withColumn("at", F.array(lat, lon))


def metres(a, b):
    (p, s), (q, t) = ((math.radians(x), math.radians(y)) for x, y in (a, b))
    h = math.sin((p - q) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin((s - t) / 2) ** 2
    return 2000 * grid.EARTH_RADIUS_KM * math.asin(min(1, math.sqrt(h)))


def spots(rng, n):
    """All over the earth, close to the poles, along the edge of the sheet, and in one town."""
    for k in range(n):
        kind = k % 4
        if kind == 0:
            yield math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)
        elif kind == 1:
            yield rng.choice([-1, 1]) * rng.uniform(88, 90), rng.uniform(-180, 180)
        elif kind == 2:
            yield rng.uniform(-60, 60), rng.choice([-180, 180]) + rng.uniform(-0.6, 0.6)
        else:
            yield 10 + rng.uniform(0, 0.3), 20 + rng.uniform(0, 0.3)


@pytest.mark.parametrize("seed, flooded, targets", [(1, 300, 200), (2, 200, 3), (3, 40, 600)])
def test_nearest(spark, seed, flooded, targets):
    rng = random.Random(seed)
    flood = [(k, f"p{k}", k, *p, k % 2) for k, p in enumerate(spots(rng, flooded))]
    flood += [(9000 + k, f"hot{k}", 1, *flood[3][3:5], 0) for k in range(100)]
    flood += [(9200, "nowhere", 1, None, 2.0, 0)]
    target = [(k, f"t{k}", 1.0, *p, rng.randrange(2)) for k, p in enumerate(spots(rng, targets))]
    a, b = celled(spark, flood, FLOOD), celled(spark, target, TARGET)
    city = N.Target(b, "destination_id", "destination", "safe_population", N.Search(max_distance=9_000_000))
    found = nearest_on_earth(a, {"city": city}, ("rise",)).collect()
    assert len(found) == len(flood)
    goals = [(r.at, r.destination_id, r.rise) for r in b.collect()]
    for row in found:
        pairs = [(metres(row.at, at), i) for at, i, rise in goals if rise == row.rise] if row.cell else []
        best = min(pairs, default=(1e9, None))
        if best[0] > 9_000_000.4:
            assert row.city is None
            continue
        chosen = dict((i, d) for d, i in pairs)[row.city.target.id]
        assert abs(row.city.distance - best[0]) < 1 and abs(chosen - best[0]) < 1


def test_equal_distances_go_to_the_smaller_id(spark):
    flood = celled(spark, [(1, "p", 1, 0.0, 0.0, 0)], FLOOD)
    twins = [(k, "t", 1.0, 0.0, 30.0, 0) for k in (9, 7, 8)]
    city = N.Target(celled(spark, twins, TARGET), "destination_id", "destination", None, N.Search())
    assert nearest_on_earth(flood, {"city": city}).first().city.target.id == 7


def test_across_the_date_line(spark):
    flood = celled(spark, [(1, "Taveuni", 1, -17.0, 179.9, 0)], FLOOD)
    cities = [(1, "near", 1.0, -17.0, -179.9, 0), (2, "far", 1.0, -17.0, 170.0, 0)]
    found = N.nearest_city(flood, celled(spark, cities, TARGET), find=nearest_on_earth).first()
    assert found.destination == "near" and 19_000 < found.city_distance < 24_000


def test_no_targets_and_rings(spark):
    flood = celled(spark, [(1, "p", 1, 0.0, 0.0, 0)], FLOOD)
    none = celled(spark, [], TARGET)
    city = N.Target(none, "destination_id", "destination", None, N.Search())
    assert nearest_on_earth(flood, {"city": city}).first().city is None
    with pytest.raises(ValueError):
        nearest_on_earth(flood, {"city": N.Target(none, "destination_id", "destination", None, N.Search("ring"))})


def test_centres_lie_in_their_cells(spark):
    rng = random.Random(5)
    rows = [(k, *p) for k, p in enumerate(spots(rng, 2000))]
    table = spark.createDataFrame(rows, "id long, lat double, lon double")
    at = grid.cell(F.col("lat"), F.col("lon"), sheets=SHEETS)
    lat, lon = grid.centre(F.col("cell"), sheets=SHEETS)
    vectors = [F.array(*grid.unit_vector(*p)) for p in ((F.col("lat"), F.col("lon")), (lat, lon))]
    apart = F.aggregate(F.zip_with(*vectors, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, b: a + b)
    worst = table.withColumn("cell", at).agg(F.max(F.sqrt(apart)) * grid.EARTH_RADIUS_KM).first()[0]
    assert worst < 2.0
    again = grid.cell(lat, lon, sheets=SHEETS)
    inside = table.filter("abs(lat) < 87").withColumn("cell", at).withColumn("again", again)
    assert inside.filter("cell = again").count() > 0.95 * inside.count()


def test_one_sheet_is_unchanged(spark):
    table = spark.createDataFrame([(12.5, 33.25)], "lat double, lon double")
    one, same = (grid.cell(F.col("lat"), F.col("lon"), **how) for how in ({}, {"sheets": 1}))
    assert table.select((one == same).alias("x")).first().x
    lat, lon = grid.centre(one)
    row = table.select(lat.alias("lat"), lon.alias("lon")).first()
    assert abs(row.lat - 12.5) < 0.02 and abs(row.lon - 33.25) < 0.02


def test_payloads_move_only_with_survivors(spark):
    """No product, and every step of the search is an equi-join."""
    rng = random.Random(6)
    flood = celled(spark, [(k, f"p{k}", 1, *p, 0) for k, p in enumerate(spots(rng, 50))], FLOOD)
    cities = celled(spark, [(k, "t", 1.0, *p, 0) for k, p in enumerate(spots(rng, 50))], TARGET)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from floodplan.operators import planet

        plans = []
        keep = planet.settle
        planet.settle = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df)
        N.nearest_city(flood, cities, find=nearest_on_earth)
    finally:
        planet.settle = keep
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(plans) == 5 and not any("CartesianProduct" in p or "NestedLoop" in p for p in plans)
