"""All rises in one search against a search for each."""

import random

import pytest
from pyspark.sql import functions as F

from floodplan.functions import grid
from floodplan.operators import nearest as N
from floodplan.operators.elevation import at_rises, flooded, safe_cities
from floodplan.plans import curve as C
from floodplan.plans.evacuation import relocation_plan, total_evacuees

TOP = 12
PLACES = "id long, name string, population string, place string, cell long, rough long, elevation int"
HARBOURS = "harbour_id long, harbour string, cell long, rough long"


def cell(q, r):
    return (grid.FINE_RES * grid.AXIS_SPAN + q + grid.AXIS_ZERO) * grid.AXIS_SPAN + r + grid.AXIS_ZERO


def world(spark, seed, n, spread, top_elevation):
    rng = random.Random(seed)
    height, rows = {}, []
    for k in range(n):
        at = cell(rng.randint(-spread, spread), rng.randint(-spread, spread)) if k % 5 else cell(3, 3)
        elevation = height.setdefault(at, rng.randint(-4, top_elevation))
        name = rng.choice([f"p{k}", f"p{k}", f"same{k % 7}", None])
        rows.append((k, name, rng.choice(["10", "7", "x"]), rng.choice(["city", "town"]), at, 0, elevation))
    harbours = [(900 + k, "h", cell(rng.randint(-spread, spread), 0), 0) for k in range(4)]
    return spark.createDataFrame(rows, PLACES), spark.createDataFrame(harbours, HARBOURS)


def one_by_one(places, harbours, place_key):
    each = at_rises(places, list(range(TOP + 1)))
    ports = at_rises(harbours, list(range(TOP + 1)))
    options = N.refuge_options(
        flooded(each, "rise"), safe_cities(each, "rise"), ports, place_key=place_key, scope=("rise",)
    )
    return relocation_plan(options, scope=("rise",))


@pytest.mark.parametrize("seed, n, spread, high", [(1, 120, 40, 15), (2, 200, 400, 9), (3, 60, 5, 30)])
@pytest.mark.parametrize("key", ["name", "id"])
def test_plans(spark, seed, n, spread, high, key):
    places, harbours = world(spark, seed, n, spread, high)
    plans = C.plans_by_rise(places, harbours, TOP, key)
    found = plans.withColumn("rise", F.explode(F.sequence("low", "high"))).drop("low", "high")
    want = one_by_one(places, harbours, key)
    columns = want.columns
    assert sorted(map(str, found.select(columns).collect())) == sorted(map(str, want.collect()))
    totals = {r.rise: r.total_evacuees for r in total_evacuees(want, ("rise",)).collect()}
    curve = C.evacuation_curve(plans, TOP).collect()
    assert {r.rise: r.total_evacuees for r in curve} == {r: totals.get(r) or 0.0 for r in range(TOP + 1)}


def test_one_row_for_every_place(spark):
    """Rises are never multiplied with places: steps come as arrays, and plans as ranges."""
    places, harbours = world(spark, 4, 150, 60, 20)
    low = C.flooded_by_rise(places, TOP)
    city = N.Target(
        C.cities_by_height(places, TOP), "destination_id", "destination", None, N.Search(), "height"
    )
    found = N.nearest_by_rise(low, {"city": city})
    assert found.count() == low.count()
    plans = C.plans_by_rise(places, harbours, TOP, "id")
    spread = plans.select(F.sum(F.col("high") - F.col("low") + 1)).first()[0]
    assert plans.count() < spread / 2


def test_nobody_floods_and_no_city(spark):
    places, harbours = world(spark, 5, 20, 10, 5)
    high = places.withColumn("elevation", F.lit(50))
    assert C.plans_by_rise(high, harbours, TOP).count() == 0
    curve = C.evacuation_curve(C.plans_by_rise(high, harbours, TOP), TOP).collect()
    assert [(r.rise, r.total_evacuees) for r in sorted(curve)] == [(r, 0.0) for r in range(TOP + 1)]
    assert C.plans_by_rise(places.filter("place <> 'city'"), harbours, TOP).count() == 0
    with pytest.raises(ValueError):
        C.plans_by_rise(places, harbours, -1)
