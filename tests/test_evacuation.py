import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from floodplan.operators.elevation import flooded
from floodplan.plans import evacuation as V
from floodplan.plans import pipeline as L
from floodplan.session import settle

SF_DIR = "/root/testdata/sf0.001"
OPTIONS = (
    "place string, flood_id bigint, num_evacuees int, destination string, "
    "destination_id bigint, safe_population double, city_distance int, harbour_distance int"
)


@pytest.fixture(scope="module")
def terrain(spark):
    return entry._terrain(spark, SF_DIR)


def test_shares(spark):
    options = spark.createDataFrame(
        [
            ("near harbour", 1, 1542, "M", 9, 100.0, 5, 5),
            ("near city", 2, 10, "M", 9, 100.0, 4, 5),
            ("no harbour", 3, 8, "N", 8, None, 4, None),
            ("unknown number", 4, None, "N", 8, None, 9, 1),
        ],
        OPTIONS,
    )
    plan = V.relocation_plan(options).collect()
    assert {(r["place"], r["destination"], r["num_evacuees"]) for r in plan} == {
        ("near harbour", "M", 1156.5),
        ("near harbour", "Waterworld", 385.5),
        ("near city", "M", 10.0),
        ("no harbour", "N", 8.0),
        ("unknown number", "N", None),
        ("unknown number", "Waterworld", None),
    }
    change = V.destination_change(V.relocation_plan(options)).collect()
    assert {tuple(r) for r in change} == {
        ("M", 100.0, 1266.5),
        ("Waterworld", 0.0, 385.5),
        ("N", None, None),
    }
    near, far = V.split_by_refuge(options)
    assert (near.count(), far.count()) == (2, 2)
    near, far = V.split_by_refuge(options, "nearest")
    assert (near.count(), far.count()) == (3, 1)
    assert V.total_evacuees(V.relocation_plan(options)).first()[0] == 1560.0
    with pytest.raises(ValueError):
        V.relocation_plan(options, "x")


# Computed once with SQL: rows, total, out to sea.
GOLDEN = {
    ("exhaustive", "name"): (65, 27569.0, 4307.0),
    ("exhaustive", "id"): (67, 28012.0, 4417.75),
    ("ring", "name"): (52, 27569.0, 2324.75),
    ("ring", "id"): (54, 28012.0, 2435.5),
}


@pytest.mark.parametrize("case", list(GOLDEN))
def test_golden_plan(spark, terrain, case):
    strategy, place_key = case
    searches = L.EXHAUSTIVE if strategy == "exhaustive" else L.RING
    plan = settle(L.evacuation_plan(terrain, 20, searches, place_key))
    at_sea = plan.filter(F.col("destination") == V.SEA_DESTINATION)
    found = (
        plan.count(),
        V.total_evacuees(plan).first()[0],
        V.total_evacuees(at_sea).first()[0],
    )
    assert found == GOLDEN[case]
    key = "place" if place_key == "name" else "flood_id"
    flood = flooded(terrain.places, 20)
    assert V.unassigned(flood, plan, place_key).count() == 0
    assert plan.select(key).distinct().count() == flood.select(key).distinct().count()


def test_job_writes_both_outputs(spark, tmp_path):
    from floodplan.sources import fixtures

    nodes, samples = f"{tmp_path}/nodes", f"{tmp_path}/samples"
    fixtures.nodes(spark, SF_DIR).withColumns(
        {c: F.col(c).cast("decimal(10,7)") for c in ("lat", "lon")}
    ).write.orc(nodes)
    fixtures.elevation(spark, SF_DIR).write.parquet(f"{samples}/a")
    plan, change = f"{tmp_path}/plan", f"{tmp_path}/change"
    total = L.run(spark, nodes, f"{samples}/*", 20, plan, change, L.EXHAUSTIVE)
    assert total.first()["total_evacuees"] == 27569.0
    written = spark.read.orc(plan)
    assert written.columns == ["place", "num_evacuees", "destination"]
    assert written.count() == 65
    assert spark.read.orc(change).columns == ["destination", "old_population", "new_population"]
    with pytest.raises(ValueError):
        L.run(spark, nodes, samples, 96, plan, change, max_rise=95)
