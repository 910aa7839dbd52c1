"""The search against brute force over all pairs."""

import functools
import random

import pytest

from floodplan.functions import grid
from floodplan.operators import nearest as N

ROUGH_SIDE = 200


def cell(q, r, res=grid.FINE_RES):
    return (res * grid.AXIS_SPAN + q + grid.AXIS_ZERO) * grid.AXIS_SPAN + r + grid.AXIS_ZERO


def axial(c):
    return (c >> grid.AXIS_BITS) % grid.AXIS_SPAN, c % grid.AXIS_SPAN


def steps(a, b):
    (aq, ar), (bq, br) = axial(a), axial(b)
    return max(abs(aq - bq), abs(ar - br), abs(aq + ar - bq - br))


def spot(rng, spread):
    q, r = rng.randint(-spread, spread), rng.randint(-spread, spread)
    return cell(q, r), cell(q // ROUGH_SIDE, r // ROUGH_SIDE, grid.ROUGH_RES)


def brute(flood, targets, search):
    """Per flooded row (distance, target id) or None."""
    found = {}
    for row in flood:
        pairs = [
            (steps(row["cell"], t["cell"]), t["id"], steps(row["rough"], t["rough"]))
            for t in targets
            if t["rise"] == row["rise"]
        ]
        if search.strategy == "ring":
            for k in search.rings:
                inside = [p for p in pairs if p[2] <= k]
                if inside:
                    break
            pairs = inside or (pairs if search.fallback else [])
        best = min(((d, i) for d, i, _ in pairs), default=None)
        if best and search.max_distance is not None and best[0] > search.max_distance:
            best = None
        found[row["rise"], row["flood_id"]] = best
    return found


def world(seed, flooded, targets, spread, hot=False, rises=(0,)):
    rng = random.Random(seed)
    crowd = spot(rng, spread)
    flood = []
    for i in range(flooded):
        c, rough = crowd if hot and i % 3 == 0 else spot(rng, spread)
        flood.append(
            {
                "rise": rng.choice(rises),
                "place": f"p{i % (flooded // 2)}",
                "flood_id": i,
                "num_evacuees": 10 * i,
                "cell": c,
                "rough": rough,
            }
        )
    refuge = []
    for i in range(targets):
        c, rough = crowd if hot and i % 3 == 0 else spot(rng, spread)
        refuge.append({"rise": rng.choice(rises), "id": 1000 + i, "cell": c, "rough": rough})
    rng.shuffle(refuge)
    return flood, refuge


FLOOD = (
    "rise int, place string, flood_id bigint, num_evacuees int, cell bigint, rough bigint"
)
TARGET = "rise int, id bigint, cell bigint, rough bigint"


def search_all(spark, flood, refuge, search):
    targets = spark.createDataFrame([tuple(t.values()) for t in refuge], TARGET).selectExpr(
        "*", "concat('t', id) AS name", "CAST(id AS DOUBLE) AS size"
    )
    rows = spark.createDataFrame([tuple(f.values()) for f in flood], FLOOD)
    target = N.Target(targets, "id", "name", "size", search)
    found = N.nearest_targets(rows, {"city": target}, ("rise",)).collect()
    assert len(found) == len(flood)
    assert all(
        r["city"] is None or r["city"]["target"]["name"] == f"t{r['city']['target']['id']}"
        for r in found
    )
    return {
        (r["rise"], r["flood_id"]): r["city"] and (r["city"]["distance"], r["city"]["target"]["id"])
        for r in found
    }


CASES = {
    "dense": (dict(flooded=300, targets=300, spread=12), N.Search()),
    "sparse": (dict(flooded=200, targets=40, spread=4000), N.Search()),
    "one target": (dict(flooded=50, targets=1, spread=2000), N.Search()),
    "hot": (dict(flooded=300, targets=300, spread=60, hot=True), N.Search()),
    "rises": (dict(flooded=200, targets=60, spread=500, rises=(1, 2, 3)), N.Search()),
    "far is none": (
        dict(flooded=200, targets=20, spread=500),
        N.Search(max_distance=150),
    ),
    "ring": (dict(flooded=200, targets=20, spread=1500), N.Search("ring")),
    "ring only": (
        dict(flooded=200, targets=20, spread=1500),
        N.Search("ring", fallback=False),
    ),
    "rings": (
        dict(flooded=200, targets=12, spread=2500, rises=(1, 2)),
        N.Search("ring", rings=(0, 1, 3), fallback=True),
    ),
}


@pytest.mark.parametrize("case", list(CASES))
def test_brute_force(spark, case):
    given, search = CASES[case]
    flood, refuge = world(case, **given)
    assert search_all(spark, flood, refuge, search) == brute(flood, refuge, search)


def test_heavy_cell_is_spread(spark, monkeypatch):
    flood, refuge = world(1, flooded=300, targets=30, spread=60, hot=True)
    eager = functools.partial(N.spread_join, shares=10)
    monkeypatch.setattr(N, "spread_join", eager)
    assert search_all(spark, flood, refuge, N.Search()) == brute(flood, refuge, N.Search())


def test_wide_ring_equals_exhaustive(spark):
    flood, refuge = world(2, flooded=100, targets=20, spread=600)
    wide = N.Search("ring", rings=(20,), fallback=False)
    assert search_all(spark, flood, refuge, wide) == brute(flood, refuge, N.Search())


def test_same_names_collapse_to_the_nearest_row(spark):
    flood, refuge = world(3, flooded=60, targets=10, spread=100)
    rows = spark.createDataFrame([tuple(f.values()) for f in flood], FLOOD).drop("rise")
    targets = spark.createDataFrame([tuple(t.values()) for t in refuge], TARGET).selectExpr(
        "id AS destination_id", "'d' AS destination", "1.0D AS safe_population", "cell", "rough"
    )
    best = brute(flood, refuge, N.Search())
    by_name, by_id = {}, {}
    for f in flood:
        distance, target = best[0, f["flood_id"]]
        key = (distance, f["flood_id"], target)
        by_id[f["flood_id"]] = key
        by_name[f["place"]] = min(by_name.get(f["place"], key), key)
    for place_key, column, expected in (("name", "place", by_name), ("id", "flood_id", by_id)):
        found = N.nearest_city(rows, targets, place_key=place_key).collect()
        assert expected == {
            r[column]: (r["city_distance"], r["flood_id"], r["destination_id"]) for r in found
        }
        assert all(r["num_evacuees"] == 10 * r["flood_id"] for r in found)


def test_no_targets(spark):
    flood, _ = world(4, flooded=10, targets=1, spread=10)
    assert set(search_all_empty(spark, flood).values()) == {None}


def search_all_empty(spark, flood):
    targets = spark.createDataFrame([], TARGET).selectExpr("*", "'t' AS name", "1.0D AS size")
    rows = spark.createDataFrame([tuple(f.values()) for f in flood], FLOOD)
    target = N.Target(targets, "id", "name", "size", N.Search("ring"))
    return {
        r["flood_id"]: r["city"]
        for r in N.nearest_targets(rows, {"city": target}, ("rise",)).collect()
    }


def test_bad_arguments():
    for bad in (dict(strategy="x"), dict(rings=()), dict(rings=(2, 1)), dict(rings=(-1,))):
        with pytest.raises(ValueError):
            N.Search(**bad)


def test_levels_end_at_one_cell():
    for res in (1, 5, 7, 9):
        shifts = N.level_shifts(res)
        assert shifts[-1] == 0 and grid.axis_extent(res) >> shifts[0] <= N.FIRST_BLOCKS
