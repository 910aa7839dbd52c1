import math

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from floodplan.functions import grid

# The central meridian is itself an edge between cells in every other row.
LONGITUDES = st.floats(-179, 179).filter(lambda lon: abs(lon) > 1e-6)
POSITIONS = st.lists(st.tuples(st.floats(-89, 89), LONGITUDES), min_size=3, max_size=3)
RELAXED = settings(
    max_examples=10,
    deadline=None,
    derandomize=True,
    phases=[Phase.explicit, Phase.generate],
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


def cells(spark, positions, res=grid.FINE_RES):
    frame = spark.createDataFrame(positions, "lat double, lon double")
    return [r[0] for r in frame.select(grid.cell(F.col("lat"), F.col("lon"), res)).collect()]


def rounded_cell(lat, lon, res):
    """The same cell by rounding three axes and correcting the worst."""
    edge = grid.edge_km(res)
    x = grid.EARTH_RADIUS_KM * math.radians(lon) * math.cos(math.radians(lat))
    y = grid.EARTH_RADIUS_KM * math.radians(lat)
    q, r = (x * math.sqrt(3) / 3 - y / 3) / edge, 2 * y / 3 / edge
    s = -q - r
    near = [math.floor(v + 0.5) for v in (q, r, s)]
    errors = [abs(n - v) for n, v in zip(near, (q, r, s))]
    if errors[0] > errors[1] and errors[0] > errors[2]:
        near[0] = -near[1] - near[2]
    elif errors[1] > errors[2]:
        near[1] = -near[0] - near[2]
    zero, span = grid.AXIS_ZERO, grid.AXIS_SPAN
    return (res * span + near[0] + zero) * span + near[1] + zero


@RELAXED
@given(POSITIONS)
def test_cell_is_the_rounded_one(spark, positions):
    for res in (grid.FINE_RES, grid.ROUGH_RES):
        assert cells(spark, positions, res) == [rounded_cell(*p, res) for p in positions]


def test_edge_goes_to_one_of_its_two_cells(spark):
    ours = cells(spark, [(50.40625, 0.0)])[0]
    rounded = rounded_cell(50.40625, 0.0, grid.FINE_RES)
    frame = spark.createDataFrame([(ours, rounded)], "a bigint, b bigint")
    assert frame.select(grid.grid_distance(F.col("a"), F.col("b"))).first()[0] <= 1


def test_missing_position_has_no_cell(spark):
    assert cells(spark, [(None, 1.0), (1.0, None)]) == [None, None]


@RELAXED
@given(POSITIONS)
def test_distance_is_a_metric(spark, positions):
    a, b, c = cells(spark, positions)
    pairs = [(a, b), (b, a), (b, c), (a, c), (a, a)]
    frame = spark.createDataFrame(pairs, "x bigint, y bigint")
    ab, ba, bc, ac, aa = [
        r[0] for r in frame.select(grid.grid_distance(F.col("x"), F.col("y"))).collect()
    ]
    assert ab == ba and aa == 0 and ac <= ab + bc
    assert (ab == 0) == (a == b)


def test_undefined_distance(spark):
    fine, far = cells(spark, [(0.0, 0.0), (10.0, 10.0)])
    (rough,) = cells(spark, [(0.0, 0.0)], grid.ROUGH_RES)
    frame = spark.createDataFrame([(fine, rough), (fine, None), (fine, far)], "x bigint, y bigint")
    pair = (F.col("x"), F.col("y"))
    assert [r[0] for r in frame.select(grid.grid_distance(*pair)).collect()][:2] == [None, None]
    assert [r[0] for r in frame.select(grid.grid_distance(*pair, max_distance=5)).collect()][
        2
    ] is None


def test_ring_size_and_distance(spark):
    (home,) = cells(spark, [(52.0, 4.0)])
    for k in (0, 1, 2, 5):
        frame = spark.createDataFrame([(home,)], "cell bigint").select(
            "cell", F.explode(grid.k_ring(F.col("cell"), k)).alias("near")
        )
        found = frame.select("near", grid.grid_distance(F.col("cell"), F.col("near"))).collect()
        assert len({r[0] for r in found}) == 3 * k * (k + 1) + 1
        assert max(r[1] for r in found) == k
