"""The nearest refuge anywhere on the earth, exactly, by great circles.

The flat sheet of the grid ends half the earth away from its meridian, and steps on it are no
measure across that edge. Here cells are taken on several sheets, each with its own meridian,
and compared by the great-circle distance of their centres, which knows no edge.

As in ``nearest``, what is compared are distinct cells, never rows. A centre is a point on the
unit sphere. Points are seen through ever smaller cubes; two cubes are at least as far apart
as the boxes around their points, and no farther than the flooded box's farthest corner from
one target known to exist. Chords order as great circles do, so a pair of cubes is dropped
once its chord is above the best bound, and what is left at the last level is exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floodplan.functions import grid
from floodplan.operators.nearest import Target
from floodplan.operators.skew import spread_join
from floodplan.session import settle

#: Sheets of the whole earth, 15 degrees each: no cell is sheared by more than an eighth of that.
SHEETS = 24
#: The sides of the cubes, as halvings of the earth's diameter; the last is about 3 km.
LEVELS = (3, 6, 9, 12)
#: Chords within this are looked at further: more than a metre, and far more than rounding.
SLACK = 4e-7
AXES = ("x", "y", "z")
BOUNDS = [f"{axis}_{end}" for axis in AXES for end in ("min", "max")]


def great_circle_m(chord: Column) -> Column:
    """Whole metres on the earth's surface for a chord of the unit sphere."""
    half = F.least(F.lit(1.0), chord / 2)
    return F.round(F.lit(2000.0 * grid.EARTH_RADIUS_KM) * F.asin(half)).cast("bigint")


def _length(parts: list[Column]) -> Column:
    return F.sqrt(reduce(lambda a, b: a + b, [p * p for p in parts]))


def _gap(a: str, b: str) -> Column:
    """No points of the two boxes are nearer than this."""
    apart = [
        F.greatest(
            F.lit(0.0),
            F.col(f"{a}.{axis}_min") - F.col(f"{b}.{axis}_max"),
            F.col(f"{b}.{axis}_min") - F.col(f"{a}.{axis}_max"),
        )
        for axis in AXES
    ]
    return _length(apart)


def _reach(box: str, point: str) -> Column:
    """No point of the box is farther from the point than this."""
    far = [
        F.greatest(
            F.col(f"{point}.{axis}") - F.col(f"{box}.{axis}_min"),
            F.col(f"{box}.{axis}_max") - F.col(f"{point}.{axis}"),
        )
        for axis in AXES
    ]
    return _length(far)


def _cube(bits: int) -> Column:
    """The cube of a point, of so many halvings; all points lie in that of none."""
    scale = 2.0 ** (bits - 1) if bits else 0.25
    x, y, z = (F.floor((F.col(axis) + 1.0) * scale).cast("bigint") for axis in AXES)
    return F.shiftleft(x, 26) + F.shiftleft(y, 13) + z


def _boxes(cells: DataFrame, by: list[str], bits: int, parent: int) -> DataFrame:
    """The cubes that hold cells: bounds of their points, and one of these."""
    bounds = [end(axis).alias(f"{axis}_{name}") for axis in AXES for name, end in (("min", F.min), ("max", F.max))]
    placed = cells.select(*by, *AXES, _cube(parent).alias("parent"), _cube(bits).alias("block"))
    return placed.groupBy(*by, "parent", "block").agg(*bounds, F.min(F.struct(*AXES)).alias("point"))


def _points(cells: DataFrame, by: list[str], parent: int, more: list[str]) -> DataFrame:
    """Single cells in the place of boxes."""
    point = F.struct(*AXES).alias("point")
    bounds = [F.col(axis).alias(f"{axis}_{end}") for axis in AXES for end in ("min", "max")]
    return cells.select(*by, _cube(parent).alias("parent"), F.col("cell").alias("block"), *bounds, point, *more)


def _same(a: str, b: str, keys: list[str]) -> list[Column]:
    return [F.col(f"{a}.{k}") == F.col(f"{b}.{k}") for k in keys]


def _pairs(state: DataFrame, flood: DataFrame, target: DataFrame, scope: list[str], more: list[str]) -> DataFrame:
    """The children of the pairs that are left; the parents' bound prunes before each shuffle."""
    near = (
        state.alias("s")
        .join(target.alias("t"), [*_same("s", "t", [*scope, "kind"]), F.col("s.target_parent") == F.col("t.parent")])
        .filter(_gap("s", "t") <= F.col("s.bound") + SLACK)
        .select(
            *[f"s.{c}" for c in (*scope, "kind", "flood_parent", "bound")],
            *[f"t.{c}" for c in (*BOUNDS, "point", *more)],
            F.col("t.block").alias("target_block"),
        )
    )
    return (
        near.alias("n")
        .join(flood.alias("f"), [*_same("n", "f", scope), F.col("n.flood_parent") == F.col("f.parent")])
        .filter(_gap("f", "n") <= F.col("n.bound") + SLACK)
        .select(
            *[f"n.{c}" for c in (*scope, "kind", "target_block", *more)],
            *[f"f.{c}" for c in BOUNDS],
            F.col("f.block").alias("flood_block"),
            _gap("f", "n").alias("lower"),
            _reach("f", "n.point").alias("farthest"),
        )
    )


def _descent(flood: DataFrame, target: DataFrame, seeds: DataFrame, scope: list[str]) -> DataFrame:
    """(scope, kind, cell, lower, target): candidates of every flooded cell, the nearest among them."""
    whole = [F.lit(0.0).alias(f"{axis}_min") for axis in AXES] + [F.lit(0.0).alias(f"{axis}_max") for axis in AXES]
    # The first bound is above any chord, so these boxes exclude nothing.
    state, parent = seeds.select("*", *whole, F.lit(9.0).alias("bound")), 0
    for bits in LEVELS:
        pairs = _pairs(
            state, _boxes(flood, scope, bits, parent), _boxes(target, [*scope, "kind"], bits, parent), scope, []
        )
        best = F.min("farthest").over(Window.partitionBy(*scope, "kind", "flood_block"))
        state = (
            pairs.withColumn("bound", best)
            .filter(F.col("lower") <= F.col("bound") + SLACK)
            .withColumnsRenamed({"flood_block": "flood_parent", "target_block": "target_parent"})
        )
        parent = bits
    last = _pairs(
        state, _points(flood, scope, parent, []), _points(target, [*scope, "kind"], parent, ["target"]), scope, ["target"]
    )
    return last.withColumnRenamed("flood_block", "cell")


def nearest_on_earth(
    flooded: DataFrame,
    targets: dict[str, Target],
    scope: tuple[str, ...] = (),
    res: int = grid.FINE_RES,
    sheets: int = SHEETS,
    lon0: float = 0.0,
) -> DataFrame:
    """As ``nearest.nearest_targets``, with great-circle metres between the centres of cells.

    Cells of both sides must come from as many sheets. Equal whole metres go to the smallest
    target id. A search has no rings here; its ``max_distance`` is in metres.
    """
    scope = list(scope)
    for kind, target in targets.items():
        if target.search.strategy != "exhaustive":
            raise ValueError(f"the search for a {kind} on the whole earth must be exhaustive")

    def placed(cells: DataFrame) -> DataFrame:
        return cells.withColumns(dict(zip(AXES, grid.unit_vector(*grid.centre(F.col("cell"), res, lon0, sheets)))))

    frames = [
        t.rows.filter("cell IS NOT NULL").selectExpr(
            *scope,
            f"'{kind}' AS kind",
            "cell",
            f"struct({t.id} AS id, {t.name} AS name, CAST({t.population or 'NULL'} AS DOUBLE) AS population) AS target",
        )
        for kind, t in targets.items()
    ]
    every = reduce(DataFrame.unionByName, frames)
    target_cells = settle(placed(every.groupBy(*scope, "kind", "cell").agg(F.min("target").alias("target"))))
    sizes = settle(flooded.groupBy(*scope, "cell").agg(F.count("*").alias("n")))
    flood_cells = settle(placed(sizes.filter("cell IS NOT NULL").drop("n")))
    root = [_cube(0).alias("flood_parent"), _cube(0).alias("target_parent")]
    seeds = settle(target_cells.select(*scope, "kind", *root).distinct())
    found = _descent(flood_cells, target_cells, seeds, scope).withColumn("distance", great_circle_m(F.col("lower")))
    best = []
    for kind, target in targets.items():
        reached = F.col("kind") == kind
        if target.search.max_distance is not None:
            reached &= F.col("distance") <= target.search.max_distance
        best.append(F.min(F.when(reached, F.struct("distance", "target"))).alias(kind))
    per_cell = settle(found.groupBy(*scope, "cell").agg(*best))
    return spread_join(flooded, per_cell, [*scope, "cell"], "flood_id", sizes, "left")
