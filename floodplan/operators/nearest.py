"""The nearest refuge of every flooded place, exactly and without a product of the two.

What is compared are cells, not rows: distance depends on nothing else. Flooded rows
shrink to their distinct cells and targets to the smallest id per cell, so a cell that
holds a third of all rows weighs as much as any other, and both sides are bounded by
the number of cells of the earth.

The cells of both sides are then seen through ever smaller square blocks. A pair of
(flooded block, target block) survives a level if the target block's lower bound is
not above the flooded block's best upper bound: the largest distance any of its cells
can have to one target cell known to exist. Whatever is nearest, ties included, always
survives, and per block only a thin band of candidates does. Survivors are replaced by
their children until blocks are single cells and bounds are distances. Every step is
an equi-join on a block, and only survivors are shuffled.

Which target groups a flooded group may look at is settled before the first level, on
groups alone: all of them for an exhaustive search, those in a ring of rough cells for
a ring search.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floodplan.functions import grid
from floodplan.operators.skew import spread_join
from floodplan.session import settle

# Halvings of a block's side from one level to the next.
LEVEL_BITS = 3
# Blocks per axis with which the first level may begin.
FIRST_BLOCKS = 64
# The group that holds every target, whatever its rough cell.
EVERYWHERE = 0

# Bounds of a block on the three axes; s is q + r, and the distance of two cells is the
# largest of their differences on the three.
BOX = ("q_min", "q_max", "r_min", "r_max", "s_min", "s_max")
# Above any distance.
UNBOUNDED = 1 << 40


@dataclass(frozen=True)
class Search:
    """How far to look for one kind of target.

    ``strategy``: "exhaustive" looks everywhere; "ring" looks in the rough cells at most
    ``rings[0]`` steps away, then ``rings[1]`` where that found none, and so on, and at
    last everywhere if ``fallback``. A nearest target more than ``max_distance`` steps
    away counts as none.
    """

    strategy: str = "exhaustive"
    rings: tuple[int, ...] = (1,)
    fallback: bool = True
    max_distance: int | None = None

    def __post_init__(self):
        if self.strategy not in ("exhaustive", "ring"):
            raise ValueError(f"strategy must be 'exhaustive' or 'ring', not {self.strategy!r}")
        if not self.rings or list(self.rings) != sorted(set(self.rings)) or self.rings[0] < 0:
            raise ValueError(f"rings must be rising and not negative, not {self.rings!r}")


@dataclass(frozen=True)
class Target:
    """A frame of refuges, and which of its columns hold id, name and population."""

    rows: DataFrame
    id: str
    name: str
    population: str | None
    search: Search
    #: Column with the first whole rise that floods the target, for a search over all rises.
    height: str | None = None


#: What finds targets: flooded rows, targets by kind and scope to rows with their nearest.
Finder = Callable[[DataFrame, dict[str, Target], tuple[str, ...]], DataFrame]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _target_cells(targets: dict[str, Target], scope: list[str]) -> DataFrame:
    """Per kind, group and cell the target with the smallest id."""
    frames = []
    for kind, target in targets.items():
        groups = []
        if target.search.strategy == "ring":
            groups.append("rough")
        if target.search.strategy == "exhaustive" or target.search.fallback:
            groups.append(f"{EVERYWHERE}L")
        frames.append(
            target.rows.selectExpr(
                *scope,
                f"'{kind}' AS kind",
                f"explode(array({', '.join(groups)})) AS target_group",
                "cell",
                f"struct({target.id} AS id, {target.name} AS name, "
                f"CAST({target.population or 'NULL'} AS DOUBLE) AS population) AS target",
                *([f"CAST({target.height} AS INT) AS height"] if target.height else []),
            )
        )
    height = ["height"] if all(t.height for t in targets.values()) else []
    return (
        _union(frames)
        .filter("cell IS NOT NULL")
        .groupBy(*scope, "kind", "target_group", "cell", *height)
        .agg(F.min("target").alias("target"))
    )


def _ring_seeds(
    flood_groups: DataFrame, target_groups: DataFrame, kind: str, search: Search, scope: list[str]
) -> DataFrame:
    """(flooded group, target group) for the first ring that holds a target."""
    reach = F.array(
        *[
            F.struct(F.lit(offset).cast("bigint").alias("offset"), F.lit(steps).alias("steps"))
            for offset, steps in grid.ring_offsets(search.rings[-1])
        ]
    )
    around = flood_groups.select(*scope, "flood_group", F.explode(reach).alias("near")).select(
        *scope,
        "flood_group",
        (F.col("flood_group") + F.col("near.offset")).alias("target_group"),
        "near.steps",
    )
    found = around.join(target_groups.filter(F.col("kind") == kind), [*scope, "target_group"])
    rings = F.array(*[F.lit(k) for k in search.rings])
    nearest = F.min("steps").over(Window.partitionBy(*scope, "flood_group"))
    first_ring = F.array_min(F.filter(rings, lambda k: k >= nearest))
    return (
        found.withColumn("first_ring", first_ring)
        .filter("steps <= first_ring")
        .select(*scope, "kind", "flood_group", "target_group")
    )


def _seeds(
    flood_cells: DataFrame, target_cells: DataFrame, targets: dict[str, Target], scope: list[str]
) -> DataFrame:
    """Which groups look at which. There are no more groups than rough cells."""
    flood_groups = flood_cells.select(*scope, "flood_group").distinct()
    target_groups = target_cells.select(*scope, "kind", "target_group").distinct()
    frames = []
    for kind, target in targets.items():
        whole = flood_groups.selectExpr(
            *scope, f"'{kind}' AS kind", "flood_group", f"{EVERYWHERE}L AS target_group"
        )
        if target.search.strategy == "exhaustive":
            frames.append(whole)
            continue
        ring = _ring_seeds(flood_groups, target_groups, kind, target.search, scope)
        frames.append(ring)
        if target.search.fallback:
            frames.append(whole.join(ring, [*scope, "kind", "flood_group"], "left_anti"))
    return _union(frames)


def _blocks(
    cells: str, by: list[str], shift: int, parent: int | None, carried: list[str], graded: bool = False
) -> str:
    """SQL for the non-empty blocks of a level: bounds, and one of the cells in each.

    Where targets are graded by height, that is one of the highest, and its height.
    """
    mask = grid.AXIS_SPAN - 1
    axes = {"q": "q", "r": "r", "s": "q + r"}

    def block(bits: int) -> str:
        return f"shiftleft(shiftright(q, {bits}), {grid.AXIS_BITS}) | shiftright(r, {bits})"

    placed = f"""
      SELECT *, shiftright(cell, {grid.AXIS_BITS}) & {mask} AS q, cell & {mask} AS r
      FROM {{{cells}}}"""
    of_parent = "0L" if parent is None else block(parent)
    if shift == 0:
        bounds = [f"{v} AS {a}_{end}" for a, v in axes.items() for end in ("min", "max")]
        return f"""
      SELECT {_list(by, f"{of_parent} AS parent", "cell AS block", bounds, "cell", carried)}
      FROM ({placed})"""
    bounds = [f"{end}({v}) AS {a}_{end}" for a, v in axes.items() for end in ("min", "max")]
    one = "max_by(cell, struct(height, cell)) AS cell, max(height) AS height" if graded else "min(cell) AS cell"
    return f"""
      SELECT {_list(by, "parent, block", bounds, one)}
      FROM (SELECT *, {of_parent} AS parent, {block(shift)} AS block FROM ({placed}))
      GROUP BY {_list(by, "parent, block")}"""


def _list(*parts: str | list[str]) -> str:
    """Column expressions, single ones and lists of them, as one SQL list."""
    return ", ".join(p for part in parts for p in ([part] if isinstance(part, str) else part))


def _of(alias: str, columns: list[str] | tuple[str, ...]) -> list[str]:
    return [f"{alias}.{c}" for c in columns]


def _same(a: str, b: str, columns: list[str]) -> str:
    return " AND ".join(f"{a}.{c} = {b}.{c}" for c in columns)


def _closest(a: str, b: str) -> str:
    """No two cells of the blocks are nearer than this."""
    gaps = [f"{x}.{axis}_min - {y}.{axis}_max" for axis in "qrs" for x, y in ((a, b), (b, a))]
    return f"greatest(0L, {', '.join(gaps)})"


def _farthest(block: str, cell: str) -> str:
    """No cell of the block is farther from the cell than this."""
    mask = grid.AXIS_SPAN - 1
    q, r = f"(shiftright({cell}, {grid.AXIS_BITS}) & {mask})", f"({cell} & {mask})"
    point = {"q": q, "r": r, "s": f"({q} + {r})"}
    below = [f"{v} - {block}.{a}_min" for a, v in point.items()]
    above = [f"{block}.{a}_max - {v}" for a, v in point.items()]
    return f"greatest({', '.join(below + above)})"


def level_shifts(res: int) -> list[int]:
    """The block sides of all levels as powers of two, largest first, down to one cell."""
    first = 0
    while grid.axis_extent(res) >> first > FIRST_BLOCKS:
        first += LEVEL_BITS
    return list(range(first, -1, -LEVEL_BITS))


def _pairs(
    scope: list[str], level: int, shift: int, parent: int | None, graded: bool = False
) -> str:
    """SQL for what a level begins with: the children of the pairs left by the level before.

    The parents' bound holds for their children, so it prunes before each shuffle.
    """
    flood_by, target_by = [*scope, "flood_group"], [*scope, "kind", "target_group"]
    groups = [*scope, "kind", "flood_group", "target_group"]
    height = ["height"] if graded else []
    found = [*height, "target"] if shift == 0 else height
    return f"""
    flood_{level} AS ({_blocks("flood_cells", flood_by, shift, parent, [])}),
    target_{level} AS ({_blocks("target_cells", target_by, shift, parent, found, graded)}),
    near_{level} AS (
      SELECT {_list(_of("s", [*groups, "flood_parent", "bound"]), "t.block AS target_block",
                    _of("t", [*BOX, "cell", *found]))}
      FROM state_{level} s JOIN target_{level} t
      ON {_same("s", "t", target_by)} AND s.target_parent = t.parent
      WHERE {_closest("s", "t")} <= s.bound),
    pairs_{level} AS (
      SELECT {_list(_of("n", [*groups, "flood_parent", "target_block", *found]),
                    "f.block AS flood_block", _of("f", BOX),
                    f"{_closest('f', 'n')} AS lower", f"{_farthest('f', 'n.cell')} AS farthest")}
      FROM near_{level} n JOIN flood_{level} f
      ON {_same("n", "f", flood_by)} AND n.flood_parent = f.parent
      WHERE {_closest("f", "n")} <= n.bound)"""


def _descent(targets: dict[str, Target], scope: list[str], res: int, graded: bool = False) -> str:
    """SQL for the nearest target of each kind, per (scope, flood_group, cell).

    Where targets are graded by height, a target serves only rises below its own. What can
    do without it are targets that are as high and nearer: a block's bound is the best of all
    blocks that reach as high. So one descent finds the nearest for every rise, as steps.
    """
    groups = [*scope, "kind", "flood_group", "target_group"]
    unbounded = [f"0L AS {c}" for c in ("flood_parent", "target_parent", *BOX)]
    unbounded.append(f"{UNBOUNDED}L AS bound")
    steps = [f"state_0 AS (SELECT {_list(groups, unbounded)} FROM {{seeds}})"]
    *coarse, last = enumerate(level_shifts(res))
    parent = None
    for level, shift in coarse:
        own = _list(scope, "kind", "flood_group", "flood_parent", "flood_block")
        # The children's own bound prunes the rest. All candidates of a flooded parent
        # lie together after the join, so the window needs no shuffle of its own.
        steps.append(_pairs(scope, level, shift, parent, graded))
        order = " ORDER BY height DESC" if graded else ""
        steps.append(f"""
    bounded_{level} AS (
      SELECT *, min(farthest) OVER (PARTITION BY {own}{order}) AS bound FROM pairs_{level}),
    state_{level + 1} AS (
      SELECT {_list(groups, "flood_block AS flood_parent", "target_block AS target_parent",
                    list(BOX), "bound")}
      FROM bounded_{level} WHERE lower <= bound)""")
        parent = shift
    level, shift = last
    steps.append(_pairs(scope, level, shift, parent, graded))
    if graded:
        return _rise_steps(scope, level, steps)
    bests = []
    for kind, target in targets.items():
        reached = f"kind = '{kind}'"
        if target.search.max_distance is not None:
            reached += f" AND lower <= {target.search.max_distance}"
        best = "struct(CAST(lower AS INT) AS distance, target)"
        bests.append(f"min(CASE WHEN {reached} THEN {best} END) AS {kind}")
    # All kinds of a cell lie together already: one row per cell, without a shuffle.
    cell = _list(scope, "flood_group")
    return f"""
    WITH {",".join(steps)}
    SELECT {_list(cell, "flood_block AS cell", bests)}
    FROM pairs_{level} GROUP BY {_list(cell, "flood_parent", "flood_block")}"""


def _rise_steps(scope: list[str], level: int, steps: list[str]) -> str:
    """SQL for each cell's steps per kind: from which to which rise which target is nearest."""
    cell = _list(scope, "flood_group", "flood_block")
    by = _list(scope, "kind", "flood_group", "flood_parent", "flood_block")
    # All rows of a cell lie together after the last join, so neither window is shuffled.
    steps.append(f"""
    nearest AS (
      SELECT *, min(struct(CAST(lower AS INT) AS distance, target)) OVER (
        PARTITION BY {by} ORDER BY height DESC) AS best
      FROM pairs_{level}),
    heights AS (SELECT {by}, height, min(best) AS best FROM nearest GROUP BY {by}, height),
    ranges AS (
      SELECT *, coalesce(lead(height) OVER (PARTITION BY {by} ORDER BY height DESC), 0) AS low
      FROM heights)""")
    step = "struct(low, height - 1 AS high, best.distance, best.target)"
    return f"""
    WITH {",".join(steps)}
    SELECT {cell.replace("flood_block", "flood_block AS cell")}, kind,
      collect_list({step}) AS steps
    FROM ranges GROUP BY {cell}, flood_parent, kind"""


def nearest_by_rise(
    flooded: DataFrame,
    targets: dict[str, Target],
    scope: tuple[str, ...] = (),
    res: int = grid.FINE_RES,
) -> DataFrame:
    """Flooded rows with, per kind, an array ``<kind>`` of steps: the nearest target by rise.

    A step has low, high (whole rises, both included), distance and target. Every target has
    a ``height``, and is a refuge for whole rises below it, from 0 on. Steps of a kind don't
    overlap, and above the highest reachable target there is none. Ties go to the smallest
    target id. All rises are searched at once, everywhere and without a limit of distance.
    """
    scope = list(scope)
    if not all(t.height and t.search == Search() for t in targets.values()):
        raise ValueError("a search over rises needs heights, and looks everywhere")
    rows = flooded.withColumn("flood_group", F.lit(EVERYWHERE).cast("bigint"))
    keys = [*scope, "flood_group", "cell"]
    flood_cells = settle(rows.groupBy(*keys).agg(F.count("*").alias("n")))
    target_cells = settle(_target_cells(targets, scope).filter("height > 0"))
    seeds = settle(_seeds(flood_cells, target_cells, targets, scope))
    found = settle(
        flooded.sparkSession.sql(
            _descent(targets, scope, res, graded=True),
            seeds=seeds,
            flood_cells=flood_cells,
            target_cells=target_cells,
        )
    )
    # At most as many steps a cell as there are heights, one row a cell.
    of = [F.flatten(F.collect_list(F.when(F.col("kind") == k, F.col("steps")))).alias(k) for k in targets]
    per_cell = found.groupBy(*keys).agg(*of)
    return spread_join(rows, per_cell, keys, "flood_id", flood_cells, "left").drop("flood_group")


def nearest_targets(
    flooded: DataFrame,
    targets: dict[str, Target],
    scope: tuple[str, ...] = (),
    res: int = grid.FINE_RES,
) -> DataFrame:
    """Flooded rows with, per kind, a struct ``<kind>`` of distance and target.

    The struct is NULL where no target can be reached. Ties in distance go to the
    smallest target id. Rows whose ``scope`` columns differ never meet.
    ``flooded`` is read twice and each target frame once; settle them if they are
    costly to compute. The search itself is run here and its result, one row per flooded
    cell, is settled: what follows is planned on its true size and never repeats it.
    """
    scope = list(scope)
    ring = any(t.search.strategy == "ring" for t in targets.values())
    group = F.col("rough") if ring else F.lit(EVERYWHERE).cast("bigint")
    rows = flooded.withColumn("flood_group", group)
    keys = [*scope, "flood_group", "cell"]
    flood_cells = settle(rows.groupBy(*keys).agg(F.count("*").alias("n")))
    target_cells = settle(_target_cells(targets, scope))
    # Kept as a table, its keys are columns like any other and never folded into a product.
    seeds = settle(_seeds(flood_cells, target_cells, targets, scope))
    per_cell = settle(
        flooded.sparkSession.sql(
            _descent(targets, scope, res),
            seeds=seeds,
            flood_cells=flood_cells,
            target_cells=target_cells,
        )
    )
    return spread_join(rows, per_cell, keys, "flood_id", flood_cells, "left").drop("flood_group")


def _by_place(scope: tuple[str, ...], place_key: str) -> list[str]:
    if place_key not in ("name", "id"):
        raise ValueError(f"place_key must be 'name' or 'id', not {place_key!r}")
    return [*scope, "place"] if place_key == "name" else [*scope, "flood_id"]


def _best(kind: str) -> Column:
    """The nearest of a place's rows, ties by flooded id, then by target id."""
    return F.min(
        F.when(
            F.col(kind).isNotNull(),
            F.struct(
                F.col(f"{kind}.distance").alias("distance"),
                "flood_id",
                F.col(f"{kind}.target").alias("target"),
                "num_evacuees",
                "place",
            ),
        )
    ).alias(kind)


def nearest_city(
    flooded: DataFrame,
    cities: DataFrame,
    search: Search = Search(),
    place_key: str = "name",
    scope: tuple[str, ...] = (),
    find: Finder = nearest_targets,
) -> DataFrame:
    """The nearest safe city of every flooded place that can reach one."""
    city = Target(cities, "destination_id", "destination", "safe_population", search)
    found = find(flooded, {"city": city}, scope)
    best = found.groupBy(*_by_place(scope, place_key)).agg(_best("city").alias("city"))
    return best.filter(F.col("city").isNotNull()).select(*scope, *_city_columns())


def nearest_harbour(
    flooded: DataFrame,
    harbours: DataFrame,
    search: Search = Search(),
    place_key: str = "name",
    scope: tuple[str, ...] = (),
    find: Finder = nearest_targets,
) -> DataFrame:
    """The nearest harbour of every flooded place that can reach one."""
    harbour = Target(harbours, "harbour_id", "harbour", None, search)
    found = find(flooded, {"harbour": harbour}, scope)
    best = found.groupBy(*_by_place(scope, place_key)).agg(_best("harbour").alias("harbour"))
    return best.filter(F.col("harbour").isNotNull()).select(
        *scope,
        F.col("harbour.place").alias("place"),
        F.col("harbour.flood_id").alias("flood_id"),
        F.col("harbour.distance").alias("harbour_distance"),
        F.col("harbour.target.id").alias("harbour_id"),
    )


def _city_columns() -> list[Column]:
    return [
        F.col("city.place").alias("place"),
        F.col("city.flood_id").alias("flood_id"),
        F.col("city.num_evacuees").alias("num_evacuees"),
        F.col("city.target.name").alias("destination"),
        F.col("city.target.id").alias("destination_id"),
        F.col("city.target.population").alias("safe_population"),
        F.col("city.distance").alias("city_distance"),
    ]


def refuge_options(
    flooded: DataFrame,
    cities: DataFrame,
    harbours: DataFrame,
    city_search: Search = Search(),
    harbour_search: Search = Search(),
    place_key: str = "name",
    scope: tuple[str, ...] = (),
    find: Finder = nearest_targets,
) -> DataFrame:
    """Nearest city and distance to the nearest harbour of every place, in one search.

    Both kinds descend together and meet in one row per cell, so neither is joined with
    the other afterwards. A place without a city is left out; one without a harbour has
    a NULL distance, which stands for infinity.
    """
    found = find(
        flooded,
        {
            "city": Target(cities, "destination_id", "destination", "safe_population", city_search),
            "harbour": Target(harbours, "harbour_id", "harbour", None, harbour_search),
        },
        scope,
    )
    best = found.groupBy(*_by_place(scope, place_key)).agg(
        _best("city").alias("city"), F.min("harbour.distance").alias("harbour_distance")
    )
    return best.filter(F.col("city").isNotNull()).select(
        *scope, *_city_columns(), "harbour_distance"
    )
