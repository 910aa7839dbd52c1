"""A hexagonal grid in plain column expressions.

A position is projected with the (equal-area) sinusoidal projection and rounded to
the nearest hexagon in axial coordinates ``(q, r)``. A cell is one ``bigint`` that
packs resolution, q and r, so it joins, groups and shuffles as a primitive and
every expression here stays inside whole-stage code generation.

The number of cells is bounded by the surface of the earth, whatever the number of
rows: about 100 million at resolution 7 and 840 at resolution 1. The operators use
this bound.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean earth radius in km; average cell area in km2 at resolution 0,
# which each further resolution divides by 7.
EARTH_RADIUS_KM = 6371.0088
BASE_CELL_KM2 = 4250546.8477

FINE_RES = 7
ROUGH_RES = 1

AXIS_BITS = 28
AXIS_SPAN = 1 << AXIS_BITS
AXIS_ZERO = AXIS_SPAN // 2


def edge_km(res: int) -> float:
    """Edge length of a hexagon at a resolution."""
    return math.sqrt(2 * BASE_CELL_KM2 / 7**res / (3 * math.sqrt(3)))


def axis_extent(res: int) -> int:
    """Upper bound of the number of cells along one axis of the whole earth."""
    return math.ceil(math.pi * EARTH_RADIUS_KM * 2 / (math.sqrt(3) * edge_km(res))) * 2


def _sheet(x: Column, sheets: int) -> Column:
    """The meridian of the sheet that holds a longitude counted from ``lon0``, -180 to 180."""
    width = 360.0 / sheets
    number = F.least(F.greatest(F.floor((x + F.lit(180.0)) / F.lit(width)), F.lit(0)), F.lit(sheets - 1))
    return number * F.lit(width) + F.lit(width / 2 - 180.0)


def cell(
    lat: Column, lon: Column, res: int = FINE_RES, lon0: float = 0.0, sheets: int = 1
) -> Column:
    """The cell of a position, NULL if either coordinate is.

    ``lon0`` is the central meridian: shapes are true there and sheared away from it. With
    several ``sheets`` the earth is cut along meridians, and each sheet has its own in its
    middle; they lie side by side on one plane, so cells of the earth remain distinct numbers.
    The nearest hexagon is found with three floors instead of the usual rounding of
    three axes with a correction of the worst: no branch, and each input once or
    twice, which is a third of the work per elevation sample.
    """
    unit = EARTH_RADIUS_KM * math.pi / 180 / (math.sqrt(3) * edge_km(res))
    lat, lon = lat.cast("double"), lon.cast("double")
    narrowing = F.cos(lat * F.lit(math.pi / 180))
    if sheets == 1:
        x = (lon - F.lit(lon0)) * F.lit(unit) * narrowing
    else:
        from_lon0 = F.pmod(lon - F.lit(lon0 - 180.0), F.lit(360.0)) - F.lit(180.0)
        middle = _sheet(from_lon0, sheets)
        x = (middle + (from_lon0 - middle) * narrowing) * F.lit(unit)
    t = lat * F.lit(-unit * math.sqrt(3)) + F.lit(1.0)
    corner = F.floor(t + x)
    q = F.floor((corner + x * F.lit(2.0) + F.lit(1.0)) / F.lit(3.0))
    r = -F.floor((corner + t - x) / F.lit(3.0))
    return pack(q, r, res)


def pack(q: Column, r: Column, res: int) -> Column:
    """Axial coordinates to a cell."""
    zero, span = F.lit(AXIS_ZERO).cast("bigint"), F.lit(AXIS_SPAN).cast("bigint")
    return ((F.lit(res).cast("bigint") * span + q + zero) * span + r + zero).cast("bigint")


def centre(
    cell: Column, res: int = FINE_RES, lon0: float = 0.0, sheets: int = 1
) -> tuple[Column, Column]:
    """Latitude and longitude of the middle of a cell, at most those of its sheet's edge."""
    degree = EARTH_RADIUS_KM * math.pi / 180
    q, r = axial_q(cell) - F.lit(AXIS_ZERO), axial_r(cell) - F.lit(AXIS_ZERO)
    lat = F.greatest(F.least(r * F.lit(1.5 * edge_km(res) / degree), F.lit(90.0)), F.lit(-90.0))
    x = (q + r / F.lit(2.0)) * F.lit(math.sqrt(3) * edge_km(res) / degree)
    half, middle = F.lit(180.0 / sheets), _sheet(x, sheets)
    aside = (x - middle) / F.cos(lat * F.lit(math.pi / 180))
    lon = middle + F.greatest(F.least(aside, half), -half)
    return lat, lon + F.lit(lon0)


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """A position as a point on the sphere of radius 1."""
    phi, theta = lat * F.lit(math.pi / 180), lon * F.lit(math.pi / 180)
    return F.cos(phi) * F.cos(theta), F.cos(phi) * F.sin(theta), F.sin(phi)


def resolution(cell: Column) -> Column:
    return F.shiftright(cell, 2 * AXIS_BITS)


def axial_q(cell: Column) -> Column:
    """q counted from the edge of the packed range, so never negative."""
    return F.shiftright(cell, AXIS_BITS).bitwiseAND(F.lit(AXIS_SPAN - 1))


def axial_r(cell: Column) -> Column:
    """r counted from the edge of the packed range, so never negative."""
    return cell.bitwiseAND(F.lit(AXIS_SPAN - 1))


def grid_distance(a: Column, b: Column, max_distance: int | None = None) -> Column:
    """Steps between two cells; NULL if undefined.

    Undefined: a missing cell, different resolutions, more than ``max_distance``.
    """
    dq, dr = axial_q(a) - axial_q(b), axial_r(a) - axial_r(b)
    steps = F.greatest(F.abs(dq), F.abs(dr), F.abs(dq + dr)).cast("int")
    defined = resolution(a) == resolution(b)
    if max_distance is not None:
        defined = defined & (steps <= F.lit(max_distance))
    return F.when(defined, steps)


def ring_offsets(k: int) -> list[tuple[int, int]]:
    """(packed offset, steps) of every cell at most k steps away."""
    return [
        (dq * AXIS_SPAN + dr, max(abs(dq), abs(dr), abs(dq + dr)))
        for dq in range(-k, k + 1)
        for dr in range(max(-k, -dq - k), min(k, -dq + k) + 1)
    ]


def k_ring(cell: Column, k: int = 1) -> Column:
    """The cells at most k steps away, as an array of 3k(k+1)+1 cells."""
    if k < 0:
        raise ValueError("k must not be negative")
    offsets = F.array(*[F.lit(offset).cast("bigint") for offset, _ in ring_offsets(k)])
    return F.transform(offsets, lambda offset: cell + offset)
