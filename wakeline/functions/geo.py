"""Spherical and planar geometry as column expressions.

Arguments are SQL expressions as text (usually column names) or plain numbers; each function returns
one column built in a single step.
"""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.constants import EARTH_RADIUS_M, HOTSPOT_CELL_DEG, METRES_PER_NM

Scalar = str | float


def number(value: float) -> str:
    """A number as a double literal."""
    return f"({float(value)!r}D)"


def _text(value: Scalar) -> str:
    return f"({value})" if isinstance(value, str) else number(value)


def _radians(value: Scalar) -> str:
    """Radians of an expression, or of a number worked out here and not once per row."""
    return f"radians({value})" if isinstance(value, str) else number(math.radians(value))


def arc_m_sql(half_chord_sq: str) -> str:
    """Metres along the sphere for the square of half the chord (unit sphere)."""
    # Rounding can lift the value of antipodes just above 1.
    rest = f"greatest(0D, 1D - ({half_chord_sq}))"
    return f"({number(2 * EARTH_RADIUS_M)} * atan2(sqrt({half_chord_sq}), sqrt({rest})))"


def haversine_sql(lat1: Scalar, lon1: Scalar, lat2: Scalar, lon2: Scalar) -> str:
    phi1, phi2 = _radians(lat1), _radians(lat2)
    sin_dphi = f"sin(({phi2} - {phi1}) / 2D)"
    sin_dlam = f"sin(({_radians(lon2)} - {_radians(lon1)}) / 2D)"
    half = f"{sin_dphi} * {sin_dphi} + cos({phi1}) * cos({phi2}) * {sin_dlam} * {sin_dlam}"
    return arc_m_sql(half)


def haversine_m(lat1: Scalar, lon1: Scalar, lat2: Scalar, lon2: Scalar) -> Column:
    """Great-circle metres between two points in degrees."""
    return F.expr(haversine_sql(lat1, lon1, lat2, lon2))


def unit_vector(lat: str, lon: str) -> Column:
    """A point in degrees as ``struct(x, y, z)`` on the unit sphere."""
    return F.expr(
        f"named_struct('x', cos(radians({lat})) * cos(radians({lon})),"
        f" 'y', cos(radians({lat})) * sin(radians({lon})), 'z', sin(radians({lat})))"
    )


def half_chord_sq_sql(a: tuple[str, str, str], b: tuple[str, str, str]) -> str:
    """Square of half the chord between two unit vectors.

    It grows with the great-circle distance, so the nearest of many points can be found with
    multiplications alone and only the winner turned into metres by ``arc_m_sql``.
    """
    squares = [f"({p} - {q}) * ({p} - {q})" for p, q in zip(a, b)]
    return f"(({' + '.join(squares)}) / 4D)"


def unit_numbers(lat: float, lon: float) -> tuple[str, str, str]:
    """The unit vector of a fixed point as three literals."""
    phi, lam = math.radians(lat), math.radians(lon)
    xyz = (math.cos(phi) * math.cos(lam), math.cos(phi) * math.sin(lam), math.sin(phi))
    return tuple(number(v) for v in xyz)


def implied_speed_sql(metres: str, elapsed_ms: str) -> str:
    """Knots needed to cover ``metres`` in ``elapsed_ms``; NULL when no time passed."""
    hours = f"(({elapsed_ms}) / 3600000D)"
    return f"CASE WHEN {elapsed_ms} > 0 THEN ({metres} / {number(METRES_PER_NM)}) / {hours} END"


def initial_bearing_deg(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Heading at the first point towards the second, clockwise from north, in [0, 360)."""
    phi1, phi2 = _radians(lat1), _radians(lat2)
    dlam = f"(radians({lon2}) - radians({lon1}))"
    east = f"sin({dlam}) * cos({phi2})"
    north = f"cos({phi1}) * sin({phi2}) - sin({phi1}) * cos({phi2}) * cos({dlam})"
    return F.expr(f"pmod(degrees(atan2({east}, {north})) + 360D, 360D)")


def grid_snap(degrees: str, cell_deg: float = HOTSPOT_CELL_DEG) -> Column:
    """South-west corner of the grid cell holding a coordinate.

    The division keeps binary rounding as it is: 0.3 / 0.1 floors to 2.
    """
    return F.expr(f"round(floor({degrees} / {number(cell_deg)}) * {number(cell_deg)}, 6)")


def ring_edges_sql(ring: str) -> str:
    """The sides of a ring as ``array<struct<x1,y1,x2,y2>>``; an open ring is closed.

    A ring of fewer than three vertices has no sides. The first vertex is repeated at the end; if
    it was there already, the extra side is a point, which neither crosses nor changes anything
    that the other sides at that vertex do not.
    """
    side = "(a, b) -> named_struct('x1', a.lon, 'y1', a.lat, 'x2', b.lon, 'y2', b.lat)"
    shifted = f"concat(slice({ring}, 2, greatest(size({ring}) - 1, 0)), slice({ring}, 1, 1))"
    return f"filter(zip_with({ring}, {shifted}, {side}), e -> size({ring}) >= 3)"


def inside_edges_sql(edges: str, lon: Scalar, lat: Scalar) -> str:
    """Whether a point lies strictly inside the ring with these sides (even-odd rule).

    A point on a side is outside; NULL or empty sides contain nothing.
    """
    x, y = _text(lon), _text(lat)
    crosses = (
        f"e -> (e.y1 > {y}) != (e.y2 > {y})"
        f" AND {x} < e.x1 + ({y} - e.y1) * (e.x2 - e.x1) / nullif(e.y2 - e.y1, 0D)"
    )
    touches = (
        f"e -> {x} BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)"
        f" AND {y} BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)"
        f" AND (e.x2 - e.x1) * ({y} - e.y1) - (e.y2 - e.y1) * ({x} - e.x1) = 0D"
    )
    odd = f"size(filter({edges}, {crosses})) % 2 = 1"
    return f"coalesce({odd} AND NOT exists({edges}, {touches}), false)"


def point_in_polygon(ring: str, lon: Scalar, lat: Scalar) -> Column:
    """Strict containment in a ring of (lon, lat) vertices; NULL or empty ring gives false."""
    return F.expr(inside_edges_sql(ring_edges_sql(ring), lon, lat))
