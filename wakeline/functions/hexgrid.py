"""A planar hexagon grid over (longitude, latitude) degrees, as column expressions.

Pointy-top hexagons with a fixed edge in degrees. Cells narrow towards the poles, as degrees do,
and the grid does not wrap at the antimeridian. A cell id is opaque, ``q:r``; it is used only for
equality and for its centroid, so callers may pass another cell function instead.
"""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.constants import HEX_EDGE_DEG
from wakeline.functions.geo import number


def hex_cell(lat: str = "latitude", lon: str = "longitude", edge_deg: float = HEX_EDGE_DEG) -> Column:
    """Id of the hexagon holding a point."""
    edge = number(edge_deg)
    q = f"(({number(math.sqrt(3.0) / 3.0)} * {lon} - {lat} / 3D) / {edge})"
    r = f"(({number(2.0 / 3.0)} * {lat}) / {edge})"
    s = f"(-{q} - {r})"
    near = {name: f"floor({v} + 0.5D)" for name, v in (("q", q), ("r", r), ("s", s))}
    off_q, off_r, off_s = f"abs({near['q']} - {q})", f"abs({near['r']} - {r})", f"abs({near['s']} - {s})"
    # The coordinate that moved most is rebuilt from the other two, so they still sum to zero.
    q_moved = f"{off_q} > {off_r} AND {off_q} > {off_s}"
    cell_q = f"CASE WHEN {q_moved} THEN -{near['r']} - {near['s']} ELSE {near['q']} END"
    cell_r = (
        f"CASE WHEN {q_moved} THEN {near['r']} WHEN {off_r} > {off_s} THEN -{near['q']} - {near['s']}"
        f" ELSE {near['r']} END"
    )
    return F.expr(f"concat_ws(':', cast({cell_q} AS string), cast({cell_r} AS string))")


def hex_centroid(cell: str = "cell", edge_deg: float = HEX_EDGE_DEG) -> Column:
    """Centre of a cell as ``struct(lat, lon)``."""
    q, r = (f"cast(split_part({cell}, ':', {i}) AS double)" for i in (1, 2))
    return F.expr(
        f"named_struct('lat', {number(edge_deg * 1.5)} * {r},"
        f" 'lon', {number(edge_deg * math.sqrt(3.0))} * ({q} + {r} / 2D))"
    )
