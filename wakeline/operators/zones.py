"""Point-in-zone join over a cover of grid cells.

Each polygon is cut into the grid cells it touches, so a point meets only the zones of its own cell:
an equi-join on the cell, then the exact test. Cells that lie wholly inside a polygon skip the test.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions.geo import inside_edges_sql, number, ring_edges_sql
from wakeline.functions.risk import zone_priority_sql

CELL_DEG = 1.0
# Up to this many zones, with this many polygon sides in their whole cover, the cover is sent to
# every executor: 40 bytes a side and about 100 a zone entry keep it under some tens of megabytes.
MAX_BROADCAST_ZONES = 5_000
MAX_BROADCAST_SIDES = 200_000
# Beyond that, the points of a cell are spread over this many salts.
SALTS = 32

_ZONE = "'priority', {priority}, 'minus_id', -id, 'id', id, 'name', name, 'zone_type', zone_type".format(
    priority=zone_priority_sql()
)


def cell_sql(degrees: str, cell_deg: float) -> str:
    return f"cast(floor({degrees} / {number(cell_deg)}) AS int)"


def _boxed(zones: DataFrame) -> DataFrame:
    """Zones with their bounding box; a ring without vertices drops out."""
    corners = {"west": ("min", "lon"), "east": ("max", "lon"), "south": ("min", "lat"), "north": ("max", "lat")}
    return zones.select(
        "id", "name", "zone_type", "ring", *[F.expr(f"array_{f}(ring.{c})").alias(n) for n, (f, c) in corners.items()]
    ).where("west IS NOT NULL")


def cover_is_small(zones: DataFrame, cell_deg: float = CELL_DEG, max_sides: int = MAX_BROADCAST_SIDES) -> bool:
    """Whether the cover of this catalogue is bounded tightly enough to be sent to every executor.

    Counts every zone's sides once per cell of its bounding box, which is more than the cover holds.
    """
    spans = [
        f"({cell_sql(high, cell_deg)} - {cell_sql(low, cell_deg)} + 1L)"
        for low, high in (("west", "east"), ("south", "north"))
    ]
    sides = f"{spans[0]} * {spans[1]} * (size(ring) + 1)"
    counted = _boxed(zones).select(F.expr(sides).alias("sides")).limit(MAX_BROADCAST_ZONES + 1).collect()
    return len(counted) <= MAX_BROADCAST_ZONES and sum(row["sides"] for row in counted) <= max_sides


def zone_cover(zones: DataFrame, cell_deg: float = CELL_DEG) -> DataFrame:
    """One row per (zone, touched cell): the sides, and whether the cell is wholly inside."""
    step = number(cell_deg)
    cells = (
        _boxed(zones)
        .selectExpr(
            "id",
            "name",
            "zone_type",
            f"{ring_edges_sql('ring')} AS edges",
            "south",
            "north",
            f"explode(sequence({cell_sql('west', cell_deg)}, {cell_sql('east', cell_deg)})) AS cell_x",
        )
        .selectExpr(
            "id",
            "name",
            "zone_type",
            "edges",
            "cell_x",
            f"explode(sequence({cell_sql('south', cell_deg)}, {cell_sql('north', cell_deg)})) AS cell_y",
        )
    )
    left, bottom = f"(cell_x * {step})", f"(cell_y * {step})"
    near = (
        f"e -> least(e.x1, e.x2) <= {left} + {step} AND greatest(e.x1, e.x2) >= {left}"
        f" AND least(e.y1, e.y2) <= {bottom} + {step} AND greatest(e.y1, e.y2) >= {bottom}"
    )
    # Only sides at the height of the cell and not left of it can be crossed on the way east, so a
    # cell keeps those alone and a long coastline is not repeated whole in every cell it crosses.
    counts = (
        f"e -> greatest(e.x1, e.x2) >= {left} AND greatest(e.y1, e.y2) >= {bottom}"
        f" AND least(e.y1, e.y2) <= {bottom} + {step}"
    )
    # No side near the cell: it is wholly inside or wholly outside, as its centre is.
    centre_inside = inside_edges_sql("edges", f"{left} + {step} / 2", f"{bottom} + {step} / 2")
    crossed = cells.selectExpr("*", f"exists(edges, {near}) AS crossed")
    return crossed.where(f"crossed OR {centre_inside}").selectExpr(
        "id",
        "name",
        "zone_type",
        "cell_x",
        "cell_y",
        "NOT crossed AS whole",
        f"CASE WHEN crossed THEN filter(edges, {counts}) END AS edges",
    )


def with_zones(
    points: DataFrame,
    zones: DataFrame,
    *,
    lon: str = "longitude",
    lat: str = "latitude",
    key: tuple[str, ...] = ("mmsi", "ts_ms", "ingest_ms", "seq"),
    cell_deg: float = CELL_DEG,
    max_broadcast_sides: int = MAX_BROADCAST_SIDES,
) -> DataFrame:
    """Add ``zones``: all zones that contain the point, as structs with their priority.

    Points are kept whether or not they lie in a zone. ``key`` names a point; it is used only when
    the catalogue is too large to broadcast.
    """
    cover = zone_cover(zones, cell_deg)
    located = points.selectExpr(
        "*", f"{cell_sql(lon, cell_deg)} AS cell_x", f"{cell_sql(lat, cell_deg)} AS cell_y"
    )
    if cover_is_small(zones, cell_deg, max_broadcast_sides):
        # The whole cover is bounded, hence so is the list of one cell. Points are not shuffled.
        entry = f"named_struct({_ZONE}, 'whole', whole, 'edges', edges)"
        per_cell = cover.groupBy("cell_x", "cell_y").agg(F.expr(f"collect_list({entry}) AS candidates"))
        joined = located.join(F.broadcast(per_cell), ["cell_x", "cell_y"], "left")
        hits = f"filter(candidates, z -> z.whole OR {inside_edges_sql('z.edges', lon, lat)})"
        fields = ", ".join(f"'{name}', z.{name}" for name in ("priority", "minus_id", "id", "name", "zone_type"))
        kept = F.expr(f"coalesce(transform({hits}, z -> named_struct({fields})), array())")
        return joined.select(*points.columns, kept.alias("zones"))

    # A cell may hold any share of the points: spread them over salts and repeat its zones per salt.
    # What is still large after that, AQE's skew join splits.
    salted_points = located.select(*key, lon, lat, "cell_x", "cell_y").withColumn(
        "salt", F.pmod(F.xxhash64(*key), F.lit(SALTS)).cast("int")
    )
    salted_cover = cover.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    matches = (
        salted_points.join(salted_cover, ["cell_x", "cell_y", "salt"])
        .where(f"whole OR {inside_edges_sql('edges', lon, lat)}")
        .groupBy(*key)
        .agg(F.expr(f"collect_list(named_struct({_ZONE})) AS zones"))
    )
    return points.join(matches, list(key), "left").select(
        *points.columns, F.coalesce("zones", F.array()).alias("zones")
    )


def any_restricted() -> Column:
    """Whether one of ``zones`` is restricted."""
    return F.expr("exists(zones, z -> z.zone_type = 'RESTRICTED')")


def primary_zone() -> Column:
    """The zone of highest priority, the lowest id among equals; NULL without zones."""
    return F.array_max("zones")


def zone_pairs(located: DataFrame, *keep: str) -> DataFrame:
    """One row per (point, containing zone); points outside all zones keep one row of NULLs."""
    return located.select(*keep, F.explode_outer("zones").alias("zone")).selectExpr(
        *keep, "zone.id AS zone_id", "zone.name AS zone_name", "zone.zone_type AS zone_type"
    )
