"""Distance to the nearest port.

A short gazetteer becomes plain arithmetic in the row (no join). A large port table is cut down
first to a tree of cells: each keeps only the ports that can be nearest to some point of it, and is
split further while its list is long. Where ports are dense the leaves are small, so lists stay
short for any number of ports, without dropping any possible winner.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.constants import EARTH_RADIUS_M, METRES_PER_NM
from wakeline.functions.geo import (
    arc_m_sql,
    half_chord_sq_sql,
    haversine_sql,
    number,
    unit_numbers,
    unit_vector,
)
from wakeline.settings import stage

# Longest gazetteer written into the expression itself.
MAX_INLINE_PORTS = 64
# Cell sizes in degrees, each a whole multiple of the next. Cells down to SPLIT_DEG are always split, where points are.
LEVELS_DEG = (30, 5, 1, 0.25, 0.0625, 0.015625, 0.00390625)
SPLIT_DEG = 1
# Longest list of a leaf, but for leaves of the smallest size.
LEAF_PORTS = 12
# Largest candidate table sent to every executor (about 40 bytes a row).
MAX_BROADCAST_CANDIDATES = 500_000
SALTS = 32


_HERE = ("_here.x", "_here.y", "_here.z")


def _as_nm(chord: str) -> Column:
    return F.expr(f"{arc_m_sql(chord)} / {number(METRES_PER_NM)}")


def nearest_chord_sql(ports: Sequence[tuple]) -> str:
    """Half the chord, squared, from ``_here`` to the nearest of ``(id, name, lat, lon)`` ports."""
    chords = [half_chord_sq_sql(_HERE, unit_numbers(lat, lon)) for _, _, lat, lon in ports]
    # A second, equal argument lets one port stand alone.
    return f"least({', '.join(chords + chords[:1])})"


def with_nearest_port(
    points: DataFrame,
    ports: Sequence[tuple] | DataFrame,
    *,
    lon: str = "longitude",
    lat: str = "latitude",
    key: tuple[str, ...] = ("mmsi", "ts_ms", "ingest_ms", "seq"),
    max_broadcast: int = MAX_BROADCAST_CANDIDATES,
) -> DataFrame:
    """Add ``distance_to_port`` in nautical miles.

    ``ports`` is a short gazetteer or a port table of any size.
    """
    if isinstance(ports, DataFrame):
        head = ports.select("port_id", "name", "latitude", "longitude").limit(MAX_INLINE_PORTS + 1).collect()
        if len(head) > MAX_INLINE_PORTS:
            return _from_table(points, ports, lon, lat, key, max_broadcast)
        ports = [tuple(row) for row in head]
    if len(ports) > MAX_INLINE_PORTS:
        raise ValueError(f"more than {MAX_INLINE_PORTS} ports: pass them as a DataFrame")
    if not ports:
        return points.withColumn("distance_to_port", F.lit(None).cast("double"))
    # Vector and chord are columns of their own, so neither is worked out more than once.
    return (
        points.select("*", unit_vector(lat, lon).alias("_here"))
        .select(*points.columns, F.expr(nearest_chord_sql(ports)).alias("_chord"))
        .select(*points.columns, _as_nm("_chord").alias("distance_to_port"))
    )


def _cell_sql(degrees: str, step: int) -> str:
    return f"cast(floor({degrees} / {number(step)}) AS int)"


def _cells(degrees: str, level: int) -> str:
    return _cell_sql(degrees, LEVELS_DEG[level])


def _split(pairs: DataFrame, level: int) -> DataFrame:
    """The lists of cells of one level as those of the cells of the next one inside them."""
    parts = int(LEVELS_DEG[level - 1] / LEVELS_DEG[level])
    inner = F.sequence(F.lit(0), F.lit(parts - 1))
    return (
        pairs.withColumn("dx", F.explode(inner))
        .withColumn("dy", F.explode(inner))
        .withColumn("cell_x", F.col("cell_x") * parts + F.col("dx"))
        .withColumn("cell_y", F.col("cell_y") * parts + F.col("dy"))
        .drop("dx", "dy")
    )


def candidate_ports(ports: DataFrame, occupied: DataFrame) -> tuple[DataFrame, list[tuple[int, DataFrame]]]:
    """Leaves as rows (level, cell_x, cell_y, plat, plon), and for each level that is split in part, the cells split.

    ``occupied`` are the cells of SPLIT_DEG that hold points. Going from coarse cells to fine ones, a port stays on a
    cell's list while its distance to the cell's centre, less the cell's radius, does not exceed the smallest such
    distance plus radius. Ports at the same place are one. A cell of SPLIT_DEG or less with at most LEAF_PORTS on its list
    is a leaf; so the lists of all leaves together grow with the ports, and not with ports times points.
    """
    top = LEVELS_DEG[0]
    # Every port starts on the list of every coarse cell: a fixed number of cells. One more on each side holds points
    # just past the edges, as centroids of cells at the edge are.
    pairs = (
        ports.select(F.col("latitude").alias("plat"), F.col("longitude").alias("plon")).distinct()
        .withColumn("cell_x", F.explode(F.sequence(F.lit(-180 // top - 1), F.lit(180 // top))))
        .withColumn("cell_y", F.explode(F.sequence(F.lit(-90 // top - 1), F.lit(90 // top))))
    )
    leaves, split = [], []
    for level, step in enumerate(LEVELS_DEG):
        if level:
            pairs = _split(pairs, level)
        if step >= SPLIT_DEG:
            # Only cells above some occupied cell are refined.
            scale = int(step / SPLIT_DEG)
            above = occupied.select(
                F.floor(F.col("cell_x") / scale).cast("int").alias("cell_x"),
                F.floor(F.col("cell_y") / scale).cast("int").alias("cell_y"),
            ).distinct()
            pairs = pairs.join(above, ["cell_x", "cell_y"], "left_semi")
        if step > SPLIT_DEG:
            # Lists are long here. They are read twice, to find the bound and to apply it, so they are written in between.
            pairs = _prune(stage(pairs, f"port-level-{level}"), step)
            continue
        pairs = stage(_prune_short(pairs, step), f"port-level-{level}")
        last = level + 1 == len(LEVELS_DEG)
        leaves.append((pairs if last else pairs.where(f"n <= {LEAF_PORTS}")).withColumn("level", F.lit(level)))
        if last:
            break
        pairs = pairs.where(f"n > {LEAF_PORTS}").drop("n")
        long = stage(pairs.select("cell_x", "cell_y").distinct(), f"port-split-{level}")
        if long.isEmpty():
            break
        split.append((level, long))
    return reduce(lambda a, b: a.unionByName(b), leaves), split


def _measured(pairs: DataFrame, step: float) -> DataFrame:
    """Lists with the cell's radius and each port's distance to its centre."""
    west, south = f"(cell_x * {number(step)})", f"(cell_y * {number(step)})"
    north = f"least({south} + {number(step)}, 90D)"
    middle = (f"(({south} + {north}) / 2D)", f"({west} + {number(step / 2)})")
    # The farthest point of a cell from its centre is a corner; a metre covers rounding.
    corners = [haversine_sql(*middle, south, west), haversine_sql(*middle, north, west)]
    return pairs.selectExpr(
        "*",
        f"greatest({', '.join(corners)}) + 1D AS radius",
        f"{haversine_sql(*middle, 'plat', 'plon')} AS centre_m",
    )


def _prune(pairs: DataFrame, step: float) -> DataFrame:
    """The lists without ports that can't be nearest to any point of their cell."""
    measured = _measured(pairs, step)
    bound = measured.groupBy("cell_x", "cell_y").agg(F.expr("min(centre_m + radius) AS bound"))
    near = measured.join(bound, ["cell_x", "cell_y"]).where("centre_m - radius <= bound")
    return near.drop("radius", "centre_m", "bound")


def _dot(a: str, b: str) -> str:
    return f"({a}.x * {b}.x + {a}.y * {b}.y + {a}.z * {b}.z)"


def _prune_short(pairs: DataFrame, step: float) -> DataFrame:
    """The same in one shuffle, for lists that the levels above have cut down; ``n`` is the length of the list left.

    Also goes what another port is nearer than at every point of the cell, so that cells far from a dense group of ports
    keep those on its edge alone. A port is nearer than another on one side of a plane through the globe's centre. Points
    of the cell lie in the hull of its corners but for at most the square of its radius, so the corners decide. The ports
    nearest to the centre and to the corners are tried.
    """
    cell = Window.partitionBy("cell_x", "cell_y")
    measured = _measured(pairs, step).withColumn("bound", F.min(F.expr("centre_m + radius")).over(cell))
    near = measured.where("centre_m - radius <= bound")
    west, south = f"(cell_x * {number(step)})", f"(cell_y * {number(step)})"
    east, north = f"({west} + {number(step)})", f"least({south} + {number(step)}, 90D)"
    corners = [unit_vector(lat, lon) for lat in (south, north) for lon in (west, east)]
    near = near.withColumns(
        {"port": unit_vector("plat", "plon"), "corners": F.array(*corners), "hull": F.expr(f"pow(radius / {number(EARTH_RADIUS_M)}, 2)")}
    )
    nearest = [F.max_by("port", F.expr(_dot("port", f"corners[{i}]"))).over(cell) for i in range(4)]
    tried = near.withColumn("tried", F.array(F.min_by("port", "centre_m").over(cell), *nearest))
    apart = "named_struct('x', port.x - p.x, 'y', port.y - p.y, 'z', port.z - p.z)"
    beaten = (
        f"exists(transform(tried, p -> {apart}), d -> {_dot('d', 'd')} > 0 AND "
        f"forall(corners, c -> {_dot('c', 'd')} <= -hull * sqrt({_dot('d', 'd')})))"
    )
    kept = tried.where(f"NOT {beaten}").withColumn("n", F.count("*").over(cell))
    return kept.select(*pairs.columns, "n")


def _located(points: DataFrame, split: list[tuple[int, DataFrame]], lon: str, lat: str, max_broadcast: int) -> DataFrame:
    """Points with the level and cell of their leaf: the first level at which their cell is not split.

    The cells split are at most a LEAF_PORTS-th of the lists, so they are broadcast as long as those may be.
    """
    first = LEVELS_DEG.index(SPLIT_DEG)
    found = points.withColumn("level", F.lit(first))
    for level, cells in split:
        cells = F.broadcast(cells) if cells.count() <= max_broadcast else cells
        keys = cells.withColumnRenamed("cell_x", "_x").withColumnRenamed("cell_y", "_y").withColumn("_deeper", F.lit(True))
        found = (
            found.withColumns({"_x": F.expr(_cells(lon, level)), "_y": F.expr(_cells(lat, level))})
            .join(keys, ["_x", "_y"], "left")
            .withColumn("level", F.expr(f"CASE WHEN level = {level} AND _deeper THEN {level + 1} ELSE level END"))
            .drop("_x", "_y", "_deeper")
        )
    levels = range(first, first + len(split) + 1)

    def cell(degrees: str) -> str:
        return "CASE level " + " ".join(f"WHEN {k} THEN {_cells(degrees, k)}" for k in levels) + " END"

    return found.withColumns({"cell_x": F.expr(cell(lon)), "cell_y": F.expr(cell(lat))})


_LEAF = ["level", "cell_x", "cell_y"]


def _from_table(points, ports, lon, lat, key, max_broadcast) -> DataFrame:
    whole = points.selectExpr(f"{_cell_sql(lon, SPLIT_DEG)} AS cell_x", f"{_cell_sql(lat, SPLIT_DEG)} AS cell_y")
    # At most one row per cell of one degree.
    occupied = stage(whole.distinct(), "port-cells")
    leaves, split = candidate_ports(ports, occupied)
    # Written once, because it is counted before it is used; it is small next to the points.
    candidates = stage(leaves.select(*_LEAF, unit_vector("plat", "plon").alias("port")), "port-candidates")
    located = _located(points, split, lon, lat, max_broadcast)
    here = unit_vector(lat, lon).alias("_here")
    if candidates.count() <= max_broadcast:
        # The whole table is bounded, hence so is the list of one cell. Points are not shuffled.
        per_cell = candidates.groupBy(*_LEAF).agg(F.collect_list("port").alias("near"))
        chord = half_chord_sq_sql(_HERE, ("p.x", "p.y", "p.z"))
        return (
            located.join(F.broadcast(per_cell), _LEAF, "left")
            .select(*points.columns, "near", here)
            .select(*points.columns, F.expr(f"array_min(transform(near, p -> {chord}))").alias("_chord"))
            .select(*points.columns, _as_nm("_chord").alias("distance_to_port"))
        )
    # A cell may hold any share of the points: spread them over salts and repeat its list per salt.
    # What is still large after that, AQE's skew join splits.
    salted = located.select(*key, *_LEAF, here).withColumn(
        "salt", F.pmod(F.xxhash64(*key), F.lit(SALTS)).cast("int")
    )
    spread = candidates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    chord = half_chord_sq_sql(_HERE, ("port.x", "port.y", "port.z"))
    # Spark judges the lists by the file they come from, without the salts, and may broadcast them: the hint forbids it.
    nearest = (
        salted.join(spread.hint("merge"), [*_LEAF, "salt"]).groupBy(*key).agg(F.expr(f"min({chord}) AS _chord"))
    )
    return points.join(nearest, list(key), "left").select(
        *points.columns, _as_nm("_chord").alias("distance_to_port")
    )
