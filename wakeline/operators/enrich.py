"""Zone, port distance, risk score and level for reports and for cell crossings."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.constants import SEED_PORTS
from wakeline.functions.hexgrid import hex_centroid
from wakeline.functions.risk import risk_level, risk_score
from wakeline.operators.ports import with_nearest_port
from wakeline.operators.zones import any_restricted, primary_zone, with_zones
from wakeline.sources.reference import seed_zones


def _with_context(points, zones, ports, lon, lat, key) -> DataFrame:
    zones = seed_zones(points.sparkSession) if zones is None else zones
    located = with_zones(points, zones, lon=lon, lat=lat, key=key)
    labelled = located.select(
        *points.columns, any_restricted().alias("in_restricted_zone"), primary_zone().alias("_zone")
    ).selectExpr(
        *points.columns, "in_restricted_zone", "_zone.name AS zone_name", "_zone.zone_type AS zone_type"
    )
    return with_nearest_port(labelled, ports, lon=lon, lat=lat, key=key)


def enrich(
    reports: DataFrame, zones: DataFrame | None = None, ports: Sequence[tuple] | DataFrame = SEED_PORTS
) -> DataFrame:
    """Accepted reports with their zone, port distance and risk; all flags still false."""
    key = ("mmsi", "ts_ms", "ingest_ms", "seq")
    placed = _with_context(reports, zones, ports, "longitude", "latitude", key)
    return placed.select("*", risk_score(speed="speed").alias("risk_score")).select(
        "*",
        risk_level().alias("risk_level"),
        F.lit(False).alias("loitering"),
        F.lit(False).alias("dark_vessel"),
        F.lit(False).alias("speed_anomaly"),
    )


def enrich_crossings(
    crossings: DataFrame, zones: DataFrame | None = None, ports: Sequence[tuple] | DataFrame = SEED_PORTS
) -> DataFrame:
    """Crossings with the zone, port distance and risk of the entered cell's centroid.

    The speed of the vessel does not count here.
    """
    centred = crossings.select("*", hex_centroid("to_cell").alias("_centre")).selectExpr(
        *crossings.columns, "_centre.lat AS centroid_lat", "_centre.lon AS centroid_lon"
    )
    placed = _with_context(centred, zones, ports, "centroid_lon", "centroid_lat", ("mmsi", "ts_ms", "seq"))
    return placed.select("*", risk_score().alias("risk_score")).select("*", risk_level().alias("risk_level"))
