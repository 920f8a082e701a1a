"""Reference data: the zone catalogue and the port gazetteer."""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema

from wakeline.constants import SEED_PORTS, SEED_ZONES
from wakeline.schemas import PORTS, ZONES


def _local(spark: SparkSession, rows: list[dict], schema) -> DataFrame:
    """A handful of literal rows, planned as a local relation and not as a Python job."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=to_arrow_schema(schema)), schema)


def seed_zones(spark: SparkSession) -> DataFrame:
    rows = []
    for zone_id, name, kind, west, south, east, north in SEED_ZONES:
        corners = [(west, south), (east, south), (east, north), (west, north), (west, south)]
        ring = [{"lon": lon, "lat": lat} for lon, lat in corners]
        rows.append({"id": zone_id, "name": name, "zone_type": kind, "ring": ring})
    return _local(spark, rows, ZONES)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """A zone table at rest: id, name, zone_type and a ring of (lon, lat) vertices."""
    return spark.read.schema(ZONES).parquet(path)


def seed_ports(spark: SparkSession) -> DataFrame:
    return _local(spark, [dict(zip(PORTS.names, port)) for port in SEED_PORTS], PORTS)


def read_ports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PORTS).parquet(path)
