"""Schemas of the records and tables. Reports are read with these, never inferred."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields) -> StructType:
    return StructType([StructField(name, kind, nullable) for name, kind, nullable in fields])


# A raw position report as it arrives, one row per arrival.
RAW_REPORT = _struct(
    ("seq", LongType(), False),
    ("mmsi", StringType(), True),
    ("latitude", DoubleType(), True),
    ("longitude", DoubleType(), True),
    ("speed", DoubleType(), True),
    ("heading", DoubleType(), True),
    ("ts_ms", LongType(), True),
    ("ingest_ms", LongType(), True),
    ("source_type", StringType(), True),
    ("event_type", StringType(), True),
    ("correlation_id", StringType(), True),
)

# A position report as other systems exchange it.
VESSEL_EVENT = _struct(
    ("mmsi", StringType(), False),
    ("latitude", DoubleType(), False),
    ("longitude", DoubleType(), False),
    ("speed", DoubleType(), False),
    ("heading", DoubleType(), False),
    ("timestamp", TimestampType(), False),
    ("eventType", StringType(), False),
    ("sourceType", StringType(), True),
)

# The enriched record: the report nested, its context and flags beside it.
ENRICHED_EVENT = _struct(
    ("vesselEvent", VESSEL_EVENT, False),
    ("inRestrictedZone", BooleanType(), False),
    ("zoneName", StringType(), True),
    ("zoneType", StringType(), True),
    ("distanceToPort", DoubleType(), True),
    ("riskScore", DoubleType(), False),
    ("riskLevel", StringType(), False),
    ("loitering", BooleanType(), True),
    ("darkVessel", BooleanType(), True),
    ("speedAnomaly", BooleanType(), True),
)

HEX_CROSSING = _struct(
    ("mmsi", StringType(), False),
    ("fromCell", StringType(), False),
    ("toCell", StringType(), False),
    ("latitude", DoubleType(), False),
    ("longitude", DoubleType(), False),
    ("speed", DoubleType(), False),
    ("sourceType", StringType(), True),
    ("timestamp", TimestampType(), False),
)

ENRICHED_HEX_CROSSING = _struct(
    ("hexCrossingEvent", HEX_CROSSING, False),
    ("toCellCentroidLat", DoubleType(), False),
    ("toCellCentroidLon", DoubleType(), False),
    ("inRestrictedZone", BooleanType(), False),
    ("zoneName", StringType(), True),
    ("zoneType", StringType(), True),
    ("distanceToPort", DoubleType(), True),
    ("riskScore", DoubleType(), False),
    ("riskLevel", StringType(), False),
)

ZONES = _struct(
    ("id", LongType(), False),
    ("name", StringType(), False),
    ("zone_type", StringType(), False),
    ("ring", ArrayType(_struct(("lon", DoubleType(), False), ("lat", DoubleType(), False))), False),
)

PORTS = _struct(
    ("port_id", LongType(), False),
    ("name", StringType(), False),
    ("latitude", DoubleType(), False),
    ("longitude", DoubleType(), False),
)

DAILY_STATS = _struct(
    ("mmsi", StringType(), False),
    ("date", DateType(), False),
    ("event_count", LongType(), False),
    ("avg_speed_kn", DoubleType(), True),
    ("max_speed_kn", DoubleType(), True),
    ("avg_risk_score", DoubleType(), True),
    ("restricted_count", LongType(), False),
    ("loitering_count", LongType(), False),
    ("dark_vessel_count", LongType(), False),
    ("speed_anomaly_count", LongType(), False),
)

RISK_PERCENTILES = _struct(
    ("mmsi", StringType(), False),
    ("date", DateType(), False),
    ("p50_risk", DoubleType(), True),
    ("p95_risk", DoubleType(), True),
    ("sample_count", LongType(), False),
)

HOTSPOTS = _struct(
    ("date", DateType(), False),
    ("cell_lat", DoubleType(), False),
    ("cell_lon", DoubleType(), False),
    ("event_count", LongType(), False),
    ("vessel_count", LongType(), False),
)

# The same enriched record in Avro's JSON encoding: a nullable field is an object keyed by its
# type, and a timestamp is a bare number of milliseconds.
_UNION_STRING = _struct(("string", StringType(), True))
AVRO_JSON_ENRICHED = _struct(
    (
        "vesselEvent",
        _struct(
            ("mmsi", StringType(), True),
            ("latitude", DoubleType(), True),
            ("longitude", DoubleType(), True),
            ("speed", DoubleType(), True),
            ("heading", DoubleType(), True),
            ("timestamp", LongType(), True),
            ("eventType", StringType(), True),
            ("sourceType", _UNION_STRING, True),
        ),
        True,
    ),
    ("inRestrictedZone", BooleanType(), True),
    ("zoneName", _UNION_STRING, True),
    ("zoneType", _UNION_STRING, True),
    ("distanceToPort", DoubleType(), True),
    ("riskScore", DoubleType(), True),
    ("riskLevel", StringType(), True),
    ("loitering", BooleanType(), True),
    ("darkVessel", BooleanType(), True),
    ("speedAnomaly", BooleanType(), True),
)


def nested_event() -> Column:
    """The report columns of a flat row as the nested ``vesselEvent`` struct."""
    return F.struct(
        "mmsi",
        "latitude",
        "longitude",
        "speed",
        "heading",
        F.timestamp_millis("ts_ms").alias("timestamp"),
        F.col("event_type").alias("eventType"),
        F.col("source_type").alias("sourceType"),
    )


# Flat column name beside the name the nested record uses for it.
ENRICHED_NAMES = {
    "in_restricted_zone": "inRestrictedZone",
    "zone_name": "zoneName",
    "zone_type": "zoneType",
    "distance_to_port": "distanceToPort",
    "risk_score": "riskScore",
    "risk_level": "riskLevel",
    "loitering": "loitering",
    "dark_vessel": "darkVessel",
    "speed_anomaly": "speedAnomaly",
}


def to_nested(flat, *keep: str):
    """Flat enriched rows as nested records; ``keep`` names flat columns carried along."""
    return flat.select(
        nested_event().alias("vesselEvent"),
        *[F.col(flat_name).alias(name) for flat_name, name in ENRICHED_NAMES.items()],
        *keep,
    )


def to_flat(nested, *keep: str):
    """Nested records as flat enriched rows, absent flags read as false."""
    event = "vesselEvent."
    flags = ("loitering", "darkVessel", "speedAnomaly")
    return nested.select(
        F.col(event + "mmsi").alias("mmsi"),
        F.col(event + "latitude").alias("latitude"),
        F.col(event + "longitude").alias("longitude"),
        F.col(event + "speed").alias("speed"),
        F.col(event + "heading").alias("heading"),
        F.unix_millis(event + "timestamp").alias("ts_ms"),
        F.col(event + "eventType").alias("event_type"),
        F.col(event + "sourceType").alias("source_type"),
        *[
            (F.coalesce(F.col(name), F.lit(False)) if name in flags else F.col(name)).alias(flat_name)
            for flat_name, name in ENRICHED_NAMES.items()
        ],
        *keep,
    )
