"""Enriched records in Avro's JSON encoding: normalise, emit, and set bad lines aside."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wakeline.schemas import AVRO_JSON_ENRICHED


def normalise(wire: DataFrame, *keep: str) -> DataFrame:
    """Parsed Avro-JSON rows as plain nested records.

    ``{"string": v}`` becomes ``v``, a millisecond number becomes a timestamp, and a flag missing
    from an older record becomes false.
    """
    flags = ("inRestrictedZone", "loitering", "darkVessel", "speedAnomaly")
    event = "vesselEvent."
    return wire.select(
        F.struct(
            F.col(event + "mmsi").alias("mmsi"),
            F.col(event + "latitude").alias("latitude"),
            F.col(event + "longitude").alias("longitude"),
            F.col(event + "speed").alias("speed"),
            F.col(event + "heading").alias("heading"),
            F.timestamp_millis(event + "timestamp").alias("timestamp"),
            F.col(event + "eventType").alias("eventType"),
            F.col(event + "sourceType.string").alias("sourceType"),
        ).alias("vesselEvent"),
        F.col("zoneName.string").alias("zoneName"),
        F.col("zoneType.string").alias("zoneType"),
        "distanceToPort",
        "riskScore",
        "riskLevel",
        *[F.coalesce(F.col(name), F.lit(False)).alias(name) for name in flags],
        *keep,
    )


def _union_string(value: Column) -> Column:
    return F.when(value.isNotNull(), F.struct(value.alias("string")))


def to_avro_json(nested: DataFrame, *keep: str) -> DataFrame:
    """Nested records as one Avro-JSON line each, in column ``line``.

    Nulls are written, as Avro's encoder does.
    """
    event = F.col("vesselEvent")
    record = F.struct(
        F.struct(
            *[event[name].alias(name) for name in ("mmsi", "latitude", "longitude", "speed", "heading")],
            F.unix_millis(event["timestamp"]).alias("timestamp"),
            event["eventType"].alias("eventType"),
            _union_string(event["sourceType"]).alias("sourceType"),
        ).alias("vesselEvent"),
        "inRestrictedZone",
        _union_string(F.col("zoneName")).alias("zoneName"),
        _union_string(F.col("zoneType")).alias("zoneType"),
        "distanceToPort",
        "riskScore",
        "riskLevel",
        "loitering",
        "darkVessel",
        "speedAnomaly",
    )
    return nested.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("line"), *keep)


CORRUPT = "_corrupt_record"
_WITH_CORRUPT = StructType([*AVRO_JSON_ENRICHED.fields, StructField(CORRUPT, StringType())])


def parse_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Parse lines, keeping every row: ``record`` and, where it failed, ``dead`` = true.

    A line that is not JSON, or lacks the report or its key, is a poison record. Splitting on
    ``dead`` sends it to the dead-letter table while the rest continue.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.withColumn("record", F.from_json(F.col(line), _WITH_CORRUPT, options))
    bad = (
        F.col("record").isNull()
        | F.col(f"record.{CORRUPT}").isNotNull()
        | F.col("record.vesselEvent.mmsi").isNull()
        | F.col("record.vesselEvent.timestamp").isNull()
    )
    return parsed.withColumn("dead", bad)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Avro-JSON files, one record per line, as normalised nested records."""
    return normalise(spark.read.schema(AVRO_JSON_ENRICHED).json(path))
