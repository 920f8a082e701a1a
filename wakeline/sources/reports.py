"""Raw position reports: the scan, the channel split and union, and the wire format."""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from wakeline.constants import CHANNEL_TOPICS, EVENT_TYPE_AIS
from wakeline.schemas import RAW_REPORT
from wakeline.settings import table_path, use_utc
from wakeline.sources.folders import path_exists

EVENTS = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)


def read_reports(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Raw reports at rest, with their fixed schema (an MMSI with leading zeros stays text)."""
    use_utc(spark)
    return spark.read.schema(RAW_REPORT).format(fmt).load(path)


def events_as_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the ``events`` table as a raw report.

    The table holds no ship positions, so identity, position and arrival are derived from its
    columns; some rows come out malformed or stale and some arrive twice, so that each rule has
    input. No row is left out. One scan: the second arrival is exploded, not a second read.
    """
    use_utc(spark)
    events = spark.read.schema(EVENTS).parquet(table_path(sf_dir, "events"))
    return reports_from_events(events)


def reports_from_events(events: DataFrame) -> DataFrame:
    """The mapping behind ``events_as_reports``, also usable on a streaming frame."""
    copied = events.selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "unix_millis(cast(ts AS timestamp)) AS ts_ms",
        "explode(CASE WHEN event_id % 50 = 0 THEN array(0, 1) ELSE array(0) END) AS copy",
    )
    return copied.selectExpr(
        "event_id * 2 + copy AS seq",
        "CASE WHEN event_id % 97 = 0 THEN '12345678A' ELSE cast(200000000 + user_id AS string) END AS mmsi",
        "CASE WHEN event_id % 89 = 0 THEN 0D WHEN event_id % 83 = 0 THEN 91D"
        " ELSE 25 + ((event_id * 37 + user_id * 613) % 10000) / 1000D END AS latitude",
        "CASE WHEN event_id % 89 = 0 THEN 0D WHEN event_id % 79 = 0 THEN 181D"
        " ELSE -97 + ((event_id * 53 + user_id * 911) % 17000) / 1000D END AS longitude",
        "CASE WHEN event_id % 101 = 0 THEN -1D ELSE value * 0.25D END AS speed",
        "cast((event_id * 7) % 360 AS double) AS heading",
        "ts_ms",
        "ts_ms + CASE WHEN event_id % 71 = 0 THEN 90000000 ELSE 2000 END + copy * 60000 AS ingest_ms",
        "CASE WHEN event_type IN ('click', 'view') THEN 'TERRESTRIAL' WHEN event_type = 'error' THEN 'VESSEL'"
        " ELSE 'SATELLITE' END AS source_type",
        f"'{EVENT_TYPE_AIS}' AS event_type",
        "CASE WHEN event_type = 'signup' THEN concat('signup-', cast(event_id AS string)) END AS correlation_id",
    )


#: Folder of reports whose source type has no channel.
NO_CHANNEL = "no-channel"


def topic_of(source_type: Column, topics: dict[str, str] = CHANNEL_TOPICS) -> Column:
    """Raw topic a report is published to; NULL for a source type without a channel."""
    topic = F.lit(None).cast("string")
    for kind, name in topics.items():
        topic = F.when(source_type == kind, name).otherwise(topic)
    return topic


def write_channels(reports: DataFrame, root: str, topics: dict[str, str] = CHANNEL_TOPICS) -> None:
    """Route each report to the folder of its topic in one pass; reports without a channel have one of their own."""
    topic = F.coalesce(topic_of(F.col("source_type"), topics), F.lit(NO_CHANNEL))
    reports.withColumn("topic", topic).write.partitionBy("topic").mode(
        "append"
    ).parquet(root)


def union_channels(channels: Iterable[DataFrame]) -> DataFrame:
    """All raw channels as one frame, columns matched by name."""
    return reduce(lambda left, right: left.unionByName(right), channels)


def read_channels(spark: SparkSession, root: str, topics: dict[str, str] = CHANNEL_TOPICS) -> DataFrame:
    """The union of the topic folders below ``root`` that are there, with reports without a channel."""
    folders = [f"{root}/topic={name}" for name in (*topics.values(), NO_CHANNEL)]
    there = [read_reports(spark, folder) for folder in folders if path_exists(spark, folder)]
    return union_channels(there) if there else spark.createDataFrame([], RAW_REPORT)
