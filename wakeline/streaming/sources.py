"""Streaming scans."""

from pyspark.sql import DataFrame, SparkSession

from wakeline.constants import CHANNEL_TOPICS
from wakeline.schemas import RAW_REPORT
from wakeline.settings import use_utc
from wakeline.sources.folders import is_folder, make_folder
from wakeline.sources.reports import EVENTS, NO_CHANNEL, reports_from_events, union_channels


# Bounds a micro-batch.
FILES_PER_TRIGGER = 256


def _files(spark: SparkSession, schema, path: str, files_per_trigger: int, **options: str) -> DataFrame:
    use_utc(spark)
    options["maxFilesPerTrigger"] = str(files_per_trigger)
    return spark.readStream.schema(schema).options(**options).parquet(path)


def stream_table(
    spark: SparkSession, path: str, schema, files_per_trigger: int = FILES_PER_TRIGGER
) -> DataFrame:
    """A folder of files written by another query, from the beginning."""
    return _files(spark, schema, path, files_per_trigger, recursiveFileLookup="true")


def stream_channels(
    spark: SparkSession,
    root: str,
    topics: dict[str, str] = CHANNEL_TOPICS,
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> DataFrame:
    """All raw channels as one stream, with reports without a channel. On Kafka this is one ``subscribe``.

    Folders that are not there yet are made, so that what is written to them later is read.
    """
    folders = [f"{root}/topic={name}" for name in (*topics.values(), NO_CHANNEL)]
    for folder in folders:
        make_folder(spark, folder)
    return union_channels(_files(spark, RAW_REPORT, folder, files_per_trigger) for folder in folders)


def stream_events(spark: SparkSession, sf_dir: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """The ``events`` table, one file or a folder of files, as a stream of raw reports."""
    table = f"{sf_dir}/events.parquet"
    if is_folder(spark, table):
        return reports_from_events(_files(spark, EVENTS, table, files_per_trigger))
    return reports_from_events(_files(spark, EVENTS, sf_dir, files_per_trigger, pathGlobFilter="events.parquet"))
