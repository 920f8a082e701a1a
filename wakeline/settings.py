"""Session settings and the shared folder for intermediate tables."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def use_utc(spark: SparkSession) -> None:
    """Dates and timestamps of reports are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the session names none (a local run), a new temporary folder is set once.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        configured = spark.conf.get("spark.wakeline.dir", None)
    if configured is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="wakeline-")
        spark.conf.set("spark.wakeline.dir", configured)
    return configured.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder once and read it back.

    Used where several branches need the same rows: each branch then scans only its own
    columns, and a lost executor costs a re-read instead of the whole lineage.
    """
    spark = frame.sparkSession
    path = new_folder(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
