"""Tracks: recent trail and resampling at a fixed cadence."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.constants import TRAIL_POINTS
from wakeline.operators.neighbours import ORDER, with_neighbours

# Steps generated at a time when a long gap is filled.
_STEPS_PER_BLOCK = 10_000


def trail(reports: DataFrame, points: int = TRAIL_POINTS) -> DataFrame:
    """The last ``points`` positions of each vessel, oldest first, without repeats in a row.

    Going back to an earlier place counts as a new position. The rank filter keeps at most
    ``points`` rows of a vessel in each task before the shuffle.
    """
    moved = with_neighbours(reports, before=("latitude", "longitude")).where(
        F.col("before").isNull()
        | (F.col("before.latitude") != F.col("latitude"))
        | (F.col("before.longitude") != F.col("longitude"))
    )
    newest = Window.partitionBy("mmsi").orderBy(*[F.col(name).desc() for name in ORDER])
    return (
        moved.select("mmsi", "latitude", "longitude", *ORDER)
        .withColumn("back", F.row_number().over(newest))
        .where(F.col("back") <= points)
        .withColumn("points", F.count("*").over(Window.partitionBy("mmsi")))
        .withColumn("position", F.col("points") - F.col("back") + 1)
        .drop("back", "points")
    )


def trail_lines(recent: DataFrame) -> DataFrame:
    """Trails as one row per vessel with an ordered array; bounded by the trail length."""
    point = F.struct("position", "latitude", "longitude")
    return recent.groupBy("mmsi").agg(F.array_sort(F.collect_list(point)).alias("trail"))


def resample(reports: DataFrame, cadence_ms: int) -> DataFrame:
    """Positions at whole multiples of ``cadence_ms``, on the straight line between two reports.

    A sample at the time of a report takes that report's position; nothing is added after a
    vessel's last report. Long gaps are filled block by block, so no row builds a long array.
    """
    pairs = with_neighbours(reports, after=("ts_ms", "latitude", "longitude")).where(
        F.col("after.ts_ms") > F.col("ts_ms")
    )
    first = F.ceil(F.col("ts_ms") / cadence_ms)
    last = F.floor((F.col("after.ts_ms") - 1) / cadence_ms)
    block = F.lit(_STEPS_PER_BLOCK)
    stepped = (
        pairs.withColumns({"_first": first, "_last": last})
        .where(F.col("_first") <= F.col("_last"))
        .withColumn("_from", F.explode(F.sequence("_first", "_last", block.cast("long"))))
        .withColumn(
            "_step", F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + block - 1, F.col("_last"))))
        )
        .withColumn("sample_ms", F.col("_step") * cadence_ms)
    )
    share = (F.col("sample_ms") - F.col("ts_ms")) / (F.col("after.ts_ms") - F.col("ts_ms"))

    def blend(name: str):
        return F.col(name) + (F.col(f"after.{name}") - F.col(name)) * share

    return stepped.select(
        "mmsi", "sample_ms", blend("latitude").alias("latitude"), blend("longitude").alias("longitude")
    )
