"""Serving views: latest state, history, chart rows and the merged view of a vessel."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.constants import HISTORY_ROWS
from wakeline.functions.labels import active_flags, marker_class, short_date, two_decimals
from wakeline.sources.tiers import lookup


def _average(name: str) -> Column:
    # A missing average reads 0, a missing percentile stays missing.
    return F.coalesce(two_decimals(F.col(name)), F.lit(0.0)).alias(name)


def history(
    stats: DataFrame, percentiles: DataFrame, mmsi: str | None = None, rows: int = HISTORY_ROWS
) -> DataFrame:
    """The newest ``rows`` daily rows of one vessel, or of every vessel.

    Days without percentiles stay. Both tables are keyed by (mmsi, date).
    """
    if mmsi is not None:
        stats = stats.where(F.col("mmsi") == mmsi)
    joined = stats.join(percentiles, ["mmsi", "date"], "left")
    newest = Window.partitionBy("mmsi").orderBy(F.desc("date"))
    kept = joined.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= rows)
    return kept.select(
        "mmsi",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        "event_count",
        _average("avg_speed_kn"),
        _average("max_speed_kn"),
        _average("avg_risk_score"),
        "restricted_count",
        "loitering_count",
        "dark_vessel_count",
        "speed_anomaly_count",
        two_decimals(F.col("p50_risk")).alias("p50_risk"),
        two_decimals(F.col("p95_risk")).alias("p95_risk"),
    )


def history_of(stats: DataFrame, percentiles: DataFrame, mmsi: str, rows: int = HISTORY_ROWS) -> DataFrame:
    """One vessel's history, newest first; empty when the batch holds nothing for it."""
    return history(stats, percentiles, mmsi, rows).orderBy(F.desc("date"))


def chart(history_rows: DataFrame) -> DataFrame:
    """History for plotting: oldest first with a short date label and the position on the axis."""
    oldest = Window.partitionBy("mmsi").orderBy("date")
    return history_rows.withColumns(
        {
            "date_label": short_date(F.to_date("date")),
            "position": F.row_number().over(oldest),
        }
    )


def fleet(hot: DataFrame) -> DataFrame:
    """The latest state of every vessel with its marker class and raised flags."""
    return hot.withColumns(
        {
            "marker_class": marker_class(F.col("risk_level"), F.col("dark_vessel")),
            "active_flags": active_flags(),
        }
    )


def latest(hot: DataFrame, mmsi: str) -> DataFrame:
    """The latest state of one vessel; an empty frame when it is unknown."""
    return lookup(hot, mmsi)


def serving_view(hot: DataFrame, history_rows: DataFrame) -> DataFrame:
    """Latest state beside each day of history; vessels known to only one side stay.

    At most one hot row and a bounded number of history rows a vessel, so no key is heavy.
    """
    state = hot.select("mmsi", "risk_level", "risk_score", "zone_name", "loitering", "dark_vessel", "speed_anomaly")
    return state.join(history_rows, "mmsi", "full_outer")
