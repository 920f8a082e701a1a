"""The daily batch over the cold tier: vessel statistics, risk percentiles, loitering hotspots.

All three take cold-tier rows of any number of dates and group by the real date, so one run can cover
many days.
"""

from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.constants import HOTSPOT_CELL_DEG, HOTSPOT_TOP_N, PERCENTILE_ACCURACY
from wakeline.functions.geo import grid_snap
from wakeline.settings import stage, use_utc
from wakeline.sources.tables import replace_dates
from wakeline.sources.tiers import scan_cold

def _vessel_day(cold: DataFrame):
    return cold.groupBy(F.col("vesselEvent.mmsi").alias("mmsi"), "date")


def _count_true(name: str) -> Column:
    return F.sum(F.coalesce(F.col(name), F.lit(False)).cast("long"))


def _stats() -> list[Column]:
    return [
        F.count("*").alias("event_count"),
        F.avg("vesselEvent.speed").alias("avg_speed_kn"),
        F.max("vesselEvent.speed").alias("max_speed_kn"),
        F.avg("riskScore").alias("avg_risk_score"),
        _count_true("inRestrictedZone").alias("restricted_count"),
        _count_true("loitering").alias("loitering_count"),
        _count_true("darkVessel").alias("dark_vessel_count"),
        _count_true("speedAnomaly").alias("speed_anomaly_count"),
    ]


def _percentiles(accuracy: int) -> list[Column]:
    return [
        F.percentile_approx("riskScore", 0.5, accuracy).alias("p50_risk"),
        F.percentile_approx("riskScore", 0.95, accuracy).alias("p95_risk"),
        F.count("riskScore").alias("sample_count"),
    ]


def daily_stats(cold: DataFrame) -> DataFrame:
    """Counts, speed, risk and flag totals per vessel and day."""
    return _vessel_day(cold).agg(*_stats())


def risk_percentiles(cold: DataFrame, accuracy: int = PERCENTILE_ACCURACY) -> DataFrame:
    """Median and 95th percentile of risk per vessel and day; each is one of the scores.

    ``accuracy`` bounds the rank error at 1/accuracy; the sketches merge before the shuffle.
    """
    return _vessel_day(cold).agg(*_percentiles(accuracy))


def hotspots(
    cold: DataFrame, cell_deg: float = HOTSPOT_CELL_DEG, top_n: int | None = HOTSPOT_TOP_N
) -> DataFrame:
    """Per day, the grid cells with most loitering reports, with their distinct vessels.

    Counted per (cell, vessel) first, so a cell that holds a large share of all reports is spread
    over its vessels and reduced before it meets in one place. Ties go to the southern, then the
    western cell.
    """
    loitering = cold.where(F.col("loitering"))
    per_vessel = loitering.groupBy(
        "date",
        grid_snap("vesselEvent.latitude", cell_deg).alias("cell_lat"),
        grid_snap("vesselEvent.longitude", cell_deg).alias("cell_lon"),
        F.col("vesselEvent.mmsi").alias("mmsi"),
    ).agg(F.count("*").alias("events"))
    cells = per_vessel.groupBy("date", "cell_lat", "cell_lon").agg(
        F.sum("events").alias("event_count"), F.count("*").alias("vessel_count")
    )
    if top_n is None:
        return cells
    # The rank filter keeps at most top_n rows of a day in each task before the shuffle.
    busiest = Window.partitionBy("date").orderBy(F.desc("event_count"), "cell_lat", "cell_lon")
    return cells.withColumn("_rank", F.row_number().over(busiest)).where(F.col("_rank") <= top_n).drop("_rank")


def vessel_days(cold: DataFrame, accuracy: int = PERCENTILE_ACCURACY) -> tuple[DataFrame, DataFrame]:
    """Statistics and percentiles from one pass: they group alike, so they share scan and shuffle.

    The grouped rows, few next to the reports, are written once and both tables are cut from them.
    """
    both = stage(_vessel_day(cold).agg(*_stats(), *_percentiles(accuracy)), "vessel-days")
    percentiles = ["p50_risk", "p95_risk", "sample_count"]
    return both.drop(*percentiles), both.select("mmsi", "date", *percentiles)


def yesterday() -> str:
    return (datetime.now(UTC).date() - timedelta(days=1)).isoformat()


def run_batch(
    spark: SparkSession, cold_root: str, out_root: str, *dates: str, accuracy: int = PERCENTILE_ACCURACY
) -> None:
    """Run the three jobs in order for the given dates (default: yesterday), stopping at a failure.

    The hotspots read only the loitering rows. Each job replaces its own dates and no others.
    """
    if not cold_root.strip() or not out_root.strip():
        raise ValueError("cold_root and out_root must not be blank")
    wanted = [text.strip() for text in (dates or (yesterday(),))]
    for text in wanted:
        date.fromisoformat(text)
    use_utc(spark)
    cold = scan_cold(spark, cold_root, *wanted)
    stats, percentiles = vessel_days(cold, accuracy)
    replace_dates(stats, f"{out_root}/vessel_daily_stats")
    replace_dates(percentiles, f"{out_root}/vessel_risk_percentiles")
    replace_dates(hotspots(cold), f"{out_root}/loitering_hotspots")
