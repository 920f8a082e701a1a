"""Behaviour detectors over the neighbouring reports of a vessel.

Reports are ordered by their own time, then arrival number. All rules are column expressions on
``before`` and ``after``, so one pass gives every flag.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import constants as C
from wakeline.functions.geo import haversine_sql, implied_speed_sql, initial_bearing_deg
from wakeline.operators.neighbours import run_start, with_neighbours

BEFORE = ("ts_ms", "latitude", "longitude", "speed")
AFTER = ("ts_ms",)
FLAGS = ("loitering", "dark_vessel", "speed_anomaly")


def _whole_minutes(elapsed_ms: str) -> str:
    # Truncates towards zero, so a backward step is never a long stay.
    return f"({elapsed_ms}) DIV 60000"


def loitering() -> Column:
    """Slow now and slow at the previous report, at least five whole minutes apart."""
    return F.expr(
        f"coalesce(before.speed < {C.LOITER_SPEED_KN}D AND speed < {C.LOITER_SPEED_KN}D"
        f" AND {_whole_minutes('ts_ms - before.ts_ms')} >= {C.LOITER_MINUTES}, false)"
    )


def implied_speed() -> Column:
    """Speed implied by the last two positions; NULL on a first sighting or without elapsed time."""
    metres = haversine_sql("before.latitude", "before.longitude", "latitude", "longitude")
    return F.expr(implied_speed_sql(metres, "ts_ms - before.ts_ms"))


def speed_anomaly() -> Column:
    """Implied and reported speed differ by more than the limit."""
    metres = haversine_sql("before.latitude", "before.longitude", "latitude", "longitude")
    implied = implied_speed_sql(metres, "ts_ms - before.ts_ms")
    return F.expr(f"coalesce(abs({implied} - speed) > {C.ANOMALY_KN}D, false)")


def silence_ms(as_of_ms: int) -> Column:
    """Time until the next report, or until ``as_of_ms`` if none has come."""
    return F.expr(f"coalesce(after.ts_ms, {int(as_of_ms)}L) - ts_ms")


def bearing() -> Column:
    """Heading from the previous position to this one."""
    return initial_bearing_deg("before.latitude", "before.longitude", "latitude", "longitude")


def flag(enriched: DataFrame, as_of_ms: int, limit_ms: int = C.SILENCE_MS) -> DataFrame:
    """Set all three flags on every report, and add ``silence_ms``.

    ``dark_vessel`` marks the last report before a silence longer than the limit, once a silence.
    """
    placed = with_neighbours(enriched, before=BEFORE, after=AFTER)
    kept = [name for name in placed.columns if name not in (*FLAGS, "before", "after")]
    silent = placed.select(*kept, "before", silence_ms(as_of_ms).alias("silence_ms"))
    return silent.select(
        *kept,
        "silence_ms",
        loitering().alias("loitering"),
        F.expr(f"silence_ms > {int(limit_ms)}L AS dark_vessel"),
        speed_anomaly().alias("speed_anomaly"),
    )


def dwell(reports: DataFrame) -> DataFrame:
    """Loitering as a stay: slow without a break for at least five whole minutes.

    Adds ``slow_since_ms``, ``dwell_ms`` and ``loitering_dwell``.
    """
    runs = run_start(reports, f"speed < {C.LOITER_SPEED_KN}D", "slow_since_ms")
    return runs.selectExpr("*", "ts_ms - slow_since_ms AS dwell_ms").selectExpr(
        "*", f"coalesce({_whole_minutes('dwell_ms')} >= {C.LOITER_MINUTES}, false) AS loitering_dwell"
    )


def back_online(reports: DataFrame, limit_ms: int = C.SILENCE_MS) -> DataFrame:
    """The reports that end a silence, with ``silent_ms`` and when it began."""
    placed = with_neighbours(reports, before=("ts_ms",)).where(f"ts_ms - before.ts_ms > {int(limit_ms)}L")
    return placed.selectExpr(
        "*", "before.ts_ms AS dark_since_ms", "ts_ms - before.ts_ms AS silent_ms"
    ).drop("before")


def detections(flagged: DataFrame) -> DataFrame:
    """The detection feed, with ``detection`` = ``behaviour`` or ``dark``.

    A report flagged for loitering or speed is emitted as it is, not yet dark. A silence emits the
    last report rebuilt from what is kept of it: heading 0, no source type, its flags carried.
    """
    behaviour = F.col("loitering") | F.col("speed_anomaly")
    kinds = F.array_compact(
        F.array(F.when(behaviour, "behaviour"), F.when(F.col("dark_vessel"), "dark"))
    )
    is_dark = F.col("detection") == "dark"
    return (
        flagged.withColumn("detection", F.explode(kinds))
        .withColumns(
            {
                "dark_vessel": is_dark,
                "heading": F.when(is_dark, 0.0).otherwise(F.col("heading")),
                "source_type": F.when(~is_dark, F.col("source_type")),
                "event_type": F.when(is_dark, C.EVENT_TYPE_AIS).otherwise(F.col("event_type")),
            }
        )
    )


def merge_flags(base: DataFrame, detected: DataFrame) -> DataFrame:
    """Enriched reports with a flag raised wherever a detection of the same report raised it.

    The base row keeps its own heading and source type. Detections are reduced to one row per
    report before they are joined, so their order and repetition do not matter.
    """
    raised = detected.groupBy("mmsi", "ts_ms").agg(*[F.bool_or(name).alias(f"_{name}") for name in FLAGS])
    merged = base.join(raised, ["mmsi", "ts_ms"], "left")
    return merged.withColumns(
        {name: F.coalesce(F.col(name), F.lit(False)) | F.coalesce(F.col(f"_{name}"), F.lit(False)) for name in FLAGS}
    ).drop(*[f"_{name}" for name in FLAGS])
