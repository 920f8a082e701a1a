"""Counters and rates over the routed reports. Every one reduces before the shuffle."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _count_if(condition: Column) -> Column:
    return F.sum(F.coalesce(condition, F.lit(False)).cast("long"))


def detection_counts(flagged: DataFrame) -> DataFrame:
    """Number of detections by type; a report may count under more than one."""
    totals = flagged.agg(*[_count_if(F.col(n)).alias(n) for n in ("loitering", "speed_anomaly", "dark_vessel")])
    return totals.unpivot([], ["loitering", "speed_anomaly", "dark_vessel"], "type", "detections")


def risk_mix(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("risk_level").agg(F.count("*").alias("events"))


def quarantine_by_reason(routed: DataFrame) -> DataFrame:
    quarantined = routed.where(F.col("reason_code").isNotNull())
    return quarantined.groupBy("reason_code").agg(F.count("*").alias("events"))


def _totals() -> list[Column]:
    return [
        F.count("*").alias("ingested"),
        _count_if(F.col("reason_code").isNull()).alias("enriched"),
        _count_if(F.col("reason_code").isNotNull()).alias("quarantined"),
    ]


def throughput(routed: DataFrame) -> DataFrame:
    """Ingested, enriched and quarantined totals."""
    return routed.agg(*_totals())


def dead_letter_total(parsed: DataFrame) -> DataFrame:
    return parsed.agg(_count_if(F.col("dead")).alias("dead_letters"))


_MINUTE_MS = 60_000


def _minute() -> Column:
    return (F.floor(F.col("ingest_ms") / _MINUTE_MS) * _MINUTE_MS).alias("minute_ms")


def rate_panes(routed: DataFrame) -> DataFrame:
    """Totals by minute of arrival; reports without an arrival time are in no minute."""
    return routed.where("ingest_ms IS NOT NULL").groupBy(_minute()).agg(*_totals())


def merge_rate_panes(panes: DataFrame) -> DataFrame:
    """One pane a minute from panes of parts of it."""
    return panes.groupBy("minute_ms").agg(*[F.sum(n).alias(n) for n in ("ingested", "enriched", "quarantined")])


def rates(panes: DataFrame) -> DataFrame:
    """Reports per second from one pane a minute."""
    names = ("ingested", "enriched", "quarantined")
    return panes.select("minute_ms", *[(F.col(n) / 60.0).alias(f"{n}_per_s") for n in names])


def rate_1m(routed: DataFrame) -> DataFrame:
    """Reports per second over tumbling minutes of arrival."""
    return rates(rate_panes(routed))


# Values a quantile sketch keeps; up to so many it is exact, beyond that its rank is off by some 0.15 %.
SKETCH_SIZE = 2_048
WINDOW_MINUTES = 5


def latency_panes(reports: DataFrame) -> DataFrame:
    """One sketch of ``latency_ms`` a minute of arrival, with its number of reports."""
    sketch = F.kll_sketch_agg_bigint(F.col("latency_ms").cast("bigint"), SKETCH_SIZE)
    return reports.where("ingest_ms IS NOT NULL").groupBy(_minute()).agg(sketch.alias("sketch"), F.count("*").alias("samples"))


def merge_latency_panes(panes: DataFrame) -> DataFrame:
    """One pane a minute from panes of parts of it."""
    return panes.groupBy("minute_ms").agg(
        F.kll_merge_agg_bigint("sketch", SKETCH_SIZE).alias("sketch"), F.sum("samples").alias("samples")
    )


def latencies(panes: DataFrame) -> DataFrame:
    """99th percentile over five minutes, every minute, from panes: sketches go to five windows, reports to none."""
    starts = F.sequence(
        F.col("minute_ms") - (WINDOW_MINUTES - 1) * _MINUTE_MS, F.col("minute_ms"), F.lit(_MINUTE_MS).cast("bigint")
    )
    merged = panes.withColumn("start_ms", F.explode(starts)).groupBy("start_ms").agg(
        F.kll_merge_agg_bigint("sketch", SKETCH_SIZE).alias("sketch"), F.sum("samples").alias("samples")
    )
    there = F.coalesce(F.kll_sketch_get_n_bigint("sketch"), F.lit(0)) > 0
    p99 = F.when(there, F.kll_sketch_get_quantile_bigint("sketch", F.lit(0.99)))
    return merged.select("start_ms", p99.alias("p99_ms"), "samples")


def latency_p99(reports: DataFrame) -> DataFrame:
    """99th percentile of ``latency_ms`` over five minutes of arrival, every minute."""
    return latencies(latency_panes(reports))
