"""Validity check and the split into valid reports and quarantine."""

from pyspark.sql import DataFrame

from wakeline.functions.labels import correlation_id
from wakeline.functions.validation import reason_code, reason_text


def check(reports: DataFrame) -> DataFrame:
    """Add ``reason_code``: NULL for a valid report. A missing (null) report emits nothing.

    A report that came without a correlation id gets one here, which all outputs carry.
    """
    there = reports.where("seq IS NOT NULL")
    if "correlation_id" in there.columns:
        there = there.withColumn("correlation_id", correlation_id())
    return there.select("*", reason_code().alias("reason_code"))


def valid(reports: DataFrame) -> DataFrame:
    return check(reports).where("reason_code IS NULL").drop("reason_code")


def explain_reason(quarantined: DataFrame) -> DataFrame:
    """Add the reason as text."""
    return quarantined.select("*", reason_text().alias("reason"))
