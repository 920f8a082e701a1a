"""Small presentation expressions used by the serving views."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.constants import DAY_MS, FLAG_LABELS, FLAG_SEPARATOR


def utc_date(ts_ms: Column) -> Column:
    """UTC calendar date of an epoch-millisecond column, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(ts_ms / DAY_MS).cast("int"))


def with_date(reports: DataFrame) -> DataFrame:
    """Reports with the UTC ``date`` of their own time."""
    return reports if "date" in reports.columns else reports.withColumn("date", utc_date(F.col("ts_ms")))


def marker_class(level: Column, dark: Column) -> Column:
    return F.when(dark, "DARK").when(level.isin("HIGH", "MEDIUM"), level).otherwise("LOW")


def active_flags() -> Column:
    """Names of the raised flags, joined in fixed order; empty when none is raised."""
    return F.concat_ws(FLAG_SEPARATOR, *[F.when(F.col(name), label) for name, label in FLAG_LABELS])


def short_date(date: Column) -> Column:
    """``Mar 5``."""
    return F.date_format(date, "MMM d")


def two_decimals(value: Column) -> Column:
    """Rounded half away from zero on the decimal value, NULL kept."""
    return F.round(value.cast("decimal(18,9)"), 2).cast("double")


def correlation_id() -> Column:
    """The id a report came with, else one derived from its key: the same on every rerun."""
    minted = F.md5(F.concat_ws("|", "mmsi", F.col("ts_ms").cast("string"), F.col("seq").cast("string")))
    return F.coalesce(F.col("correlation_id"), minted)
