"""Validation rules for a raw report, in order: the first that fails names the reason."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline import constants as C


def _outside(value: str, low: float, high: float) -> str:
    """Out of range; a missing value counts as out of range, and so does NaN (it sorts highest)."""
    return f"NOT coalesce({value} BETWEEN {low}D AND {high}D, false)"


def reason_code(arrival_ms: str = "ingest_ms") -> Column:
    """Code of the first failed rule, NULL for a valid report.

    Freshness is judged against the arrival time of the row, so a rerun gives the same answer.
    """
    rules = [
        (f"NOT coalesce(mmsi RLIKE r'{C.MMSI_PATTERN}', false)", C.REASON_MMSI),
        ("latitude = 0 AND longitude = 0", C.REASON_NULL_ISLAND),
        (_outside("latitude", -C.MAX_ABS_LATITUDE, C.MAX_ABS_LATITUDE), C.REASON_LATITUDE),
        (_outside("longitude", -C.MAX_ABS_LONGITUDE, C.MAX_ABS_LONGITUDE), C.REASON_LONGITUDE),
        ("ts_ms IS NULL", C.REASON_TIMESTAMP),
        (f"{arrival_ms} IS NULL", C.REASON_ARRIVAL),
        (f"abs({arrival_ms} - ts_ms) > {C.MAX_AGE_MS}", C.REASON_STALE),
        (_outside("speed", 0.0, C.MAX_SPEED_KN), C.REASON_SPEED),
    ]
    return F.expr("CASE " + " ".join(f"WHEN {rule} THEN '{code}'" for rule, code in rules) + " END")


def reason_text(code: str = "reason_code", arrival_ms: str = "ingest_ms") -> Column:
    """The reason as a person reads it, with the offending value in it."""

    def shown(value: str) -> str:
        return f"coalesce(cast({value} AS string), 'null')"

    # Fixed formats of the reason texts.
    texts = [
        (C.REASON_MMSI, f"concat('invalid MMSI: ', {shown('mmsi')})"),
        (C.REASON_NULL_ISLAND, "'null island (0,0)'"),
        (C.REASON_LATITUDE, f"concat('latitude out of range: ', {shown('latitude')})"),
        (C.REASON_LONGITUDE, f"concat('longitude out of range: ', {shown('longitude')})"),
        (C.REASON_TIMESTAMP, "'null timestamp'"),
        (C.REASON_ARRIVAL, "'null arrival time'"),
        (C.REASON_STALE, f"concat('timestamp too old/stale: ', {shown(f'abs({arrival_ms} - ts_ms)')}, 'ms')"),
        (C.REASON_SPEED, f"concat('speed out of range: ', {shown('speed')}, ' kn')"),
    ]
    return F.expr(f"CASE {code} " + " ".join(f"WHEN '{c}' THEN {text}" for c, text in texts) + f" ELSE {code} END")
