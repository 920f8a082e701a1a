"""Small hand-made frames for the tests."""

from wakeline.schemas import RAW_REPORT
from wakeline.sources.tiers import COLD

DEFAULTS = {
    "mmsi": "123456789",
    "latitude": 29.0,
    "longitude": -90.0,
    "speed": 10.0,
    "heading": 90.0,
    "ts_ms": 1_710_500_000_000,
    "source_type": "TERRESTRIAL",
    "event_type": "AIS",
    "correlation_id": None,
}


def reports(spark, *changes: dict):
    """Raw reports that differ from a valid one in the given fields."""
    rows = []
    for number, change in enumerate(changes):
        row = {"seq": number, **DEFAULTS, **change}
        row.setdefault("ingest_ms", None if row["ts_ms"] is None else row["ts_ms"] + 2_000)
        rows.append(tuple(row[name] for name in RAW_REPORT.names))
    return spark.createDataFrame(rows, RAW_REPORT)


def cold(spark, *changes: dict):
    """Cold-tier rows; fields as in the nested record, ``lat``/``lon``/``speed``/``mmsi`` for the report."""
    from datetime import date, datetime

    rows = []
    for number, c in enumerate(changes):
        day = date.fromisoformat(c.get("date", "2024-03-15"))
        at = datetime(day.year, day.month, day.day, 12, 0, number % 60)
        event = (c.get("mmsi", "123456789"), c.get("lat", 29.0), c.get("lon", -90.0), c.get("speed", 10.0), 0.0, at, "AIS", None)
        rows.append(
            (
                event,
                c.get("restricted", False),
                None,
                None,
                50.0,
                c.get("risk", 10.0),
                "LOW",
                c.get("loitering", False),
                c.get("dark", False),
                c.get("anomaly", False),
                number,
                number,
                number,
                False,
                day,
            )
        )
    return spark.createDataFrame(rows, COLD)
