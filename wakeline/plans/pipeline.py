"""From raw reports to flagged, enriched reports."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.constants import DEDUP_TTL_MS, SEED_PORTS, SILENCE_MS
from wakeline.operators.dedup import accept
from wakeline.operators.detect import flag
from wakeline.operators.enrich import enrich
from wakeline.operators.validate import valid


def accepted(raw: DataFrame, ttl_ms: int = DEDUP_TTL_MS) -> DataFrame:
    """Valid reports without their duplicates, as a table in the shared folder."""
    return accept(valid(raw), ttl_ms)


def enriched(
    raw: DataFrame, zones: DataFrame | None = None, ports: Sequence[tuple] | DataFrame = SEED_PORTS
) -> DataFrame:
    return enrich(accepted(raw), zones, ports)


def last_arrival_ms(reports: DataFrame) -> int:
    """The clock for silences still open: the last arrival. One number, from one column."""
    return reports.agg(F.max("ingest_ms")).first()[0]


def flagged(
    raw: DataFrame,
    zones: DataFrame | None = None,
    ports: Sequence[tuple] | DataFrame = SEED_PORTS,
    as_of_ms: int | None = None,
    limit_ms: int = SILENCE_MS,
) -> DataFrame:
    """Enriched reports with the three flags set."""
    kept = accepted(raw)
    clock = last_arrival_ms(kept) if as_of_ms is None else as_of_ms
    return flag(enrich(kept, zones, ports), clock, limit_ms)
