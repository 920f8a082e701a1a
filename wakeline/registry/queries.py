"""One named query per operator, each over all reports derived from the ``events`` table.

Floating results are rounded (distances 6 decimals, averages 9) so that they can be compared with
another engine; the operators themselves do not round.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline import constants as C
from wakeline.functions.geo import grid_snap, haversine_m, point_in_polygon
from wakeline.functions.hexgrid import hex_cell, hex_centroid
from wakeline.functions.labels import correlation_id, utc_date
from wakeline.operators import detect
from wakeline.operators.crossings import hex_crossings
from wakeline.operators.dedup import route
from wakeline.operators.enrich import enrich, enrich_crossings
from wakeline.operators.neighbours import with_neighbours
from wakeline.operators.ports import with_nearest_port
from wakeline.operators.tracks import resample, trail
from wakeline.operators.validate import check, explain_reason, valid
from wakeline.operators.zones import any_restricted, primary_zone, with_zones, zone_pairs
from wakeline.plans import batch, metrics, pipeline, serving
from wakeline.schemas import DAILY_STATS, RISK_PERCENTILES
from wakeline.settings import new_folder, stage, table_path
from wakeline.sources import avro_json, tables, tiers
from wakeline.sources.reference import seed_zones
from wakeline.sources.reports import events_as_reports, topic_of, union_channels
from wakeline.streaming import behaviour, jobs, routing
from wakeline.streaming import sources as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    """Register under the function's name; a trailing underscore keeps it apart from an import."""
    QUERIES[run.__name__.rstrip("_")] = run
    return run


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.accepted(events_as_reports(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.enriched(events_as_reports(spark, sf_dir))


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.flagged(events_as_reports(spark, sf_dir))


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = events_as_reports(spark, sf_dir)
    return route(raw)


def _cold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiers.as_cold(_flagged(spark, sf_dir))


def _rounded(name: str, decimals: int = 6, alias: str | None = None):
    return F.round(F.col(name), decimals).alias(alias or name)


# --- channels, validation, deduplication, routing ---


@query
def channel_route(spark, sf_dir):
    raw = events_as_reports(spark, sf_dir)
    return raw.select("seq", "source_type", topic_of(F.col("source_type")).alias("topic"))


@query
def raw_union(spark, sf_dir):
    raw = events_as_reports(spark, sf_dir)
    known = F.coalesce(F.col("source_type").isin(*C.CHANNEL_TOPICS), F.lit(False))
    channels = [raw.where(F.col("source_type") == kind) for kind in C.CHANNEL_TOPICS]
    return union_channels([*channels, raw.where(~known)]).select("seq", "mmsi", "source_type", "ts_ms")


@query
def correlation_id_(spark, sf_dir):
    return events_as_reports(spark, sf_dir).select("seq", correlation_id().alias("correlation_id"))


@query
def validate_reason(spark, sf_dir):
    return check(events_as_reports(spark, sf_dir)).select("seq", "mmsi", "reason_code")


@query
def dedup(spark, sf_dir):
    routed = _routed(spark, sf_dir)
    kept = F.col("reason_code").isNull() | (F.col("reason_code") == C.REASON_DUPLICATE)
    return routed.where(kept).select("seq", "mmsi", "ts_ms", F.col("reason_code").isNotNull().alias("duplicate"))


@query
def etl_route(spark, sf_dir):
    to = F.when(F.col("reason_code").isNull(), "enriched").otherwise("quarantine")
    return _routed(spark, sf_dir).select("seq", "mmsi", to.alias("route"), "reason_code")


@query
def quarantine(spark, sf_dir):
    return _routed(spark, sf_dir).where(F.col("reason_code").isNotNull()).select("seq", "mmsi", "ts_ms", "reason_code")


@query
def quarantine_text(spark, sf_dir):
    """Quarantined reports with their reason as text."""
    failed = _routed(spark, sf_dir).where(F.col("reason_code").isNotNull())
    return explain_reason(failed).select("seq", "mmsi", "reason_code", "reason")


@query
def quarantine_by_reason(spark, sf_dir):
    return metrics.quarantine_by_reason(_routed(spark, sf_dir))


@query
def throughput(spark, sf_dir):
    return metrics.throughput(_routed(spark, sf_dir))


@query
def rate_1m(spark, sf_dir):
    rates = ("ingested_per_s", "enriched_per_s", "quarantined_per_s")
    return metrics.rate_1m(_routed(spark, sf_dir)).select("minute_ms", *[_rounded(n, 9) for n in rates])


@query
def latency_p99(spark, sf_dir):
    """Here the latency of a report is its arrival less its own time."""
    raw = events_as_reports(spark, sf_dir)
    return metrics.latency_p99(raw.withColumn("latency_ms", F.col("ingest_ms") - F.col("ts_ms")))


# --- geometry ---


@query
def haversine(spark, sf_dir):
    """Metres from every valid report to the first port of the gazetteer."""
    _, _, lat, lon = C.SEED_PORTS[0]
    metres = haversine_m("latitude", "longitude", lat, lon)
    return valid(events_as_reports(spark, sf_dir)).select("seq", F.round(metres, 3).alias("metres"))


@query
def point_in_polygon_(spark, sf_dir):
    """The exact ring test alone, on every valid report, for each zone's ring."""
    checked = valid(events_as_reports(spark, sf_dir))
    columns = []
    for zone_id, _, _, west, south, east, north in C.SEED_ZONES:
        corners = [(west, south), (east, south), (east, north), (west, north)]
        ring = ", ".join(f"named_struct('lon', {x}D, 'lat', {y}D)" for x, y in corners)
        columns.append(point_in_polygon(f"array({ring})", "longitude", "latitude").alias(f"in_zone_{zone_id}"))
    return checked.select("seq", *columns)


@query
def grid_snap_(spark, sf_dir):
    checked = valid(events_as_reports(spark, sf_dir))
    return checked.select(
        "seq", grid_snap("latitude").alias("cell_lat"), grid_snap("longitude").alias("cell_lon")
    )


@query
def hex_cell_(spark, sf_dir):
    checked = valid(events_as_reports(spark, sf_dir))
    return checked.select("seq", hex_cell().alias("cell"))


@query
def hex_centroid_(spark, sf_dir):
    cells = hex_cell_(spark, sf_dir).select("cell").distinct()
    centre = hex_centroid()
    return cells.select("cell", F.round(centre["lat"], 9).alias("lat"), F.round(centre["lon"], 9).alias("lon"))


@query
def implied_speed(spark, sf_dir):
    placed = with_neighbours(_accepted(spark, sf_dir), before=detect.BEFORE)
    return placed.select("seq", "mmsi", F.round(detect.implied_speed(), 3).alias("implied_kn"))


@query
def bearing(spark, sf_dir):
    placed = with_neighbours(_accepted(spark, sf_dir), before=detect.BEFORE)
    return placed.select("seq", "mmsi", F.round(detect.bearing(), 6).alias("bearing_deg"))


@query
def track_resample(spark, sf_dir):
    hourly = resample(_accepted(spark, sf_dir), 3_600_000)
    return hourly.select("mmsi", "sample_ms", _rounded("latitude"), _rounded("longitude"))


@query
def trail_(spark, sf_dir):
    return trail(_accepted(spark, sf_dir)).select("mmsi", "position", "latitude", "longitude", "ts_ms")


# --- zones, ports, risk ---


@query
def zone_join(spark, sf_dir):
    return zone_pairs(with_zones(_accepted(spark, sf_dir), seed_zones(spark)), "seq")


@query
def zone_join_shuffled(spark, sf_dir):
    """The same join in the form used for a catalogue too large to broadcast."""
    points = _accepted(spark, sf_dir)
    return zone_pairs(with_zones(points, seed_zones(spark), max_broadcast_sides=0), "seq")


@query
def primary_zone_(spark, sf_dir):
    located = with_zones(_accepted(spark, sf_dir), seed_zones(spark))
    return located.select(
        "seq",
        any_restricted().alias("in_restricted_zone"),
        primary_zone()["name"].alias("zone_name"),
        primary_zone()["zone_type"].alias("zone_type"),
    )


@query
def zone_catalogue(spark, sf_dir):
    """Each zone with its extent and how many accepted reports lie in it."""
    zones = seed_zones(spark)
    counted = (
        zone_pairs(with_zones(_accepted(spark, sf_dir), zones))
        .where(F.col("zone_id").isNotNull())
        .groupBy(F.col("zone_id").alias("id"))
        .agg(F.count("*").alias("reports"))
    )
    extent = [
        F.array_min("ring.lon").alias("west"),
        F.array_min("ring.lat").alias("south"),
        F.array_max("ring.lon").alias("east"),
        F.array_max("ring.lat").alias("north"),
    ]
    return (
        zones.join(counted, "id", "left")
        .select("id", "name", "zone_type", *extent, F.coalesce("reports", F.lit(0)).alias("reports"))
    )


@query
def nearest_port(spark, sf_dir):
    placed = with_nearest_port(_accepted(spark, sf_dir), C.SEED_PORTS)
    return placed.select("seq", _rounded("distance_to_port"))


def _customer_ports(spark, sf_dir) -> DataFrame:
    """A port table that grows with the data: one place per customer, spread over the same waters."""
    customers = spark.read.parquet(table_path(sf_dir, "customer")).select("c_custkey")
    key = F.col("c_custkey").cast("long")
    return customers.select(
        key.alias("port_id"),
        F.col("c_custkey").cast("string").alias("name"),
        (F.lit(24) + ((key * 7919) % 12_000) / 1000.0).alias("latitude"),
        (F.lit(-98) + ((key * 104_729) % 19_000) / 1000.0).alias("longitude"),
    )


@query
def nearest_port_table(spark, sf_dir):
    """Nearest of a whole port table, by candidate lists per grid cell."""
    placed = with_nearest_port(_accepted(spark, sf_dir), _customer_ports(spark, sf_dir))
    return placed.select("seq", _rounded("distance_to_port"))


@query
def nearest_port_shuffled(spark, sf_dir):
    """The same in the form used when the candidate lists are too large to broadcast."""
    placed = with_nearest_port(_accepted(spark, sf_dir), _customer_ports(spark, sf_dir), max_broadcast=0)
    return placed.select("seq", _rounded("distance_to_port"))


@query
def risk_score(spark, sf_dir):
    return _enriched(spark, sf_dir).select("seq", "mmsi", "risk_score")


@query
def risk_level(spark, sf_dir):
    return _enriched(spark, sf_dir).select("seq", "mmsi", "risk_level")


@query
def risk_mix(spark, sf_dir):
    return metrics.risk_mix(_enriched(spark, sf_dir))


# --- detection ---


@query
def loitering(spark, sf_dir):
    return _flagged(spark, sf_dir).where("loitering").select("seq", "mmsi", "ts_ms", "speed")


@query
def loitering_dwell(spark, sf_dir):
    stays = detect.dwell(_accepted(spark, sf_dir)).where("loitering_dwell")
    return stays.select("seq", "mmsi", "ts_ms", "slow_since_ms", "dwell_ms")


@query
def speed_anomaly(spark, sf_dir):
    return _flagged(spark, sf_dir).where("speed_anomaly").select("seq", "mmsi", "ts_ms", "speed")


@query
def dark_vessel(spark, sf_dir):
    return _flagged(spark, sf_dir).where("dark_vessel").select("seq", "mmsi", "ts_ms", "silence_ms")


@query
def dark_vessel_day(spark, sf_dir):
    """Silences of more than a day."""
    raw = events_as_reports(spark, sf_dir)
    dark = pipeline.flagged(raw, limit_ms=C.DAY_MS).where("dark_vessel")
    return dark.select("seq", "mmsi", "ts_ms", "silence_ms")


@query
def dark_cleared(spark, sf_dir):
    back = detect.back_online(_accepted(spark, sf_dir))
    return back.select("seq", "mmsi", "ts_ms", "dark_since_ms", "silent_ms")


_DETECTION = ["mmsi", "ts_ms", "seq", "detection", *detect.FLAGS, "heading", "source_type", "event_type", "risk_level"]


@query
def detections(spark, sf_dir):
    return detect.detections(_flagged(spark, sf_dir)).select(*_DETECTION)


@query
def detection_counts(spark, sf_dir):
    return metrics.detection_counts(_flagged(spark, sf_dir))


@query
def enriched_flagged(spark, sf_dir):
    base = stage(_enriched(spark, sf_dir), "enriched")
    found = detect.detections(detect.flag(base, pipeline.last_arrival_ms(base)))
    merged = detect.merge_flags(base, found)
    return merged.select("seq", "mmsi", "ts_ms", "heading", "source_type", *detect.FLAGS)


_CROSSING = ["mmsi", "from_cell", "to_cell", "latitude", "longitude", "speed", "source_type", "ts_ms", "seq"]


@query
def hex_crossings_(spark, sf_dir):
    return hex_crossings(_accepted(spark, sf_dir)).select(*_CROSSING)


@query
def hex_enriched(spark, sf_dir):
    entered = enrich_crossings(hex_crossings(_accepted(spark, sf_dir)))
    return entered.select(
        "seq",
        "mmsi",
        "to_cell",
        _rounded("centroid_lat", 9),
        _rounded("centroid_lon", 9),
        "in_restricted_zone",
        "zone_name",
        "zone_type",
        _rounded("distance_to_port"),
        "risk_score",
        "risk_level",
    )


# --- batch ---


def _stats_rounded(stats: DataFrame) -> DataFrame:
    averages = ("avg_speed_kn", "avg_risk_score")
    return stats.withColumns({name: F.round(name, 9) for name in averages})


@query
def daily_stats(spark, sf_dir):
    return _stats_rounded(batch.daily_stats(_cold(spark, sf_dir)))


@query
def risk_percentiles(spark, sf_dir):
    return batch.risk_percentiles(_cold(spark, sf_dir))


@query
def hotspots(spark, sf_dir):
    return batch.hotspots(_cold(spark, sf_dir))


@query
def hotspots_coarse(spark, sf_dir):
    """Top 50 one-degree cells a day by all reports, so that cells hold more than one."""
    every = _cold(spark, sf_dir).withColumn("loitering", F.lit(True))
    return batch.hotspots(every, cell_deg=1.0)


@query
def idempotent_rerun(spark, sf_dir):
    """Daily statistics written twice to the same table, then read back."""
    root = new_folder(spark, "daily-stats")
    stats = stage(batch.daily_stats(_cold(spark, sf_dir)), "stats")
    tables.replace_dates(stats, root)
    tables.replace_dates(stats, root)
    written = spark.read.schema(stats.schema).parquet(root)
    return written.groupBy("date").agg(
        F.count("*").alias("vessels"), F.sum("event_count").alias("events")
    )


@query
def batch_run(spark, sf_dir):
    """The whole batch run twice over every date of a cold tier, then its two vessel-day tables joined."""
    root = new_folder(spark, "batch-run")
    tiers.write_cold(_cold(spark, sf_dir), f"{root}/cold")
    # One row a date of the tier.
    dates = [row["date"].isoformat() for row in tiers.scan_cold(spark, f"{root}/cold").select("date").distinct().collect()]
    for _ in range(2):
        batch.run_batch(spark, f"{root}/cold", f"{root}/out", *dates)
    stats = spark.read.schema(DAILY_STATS).parquet(f"{root}/out/vessel_daily_stats")
    percentiles = spark.read.schema(RISK_PERCENTILES).parquet(f"{root}/out/vessel_risk_percentiles")
    return stats.join(percentiles, ["mmsi", "date"]).select(
        "mmsi", "date", "event_count", "max_speed_kn", "speed_anomaly_count", "p50_risk", "p95_risk", "sample_count"
    )


# --- tiers ---


@query
def cold_scan(spark, sf_dir):
    """Write the cold tier, then read two of its dates."""
    root = new_folder(spark, "cold")
    tiers.write_cold(_cold(spark, sf_dir), root)
    found = tiers.scan_cold(spark, root, "2024-01-10", "2024-01-11")
    return found.select(
        "seq", F.col("vesselEvent.mmsi").alias("mmsi"), "ts_ms", "riskLevel", "loitering", "date"
    )


@query
def cold_latest(spark, sf_dir):
    """The last written copy of every valid report, replays included."""
    copies = valid(events_as_reports(spark, sf_dir)).withColumn("date", utc_date(F.col("ts_ms")))
    return tiers.latest_copy(copies, "mmsi").select("seq", "mmsi", "ts_ms", "ingest_ms", "date")


_HOT = ["mmsi", "seq", "risk_level", "risk_score", "in_restricted_zone", "zone_name", "zone_type", *detect.FLAGS]


@query
def hot_state(spark, sf_dir):
    return tiers.hot_table(_flagged(spark, sf_dir)).select(*_HOT)


@query
def hot_lookup(spark, sf_dir):
    """Point lookup of one vessel in a stored hot tier, of which it reads one bucket."""
    root = new_folder(spark, "hot")
    tiers.upsert_hot(_flagged(spark, sf_dir), root, 0)
    return tiers.lookup_hot(spark, root, "200000007").select(*_HOT)


@query
def hot_payload(spark, sf_dir):
    """The record read back out of the hot table's JSON payload."""
    hot = tiers.hot_table(_flagged(spark, sf_dir))
    record = hot.withColumn("record", tiers.read_payload(F.col("payload")))
    return record.select(
        "mmsi",
        F.col("record.vesselEvent.mmsi").alias("payload_mmsi"),
        F.unix_millis("record.vesselEvent.timestamp").alias("ts_ms"),
        F.col("record.vesselEvent.latitude").alias("latitude"),
        F.col("record.vesselEvent.longitude").alias("longitude"),
        F.col("record.vesselEvent.speed").alias("speed"),
        F.col("record.vesselEvent.sourceType").alias("source_type"),
        F.col("record.zoneName").alias("zone_name"),
        F.col("record.riskLevel").alias("risk_level"),
        F.col("record.darkVessel").alias("dark_vessel"),
    )


@query
def avro_json_normalise(spark, sf_dir):
    """Every enriched report out to Avro-JSON and back."""
    nested = tiers.as_cold(_enriched(spark, sf_dir))
    wire = avro_json.to_avro_json(nested, "seq")
    parsed = avro_json.parse_lines(wire).where(~F.col("dead"))
    records = avro_json.normalise(parsed.select("record.*", "seq"), "seq")
    return records.select(
        "seq",
        F.col("vesselEvent.mmsi").alias("mmsi"),
        F.unix_millis("vesselEvent.timestamp").alias("ts_ms"),
        F.col("vesselEvent.sourceType").alias("source_type"),
        "zoneName",
        "zoneType",
        "inRestrictedZone",
        "riskScore",
        "darkVessel",
    )


@query
def dead_letter(spark, sf_dir):
    """All enriched reports as lines, those of relayed vessels cut short; the cut ones are set aside."""
    nested = tiers.as_cold(_enriched(spark, sf_dir))
    lines = avro_json.to_avro_json(nested, "seq", F.col("vesselEvent.sourceType").alias("source_type"))
    cut = F.when(F.col("source_type") == "VESSEL", F.substring_index("line", ",", 5)).otherwise(F.col("line"))
    parsed = avro_json.parse_lines(lines.withColumn("line", cut))
    return parsed.groupBy("source_type").agg(
        F.sum(F.col("dead").cast("long")).alias("dead_letters"),
        F.sum((~F.col("dead")).cast("long")).alias("delivered"),
    )


# --- serving ---


def _history(spark, sf_dir) -> DataFrame:
    return serving.history(*batch.vessel_days(_cold(spark, sf_dir)))


@query
def history(spark, sf_dir):
    return _history(spark, sf_dir)


@query
def history_chart(spark, sf_dir):
    rows = serving.chart(_history(spark, sf_dir))
    return rows.select("mmsi", "date", "date_label", "position", "event_count", "p50_risk", "p95_risk")


@query
def serving_view(spark, sf_dir):
    flagged = stage(_flagged(spark, sf_dir), "flagged")
    rows = serving.history(*batch.vessel_days(tiers.as_cold(flagged)))
    return serving.serving_view(tiers.hot_table(flagged), rows).select(
        "mmsi", "date", "risk_level", "risk_score", "zone_name", "dark_vessel", "event_count", "avg_speed_kn", "p95_risk"
    )


@query
def marker_class(spark, sf_dir):
    return serving.fleet(tiers.hot_table(_flagged(spark, sf_dir))).select("mmsi", "marker_class")


@query
def active_flags(spark, sf_dir):
    return serving.fleet(tiers.hot_table(_flagged(spark, sf_dir))).select("mmsi", "active_flags")


# --- streams: run over everything there is, stop, and read what was written ---

STREAM_FILES = 4


def _delivered(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """A stream of these rows in several files of mixed order, one file a micro-batch."""
    rows.repartition(STREAM_FILES).write.parquet(path)
    return streams.stream_table(spark, path, rows.schema, files_per_trigger=1)


@query
def stream_etl_route(spark, sf_dir):
    """Validation, deduplication and routing of the events as a stream."""
    root = new_folder(spark, "stream-etl")
    jobs.start_etl(_delivered(spark, events_as_reports(spark, sf_dir), f"{root}/raw"), root).awaitTermination()
    to_enriched = routing.current(spark, root, "enriched").selectExpr(
        "seq", "mmsi", "'enriched' AS route", "cast(NULL AS string) AS reason_code"
    )
    to_quarantine = routing.current(spark, root, "quarantine").selectExpr(
        "seq", "mmsi", "'quarantine' AS route", "reason_code"
    )
    return to_enriched.unionByName(to_quarantine)


@query
def stream_detections(spark, sf_dir):
    """Behaviour and silence detected on the enriched stream."""
    root = new_folder(spark, "stream-detections")
    jobs.start_detection(_delivered(spark, _enriched(spark, sf_dir), f"{root}/in"), root).awaitTermination()
    return behaviour.detections_table(spark, root).where("detection <> 'back_online'").select(*_DETECTION)


@query
def stream_crossings(spark, sf_dir):
    """Cell crossings of the enriched stream."""
    root = new_folder(spark, "stream-crossings")
    jobs.start_crossings(_delivered(spark, _enriched(spark, sf_dir), f"{root}/in"), root).awaitTermination()
    return behaviour.crossings_table(spark, f"{root}/moves").select(*_CROSSING)
