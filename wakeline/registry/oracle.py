"""Plain SQL for the named queries, written independently of the operators.

Whole histories are windowed here in one go, rectangles are compared directly and every port is
measured: what is simple on one machine and small data.
"""

RAW = """
raw AS (
  SELECT e.event_id * 2 + c.copy AS seq,
         CASE WHEN event_id % 97 = 0 THEN '12345678A' ELSE CAST(200000000 + user_id AS VARCHAR) END AS mmsi,
         CASE WHEN event_id % 89 = 0 THEN 0e0 WHEN event_id % 83 = 0 THEN 91e0
              ELSE 25 + ((event_id * 37 + user_id * 613) % 10000) / 1e3 END AS latitude,
         CASE WHEN event_id % 89 = 0 THEN 0e0 WHEN event_id % 79 = 0 THEN 181e0
              ELSE -97 + ((event_id * 53 + user_id * 911) % 17000) / 1e3 END AS longitude,
         CASE WHEN event_id % 101 = 0 THEN -1e0 ELSE value * 25e-2 END AS speed,
         CAST((event_id * 7) % 360 AS DOUBLE) AS heading,
         epoch_us(ts) // 1000 AS ts_ms,
         epoch_us(ts) // 1000 + CASE WHEN event_id % 71 = 0 THEN 90000000 ELSE 2000 END + c.copy * 60000 AS ingest_ms,
         CASE WHEN event_type IN ('click', 'view') THEN 'TERRESTRIAL' WHEN event_type = 'error' THEN 'VESSEL'
              ELSE 'SATELLITE' END AS source_type,
         'AIS' AS event_type,
         CASE WHEN event_type = 'signup' THEN 'signup-' || event_id END AS correlation_id
  FROM events e JOIN (VALUES (0), (1)) c(copy) ON c.copy = 0 OR e.event_id % 50 = 0
)"""

CHECKED = """
checked AS (
  SELECT *, CASE WHEN NOT regexp_full_match(mmsi, '[0-9]{9}') THEN 'mmsi'
                 WHEN latitude = 0 AND longitude = 0 THEN 'null_island'
                 WHEN latitude < -90 OR latitude > 90 THEN 'latitude'
                 WHEN longitude < -180 OR longitude > 180 THEN 'longitude'
                 WHEN ts_ms IS NULL THEN 'timestamp'
                 WHEN abs(ingest_ms - ts_ms) > 86400000 THEN 'stale'
                 WHEN speed < 0 OR speed > 102.2 THEN 'speed' END AS reason
  FROM raw
)"""

# At most two copies of a report exist in this data, so the window opened by the first decides.
ROUTED = """
routed AS (
  SELECT * EXCLUDE (reason),
         CASE WHEN reason IS NOT NULL THEN reason
              WHEN row_number() OVER w > 1 AND ingest_ms - first_value(ingest_ms) OVER w < 3600000
              THEN 'duplicate' END AS reason_code
  FROM checked
  WINDOW w AS (PARTITION BY mmsi, ts_ms, reason IS NULL ORDER BY ingest_ms, seq)
),
accepted AS (SELECT * EXCLUDE (reason_code) FROM routed WHERE reason_code IS NULL)"""

PLACES = """
zones(id, name, zone_type, rank, west, south, east, north) AS (VALUES
  (1, 'Gulf of Mexico Restricted Zone', 'RESTRICTED', 3, -88e0, 32e0, -85e0, 35e0),
  (2, 'Port of New Orleans', 'PORT', 2, -90.5e0, 29.5e0, -89.5e0, 30.2e0),
  (3, 'US Gulf Coast EEZ', 'EEZ', 1, -97e0, 25e0, -80e0, 30.5e0)
),
ports(name, plat, plon) AS (VALUES
  ('New Orleans', 29.95e0, -90.06e0), ('Houston', 29.73e0, -95.27e0), ('Tampa', 27.94e0, -82.45e0),
  ('Mobile', 30.69e0, -88.04e0), ('Corpus Christi', 27.81e0, -97.40e0), ('Havana', 23.14e0, -82.35e0)
)"""


def metres(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    half = (
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2)"
    )
    return f"2 * 6371000e0 * atan2(sqrt({half}), sqrt(greatest(0e0, 1 - ({half}))))"


def located(source: str, out: str, lat: str, lon: str) -> str:
    """CTEs adding zone and port context to ``source``, keyed by seq."""
    return f"""
{out}_zone AS (
  SELECT s.seq, arg_max(z.name, z.rank) AS zone_name, arg_max(z.zone_type, z.rank) AS zone_type,
         bool_or(z.zone_type = 'RESTRICTED') AS restricted
  FROM {source} s JOIN zones z
    ON s.{lon} > z.west AND s.{lon} < z.east AND s.{lat} > z.south AND s.{lat} < z.north
  GROUP BY s.seq
),
{out}_port AS (
  SELECT s.seq, min({metres(f's.{lat}', f's.{lon}', 'plat', 'plon')}) / 1852 AS distance_to_port
  FROM {source} s CROSS JOIN ports GROUP BY s.seq
),
{out}_context AS (
  SELECT s.*, coalesce(z.restricted, false) AS in_restricted_zone, z.zone_name, z.zone_type, p.distance_to_port,
         CASE WHEN z.restricted THEN 50e0 WHEN z.zone_type = 'PORT' THEN 20e0 WHEN z.zone_type = 'EEZ' THEN 10e0
              ELSE 0e0 END + CASE WHEN p.distance_to_port < 10 THEN 20e0 ELSE 0e0 END AS place_score
  FROM {source} s JOIN {out}_port p USING (seq) LEFT JOIN {out}_zone z USING (seq)
)"""


ENRICHED = (
    located("accepted", "a", "latitude", "longitude")
    + """,
enriched AS (
  SELECT *, place_score + CASE WHEN speed > 25 THEN 10e0 ELSE 0e0 END AS risk_score,
         CASE WHEN place_score + CASE WHEN speed > 25 THEN 10e0 ELSE 0e0 END >= 50 THEN 'HIGH'
              WHEN place_score + CASE WHEN speed > 25 THEN 10e0 ELSE 0e0 END >= 20 THEN 'MEDIUM'
              ELSE 'LOW' END AS risk_level,
         CAST(make_timestamp(ts_ms * 1000) AS DATE) AS date
  FROM a_context
)"""
)

MOVES = f"""
paired AS (
  SELECT *, lag(ts_ms) OVER w AS prev_ms, lag(latitude) OVER w AS prev_lat, lag(longitude) OVER w AS prev_lon,
         lag(speed) OVER w AS prev_speed, lead(ts_ms) OVER w AS next_ms, lead(latitude) OVER w AS next_lat,
         lead(longitude) OVER w AS next_lon
  FROM accepted WINDOW w AS (PARTITION BY mmsi ORDER BY ts_ms, seq)
),
moves AS (
  SELECT *, CASE WHEN ts_ms > prev_ms THEN
              ({metres('prev_lat', 'prev_lon', 'latitude', 'longitude')} / 1852) / ((ts_ms - prev_ms) / 3600000e0)
            END AS implied_kn,
         coalesce(next_ms, (SELECT max(ingest_ms) FROM accepted)) - ts_ms AS silence_ms
  FROM paired
)"""

FLAGGED = """
flagged AS (
  SELECT e.*, m.silence_ms,
         coalesce(m.prev_speed < 1 AND e.speed < 1 AND (e.ts_ms - m.prev_ms) // 60000 >= 5, false) AS loitering,
         coalesce(abs(m.implied_kn - e.speed) > 15, false) AS speed_anomaly,
         m.silence_ms > 600000 AS dark_vessel
  FROM enriched e JOIN moves m USING (seq)
)"""

# Sides of one hexagon cell: fractional axial coordinates, then the rounded ones.
HEX = """
axial AS (
  SELECT *, (sqrt(3e0) / 3e0 * longitude - latitude / 3e0) / 0.0127e0 AS q, (2e0 / 3e0 * latitude) / 0.0127e0 AS r
  FROM {source}
),
rounded AS (
  SELECT *, floor(q + 0.5e0) AS rq, floor(r + 0.5e0) AS rr, floor(-q - r + 0.5e0) AS rs,
         abs(floor(q + 0.5e0) - q) AS dq, abs(floor(r + 0.5e0) - r) AS dr,
         abs(floor(-q - r + 0.5e0) - (-q - r)) AS ds
  FROM axial
),
celled AS (
  SELECT * EXCLUDE (q, r, rq, rr, rs, dq, dr, ds),
         CAST(CAST(CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END AS BIGINT) AS VARCHAR) || ':' ||
         CAST(CAST(CASE WHEN dq > dr AND dq > ds THEN rr WHEN dr > ds THEN -rq - rs ELSE rr END AS BIGINT) AS VARCHAR)
         AS cell
  FROM rounded
)"""

CROSSINGS = """
crossings AS (
  SELECT mmsi, from_cell, cell AS to_cell, latitude, longitude, speed, source_type, ts_ms, seq,
         CAST(split_part(cell, ':', 2) AS DOUBLE) * (0.0127e0 * 1.5e0) AS centroid_lat,
         (0.0127e0 * sqrt(3e0)) * (CAST(split_part(cell, ':', 1) AS DOUBLE)
                                   + CAST(split_part(cell, ':', 2) AS DOUBLE) / 2) AS centroid_lon
  FROM (SELECT *, lag(cell) OVER (PARTITION BY mmsi ORDER BY ts_ms, seq) AS from_cell FROM celled)
  WHERE from_cell <> cell
)"""

DAILY = """
daily AS (
  SELECT mmsi, date, count(*) AS event_count, avg(speed) AS avg_speed_kn, max(speed) AS max_speed_kn,
         avg(risk_score) AS avg_risk_score,
         CAST(sum(CAST(in_restricted_zone AS INT)) AS BIGINT) AS restricted_count,
         CAST(sum(CAST(loitering AS INT)) AS BIGINT) AS loitering_count,
         CAST(sum(CAST(dark_vessel AS INT)) AS BIGINT) AS dark_vessel_count,
         CAST(sum(CAST(speed_anomaly AS INT)) AS BIGINT) AS speed_anomaly_count
  FROM flagged GROUP BY mmsi, date
),
percentiles AS (
  SELECT mmsi, date, quantile_disc(risk_score, 0.5) AS p50_risk, quantile_disc(risk_score, 0.95) AS p95_risk,
         count(*) AS sample_count
  FROM flagged GROUP BY mmsi, date
)"""

HISTORY = """
history AS (
  SELECT mmsi, strftime(date, '%Y-%m-%d') AS date, event_count,
         coalesce(CAST(round(CAST(avg_speed_kn AS DECIMAL(18,9)), 2) AS DOUBLE), 0) AS avg_speed_kn,
         coalesce(CAST(round(CAST(max_speed_kn AS DECIMAL(18,9)), 2) AS DOUBLE), 0) AS max_speed_kn,
         coalesce(CAST(round(CAST(avg_risk_score AS DECIMAL(18,9)), 2) AS DOUBLE), 0) AS avg_risk_score,
         restricted_count, loitering_count, dark_vessel_count, speed_anomaly_count,
         CAST(round(CAST(p50_risk AS DECIMAL(18,9)), 2) AS DOUBLE) AS p50_risk,
         CAST(round(CAST(p95_risk AS DECIMAL(18,9)), 2) AS DOUBLE) AS p95_risk
  FROM (SELECT d.*, p.p50_risk, p.p95_risk, row_number() OVER (PARTITION BY d.mmsi ORDER BY d.date DESC) AS n
        FROM daily d LEFT JOIN percentiles p ON d.mmsi = p.mmsi AND d.date = p.date)
  WHERE n <= 90
)"""

HOT = """
hot AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY ingest_ms DESC, seq DESC) AS n FROM flagged)
  WHERE n = 1
)"""

_CHECKED = [RAW, CHECKED]
_ROUTED = [*_CHECKED, ROUTED]
_ENRICHED = [*_ROUTED, PLACES, ENRICHED]
_MOVES = [*_ROUTED, MOVES]
_FLAGGED = [*_ENRICHED, MOVES, FLAGGED]
_DAILY = [*_FLAGGED, DAILY]
_HISTORY = [*_DAILY, HISTORY]
_HOT = [*_FLAGGED, HOT]
_CELLS = [*_CHECKED, "valid AS (SELECT * FROM checked WHERE reason IS NULL)", HEX.format(source="valid")]
_CROSSINGS = [*_ROUTED, HEX.format(source="accepted"), CROSSINGS]


def _sql(ctes: list[str], select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


def _hotspots(where: str, cell: str) -> str:
    return f"""
SELECT date, cell_lat, cell_lon, event_count, vessel_count FROM (
  SELECT *, row_number() OVER (PARTITION BY date ORDER BY event_count DESC, cell_lat, cell_lon) AS n FROM (
    SELECT date, round(floor(latitude / {cell}) * {cell}, 6) AS cell_lat,
           round(floor(longitude / {cell}) * {cell}, 6) AS cell_lon,
           count(*) AS event_count, count(DISTINCT mmsi) AS vessel_count
    FROM flagged WHERE {where} GROUP BY 1, 2, 3))
WHERE n <= 50"""


_TABLE_PORTS = (
    "SELECT a.seq, round(min("
    + metres("a.latitude", "a.longitude", "c.plat", "c.plon")
    + """) / 1852, 6) AS distance_to_port
FROM accepted a CROSS JOIN (
  SELECT 24 + ((c_custkey * 7919) % 12000) / 1e3 AS plat, -98 + ((c_custkey * 104729) % 19000) / 1e3 AS plon
  FROM (SELECT CAST(c_custkey AS BIGINT) AS c_custkey FROM customer)) c
GROUP BY a.seq"""
)

_ZONE_PAIRS = """
SELECT a.seq, CAST(z.id AS BIGINT) AS zone_id, z.name AS zone_name, z.zone_type FROM accepted a LEFT JOIN zones z
  ON longitude > west AND longitude < east AND latitude > south AND latitude < north"""

_HOT_COLUMNS = """mmsi, seq, risk_level, risk_score, in_restricted_zone, zone_name, zone_type, loitering,
  dark_vessel, speed_anomaly"""

_RUNS = """
slow AS (
  SELECT *, sum(CAST(speed >= 1 AS INT)) OVER (PARTITION BY mmsi ORDER BY ts_ms, seq) AS run FROM accepted
),
stays AS (
  SELECT *, min(ts_ms) OVER (PARTITION BY mmsi, run) AS slow_since_ms FROM slow WHERE speed < 1
)"""

_TRAIL = """
changes AS (
  SELECT *, lag(latitude) OVER w AS plat, lag(longitude) OVER w AS plon, row_number() OVER w AS n
  FROM accepted WINDOW w AS (PARTITION BY mmsi ORDER BY ts_ms, seq)
),
moved AS (
  SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY ts_ms DESC, seq DESC) AS back
  FROM changes WHERE n = 1 OR latitude <> plat OR longitude <> plon
)"""

_DETECTIONS = """
found AS (
  SELECT mmsi, ts_ms, seq, 'behaviour' AS detection, loitering, false AS dark_vessel, speed_anomaly, heading,
         source_type, event_type, risk_level
  FROM flagged WHERE loitering OR speed_anomaly
  UNION ALL
  SELECT mmsi, ts_ms, seq, 'dark', loitering, true, speed_anomaly, 0e0, NULL, 'AIS', risk_level
  FROM flagged WHERE dark_vessel
)"""

ORACLE: dict[str, str] = {
    "channel_route": _sql(
        [RAW],
        """SELECT seq, source_type, CASE source_type WHEN 'TERRESTRIAL' THEN 'ais.raw.terrestrial'
             WHEN 'SATELLITE' THEN 'ais.raw.satellite' WHEN 'VESSEL' THEN 'ais.raw.vessel' END AS topic FROM raw""",
    ),
    "raw_union": _sql([RAW], "SELECT seq, mmsi, source_type, ts_ms FROM raw"),
    "correlation_id": _sql(
        [RAW],
        "SELECT seq, coalesce(correlation_id, md5(mmsi || '|' || ts_ms || '|' || seq)) AS correlation_id FROM raw",
    ),
    "validate_reason": _sql(_CHECKED, "SELECT seq, mmsi, reason AS reason_code FROM checked"),
    "dedup": _sql(
        _ROUTED,
        """SELECT seq, mmsi, ts_ms, reason_code IS NOT NULL AS duplicate FROM routed
           WHERE reason_code IS NULL OR reason_code = 'duplicate'""",
    ),
    "etl_route": _sql(
        _ROUTED,
        """SELECT seq, mmsi, CASE WHEN reason_code IS NULL THEN 'enriched' ELSE 'quarantine' END AS route, reason_code
           FROM routed""",
    ),
    "quarantine": _sql(_ROUTED, "SELECT seq, mmsi, ts_ms, reason_code FROM routed WHERE reason_code IS NOT NULL"),
    "quarantine_text": _sql(
        _ROUTED,
        """SELECT seq, mmsi, reason_code, CASE reason_code
             WHEN 'mmsi' THEN 'invalid MMSI: ' || coalesce(mmsi, 'null')
             WHEN 'null_island' THEN 'null island (0,0)'
             WHEN 'latitude' THEN 'latitude out of range: ' || coalesce(CAST(latitude AS VARCHAR), 'null')
             WHEN 'longitude' THEN 'longitude out of range: ' || coalesce(CAST(longitude AS VARCHAR), 'null')
             WHEN 'timestamp' THEN 'null timestamp'
             WHEN 'stale' THEN 'timestamp too old/stale: ' || abs(ingest_ms - ts_ms) || 'ms'
             WHEN 'speed' THEN 'speed out of range: ' || coalesce(CAST(speed AS VARCHAR), 'null') || ' kn'
             ELSE reason_code END AS reason
           FROM routed WHERE reason_code IS NOT NULL""",
    ),
    "quarantine_by_reason": _sql(
        _ROUTED, "SELECT reason_code, count(*) AS events FROM routed WHERE reason_code IS NOT NULL GROUP BY 1"
    ),
    "throughput": _sql(
        _ROUTED,
        """SELECT count(*) AS ingested, count(*) FILTER (reason_code IS NULL) AS enriched,
                  count(*) FILTER (reason_code IS NOT NULL) AS quarantined FROM routed""",
    ),
    "rate_1m": _sql(
        _ROUTED,
        """SELECT ingest_ms // 60000 * 60000 AS minute_ms, round(count(*) / 60e0, 9) AS ingested_per_s,
                  round(count(*) FILTER (reason_code IS NULL) / 60e0, 9) AS enriched_per_s,
                  round(count(*) FILTER (reason_code IS NOT NULL) / 60e0, 9) AS quarantined_per_s
           FROM routed GROUP BY 1""",
    ),
    "latency_p99": _sql(
        [RAW],
        """SELECT ingest_ms // 60000 * 60000 - k * 60000 AS start_ms,
                  quantile_disc(ingest_ms - ts_ms, 0.99) AS p99_ms, count(*) AS samples
           FROM raw CROSS JOIN range(5) t(k) GROUP BY 1""",
    ),
    "haversine": _sql(
        _CHECKED,
        f"""SELECT seq, round({metres('latitude', 'longitude', '29.95e0', '-90.06e0')}, 3) AS metres
            FROM checked WHERE reason IS NULL""",
    ),
    "point_in_polygon": _sql(
        _CHECKED,
        """SELECT seq, longitude > -88 AND longitude < -85 AND latitude > 32 AND latitude < 35 AS in_zone_1,
                  longitude > -90.5 AND longitude < -89.5 AND latitude > 29.5 AND latitude < 30.2 AS in_zone_2,
                  longitude > -97 AND longitude < -80 AND latitude > 25 AND latitude < 30.5 AS in_zone_3
           FROM checked WHERE reason IS NULL""",
    ),
    "grid_snap": _sql(
        _CHECKED,
        """SELECT seq, round(floor(latitude / 1e-1) * 1e-1, 6) AS cell_lat,
                  round(floor(longitude / 1e-1) * 1e-1, 6) AS cell_lon FROM checked WHERE reason IS NULL""",
    ),
    "hex_cell": _sql(_CELLS, "SELECT seq, cell FROM celled"),
    "hex_centroid": _sql(
        _CELLS,
        """SELECT cell, round((0.0127e0 * 1.5e0) * CAST(split_part(cell, ':', 2) AS DOUBLE), 9) AS lat,
                  round((0.0127e0 * sqrt(3e0)) * (CAST(split_part(cell, ':', 1) AS DOUBLE)
                        + CAST(split_part(cell, ':', 2) AS DOUBLE) / 2), 9) AS lon
           FROM (SELECT DISTINCT cell FROM celled)""",
    ),
    "implied_speed": _sql(_MOVES, "SELECT seq, mmsi, round(implied_kn, 3) AS implied_kn FROM moves"),
    "bearing": _sql(
        _MOVES,
        """SELECT seq, mmsi, round((degrees(atan2(
                    sin(radians(longitude) - radians(prev_lon)) * cos(radians(latitude)),
                    cos(radians(prev_lat)) * sin(radians(latitude)) - sin(radians(prev_lat)) * cos(radians(latitude))
                      * cos(radians(longitude) - radians(prev_lon)))) + 360) % 360, 6) AS bearing_deg
           FROM moves""",
    ),
    "track_resample": _sql(
        _MOVES,
        """SELECT mmsi, hour * 3600000 AS sample_ms,
                  round(latitude + (next_lat - latitude) * ((hour * 3600000 - ts_ms) / CAST(next_ms - ts_ms AS DOUBLE)), 6)
                    AS latitude,
                  round(longitude + (next_lon - longitude) * ((hour * 3600000 - ts_ms) / CAST(next_ms - ts_ms AS DOUBLE)), 6)
                    AS longitude
           FROM (SELECT *, unnest(range((ts_ms + 3599999) // 3600000, (next_ms - 1) // 3600000 + 1)) AS hour
                 FROM moves WHERE next_ms > ts_ms)""",
    ),
    "trail": _sql(
        [*_ROUTED, _TRAIL],
        """SELECT mmsi, count(*) OVER (PARTITION BY mmsi) - back + 1 AS position, latitude, longitude, ts_ms
           FROM moved WHERE back <= 60""",
    ),
    "zone_join": _sql([*_ROUTED, PLACES], _ZONE_PAIRS),
    "zone_join_shuffled": _sql([*_ROUTED, PLACES], _ZONE_PAIRS),
    "primary_zone": _sql(_ENRICHED, "SELECT seq, in_restricted_zone, zone_name, zone_type FROM enriched"),
    "zone_catalogue": _sql(
        [*_ROUTED, PLACES],
        """SELECT CAST(id AS BIGINT) AS id, name, zone_type, west, south, east, north, count(seq) AS reports
           FROM zones LEFT JOIN accepted
             ON longitude > west AND longitude < east AND latitude > south AND latitude < north
           GROUP BY ALL""",
    ),
    "nearest_port": _sql(_ENRICHED, "SELECT seq, round(distance_to_port, 6) AS distance_to_port FROM enriched"),
    "nearest_port_table": _sql(_ROUTED, _TABLE_PORTS),
    "nearest_port_shuffled": _sql(_ROUTED, _TABLE_PORTS),
    "risk_score": _sql(_ENRICHED, "SELECT seq, mmsi, risk_score FROM enriched"),
    "risk_level": _sql(_ENRICHED, "SELECT seq, mmsi, risk_level FROM enriched"),
    "risk_mix": _sql(_ENRICHED, "SELECT risk_level, count(*) AS events FROM enriched GROUP BY 1"),
    "loitering": _sql(_FLAGGED, "SELECT seq, mmsi, ts_ms, speed FROM flagged WHERE loitering"),
    "loitering_dwell": _sql(
        [*_ROUTED, _RUNS],
        """SELECT seq, mmsi, ts_ms, slow_since_ms, ts_ms - slow_since_ms AS dwell_ms FROM stays
           WHERE (ts_ms - slow_since_ms) // 60000 >= 5""",
    ),
    "speed_anomaly": _sql(_FLAGGED, "SELECT seq, mmsi, ts_ms, speed FROM flagged WHERE speed_anomaly"),
    "dark_vessel": _sql(_FLAGGED, "SELECT seq, mmsi, ts_ms, silence_ms FROM flagged WHERE dark_vessel"),
    "dark_vessel_day": _sql(_FLAGGED, "SELECT seq, mmsi, ts_ms, silence_ms FROM flagged WHERE silence_ms > 86400000"),
    "dark_cleared": _sql(
        _MOVES,
        """SELECT seq, mmsi, ts_ms, prev_ms AS dark_since_ms, ts_ms - prev_ms AS silent_ms FROM moves
           WHERE ts_ms - prev_ms > 600000""",
    ),
    "detections": _sql([*_FLAGGED, _DETECTIONS], "SELECT * FROM found"),
    "detection_counts": _sql(
        _FLAGGED,
        """SELECT 'loitering' AS type, count(*) FILTER (loitering) AS detections FROM flagged
           UNION ALL SELECT 'speed_anomaly', count(*) FILTER (speed_anomaly) FROM flagged
           UNION ALL SELECT 'dark_vessel', count(*) FILTER (dark_vessel) FROM flagged""",
    ),
    "enriched_flagged": _sql(
        _FLAGGED, "SELECT seq, mmsi, ts_ms, heading, source_type, loitering, dark_vessel, speed_anomaly FROM flagged"
    ),
    "hex_crossings": _sql(
        _CROSSINGS, "SELECT mmsi, from_cell, to_cell, latitude, longitude, speed, source_type, ts_ms, seq FROM crossings"
    ),
    "hex_enriched": _sql(
        [*_CROSSINGS, PLACES, located("crossings", "x", "centroid_lat", "centroid_lon")],
        """SELECT seq, mmsi, to_cell, round(centroid_lat, 9) AS centroid_lat, round(centroid_lon, 9) AS centroid_lon,
                  in_restricted_zone, zone_name, zone_type, round(distance_to_port, 6) AS distance_to_port,
                  place_score AS risk_score,
                  CASE WHEN place_score >= 50 THEN 'HIGH' WHEN place_score >= 20 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
           FROM x_context""",
    ),
    "daily_stats": _sql(
        _DAILY,
        """SELECT mmsi, date, event_count, round(avg_speed_kn, 9) AS avg_speed_kn, max_speed_kn,
                  round(avg_risk_score, 9) AS avg_risk_score, restricted_count, loitering_count, dark_vessel_count,
                  speed_anomaly_count FROM daily""",
    ),
    "risk_percentiles": _sql(_DAILY, "SELECT * FROM percentiles"),
    "hotspots": _sql(_FLAGGED, _hotspots("loitering", "1e-1")),
    "hotspots_coarse": _sql(_FLAGGED, _hotspots("true", "1e0")),
    "idempotent_rerun": _sql(
        _DAILY, "SELECT date, count(*) AS vessels, CAST(sum(event_count) AS BIGINT) AS events FROM daily GROUP BY 1"
    ),
    "batch_run": _sql(
        _DAILY,
        """SELECT mmsi, date, event_count, max_speed_kn, speed_anomaly_count, p50_risk, p95_risk, sample_count
           FROM daily JOIN percentiles USING (mmsi, date)""",
    ),
    "cold_scan": _sql(
        _FLAGGED,
        """SELECT seq, mmsi, ts_ms, risk_level AS "riskLevel", loitering, date FROM flagged
           WHERE date IN (DATE '2024-01-10', DATE '2024-01-11')""",
    ),
    "cold_latest": _sql(
        _CHECKED,
        """SELECT seq, mmsi, ts_ms, ingest_ms, CAST(make_timestamp(ts_ms * 1000) AS DATE) AS date FROM (
             SELECT *, row_number() OVER (PARTITION BY mmsi, ts_ms ORDER BY ingest_ms DESC, seq DESC) AS n
             FROM checked WHERE reason IS NULL) WHERE n = 1""",
    ),
    "hot_state": _sql(_HOT, f"SELECT {_HOT_COLUMNS} FROM hot"),
    "hot_lookup": _sql(_HOT, f"SELECT {_HOT_COLUMNS} FROM hot WHERE mmsi = '200000007'"),
    "hot_payload": _sql(
        _HOT,
        """SELECT mmsi, mmsi AS payload_mmsi, ts_ms, latitude, longitude, speed, source_type, zone_name, risk_level,
                  dark_vessel FROM hot""",
    ),
    "avro_json_normalise": _sql(
        _ENRICHED,
        """SELECT seq, mmsi, ts_ms, source_type, zone_name AS "zoneName", zone_type AS "zoneType",
                  in_restricted_zone AS "inRestrictedZone", risk_score AS "riskScore", false AS "darkVessel"
           FROM enriched""",
    ),
    "dead_letter": _sql(
        _ROUTED,
        """SELECT source_type, count(*) FILTER (source_type = 'VESSEL') AS dead_letters,
                  count(*) FILTER (source_type <> 'VESSEL') AS delivered FROM accepted GROUP BY 1""",
    ),
    "history": _sql(_HISTORY, "SELECT * FROM history"),
    "history_chart": _sql(
        _HISTORY,
        """SELECT mmsi, date, strftime(CAST(date AS DATE), '%b %-d') AS date_label,
                  row_number() OVER (PARTITION BY mmsi ORDER BY date) AS position, event_count, p50_risk, p95_risk
           FROM history""",
    ),
    "serving_view": _sql(
        [*_HISTORY, HOT],
        """SELECT mmsi, h.date, risk_level, risk_score, zone_name, dark_vessel, event_count, avg_speed_kn, p95_risk
           FROM hot FULL OUTER JOIN history h USING (mmsi)""",
    ),
    "marker_class": _sql(
        _HOT,
        "SELECT mmsi, CASE WHEN dark_vessel THEN 'DARK' ELSE risk_level END AS marker_class FROM hot",
    ),
    "active_flags": _sql(
        _HOT,
        """SELECT mmsi, concat_ws(' · ', CASE WHEN loitering THEN 'Loitering' END,
                  CASE WHEN dark_vessel THEN 'Dark Vessel' END,
                  CASE WHEN speed_anomaly THEN 'Speed Anomaly' END) AS active_flags FROM hot""",
    ),
}

# The streams must give what the batch gives.
ORACLE["stream_etl_route"] = ORACLE["etl_route"]
ORACLE["stream_detections"] = ORACLE["detections"]
ORACLE["stream_crossings"] = ORACLE["hex_crossings"]
