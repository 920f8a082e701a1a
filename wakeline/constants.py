"""Fixed values of the vessel-tracking domain.

These numbers, names and formats define the results, so they are stated once, here.
"""

# --- validation (fixed values) ---
MMSI_PATTERN = r"^[0-9]{9}\z"
MAX_ABS_LATITUDE = 90.0
MAX_ABS_LONGITUDE = 180.0
MAX_AGE_MS = 24 * 60 * 60 * 1000
MAX_SPEED_KN = 102.2

REASON_MMSI = "mmsi"
REASON_NULL_ISLAND = "null_island"
REASON_LATITUDE = "latitude"
REASON_LONGITUDE = "longitude"
REASON_TIMESTAMP = "timestamp"
REASON_ARRIVAL = "arrival"
REASON_STALE = "stale"
REASON_SPEED = "speed"
REASON_DUPLICATE = "duplicate"
REASON_LATE = "late"

# --- risk policy (fixed values) ---
ZONE_WEIGHTS = {"RESTRICTED": 50.0, "PORT": 20.0, "EEZ": 10.0}
ZONE_PRIORITY = {"RESTRICTED": 3, "PORT": 2, "EEZ": 1}
NEAR_PORT_WEIGHT = 20.0
NEAR_PORT_NM = 10.0
HIGH_SPEED_WEIGHT = 10.0
HIGH_SPEED_KN = 25.0
HIGH_SCORE = 50.0
MEDIUM_SCORE = 20.0

# --- detection (fixed values) ---
LOITER_SPEED_KN = 1.0
LOITER_MINUTES = 5
SILENCE_MS = 10 * 60 * 1000
ANOMALY_KN = 15.0
METRES_PER_NM = 1852.0
EARTH_RADIUS_M = 6_371_000.0

# --- deduplication (fixed value) ---
DEDUP_TTL_MS = 60 * 60 * 1000

# --- batch and serving (fixed values) ---
HOTSPOT_CELL_DEG = 0.1
HOTSPOT_TOP_N = 50
PERCENTILE_ACCURACY = 10_000
COARSE_PERCENTILE_ACCURACY = 100
HISTORY_ROWS = 90
TRAIL_POINTS = 60

# --- channels (fixed values): source type -> raw topic ---
CHANNEL_TOPICS = {
    "TERRESTRIAL": "ais.raw.terrestrial",
    "SATELLITE": "ais.raw.satellite",
    "VESSEL": "ais.raw.vessel",
}
EVENT_TYPE_AIS = "AIS"

# --- zone catalogue (fixed values): id, name, type, west, south, east, north ---
SEED_ZONES = [
    (1, "Gulf of Mexico Restricted Zone", "RESTRICTED", -88.0, 32.0, -85.0, 35.0),
    (2, "Port of New Orleans", "PORT", -90.5, 29.5, -89.5, 30.2),
    (3, "US Gulf Coast EEZ", "EEZ", -97.0, 25.0, -80.0, 30.5),
]

# --- port gazetteer (fixed values): id, name, latitude, longitude ---
SEED_PORTS = [
    (1, "New Orleans", 29.95, -90.06),
    (2, "Houston", 29.73, -95.27),
    (3, "Tampa", 27.94, -82.45),
    (4, "Mobile", 30.69, -88.04),
    (5, "Corpus Christi", 27.81, -97.40),
    (6, "Havana", 23.14, -82.35),
]

# --- labels (fixed values) ---
FLAG_LABELS = [
    ("loitering", "Loitering"),
    ("dark_vessel", "Dark Vessel"),
    ("speed_anomaly", "Speed Anomaly"),
]
FLAG_SEPARATOR = " · "

# --- hexagon grid: edge in degrees, about 1.4 km north to south ---
HEX_EDGE_DEG = 0.0127

DAY_MS = 24 * 60 * 60 * 1000
