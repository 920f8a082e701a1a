"""Column expressions: known values and properties."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rows import reports

from wakeline.functions.geo import grid_snap, haversine_m, initial_bearing_deg, point_in_polygon
from wakeline.functions.hexgrid import hex_cell, hex_centroid
from wakeline.functions.labels import active_flags, marker_class, short_date, two_decimals, utc_date
from wakeline.functions.risk import risk_level, risk_score
from wakeline.functions.validation import reason_code, reason_text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_distance_to_itself_is_zero(spark):
    assert value(spark, haversine_m(29.0, -90.0, 29.0, -90.0)) == 0.0


def test_distance_london_paris(spark):
    assert value(spark, haversine_m(51.507, -0.128, 48.857, 2.352)) == pytest.approx(343_500, abs=2_000)


def test_distance_across_the_antimeridian(spark):
    assert 0 < value(spark, haversine_m(-18.0, 178.0, -14.0, -172.0)) < 2_000_000


def test_distance_to_the_antipode(spark):
    assert value(spark, haversine_m(0.0, 0.0, 0.0, 180.0)) == pytest.approx(math.pi * 6_371_000)


_points = st.tuples(st.floats(-89, 89), st.floats(-180, 180))


@settings(max_examples=3, deadline=None)
@given(pairs=st.lists(st.tuples(_points, _points), min_size=50, max_size=50))
def test_distance_is_symmetric_and_bounded(spark, pairs):
    frame = spark.createDataFrame([(*a, *b) for a, b in pairs], "a double, b double, c double, d double")
    for there, back in frame.select(haversine_m("a", "b", "c", "d"), haversine_m("c", "d", "a", "b")).collect():
        assert there == pytest.approx(back, abs=1e-3)
        assert 0 <= there <= math.pi * 6_371_000 + 1


@pytest.mark.parametrize(
    "to, degrees", [((1.0, 0.0), 0.0), ((0.0, 1.0), 90.0), ((-1.0, 0.0), 180.0), ((0.0, -1.0), 270.0)]
)
def test_bearing(spark, to, degrees):
    assert value(spark, initial_bearing_deg("0D", "0D", f"{to[0]}D", f"{to[1]}D")) == pytest.approx(degrees)


BOX = "array(" + ",".join(f"named_struct('lon', {x}D, 'lat', {y}D)" for x, y in [(-90, 29), (-89, 29), (-89, 30), (-90, 30)]) + ")"
CLOSED = BOX[:-1] + ", named_struct('lon', -90D, 'lat', 29D))"


@pytest.mark.parametrize("ring", [BOX, CLOSED])
@pytest.mark.parametrize(
    "lat, lon, inside",
    [
        (29.5, -89.5, True),
        (35.0, -80.0, False),
        (29.0, -89.5, False),
        (30.0, -89.5, False),
        (29.5, -90.0, False),
        (29.5, -89.0, False),
        (29.0, -90.0, False),
        (30.0, -89.0, False),
        (30.0, -95.0, False),
        (29.0, -95.0, False),
    ],
)
def test_polygon_excludes_its_boundary(spark, ring, lat, lon, inside):
    assert value(spark, point_in_polygon(ring, lon, lat)) is inside


def test_empty_and_missing_rings_contain_nothing(spark):
    empty = "cast(array() AS array<struct<lon:double,lat:double>>)"
    missing = "cast(NULL AS array<struct<lon:double,lat:double>>)"
    assert value(spark, point_in_polygon(empty, -89.5, 29.5)) is False
    assert value(spark, point_in_polygon(missing, -89.5, 29.5)) is False


def test_concave_polygon(spark):
    # A U: the notch is outside.
    corners = [(0, 0), (4, 0), (4, 4), (3, 4), (3, 1), (1, 1), (1, 4), (0, 4)]
    ring = "array(" + ",".join(f"named_struct('lon', {x}D, 'lat', {y}D)" for x, y in corners) + ")"
    assert value(spark, point_in_polygon(ring, 0.5, 3.0)) is True
    assert value(spark, point_in_polygon(ring, 2.0, 3.0)) is False
    assert value(spark, point_in_polygon(ring, 2.0, 0.5)) is True


@settings(max_examples=3, deadline=None)
@given(points=st.lists(_points, min_size=100, max_size=100))
def test_grid_snap_holds_the_point(spark, points):
    frame = spark.createDataFrame(points, "lat double, lon double")
    for lat, corner in frame.select("lat", grid_snap("lat")).collect():
        assert corner == round(math.floor(lat / 0.1) * 0.1, 6)


def test_grid_snap_keeps_binary_rounding(spark):
    assert value(spark, grid_snap("0.3D")) == 0.2


@settings(max_examples=3, deadline=None)
@given(points=st.lists(_points, min_size=100, max_size=100))
def test_hexagon_of_a_centroid_is_the_same(spark, points):
    frame = spark.createDataFrame(points, "lat double, lon double").withColumn("cell", hex_cell("lat", "lon"))
    centred = frame.withColumn("c", hex_centroid("cell")).withColumn("again", hex_cell("c.lat", "c.lon"))
    for row in centred.collect():
        assert row["cell"] == row["again"]
        assert math.hypot(row["lat"] - row["c"]["lat"], row["lon"] - row["c"]["lon"]) <= 0.0127 + 1e-9


@pytest.mark.parametrize(
    "restricted, zone, port_nm, speed, score",
    [
        (True, "RESTRICTED", 50.0, 10.0, 50.0),
        (True, "RESTRICTED", 9.9, 25.1, 80.0),
        (False, "PORT", 50.0, 10.0, 20.0),
        (False, "EEZ", 50.0, 10.0, 10.0),
        (False, None, 10.0, 25.0, 0.0),
        (False, None, 9.99, 25.0, 20.0),
        (False, None, 10.0, 25.01, 10.0),
        (False, "LAKE", None, 0.0, 0.0),
    ],
)
def test_risk_score(spark, restricted, zone, port_nm, speed, score):
    row = spark.createDataFrame([(restricted, zone, port_nm, speed)], "r boolean, z string, p double, s double")
    assert row.select(risk_score("r", "z", "p", "s")).first()[0] == score
    slow = score - (10.0 if speed > 25 else 0.0)
    assert row.select(risk_score("r", "z", "p")).first()[0] == slow


@pytest.mark.parametrize("score, level", [(50.0, "HIGH"), (49.9, "MEDIUM"), (20.0, "MEDIUM"), (19.9, "LOW"), (0.0, "LOW")])
def test_risk_level(spark, score, level):
    assert value(spark, risk_level(f"{score}D")) == level


CASES = [
    ({}, None),
    ({"mmsi": "12345678"}, "mmsi"),
    ({"mmsi": "1234567890"}, "mmsi"),
    ({"mmsi": "12345678A"}, "mmsi"),
    ({"mmsi": "123456789\n"}, "mmsi"),
    ({"mmsi": ""}, "mmsi"),
    ({"mmsi": "ABCDEFGHI"}, "mmsi"),
    ({"mmsi": None}, "mmsi"),
    ({"latitude": 0.0, "longitude": 0.0}, "null_island"),
    ({"latitude": 0.0, "longitude": 10.0}, None),
    ({"latitude": 91.0}, "latitude"),
    ({"latitude": -91.0}, "latitude"),
    ({"latitude": 90.0}, None),
    ({"latitude": -90.0}, None),
    ({"latitude": float("nan")}, "latitude"),
    ({"longitude": 181.0}, "longitude"),
    ({"longitude": -181.0}, "longitude"),
    ({"longitude": 180.0}, None),
    ({"longitude": float("nan")}, "longitude"),
    ({"ts_ms": None, "ingest_ms": 5}, "timestamp"),
    ({"ts_ms": 0, "ingest_ms": 25 * 3_600_000}, "stale"),
    ({"ts_ms": 25 * 3_600_000, "ingest_ms": 0}, "stale"),
    ({"ts_ms": 0, "ingest_ms": 24 * 3_600_000}, None),
    ({"speed": -1.0}, "speed"),
    ({"speed": 103.0}, "speed"),
    ({"speed": 102.2}, None),
    ({"speed": 0.0}, None),
    ({"speed": float("nan")}, "speed"),
    # The first failing rule names the reason.
    ({"mmsi": "1", "latitude": 91.0, "speed": -1.0}, "mmsi"),
    ({"latitude": 91.0, "longitude": 181.0}, "latitude"),
]


def test_validation_rules(spark):
    checked = reports(spark, *[change for change, _ in CASES]).withColumn("code", reason_code())
    codes = {row["seq"]: row["code"] for row in checked.collect()}
    assert [codes[i] for i in range(len(CASES))] == [code for _, code in CASES]


def test_reason_texts(spark):
    checked = reports(
        spark, {"mmsi": "1"}, {"latitude": 0.0, "longitude": 0.0}, {"latitude": 91.0}, {"longitude": 181.0},
        {"ts_ms": None, "ingest_ms": 1}, {"ts_ms": 0, "ingest_ms": 90_000_000}, {"speed": -1.0},
    ).withColumn("code", reason_code())
    texts = [r["text"] for r in checked.withColumn("text", reason_text("code")).orderBy("seq").collect()]
    assert texts == [
        "invalid MMSI: 1",
        "null island (0,0)",
        "latitude out of range: 91.0",
        "longitude out of range: 181.0",
        "null timestamp",
        "timestamp too old/stale: 90000000ms",
        "speed out of range: -1.0 kn",
    ]


def test_labels(spark):
    assert value(spark, short_date(F.to_date(F.lit("2024-03-05")))) == "Mar 5"
    assert value(spark, two_decimals(F.lit(1.235))) == 1.24
    assert str(value(spark, utc_date(F.lit(1_709_596_799_999)))) == "2024-03-04"
    assert str(value(spark, utc_date(F.lit(-1)))) == "1969-12-31"
    frame = spark.createDataFrame(
        [("HIGH", True, False, True), ("HIGH", False, False, False), ("MEDIUM", False, True, True), ("ODD", False, False, False)],
        "level string, dark_vessel boolean, loitering boolean, speed_anomaly boolean",
    )
    shown = frame.select(marker_class(F.col("level"), F.col("dark_vessel")).alias("m"), active_flags().alias("f"))
    assert [tuple(r) for r in shown.collect()] == [
        ("DARK", "Dark Vessel · Speed Anomaly"),
        ("HIGH", ""),
        ("MEDIUM", "Loitering · Speed Anomaly"),
        ("LOW", ""),
    ]
