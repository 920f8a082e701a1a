"""Operators against brute force on small inputs."""

import math
import random

import pytest
from pyspark.sql import functions as F
from rows import reports

from wakeline import constants as C
from wakeline.operators import detect
from wakeline.operators.crossings import hex_crossings
from wakeline.operators import dedup, ports
from wakeline.operators.dedup import accept, route
from wakeline.operators.enrich import enrich, enrich_crossings
from wakeline.operators.neighbours import run_start, with_neighbours
from wakeline.operators.ports import with_nearest_port
from wakeline.operators.tracks import resample, trail, trail_lines
from wakeline.operators.validate import explain_reason, valid
from wakeline.operators.zones import primary_zone, with_zones, zone_cover
from wakeline.schemas import PORTS, ZONES
from wakeline.sources.reference import seed_ports, seed_zones

T0 = 1_710_500_000_000
HOUR = 3_600_000


# --- deduplication ---


def _greedy(arrivals, ttl):
    """Numbers of the accepted copies of one key."""
    opened, kept = None, []
    for ingest, seq in sorted(arrivals):
        if opened is None or ingest >= opened + ttl:
            opened = ingest
            kept.append(seq)
    return kept


def _seqs(frame):
    return sorted(row["seq"] for row in frame.collect())


def test_first_second_other_time_other_vessel(spark):
    frame = reports(spark, {}, {"ingest_ms": T0 + 3_000}, {"ts_ms": T0 + 1}, {"mmsi": "987654321"})
    assert _seqs(accept(frame)) == [0, 2, 3]


def test_copy_after_the_window_is_accepted_again(spark):
    at = [0, HOUR - 1, HOUR, HOUR + 1, 2 * HOUR - 1, 2 * HOUR, 5 * HOUR]
    frame = reports(spark, *[{"ingest_ms": T0 + a} for a in at])
    assert _seqs(accept(frame)) == [0, 2, 5, 6]


def test_window_is_not_refreshed_by_duplicates(spark):
    at = [0, 40 * 60_000, 80 * 60_000]
    frame = reports(spark, *[{"ingest_ms": T0 + a} for a in at])
    assert _seqs(accept(frame)) == [0, 2]


def test_many_equal_copies_give_one(spark):
    frame = reports(spark, *[{"ingest_ms": T0} for _ in range(20)])
    assert _seqs(accept(frame)) == [0]


def test_random_copies_match_the_sequential_rule(spark):
    rng = random.Random(7)
    changes = []
    for _ in range(400):
        # One key holds a third of all copies.
        hot = rng.random() < 0.34
        ts = T0 if hot else T0 + rng.randrange(20)
        changes.append({"mmsi": "111111111" if hot else f"22222222{rng.randrange(3)}", "ts_ms": ts,
                        "ingest_ms": T0 + rng.randrange(100 if rng.random() < 0.3 else 20_000)})
    keys = {}
    for seq, c in enumerate(changes):
        keys.setdefault((c["mmsi"], c["ts_ms"]), []).append((c["ingest_ms"], seq))
    expected = sorted(seq for copies in keys.values() for seq in _greedy(copies, 1_000))
    assert _seqs(accept(reports(spark, *changes), ttl_ms=1_000)) == expected


def test_two_thousand_windows_take_few_rounds(spark, monkeypatch):
    """A chain of windows of one key, with gaps of some steps, next to keys of one window."""
    rng, at, times = random.Random(3), 0, []
    for _ in range(2_000):
        at += 10 + rng.choice([0, 0, 3, 9, 25])
        times += [at, at + 4, at + 9]
    rounds = []
    stage = dedup.stage
    monkeypatch.setattr(dedup, "stage", lambda frame, name: rounds.append(name) or stage(frame, name))
    frame = reports(spark, *[{"ingest_ms": T0 + t} for t in times], {"mmsi": "222222222"}, {"mmsi": "222222222"})
    expected = _greedy([(t, i) for i, t in enumerate(times)], 10)
    assert len(expected) >= 2_000
    assert _seqs(accept(frame, ttl_ms=10)) == sorted([*expected, len(times)])
    assert rounds.count("window-openings") <= 13


def test_route_sends_each_report_one_way(spark):
    frame = reports(spark, {}, {"ingest_ms": T0 + 3_000}, {"speed": -1.0}, {"mmsi": "bad"})
    routed = route(frame)
    codes = {r["seq"]: r["reason_code"] for r in routed.collect()}
    assert codes == {0: None, 1: "duplicate", 2: "speed", 3: "mmsi"}
    texts = {r["seq"]: r["reason"] for r in explain_reason(routed.where("reason_code IS NOT NULL")).collect()}
    assert texts[1] == "duplicate" and texts[3] == "invalid MMSI: bad"


def test_exact_replays_and_missing_arrivals(spark):
    frame = reports(spark, {}, {"ts_ms": T0 + 1}, {"ts_ms": T0 + 2, "ingest_ms": None})
    routed = [(r["seq"], r["reason_code"]) for r in route(frame.unionByName(frame.where("seq = 0"))).collect()]
    assert sorted(routed, key=str) == [(0, "duplicate"), (0, None), (1, None), (2, "arrival")]
    with pytest.raises(ValueError):
        accept(frame, ttl_ms=0)


# --- zones ---


def _inside(ring, x, y):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
        if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return False
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd


def _zones(spark, zones):
    rows = [(i, f"z{i}", kind, [(float(x), float(y)) for x, y in ring]) for i, kind, ring in zones]
    return spark.createDataFrame(rows, ZONES)


@pytest.mark.parametrize("limit", [200_000, 0], ids=["broadcast", "shuffled"])
def test_zone_join_matches_brute_force(spark, limit):
    rng = random.Random(11)
    zones = []
    for i in range(25):
        x, y, n = rng.randrange(-20, 20), rng.randrange(-20, 20), rng.randrange(3, 9)
        ring = []
        for k in range(n):
            r, a = rng.choice([0.3, 1, 2.5, 6]), 2 * math.pi * k / n
            ring.append((round(x + r * math.cos(a), 2), round(y + r * math.sin(a), 2)))
        zones.append((i, rng.choice(["RESTRICTED", "PORT", "EEZ", "LAKE"]), ring))
    zones.append((99, "EEZ", [(-10, -10), (10, -10), (10, 10), (-10, 10)]))
    # Whole numbers fall on cell borders and on the sides of the square.
    spots = [(rng.choice([rng.uniform(-25, 25), rng.randrange(-12, 13)]), rng.choice([rng.uniform(-25, 25), rng.randrange(-12, 13)])) for _ in range(400)]
    frame = reports(spark, *[{"longitude": float(x), "latitude": float(y)} for x, y in spots])
    located = with_zones(frame, _zones(spark, zones), max_broadcast_sides=limit)
    found = {r["seq"]: sorted(z["id"] for z in r["zones"]) for r in located.collect()}
    assert found == {s: sorted(i for i, _, ring in zones if _inside(ring, x, y)) for s, (x, y) in enumerate(spots)}
    assert any(len(v) > 1 for v in found.values())


def test_primary_zone_order_and_ties(spark):
    square = [(-91, 28), (-89, 28), (-89, 30), (-91, 30)]
    kinds = [(7, "EEZ"), (5, "PORT"), (3, "PORT"), (1, "LAKE")]
    located = with_zones(reports(spark, {}), _zones(spark, [(i, k, square) for i, k in kinds]))
    assert located.select(primary_zone()["id"]).first()[0] == 3


def test_cover_knows_whole_cells(spark):
    cover = {(r["cell_x"], r["cell_y"]): r["whole"] for r in zone_cover(_zones(spark, [(1, "EEZ", [(0.5, 0.5), (3.5, 0.5), (3.5, 3.5), (0.5, 3.5)])])).collect()}
    assert cover[(1, 1)] and cover[(2, 2)] and not cover[(0, 1)] and len(cover) == 16


def test_enrich_seed_zones(spark):
    frame = reports(spark, {"latitude": 33.0, "longitude": -86.0, "speed": 30.0}, {"latitude": 29.95, "longitude": -90.06}, {"latitude": 27.0, "longitude": -90.0}, {"latitude": 40.0, "longitude": -50.0})
    rows = enrich(frame).orderBy("seq").collect()
    assert [(r["zone_type"], r["in_restricted_zone"], r["risk_score"], r["risk_level"]) for r in rows] == [
        ("RESTRICTED", True, 60.0, "HIGH"),
        ("PORT", False, 40.0, "MEDIUM"),
        ("EEZ", False, 10.0, "LOW"),
        (None, False, 0.0, "LOW"),
    ]


# --- ports ---


def _nm(a, b):
    (la, lo), (lb, lp) = a, b
    p, q = math.radians(la), math.radians(lb)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(lp - lo) / 2) ** 2
    return 2 * C.EARTH_RADIUS_M * math.atan2(math.sqrt(h), math.sqrt(max(0, 1 - h))) / C.METRES_PER_NM


@pytest.mark.parametrize("limit", [500_000, 0], ids=["broadcast", "shuffled"])
def test_port_table_matches_brute_force(spark, limit):
    rng = random.Random(5)
    places = [(rng.uniform(-85, 85), rng.uniform(-180, 180)) for _ in range(60)]
    places += [(rng.uniform(29, 30), rng.uniform(-91, -90)) for _ in range(30)]  # a third in one cell
    table = spark.createDataFrame([(i, str(i), *p) for i, p in enumerate(places)], PORTS)
    spots = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(60)]
    spots += [(90.0, 0.0), (-90.0, 12.0), (0.0, 180.0), (0.0, -180.0), (29.5, -90.5), (-17.9, 179.99)]
    frame = reports(spark, *[{"latitude": a, "longitude": b} for a, b in spots])
    found = with_nearest_port(frame, table, max_broadcast=limit).select("seq", "distance_to_port").collect()
    for row in found:
        assert row["distance_to_port"] == pytest.approx(min(_nm(spots[row["seq"]], p) for p in places), abs=1e-6)
    assert len(found) == len(spots)


def test_lists_with_salts_are_not_broadcast(spark):
    """Spark takes them for as small as the lists without salts; copied, they outgrow the driver."""
    rng = random.Random(6)
    table = spark.createDataFrame([(i, str(i), rng.uniform(20, 40), rng.uniform(-99, -80)) for i in range(90)], PORTS)
    frame = reports(spark, *[{"latitude": rng.uniform(20, 40), "longitude": rng.uniform(-99, -80)} for _ in range(20)])
    found = with_nearest_port(frame, table, max_broadcast=0)
    assert found.count() == 20
    for plan in (found._jdf.queryExecution().executedPlan(), found._jdf.queryExecution().optimizedPlan()):
        joins = [line for line in plan.toString().splitlines() if "Join" in line and "salt" in line]
        assert joins and not any("Broadcast" in line for line in joins)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    assert all("SortMergeJoin" in line for line in plan.splitlines() if "Join" in line and "salt" in line)


@pytest.mark.parametrize("n", [1_500, 15_000])
def test_lists_of_ports_stay_short(spark, n):
    """Ten times the ports make smaller leaves, not longer lists."""
    places = spark.range(n).selectExpr("24 + (id * 7919) % 12000 / 1000D AS latitude", "-98 + (id * 104729) % 19000 / 1000D AS longitude")
    occupied = spark.range(17 * 11).selectExpr("cast(id % 17 - 97 AS int) AS cell_x", "cast(id % 11 + 25 AS int) AS cell_y")
    leaves, split = ports.candidate_ports(places, occupied)
    lists = [r["count"] for r in leaves.groupBy("level", "cell_x", "cell_y").count().collect()]
    assert max(lists) <= ports.LEAF_PORTS and sum(lists) / len(lists) < 8 and len(split) == (1 if n == 1_500 else 2)


def test_ports_at_one_place_and_dense_harbours(spark):
    """Many ports in one small area, some at the same place, beside far ones: leaves of several sizes."""
    rng = random.Random(9)
    places = [(29.5 + rng.random() / 50, -90.5 + rng.random() / 50) for _ in range(150)] + [(10.0, 10.0)] * 100
    places += [(rng.uniform(-60, 60), rng.uniform(-180, 180)) for _ in range(40)]
    table = spark.createDataFrame([(i, str(i), *p) for i, p in enumerate(places)], PORTS)
    spots = [(29.5 + rng.random() / 40, -90.5 + rng.random() / 40) for _ in range(60)]
    spots += [(29.0 + rng.random() * 2, -91.0 + rng.random() * 2) for _ in range(40)] + [(10.0, 10.0), (10.4, 9.9)]
    frame = reports(spark, *[{"latitude": a, "longitude": b} for a, b in spots], {"latitude": None})
    for row in with_nearest_port(frame, table).collect():
        near = min(_nm(spots[row.seq], p) for p in places) if row.seq < len(spots) else None
        assert row.distance_to_port == (near if near is None else pytest.approx(near, abs=1e-6))


def test_port_table_just_past_the_edges(spark):
    listed = [(i, f"p{i}", -80 + 2.1 * i, -179 + 4.7 * i) for i in range(70)]
    at = [{"longitude": -180.005, "latitude": 10.0}, {"longitude": 5.0, "latitude": -90.004}]
    points = reports(spark, *at)
    frame = spark.createDataFrame(listed, "port_id int, name string, latitude double, longitude double")
    got = {r.seq: r.distance_to_port for r in with_nearest_port(points, frame).collect()}
    inline = [with_nearest_port(points, listed[i : i + 35]).collect() for i in (0, 35)]
    for rows in zip(*[sorted(x, key=lambda r: r.seq) for x in inline]):
        assert got[rows[0].seq] == pytest.approx(min(r.distance_to_port for r in rows))


def test_short_gazetteer_as_list_and_as_table(spark):
    frame = reports(spark, {"latitude": 29.95, "longitude": -90.06}, {"latitude": 0.0, "longitude": 0.5})
    listed = with_nearest_port(frame, C.SEED_PORTS).orderBy("seq").collect()
    table = with_nearest_port(frame, seed_ports(spark)).orderBy("seq").collect()
    assert listed == table
    assert listed[0]["distance_to_port"] == pytest.approx(0.0, abs=1e-6)
    assert listed[1]["distance_to_port"] == pytest.approx(min(_nm((0.0, 0.5), p[2:]) for p in C.SEED_PORTS))
    assert with_nearest_port(frame, []).first()["distance_to_port"] is None


# --- neighbours, detection ---


def _history(rng, vessels=3, n=150):
    changes = []
    for v in range(vessels):
        t = T0 + rng.randrange(HOUR)
        for _ in range(n if v else 3 * n):  # the first vessel holds most rows
            t += rng.choice([0, 1_000, 120_000, 300_000, 600_000, 600_001, 9 * HOUR, 30 * HOUR])
            changes.append({"mmsi": f"30000000{v}", "ts_ms": t, "speed": rng.choice([0.0, 0.5, 0.99, 1.0, 12.0, 40.0]),
                            "latitude": 29 + rng.randrange(4) / 50, "longitude": -90 + rng.randrange(4) / 50})
    rng.shuffle(changes)
    return changes


def _tracks(changes):
    tracks = {}
    for seq, c in enumerate(changes):
        tracks.setdefault(c["mmsi"], []).append({**c, "seq": seq})
    return [sorted(t, key=lambda c: (c["ts_ms"], c["seq"])) for t in tracks.values()]


@pytest.fixture(scope="module")
def long_history(spark):
    changes = _history(random.Random(3))
    return changes, reports(spark, *changes).persist()


SLICES = pytest.mark.parametrize("slice_ms", [60_000, HOUR, 24 * HOUR])


@SLICES
def test_neighbours_cross_slices(long_history, slice_ms):
    changes, frame = long_history
    placed = with_neighbours(frame, before=("seq",), after=("seq", "ts_ms"), slice_ms=slice_ms)
    found = {r["seq"]: (r["before"] and r["before"]["seq"], r["after"] and r["after"]["seq"]) for r in placed.collect()}
    expected = {}
    for track in _tracks(changes):
        for i, c in enumerate(track):
            expected[c["seq"]] = (track[i - 1]["seq"] if i else None, track[i + 1]["seq"] if i + 1 < len(track) else None)
    assert found == expected


@SLICES
def test_run_start_crosses_slices(long_history, slice_ms):
    changes, frame = long_history
    found = {r["seq"]: r["began"] for r in run_start(frame, "speed < 30", "began", slice_ms).collect()}
    expected = {}
    for track in _tracks(changes):
        began = None
        for c in track:
            began = (c["ts_ms"] if began is None else began) if c["speed"] < 30 else None
            expected[c["seq"]] = began
    assert found == expected


def test_flags_match_the_sequential_rules(long_history):
    changes, frame = long_history
    as_of = max(c["ts_ms"] for c in changes) + 300_000
    flagged = detect.flag(enrich(frame), as_of)
    found = {r["seq"]: (r["loitering"], r["speed_anomaly"], r["dark_vessel"]) for r in flagged.collect()}
    for track in _tracks(changes):
        for i, c in enumerate(track):
            p = track[i - 1] if i else None
            gap = c["ts_ms"] - p["ts_ms"] if p else 0
            loiter = bool(p) and c["speed"] < 1 and p["speed"] < 1 and gap // 60_000 >= 5
            odd = False
            if p and gap > 0:
                knots = _nm((p["latitude"], p["longitude"]), (c["latitude"], c["longitude"])) / (gap / HOUR)
                odd = abs(knots - c["speed"]) > 15
            until = track[i + 1]["ts_ms"] if i + 1 < len(track) else as_of
            assert found[c["seq"]] == (loiter, odd, until - c["ts_ms"] > 600_000)


def _pair(spark, gap_ms, first=None, second=None):
    frame = reports(spark, {**(first or {})}, {"ts_ms": T0 + gap_ms, **(second or {})})
    return detect.flag(enrich(frame), T0 + gap_ms).orderBy("seq").collect()


@pytest.mark.parametrize(
    "gap_ms, before, now, expected",
    [(299_999, 0.0, 0.0, False), (300_000, 0.99, 0.99, True), (300_000, 1.0, 0.0, False), (300_000, 0.0, 1.0, False)],
)
def test_loitering_limits(spark, gap_ms, before, now, expected):
    rows = _pair(spark, gap_ms, {"speed": before}, {"speed": now})
    assert [r["loitering"] for r in rows] == [False, expected]


def test_speed_anomaly_limits(spark):
    # Standing still, the divergence is the reported speed: exactly 15 is not yet an anomaly.
    assert _pair(spark, 60_000, {}, {"speed": 15.0})[1]["speed_anomaly"] is False
    assert _pair(spark, 60_000, {}, {"speed": 15.01})[1]["speed_anomaly"] is True
    assert _pair(spark, 0, {}, {"speed": 50.0})[1]["speed_anomaly"] is False


def test_silence_limits(spark):
    assert [r["dark_vessel"] for r in _pair(spark, 600_000)] == [False, False]
    assert [r["dark_vessel"] for r in _pair(spark, 600_001)] == [True, False]


def test_dwell_needs_no_gap_between_reports(spark):
    # Every two seconds for six minutes: pairs never span five minutes, the stay does.
    frame = reports(spark, *[{"ts_ms": T0 + 2_000 * i, "speed": 0.2} for i in range(181)])
    stays = detect.dwell(frame)
    assert stays.where("loitering_dwell").agg(F.min("dwell_ms"), F.count("*")).first() == (300_000, 31)
    assert detect.flag(enrich(frame), T0).where("loitering").count() == 0


def test_dark_detection_is_rebuilt_and_merged(spark):
    frame = reports(spark, {"speed": 0.0}, {"ts_ms": T0 + 400_000, "speed": 0.0}, {"ts_ms": T0 + 2 * HOUR})
    base = enrich(frame)
    flagged = detect.flag(base, T0 + 2 * HOUR)
    found = detect.detections(flagged)
    dark = found.where("detection = 'dark'").collect()
    assert [(r["seq"], r["heading"], r["source_type"], r["loitering"], r["dark_vessel"]) for r in dark] == [(1, 0.0, None, True, True)]
    kept = found.where("detection = 'behaviour'").collect()
    assert [(r["seq"], r["heading"], r["dark_vessel"]) for r in kept] == [(1, 90.0, False)]
    merged = {r["seq"]: r for r in detect.merge_flags(base, found.unionByName(found)).collect()}
    assert merged[1]["loitering"] and merged[1]["dark_vessel"] and merged[1]["heading"] == 90.0
    assert not merged[0]["dark_vessel"] and len(merged) == 3
    assert [r["silent_ms"] for r in detect.back_online(frame).collect()] == [2 * HOUR - 400_000]


def test_first_sighting_is_no_crossing(spark):
    frame = reports(spark, {}, {"ts_ms": T0 + 1}, {"ts_ms": T0 + 2, "latitude": 29.5}, {"ts_ms": T0 + 3 * 24 * HOUR}, {"mmsi": "987654321"})
    crossings = hex_crossings(frame).orderBy("seq").collect()
    assert [r["seq"] for r in crossings] == [2, 3]
    assert crossings[0]["to_cell"] == crossings[1]["from_cell"]
    # Places are judged at the centre of the entered cell, and speed does not count.
    entered = enrich_crossings(hex_crossings(frame)).orderBy("seq").collect()
    assert [r["in_restricted_zone"] for r in entered] == [False, False]
    assert all(abs(r["centroid_lat"] - r["latitude"]) < 0.0127 and r["zone_type"] for r in entered)


def test_other_cell_function(spark):
    frame = reports(spark, {}, {"ts_ms": T0 + 1, "latitude": 29.5}, {"ts_ms": T0 + 2, "latitude": 30.5})
    whole_degrees = lambda lat, lon: F.expr(f"concat(floor({lat}), '/', floor({lon}))")
    assert [r["to_cell"] for r in hex_crossings(frame, whole_degrees).collect()] == ["30/-90"]


# --- tracks ---


def test_trail_drops_repeats_and_keeps_the_newest(spark):
    lats = [1.0, 1.0, 2.0, 1.0, 1.0, 3.0]
    frame = reports(spark, *[{"latitude": v, "ts_ms": T0 + i * 20 * HOUR} for i, v in enumerate(lats)])
    assert [r["latitude"] for r in trail(frame).orderBy("position").collect()] == [1.0, 2.0, 1.0, 3.0]
    line = trail_lines(trail(frame, points=2)).first()["trail"]
    assert [(p["position"], p["latitude"]) for p in line] == [(1, 1.0), (2, 3.0)]


def test_resample_on_the_straight_line(spark):
    start = T0 - T0 % 60_000
    frame = reports(spark, {"ts_ms": start, "latitude": 10.0}, {"ts_ms": start + 240_000, "latitude": 14.0})
    rows = resample(frame, 60_000).orderBy("sample_ms").collect()
    assert [(r["sample_ms"] - start, r["latitude"]) for r in rows] == [(0, 10.0), (60_000, 11.0), (120_000, 12.0), (180_000, 13.0)]


def test_resample_fills_long_gaps_in_blocks(spark):
    frame = reports(spark, {"ts_ms": T0}, {"ts_ms": T0 + 25_000_000})
    steps = resample(frame, 1_000).agg(F.count("*"), F.countDistinct("sample_ms")).first()
    assert tuple(steps) == (25_000, 25_000)


def test_seed_zones_are_rectangles(spark):
    assert seed_zones(spark).where(F.size("ring") == 5).count() == 3
