"""The batch jobs, tiers and serving views on hand-made rows."""

import os

import pytest
from pyspark.sql import functions as F
from rows import DEFAULTS, cold, reports

from wakeline.operators.detect import detections, flag
from wakeline.operators.enrich import enrich
from wakeline.plans import batch, metrics, serving
from wakeline.schemas import DAILY_STATS, HOTSPOTS, RISK_PERCENTILES, to_flat
from wakeline.sources import avro_json, tables, tiers
from wakeline.sources.reports import read_channels, write_channels

A, B = "111111111", "222222222"
TWO_VESSELS = [
    {"mmsi": A, "speed": 10.0, "risk": 15.0},
    {"mmsi": A, "speed": 20.0, "risk": 30.0, "loitering": True},
    {"mmsi": A, "speed": 15.0, "risk": 60.0, "restricted": True},
    {"mmsi": B, "speed": 5.0, "risk": 10.0},
    {"mmsi": B, "speed": 25.0, "risk": 55.0, "restricted": True},
]


def test_daily_values(spark):
    rows = {r["mmsi"]: r for r in batch.daily_stats(cold(spark, *TWO_VESSELS)).collect()}
    a, b = rows[A], rows[B]
    assert (a["event_count"], a["avg_speed_kn"], a["max_speed_kn"], a["avg_risk_score"]) == (3, 15.0, 20.0, 35.0)
    assert (a["restricted_count"], a["loitering_count"]) == (1, 1)
    assert (b["event_count"], b["avg_speed_kn"], b["max_speed_kn"]) == (2, 15.0, 25.0)
    assert (b["restricted_count"], b["loitering_count"]) == (1, 0)


def test_missing_flags_count_as_zero(spark):
    frame = cold(spark, {"loitering": None, "dark": None, "anomaly": None})
    row = batch.daily_stats(frame).first()
    assert (row["loitering_count"], row["dark_vessel_count"], row["speed_anomaly_count"]) == (0, 0, 0)


def test_schemas(spark):
    frame = cold(spark, *TWO_VESSELS)
    kinds = lambda schema: [(f.name, f.dataType) for f in schema.fields]
    assert kinds(batch.daily_stats(frame).schema) == kinds(DAILY_STATS)
    assert kinds(batch.risk_percentiles(frame).schema) == kinds(RISK_PERCENTILES)
    assert kinds(batch.hotspots(frame).schema) == kinds(HOTSPOTS)


@pytest.mark.parametrize("accuracy", [10_000, 100])
def test_percentiles(spark, accuracy):
    frame = cold(spark, *[{"risk": 10.0 * i} for i in range(1, 11)])
    row = batch.risk_percentiles(frame, accuracy).first()
    assert (row["p50_risk"], row["p95_risk"], row["sample_count"]) == (50.0, 100.0, 10)


def test_percentiles_of_one_event(spark):
    row = batch.risk_percentiles(cold(spark, {"risk": 75.0})).first()
    assert (row["p50_risk"], row["p95_risk"]) == (75.0, 75.0)


def test_hotspot_cells(spark):
    spots = [(A, 30.05, -89.05), (A, 30.05, -89.05), (B, 30.05, -89.05), (B, 30.15, -89.05)]
    frame = cold(spark, *[{"mmsi": m, "lat": la, "lon": lo, "loitering": True} for m, la, lo in spots])
    rows = [tuple(r)[1:] for r in batch.hotspots(frame).orderBy("cell_lat").collect()]
    assert rows == [(30.0, -89.1, 3, 2), (30.1, -89.1, 1, 1)]


def test_at_most_fifty_hotspots_a_day(spark):
    spots = [{"lat": 10.0 + i, "loitering": True, "date": d} for i in range(60) for d in ("2024-03-15", "2024-03-16")]
    counted = batch.hotspots(cold(spark, *spots)).groupBy("date").count().collect()
    assert [r["count"] for r in counted] == [50, 50]
    assert batch.hotspots(cold(spark, *spots), top_n=None).count() == 120


def test_no_loitering_no_hotspots(spark):
    assert batch.hotspots(cold(spark, {"mmsi": A})).count() == 0


def test_run_batch_by_date_and_rerun(spark, tmp_path):
    root, out = str(tmp_path / "cold"), str(tmp_path / "out")
    days = ["2024-03-14", "2024-03-15"]
    tiers.write_cold(cold(spark, *[{**v, "date": d} for v in TWO_VESSELS for d in days]), root)
    batch.run_batch(spark, root, out, "2024-03-15")
    stats = spark.read.schema(DAILY_STATS).parquet(f"{out}/vessel_daily_stats")
    assert {str(r["date"]) for r in stats.collect()} == {"2024-03-15"}
    batch.run_batch(spark, root, out, "2024-03-14")
    batch.run_batch(spark, root, out, "2024-03-15")
    stats = spark.read.schema(DAILY_STATS).parquet(f"{out}/vessel_daily_stats")
    # Both dates are there, each (vessel, date) once.
    assert stats.count() == 4 and stats.select("mmsi", "date").distinct().count() == 4
    assert spark.read.schema(RISK_PERCENTILES).parquet(f"{out}/vessel_risk_percentiles").count() == 4
    assert spark.read.schema(HOTSPOTS).parquet(f"{out}/loitering_hotspots").count() == 2


def test_empty_hotspots_leave_the_table_alone(spark, tmp_path):
    out = str(tmp_path / "hot")
    tables.replace_dates(batch.hotspots(cold(spark, {"loitering": True})), out)
    tables.replace_dates(batch.hotspots(cold(spark, {"date": "2024-03-20"})), out)
    assert [d for d in os.listdir(out) if d.startswith("date=")] == ["date=2024-03-15"]
    assert spark.read.schema(HOTSPOTS).parquet(out).count() == 1


def test_run_batch_checks_its_arguments(spark):
    with pytest.raises(ValueError):
        batch.run_batch(spark, " ", "out")
    with pytest.raises(ValueError):
        batch.run_batch(spark, "root", "out", "15/03/2024")


# --- tiers ---


def test_cold_tier_keeps_leading_zeros_and_other_dates(spark, tmp_path):
    root = str(tmp_path / "cold")
    tiers.write_cold(cold(spark, {"mmsi": "012345678"}, {"date": "2024-03-16"}), root)
    tiers.write_cold(cold(spark, {"mmsi": "012345678", "speed": 3.0}), root)
    rows = tiers.scan_cold(spark, root).orderBy("date").collect()
    assert [(r["vesselEvent"]["mmsi"], r["vesselEvent"]["speed"]) for r in rows] == [("012345678", 3.0), ("123456789", 10.0)]
    assert tiers.scan_cold(spark, root, "2024-03-15").count() == 1


def test_cold_tier_is_last_write_wins_and_idempotent(spark, tmp_path):
    root = str(tmp_path / "cold")
    first = reports(spark, {"speed": 1.0}, {"mmsi": "222222222"})
    again = reports(spark, {"speed": 2.0, "ingest_ms": 1_710_500_060_000})
    for step, rows in enumerate([first, again, again]):
        tiers.append_cold(tiers.as_cold(enrich(rows)), root, step)
    kept = {r["vesselEvent"]["mmsi"]: r["vesselEvent"]["speed"] for r in tiers.scan_cold(spark, root).collect()}
    assert kept == {"123456789": 2.0, "222222222": 10.0}


def test_hot_tier_upsert_and_lookup(spark):
    quiet = enrich(reports(spark, {"latitude": 40.0, "longitude": -50.0}))
    loud = enrich(reports(spark, {"latitude": 33.0, "longitude": -86.0, "ingest_ms": 1_710_500_060_000}))
    loud = loud.withColumn("loitering", F.lit(True))
    merged = tiers.merge_hot(loud, tiers.merge_hot(quiet))
    row = tiers.lookup(merged, "123456789").first()
    assert (row["risk_level"], row["loitering"]) == ("HIGH", True)
    assert tiers.merge_hot(quiet, merged).first()["risk_level"] == "HIGH"  # an older copy changes nothing
    assert serving.latest(merged, "999999999").count() == 0


@pytest.mark.parametrize("report_first", [True, False])
def test_tiers_keep_the_report_and_its_flags_in_any_order(spark, tmp_path, report_first):
    base = enrich(reports(spark, {"speed": 0.0}))
    dark = detections(flag(base, DEFAULTS["ts_ms"] + 3_600_000))
    steps = [base, dark] if report_first else [dark, base]
    hot = None
    for n, step in enumerate([*steps, *steps]):  # and once more, as a replay would
        tiers.append_cold(tiers.as_cold(step), str(tmp_path / "cold"), n)
        tiers.upsert_hot(step, str(tmp_path / "hot"), n)
        hot = tiers.merge_hot(step, hot)
    row = tiers.scan_cold(spark, str(tmp_path / "cold")).collect()
    assert [(r["darkVessel"], r["vesselEvent"]["heading"], r["vesselEvent"]["sourceType"]) for r in row] == [
        (True, 90.0, "TERRESTRIAL")]
    for latest in (hot, tiers.read_hot(spark, str(tmp_path / "hot")), tiers.lookup_hot(spark, str(tmp_path / "hot"), "123456789")):
        latest = latest.withColumn("record", tiers.read_payload(F.col("payload"))).collect()
        assert [(r["dark_vessel"], r["record"]["darkVessel"], r["record"]["vesselEvent"]["heading"]) for r in latest] == [
            (True, True, 90.0)]
    assert tiers.lookup_hot(spark, str(tmp_path / "hot"), "999999999").count() == 0


# --- Avro-JSON, dead letters, channels ---


def test_avro_json_lines(spark, tmp_path):
    line = (
        '{"vesselEvent":{"mmsi":"012345678","latitude":1.5,"longitude":2.5,"speed":3.0,"heading":4.0,'
        '"timestamp":1710500000123,"eventType":"AIS","sourceType":{"string":"VESSEL"}},"inRestrictedZone":true,'
        '"zoneName":{"string":"Z"},"zoneType":null,"distanceToPort":7.0,"riskScore":50.0,"riskLevel":"HIGH"}'
    )
    path = tmp_path / "lines.json"
    path.write_text(line + "\n")
    row = to_flat(avro_json.read_lines(spark, str(path))).first()
    assert (row["mmsi"], row["ts_ms"], row["source_type"]) == ("012345678", 1710500000123, "VESSEL")
    assert (row["zone_name"], row["zone_type"], row["dark_vessel"]) == ("Z", None, False)


def test_poison_lines_go_to_dead_letters_and_the_rest_continue(spark):
    good = avro_json.to_avro_json(tiers.as_cold(enrich(reports(spark, {}, {"mmsi": "222222222"}))))
    bad = spark.createDataFrame([("{not json",), ('{"riskLevel":"LOW"}',), ("",), (None,)], "line string")
    parsed = avro_json.parse_lines(good.unionByName(bad))
    assert parsed.where("dead").count() == 4
    assert metrics.dead_letter_total(parsed).first()["dead_letters"] == 4
    alive = avro_json.normalise(parsed.where("NOT dead").select("record.*"))
    assert sorted(r["vesselEvent"]["mmsi"] for r in alive.collect()) == ["123456789", "222222222"]


def test_channels_round_trip(spark, tmp_path):
    root = str(tmp_path / "raw")
    write_channels(reports(spark, *[{"source_type": s} for s in ("TERRESTRIAL", "SATELLITE", "VESSEL")]), root)
    assert sorted(os.path.basename(d) for d in os.listdir(root) if d.startswith("topic")) == [
        "topic=ais.raw.satellite", "topic=ais.raw.terrestrial", "topic=ais.raw.vessel"]
    assert sorted(r["source_type"] for r in read_channels(spark, root).collect()) == ["SATELLITE", "TERRESTRIAL", "VESSEL"]


# --- serving ---


def test_history_keeps_days_without_percentiles(spark):
    stats = batch.daily_stats(cold(spark, *TWO_VESSELS, {"mmsi": A, "date": "2024-03-16"}))
    stats = stats.withColumn("avg_speed_kn", F.expr("CASE WHEN date < DATE '2024-03-16' THEN avg_speed_kn END"))
    some = batch.risk_percentiles(cold(spark, *TWO_VESSELS))
    rows = serving.history_of(stats, some, A).collect()
    assert [r["date"] for r in rows] == ["2024-03-16", "2024-03-15"]
    # A missing average reads 0, a missing percentile stays missing.
    assert (rows[0]["avg_speed_kn"], rows[0]["p50_risk"]) == (0.0, None)
    assert rows[1]["p50_risk"] == 30.0
    assert serving.history_of(stats, some, "999999999").count() == 0


def test_history_is_ninety_rows_and_charts_oldest_first(spark):
    from datetime import date, timedelta

    days = [(date(2024, 1, 1) + timedelta(days=2 * i)).isoformat() for i in range(100)]
    frame = cold(spark, *[{"mmsi": A, "date": d} for d in days])
    rows = serving.history(batch.daily_stats(frame), batch.risk_percentiles(frame))
    assert sorted(r["date"] for r in rows.collect()) == days[10:]
    first = serving.chart(rows).orderBy("position").first()
    assert (first["date"], first["date_label"]) == (days[10], "Jan 21")


def test_serving_view_keeps_both_sides(spark):
    hot = tiers.hot_table(enrich(reports(spark, {"mmsi": A}, {"mmsi": "333333333"})))
    frame = cold(spark, *TWO_VESSELS)
    view = serving.serving_view(hot, serving.history(batch.daily_stats(frame), batch.risk_percentiles(frame)))
    assert {(r["mmsi"], r["risk_level"] is None, r["date"] is None) for r in view.collect()} == {
        (A, False, False), (B, True, False), ("333333333", False, True)}
