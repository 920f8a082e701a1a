"""Streams give what the batch gives, also in many micro-batches and after a restart."""

import pytest
from pyspark.sql import functions as F
from rows import reports

from wakeline.operators import detect
from wakeline.operators.crossings import hex_crossings
from wakeline.operators.dedup import accept, route
from wakeline.operators.enrich import enrich
from wakeline.operators.validate import explain_reason, valid
from wakeline.plans import metrics
from wakeline.schemas import RAW_REPORT
from wakeline.sources import tiers
from wakeline.sources.reports import events_as_reports, write_channels
from wakeline.streaming import behaviour, jobs, routing, sources
from wakeline.streaming import metrics as live
from wakeline.streaming.tables import put

SF_DIR = "/root/testdata/sf0.001"
TEN_DAYS_MS = 10 * 24 * 3_600_000
T0 = 1_710_500_000_000


def everything(spark, path):
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


def same(left, right, columns):
    left, right = left.select(*columns), right.select(*columns)
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


@pytest.fixture(scope="module")
def raw(spark):
    return events_as_reports(spark, SF_DIR).persist()


@pytest.fixture(scope="module")
def streamed(spark, raw, tmp_path_factory):
    """ETL over the reports in three deliveries, stopping and starting again between them.

    Deliveries are cut by arrival, and each holds the three channels.
    """
    root = str(tmp_path_factory.mktemp("streamed"))
    first = raw.agg(F.min("ingest_ms")).first()[0]
    for part in range(3):
        in_part = F.least(F.floor((F.col("ingest_ms") - first) / TEN_DAYS_MS), F.lit(2)) == part
        write_channels(raw.where(in_part).coalesce(1), f"{root}/raw")
        stream = sources.stream_channels(spark, f"{root}/raw")
        jobs.start_etl(stream, root).awaitTermination()
    return root


def test_reports_without_a_channel_are_streamed(spark, raw, tmp_path):
    root = str(tmp_path)
    kind = F.expr("CASE WHEN seq % 3 = 0 THEN NULL WHEN seq % 3 = 1 THEN 'BALLOON' ELSE source_type END")
    written = raw.limit(300).withColumn("source_type", kind)
    stream = sources.stream_channels(spark, f"{root}/raw")
    write_channels(written, f"{root}/raw")
    options = {"path": f"{root}/out", "checkpointLocation": f"{root}/checkpoint"}
    stream.writeStream.format("parquet").options(**options).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 300


@pytest.fixture(scope="module")
def batch(raw):
    return route(raw), enrich(accept(valid(raw)))


def _enriched_stream(spark, streamed):
    return sources.stream_table(spark, f"{streamed}/enriched", everything(spark, f"{streamed}/enriched").schema)


def test_etl_routes_as_the_batch(spark, streamed, batch):
    routed, enriched = batch
    assert same(everything(spark, f"{streamed}/enriched"), enriched, enriched.columns)
    quarantined = routed.where("reason_code IS NOT NULL")
    assert same(everything(spark, f"{streamed}/quarantine"), quarantined, ["seq", "mmsi", "reason_code"])


DETECTED = ["mmsi", "seq", "ts_ms", "detection", *detect.FLAGS, "heading", "source_type", "risk_score", "zone_name"]


def assert_detected(live, enriched):
    found = detect.detections(detect.flag(enriched, enriched.agg(F.max("ingest_ms")).first()[0]))
    assert same(live.where("detection <> 'back_online'"), found, DETECTED)
    assert same(live.where("detection = 'back_online'"), detect.back_online(enriched), ["mmsi", "seq", "ts_ms"])


def test_detection_as_the_batch(spark, streamed, batch, tmp_path):
    jobs.start_detection(_enriched_stream(spark, streamed), str(tmp_path)).awaitTermination()
    assert_detected(behaviour.detections_table(spark, str(tmp_path)), batch[1])


def test_crossings_as_the_batch(spark, streamed, batch, tmp_path):
    jobs.start_crossings(_enriched_stream(spark, streamed), str(tmp_path)).awaitTermination()
    columns = ["mmsi", "seq", "from_cell", "to_cell", "ts_ms"]
    assert same(behaviour.crossings_table(spark, f"{tmp_path}/moves"), hex_crossings(batch[1]), columns)


def test_any_order_and_cut_gives_the_batch(spark, tmp_path):
    """Files of mixed order, one a micro-batch, through routing, detection and crossings; replays and all."""
    root = str(tmp_path)
    raw = events_as_reports(spark, SF_DIR)
    raw = raw.unionByName(raw.where("seq % 50 = 0")).repartition(4).cache()
    raw.write.parquet(f"{root}/raw")
    stream = sources.stream_table(spark, f"{root}/raw", RAW_REPORT, files_per_trigger=1)
    jobs.start_etl(stream, root).awaitTermination()
    enriched = enrich(accept(valid(raw))).cache()
    live = routing.current(spark, root, "enriched")
    assert same(live, enriched, enriched.columns)
    assert live.where("correlation_id IS NULL").count() == 0
    failed = routing.current(spark, root, "quarantine")
    assert same(failed, explain_reason(route(raw).where("reason_code IS NOT NULL")), ["seq", "reason_code", "reason"])
    assert spark.read.parquet(f"{root}/withdrawn").count() > 0
    for start in (jobs.start_detection, jobs.start_crossings):
        source = sources.stream_table(spark, f"{root}/enriched", live.schema, files_per_trigger=1)
        gone = sources.stream_table(spark, f"{root}/withdrawn", routing.WITHDRAWN, files_per_trigger=1)
        start(source, f"{root}/{start.__name__}", withdrawn=gone).awaitTermination()
    assert_detected(behaviour.detections_table(spark, f"{root}/start_detection"), enriched)
    moved = behaviour.crossings_table(spark, f"{root}/start_crossings/moves")
    assert same(moved, hex_crossings(enriched), ["mmsi", "seq", "from_cell", "to_cell", "ts_ms"])


def test_replayed_epoch_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    steps = [reports(spark, {}, {"ts_ms": T0 + 60_000}), reports(spark, {"ingest_ms": T0 + 1}, {"speed": -1.0})]
    for epoch, frame in [(0, steps[0]), (1, steps[1]), (1, steps[1])]:
        kept, failed = routing.route_batch(frame, epoch, root)
        put(kept, root, "enriched", epoch)
        put(failed, root, "quarantine", epoch)
    assert routing.current(spark, root, "enriched").count() == 2
    assert sorted(r.reason_code for r in routing.current(spark, root, "quarantine").collect()) == ["duplicate", "speed"]
    cold = tiers.as_cold(enrich(steps[0]))
    for number in (0, 0, 1):
        tiers.append_cold(cold, f"{root}/cold", number)
    assert tiers.scan_cold(spark, f"{root}/cold").count() == 2


def test_events_from_a_folder(spark, tmp_path):
    spark.read.parquet(f"{SF_DIR}/events.parquet").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    stream = sources.stream_events(spark, str(tmp_path), files_per_trigger=1)
    jobs.start_etl(stream, f"{tmp_path}/out").awaitTermination()
    total = sum(routing.current(spark, f"{tmp_path}/out", r).count() for r in ("enriched", "quarantine"))
    assert total == events_as_reports(spark, SF_DIR).count()


def test_dead_lines_have_a_place(spark, tmp_path):
    lines = ["no json", '{"vesselEvent": {"mmsi": null}}']
    spark.createDataFrame([(x,) for x in lines], "line string").write.parquet(f"{tmp_path}/in")
    stream = sources.stream_table(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema)
    jobs.start_lines(stream, str(tmp_path)).awaitTermination()
    assert sorted(r.line for r in everything(spark, f"{tmp_path}/dead-letter").collect()) == sorted(lines)
    assert everything(spark, f"{tmp_path}/records").count() == 0


def test_tiers_as_the_batch(spark, streamed, batch, tmp_path):
    """Reports and detections streamed into both tiers give the flagged reports of the batch."""
    _, enriched = batch
    root = str(tmp_path)
    flagged = detect.flag(enriched, enriched.agg(F.max("ingest_ms")).first()[0]).persist()
    jobs.start_detection(_enriched_stream(spark, streamed), root).awaitTermination()
    found = everything(spark, f"{root}/detections").schema
    for start in (jobs.start_cold_tier, jobs.start_hot_tier):
        detections = sources.stream_table(spark, f"{root}/detections", found)
        start(_enriched_stream(spark, streamed), root, detections=detections).awaitTermination()
    written = tiers.scan_cold(spark, f"{root}/cold")
    columns = ["vesselEvent", "seq", "riskScore", *tiers.COLD_FLAGS, "rebuilt", "date"]
    assert same(written, tiers.latest_copy(tiers.as_cold(flagged)), columns)
    assert same(tiers.read_hot(spark, f"{root}/hot"), tiers.hot_table(flagged), tiers.HOT_COLUMNS)


def test_late_arrivals_are_set_aside_where_asked(spark, tmp_path):
    root, hour = str(tmp_path), 3_600_000
    steps = [
        [{"mmsi": "111111111", "ts_ms": T0}, {"mmsi": "222222222", "ts_ms": T0}],
        [{"mmsi": "111111111", "ts_ms": T0 - hour}, {"mmsi": "222222222", "ts_ms": T0 + 60_000}],
        [{"mmsi": "222222222", "ts_ms": T0, "ingest_ms": T0 + 50_000}],
    ]
    for name, lateness, late in [("on", 600_000, ["111111111"]), ("off", None, [])]:
        for step in steps:
            reports(spark, *step).coalesce(1).write.mode("append").parquet(f"{root}/{name}/in")
            stream = sources.stream_table(spark, f"{root}/{name}/in", RAW_REPORT)
            jobs.start_etl(stream, f"{root}/{name}", lateness_ms=lateness).awaitTermination()
        codes = [(r.mmsi, r.reason_code) for r in routing.current(spark, f"{root}/{name}", "quarantine").collect()]
        assert sorted(codes) == sorted([*((m, "late") for m in late), ("222222222", "duplicate")])


def test_rates_as_the_batch(spark, batch, tmp_path):
    """Files of mixed order, one a micro-batch: every window of the batch, and a later file is added to them."""
    routed, _ = batch
    flat = routed.withColumn("latency_ms", F.col("ingest_ms") - F.col("ts_ms")).repartition(10).persist()
    for part in ("seq % 3 > 0", "seq % 3 = 0"):
        flat.where(part).write.mode("append").parquet(f"{tmp_path}/routed")
        for start in (live.start_rates, live.start_latencies):
            stream = sources.stream_table(spark, f"{tmp_path}/routed", flat.schema, files_per_trigger=1)
            start(stream, str(tmp_path)).awaitTermination()
    for emitted, expected in [
        (live.rates_table(spark, str(tmp_path)), metrics.rate_1m(flat)),
        (live.latencies_table(spark, str(tmp_path)), metrics.latency_p99(flat)),
    ]:
        assert same(emitted, expected, expected.columns) and emitted.count() == expected.count() > 100


def test_percentiles_of_windows_are_exact_while_small(spark):
    rows = [(i * 7_000, (i * 37) % 1000 - 5 if i % 50 else None) for i in range(400)] + [(None, 3)]
    frame = spark.createDataFrame(rows, "ingest_ms long, latency_ms long")
    got = {r.start_ms: (r.p99_ms, r.samples) for r in metrics.latency_p99(frame).collect()}
    want = {}
    for start in range(-240_000, 400 * 7_000, 60_000):
        inside = [v for t, v in rows if t is not None and start <= t < start + 300_000]
        if inside:
            values = sorted(v for v in inside if v is not None)
            want[start] = (values[-(-99 * len(values) // 100) - 1] if values else None, len(inside))
    assert got == want
