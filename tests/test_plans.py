"""The physical plans are the ones meant."""

import re

import pytest
from rows import cold

import __spark_entry__ as contract
from wakeline.operators.detect import flag
from wakeline.operators.enrich import enrich
from wakeline.operators.tracks import trail
from wakeline.operators.validate import valid
from wakeline.plans import batch
from wakeline.sources import tiers
from wakeline.sources.reports import events_as_reports

SF_DIR = "/root/testdata/sf0.001"


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_date_filter_prunes_partitions_and_columns(spark, tmp_path):
    root = str(tmp_path / "cold")
    tiers.write_cold(cold(spark, {}, {"date": "2024-03-16"}), root)
    text = plan(batch.risk_percentiles(tiers.scan_cold(spark, root, "2024-03-15")))
    assert re.search(r"PartitionFilters: \[.*date", text)
    assert re.search(r"ReadSchema: struct<vesselEvent:struct<mmsi:string>,riskScore:double>", text)


def test_hotspots_push_the_flag_to_the_scan(spark, tmp_path):
    root = str(tmp_path / "cold")
    tiers.write_cold(cold(spark, {}), root)
    text = plan(batch.hotspots(tiers.scan_cold(spark, root)))
    assert re.search(r"PushedFilters: \[.*EqualTo\(loitering,true\)", text)
    # The rank limit runs before the shuffle by day as well as after it.
    assert text.count("WindowGroupLimit") == 2


def test_trail_limits_before_the_shuffle(spark):
    assert plan(trail(valid(events_as_reports(spark, SF_DIR)))).count("WindowGroupLimit") == 2


def test_enrichment_does_not_shuffle_the_reports(spark):
    text = plan(enrich(valid(events_as_reports(spark, SF_DIR))))
    report_side = text.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in report_side
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_no_shuffle_by_vessel_alone_but_of_slice_edges(spark, tmp_path):
    """Whole reports move once, by (vessel, slice); by vessel alone only the edges of slices move."""
    path = str(tmp_path / "accepted")
    valid(events_as_reports(spark, SF_DIR)).write.parquet(path)
    stats = batch.daily_stats(tiers.as_cold(flag(enrich(spark.read.parquet(path)), 0)))
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(stats))
    keyed = [re.sub(r"#\d+L?", "", s).rsplit(", ", 1)[0] for s in shuffles]
    # The partial daily sums; the reports; the zone cover; the edges by vessel and by slice.
    assert keyed == ["_groupingexpression, date", "mmsi, _slice", "cell_x, cell_y", "mmsi", "mmsi, _slice"]


@pytest.mark.parametrize("name", ["validate_reason", "daily_stats", "hex_enriched", "track_resample", "history"])
def test_batch_plans_have_no_python_and_no_cross_join(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"):
        assert word not in text


def test_generated_methods_can_be_compiled(spark):
    """Methods over 8000 bytes of byte code are left uncompiled by the JVM."""
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    for name in ("validate_reason", "haversine", "hex_cell", "cold_latest"):
        text = contract.queries()[name](spark, SF_DIR)._jdf.queryExecution().explainString(mode)
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
        assert max(sizes, default=0) < 8000, name
