"""Tables in segments: commits, folding, crashes, and what is read and written."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F
from rows import reports

from wakeline.operators.enrich import enrich
from wakeline.sources import segments, tiers
from wakeline.streaming.tables import newest_rows, recall, remember


def rows_of(frame):
    return sorted(map(tuple, frame.collect()))


def newest_per_key(rows):
    return rows.groupBy("k").agg(F.max(F.struct("n", "v")).alias("_r")).select("k", "_r.n", "_r.v")


def step(spark, number):
    """Some keys come again and again, each commit brings one of its own."""
    keys = [number % 3, 100 + number]
    return spark.createDataFrame([(k, number, f"{k}@{number}") for k in keys], "k int, n int, v string")


def folders(root):
    return sorted(os.path.basename(p) for p in glob.glob(f"{root}/_segment=v*"))


def test_segments_stay_few_and_rows_stay_the_same(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(segments, "FAN", 3)
    root, seen, most = str(tmp_path / "t"), {}, 0
    for number in range(28):
        segments.append(step(spark, number), root, number, fold=newest_per_key)
        seen |= {k: (k, n, v) for k, n, v in step(spark, number).collect()}
        most = max(most, len(segments.version(spark, root).segments))
        assert segments.version(spark, root).number == number
    assert rows_of(newest_per_key(segments.read(spark, root))) == sorted(seen.values())
    # Two a class at most, and classes grow with the logarithm; folders of old versions are gone.
    assert most <= 2 * 4 and len(folders(root)) <= most + 3 * segments.KEPT_VERSIONS
    assert len(glob.glob(f"{root}/_versions/*.json")) == segments.KEPT_VERSIONS
    # An earlier version reads as it was; a number committed before changes nothing.
    assert 126 not in {r[0] for r in segments.read(spark, root, upto=25).collect()}
    before = folders(root)
    segments.append(step(spark, 5), root, 27, fold=newest_per_key)
    assert folders(root) == before


@pytest.mark.parametrize("dies_at", range(4))
def test_a_crash_between_any_two_writes_loses_nothing(spark, tmp_path, monkeypatch, dies_at):
    """The third commit folds; its first attempt dies before the segment, the fold, the version file, or the clean-up."""
    monkeypatch.setattr(segments, "FAN", 3)
    root = str(tmp_path / "t")
    for number in range(2):
        segments.append(step(spark, number), root, number, fold=newest_per_key)
    before = rows_of(segments.read(spark, root))
    calls, writers = [0], {name: getattr(segments, name) for name in ("_write", "write_text", "_retire")}

    def dying(name):
        def call(*args):
            calls[0] += 1
            if calls[0] > dies_at:
                raise RuntimeError("executor lost")
            return writers[name](*args)

        return call

    with monkeypatch.context() as patch:
        for name in writers:
            patch.setattr(segments, name, dying(name))
        with pytest.raises(RuntimeError):
            segments.append(step(spark, 2), root, 2, fold=newest_per_key)
    if dies_at < 3:
        assert rows_of(segments.read(spark, root)) == before
    segments.append(step(spark, 2), root, 2, fold=newest_per_key)
    assert rows_of(newest_per_key(segments.read(spark, root))) == [
        (0, 0, "0@0"), (1, 1, "1@1"), (2, 2, "2@2"), (100, 0, "100@0"), (101, 1, "101@1"), (102, 2, "102@2")]
    assert segments.version(spark, root).segments == (("v2-1", 1),)


def test_a_gap_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        segments.append(step(spark, 3), str(tmp_path / "t"), 3)
    with pytest.raises(FileNotFoundError):
        segments.read(spark, str(tmp_path / "t"))


def test_remembered_rows_fold_to_the_last_micro_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(segments, "FAN", 2)
    for epoch in range(5):
        frame = spark.createDataFrame([("a", epoch), ("b", 0)] if epoch < 3 else [("a", epoch)], "mmsi string, x int")
        remember(frame, str(tmp_path), "open", epoch, fold=newest_rows("mmsi"))
    latest = newest_rows("mmsi")(recall(spark, str(tmp_path), "open"))
    assert rows_of(latest.select("mmsi", "x", "_epoch")) == [("a", 4, 4), ("b", 0, 2)]
    assert recall(spark, str(tmp_path), "open", upto=3).where("_epoch > 3").isEmpty()


def vessels(spark, *numbers, at=0):
    changes = [{"mmsi": f"2{n:08d}", "ingest_ms": 1_710_500_000_000 + at, "speed": float(at % 50)} for n in numbers]
    return enrich(reports(spark, *changes))


def test_a_lookup_opens_the_files_of_one_bucket(spark, tmp_path):
    root = str(tmp_path / "hot")
    tiers.upsert_hot(vessels(spark, *range(300)), root, 0)
    tiers.upsert_hot(vessels(spark, 7, 8, at=60_001), root, 1)
    found = tiers.lookup_hot(spark, root, "200000007")
    assert [r.ingest_ms for r in found.collect()] == [1_710_500_000_000 + 60_001]
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(bucket#\d+\), \(bucket#\d+ = \d+\)\]", scan)
    assert re.search(r"PushedFilters: \[.*EqualTo\(mmsi,200000007\)", scan)
    # Of the vessels' 64 buckets the files of one, in both segments.
    opened = {p.split("/bucket=")[1].split("/")[0] for p in _input_files(spark, root, "200000007")}
    assert len(opened) == 1 and len(glob.glob(f"{root}/_segment=v0-0/bucket=*")) > 40


def _input_files(spark, root, mmsi):
    rows = segments.read(spark, root)
    return [r[0] for r in rows.where(rows.bucket == tiers._bucket(F.lit(mmsi))).select(F.input_file_name()).distinct().collect()]


def test_a_micro_batch_writes_its_own_vessels(spark, tmp_path):
    root = str(tmp_path / "hot")
    tiers.upsert_hot(vessels(spark, *range(100)), root, 0)
    tiers.upsert_hot(vessels(spark, 3, 4, 3, at=7), root, 1)
    assert spark.read.parquet(f"{root}/_segment=v1-0").count() == 2
    assert tiers.read_hot(spark, root).count() == 100


def test_a_micro_batch_rewrites_no_date(spark, tmp_path):
    root, day = str(tmp_path / "cold"), 86_400_000
    files = []
    for number in range(3):
        frame = enrich(reports(spark, {"mmsi": f"20000000{number}"}, {"ts_ms": 1_710_500_000_000 + number * day, "speed": 1.0 + number}))
        tiers.append_cold(tiers.as_cold(frame), root, number)
        there = {p: os.path.getmtime(p) for p in glob.glob(f"{root}/_segment=v*/date=*/*.parquet")}
        assert all(there[p] == t for p, t in files)
        files = list(there.items())
    assert tiers.scan_cold(spark, root).count() == 6
    scan = tiers.scan_cold(spark, root, "2024-03-15")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*date", scan)
