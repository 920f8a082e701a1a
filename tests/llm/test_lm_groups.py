"""Scores of texts whose filter is not broadcast."""

import os

import numpy as np
import pytest

from wakeline.llm import lm, lm_groups


def by_text(frame, **given):
    rows = lm.score_documents(frame, **given).collect()
    return sorted(map(tuple, rows), key=lambda r: (str(r[0]), r[2], r[5]))


def test_groups_score_as_one(spark, monkeypatch):
    """Pairs and words of several groups count together, with texts that are null, blank, repeated or without an id."""
    texts = [None, "", "  ", "a", "a b", "a b a b a b", "the same words " * 30, "b a", "other words\n\tagain"]
    rows = [(i % 40 if i % 7 else None, texts[i % len(texts)]) for i in range(120)]
    rows += [(1000 + i, " ".join(f"w{(i * j) % 31} x{i}" for j in range(40))) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = by_text(frame)
    monkeypatch.setattr(lm_groups, "GROUP_BYTES", 2000)
    got = by_text(frame, filter_bytes=0)
    assert len(got) == len(rows) and [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)
    # No training rows, and no rows.
    held = frame.where(lm.held_out("doc_id"))
    assert by_text(held, filter_bytes=0) == by_text(held)
    assert by_text(frame.limit(0), filter_bytes=0) == []


def test_what_is_written_is_less_than_the_input(spark, tmp_path):
    """Pairs to ask for were listed by text, which took several times the input."""
    rng = np.random.default_rng(5)
    words = np.array(["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(20_000)])
    picks = (rng.pareto(0.7, (400, 800)) * 20).astype(np.int64) % len(words)
    rows = [(i, " ".join(words[p])) for i, p in enumerate(picks)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(2).write.parquet(f"{tmp_path}/docs")
    frame = spark.read.parquet(f"{tmp_path}/docs")

    def bytes_in(folder):
        return sum(os.path.getsize(f"{d}/{x}") for d, _, names in os.walk(folder) for x in names if x.endswith(".parquet"))

    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = bytes_in(shared)
    assert lm.score_documents(frame, filter_bytes=0).count() == len(rows)
    assert bytes_in(shared) - before < 1.5 * bytes_in(tmp_path)


def test_places_lay_segments_side_by_side():
    rng = np.random.default_rng(1)
    keys = np.concatenate([rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2), np.arange(3000, dtype=np.uint64), ~np.arange(3000, dtype=np.uint64)])
    for number in (1024, 1025, 3001, 1 << 20):
        places = lm_groups._places(keys, number)
        assert len(np.unique(places)) == len(np.unique(keys))
        segment = (keys % np.uint64(number))[np.argsort(places)]
        assert (np.diff(segment.astype(np.int64)) >= 0).all()
        first = lm_groups._first_place(keys % np.uint64(number), number)
        assert ((places - first) * np.uint64(number) + keys % np.uint64(number) == keys).all()


def test_packed_numbers_come_back():
    for values in (np.arange(300, dtype=np.uint64) << np.uint64(40), np.zeros(0, np.int32), np.linspace(0, 9, 50)):
        assert (lm_groups._unpacked(lm_groups._packed(values), len(values), values.dtype) == values).all()
