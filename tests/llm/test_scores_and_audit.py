"""Importance resampling, the audit of filters and the quality votes, against plain Python versions and on odd rows."""

import hashlib
import itertools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import ITEM_WORD, LOWER, WORD
from pyspark.sql import functions as F
from test_edges import CLASHES, LONG, ROWS, SCHEMA, rows_of

from wakeline.llm import filter_audit as audit
from wakeline.llm import importance, quality_knn
from wakeline.llm.queries import QUERIES

LABELS = [(2, 1, 0), (4, 0, 1), (6, 1, 1), (6, 0, None), (7, None, None), (None, 1, 1), (99, 1, 0)]
LABEL_SCHEMA = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "one two three\nfour t1x1"), (2, None), (3, "")], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, LABEL_SCHEMA)


# --- importance resampling ---


def features(text, n):
    w = ITEM_WORD.findall((text or "").translate(LOWER))
    return w, [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def drawn(rows, target, n=1, buckets=10_000, least=20, percent=10):
    """(doc_id, n_features, weight, score, rank) of every row, from all features of every text."""

    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    s = Counter(bucket(f) for _, text in rows for f in features(text, n)[1])
    t = Counter(bucket(f) for text in target for f in features(text, n)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in rows:
        w, fs = features(text, n)
        gains = [
            math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
            for b in map(bucket, fs)
        ]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(fs), weight, score, len(w) >= least])
    order = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0], r[1]))
    wanted = len(order) * percent // 100
    ranks = {id(r): i + 1 for i, r in enumerate(order[:wanted])}
    return sorted(((*r[:4], ranks.get(id(r))) for r in out), key=str)


@pytest.mark.parametrize("n", [1, 3])
def test_draws_with_runs_over_line_ends(spark, n):
    rows = [(i, "\n".join(f"w{(i * 7 + j) % 40} Ä{j} x{i}" for j in range(i % 15)) + "\n\nsame line here") for i in range(300)]
    target = ["w1 ä1 x3\nw2 w3", "same\nline here w5"]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(t,) for t in target], "text string")
    scored = importance.importance_scores(frame, items, n=n, buckets=97)
    got = importance.draw(scored, percent=50).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted(map(tuple, got.collect()), key=str) == drawn(rows, target, n, 97, percent=50)


def test_draw_of_odd_rows(docs, items):
    """Nulls, blanks, repeated rows and a very long text; columns with clashing names change nothing."""
    scored = importance.importance_scores(docs, items)
    got = importance.draw(scored, least_words=0, percent=60).select("doc_id", "n_features", "weight", "score", "rank")
    want = drawn([r[:2] for r in ROWS], ["one two three\nfour t1x1"], least=0, percent=60)
    assert sorted(map(tuple, got.collect()), key=str) == want
    clashing = importance.importance_scores(docs.withColumns({c: F.lit("x") for c in CLASHES}), items)
    assert rows_of(clashing) == rows_of(scored)
    assert importance.importance_scores(docs.limit(0), items).collect() == []
    assert importance.draw(importance.importance_scores(docs.limit(0), items)).collect() == []
    assert importance.importance_scores(docs, items.limit(0)).count() == len(ROWS)
    kept = importance.resampled(docs, items)
    assert kept.columns == docs.columns and kept.count() == 0  # two documents of 20 words, and a tenth of them


def test_equal_rows_get_ranks_of_their_own(spark):
    rows = [(1, "a b c")] * 5 + [(2, "a b c")] * 5
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    scored = importance.importance_scores(frame, frame)
    got = importance.draw(scored, least_words=3, percent=70).collect()
    assert sorted((r.rank or 0) for r in got) == [0, 0, 0, 1, 2, 3, 4, 5, 6, 7]


# --- audit of filters ---


def fails(text):
    w = WORD.findall(text)
    found = "A" * (len(w) < 200) + "B" * (100 * len(set(w)) < 50 * len(w))
    found += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text))
    return found + "D" * any(c in "#$%&*|" for c in text)


def audited(rows, labels):
    """Every row of the audit, by running each order over each part."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, text, _ in rows:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    parts = defaultdict(list)
    for d, text, source in rows:
        same = d is not None and d > least[text or ""]
        parts[source or ""].append((d, fails(text or "") + "E" * same))
    out = {}
    for part, members in parts.items():
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(members)
            for step, f in enumerate(order, 1):
                removed = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                failing = sum(f in m[1] for m in members)
                shapley[f] += len(removed)
                out[part, order, step] = (
                    len(left), len(removed), failing - len(removed), sum(m[1] == f for m in members),
                    sum(m[0] in good for m in removed), sum(m[0] in toxic for m in removed),
                )
        for (p, order, step), values in out.items():
            if p == part:
                out[p, order, step] = (*values[:6], shapley[order[step - 1]])
    return out


def written(spark, tmp_path, rows, files=1, schema=SCHEMA):
    """The rows as a folder of files, in the order given, and later files later."""
    size = -(-len(rows) // files)
    for i in range(files):
        part = spark.createDataFrame(rows[i * size : (i + 1) * size], schema).coalesce(1)
        part.write.mode("append").parquet(f"{tmp_path}/table")
    return f"{tmp_path}/table"


def as_dict(frame):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in frame.collect()}


def test_audit_of_odd_rows(spark, tmp_path, labels):
    got = audit.filter_audit(audit.part_counters(spark, written(spark, tmp_path, ROWS), labels))
    assert as_dict(got) == audited([(r[0], r[1], r[3]) for r in ROWS], LABELS)
    clashing = spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("x") for c in [*CLASHES, "mask", "part", "n"] if c not in SCHEMA})
    clashing.write.parquet(f"{tmp_path}/clashing")
    again = audit.filter_audit(audit.part_counters(spark, f"{tmp_path}/clashing", labels))
    assert as_dict(again) == as_dict(got)


def test_smaller_ids_that_come_later_take_back(spark, tmp_path, labels):
    """Ids fall from file to file, so that nearly every micro-batch retracts; groups span parts, and one is a third."""
    texts = ["", "one text of a third", *(f"{k} " * 250 + "END" * (k % 3) + "#" * (k % 2) for k in range(9)), LONG]
    rows = [(i, texts[1] if i % 3 == 0 else texts[i % 12], None, ["a", "b", None, "c"][i % 4], None) for i in range(120, 0, -1)]
    table = written(spark, tmp_path, rows, files=6)
    labelled = [(i, i % 2, i % 5 == 0) for i in range(0, 130, 3)]
    known = spark.createDataFrame([(d, q, int(t)) for d, q, t in labelled], LABEL_SCHEMA)
    want = audited([(r[0], r[1], r[3]) for r in rows], labelled)
    for micro_batches in (1, 6):
        got = audit.part_counters(spark, table, known, micro_batches=micro_batches, root=f"{tmp_path}/{micro_batches}")
        assert as_dict(audit.filter_audit(got)) == want
    # Files that come later are counted on top; nothing is read twice.
    more = [(0, texts[1], None, "a", None), (500, texts[2], None, "new", None)]
    spark.createDataFrame(more, SCHEMA).coalesce(1).write.mode("append").parquet(table)
    got = audit.part_counters(spark, table, known, root=f"{tmp_path}/6")
    assert as_dict(audit.filter_audit(got)) == audited([(r[0], r[1], r[3]) for r in rows + more], labelled)


def test_a_micro_batch_done_again_changes_nothing(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, good long, toxic long")
    batches = [[(9, "x"), (8, "x"), (3, "y")], [(5, "x"), (4, "y")], [(1, "x"), (1, "x")]]
    root = str(tmp_path / "root")
    for epoch, rows in enumerate(batches):
        frame = spark.createDataFrame([(d, t, "p") for d, t in rows], "doc_id long, text string, part string")
        for _ in range(2):
            audit._fold(frame, epoch, root, labels)
    changes = audit.get(spark, root, "counters").groupBy("part").agg(F.sum("first_n"), F.sum("same_n"), F.sum("first_good"))
    assert [tuple(r) for r in changes.collect()] == [("p", 3, 4, 2)]


def test_audit_of_an_empty_table(spark, tmp_path, labels):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/empty")
    assert audit.filter_audit(audit.part_counters(spark, f"{tmp_path}/empty", labels)).collect() == []
    got = audit.part_counters(spark, written(spark, tmp_path, ROWS), labels.limit(0))
    assert {r.good_lost for r in audit.filter_audit(got).collect()} == {0}


# --- quality votes ---


def test_votes_are_those_of_the_nearest():
    rng = np.random.default_rng(3)
    labelled, vectors = rng.normal(size=(200, 8)), rng.normal(size=(30, 8))
    labelled[50:60] = labelled[50]  # ties
    labelled, vectors = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (labelled, vectors))
    y = rng.integers(0, 2, 200).astype(float)
    got = quality_knn.votes(vectors, labelled, y, 0.5)
    for vector, score in zip(vectors, got):
        cosines = [max(0.0, float(np.dot(vector, other))) for other in labelled]
        least = sorted(cosines)[-quality_knn.NEIGHBOURS]
        near = [(c**quality_knn.SHARPNESS, label) for c, label in zip(cosines, y) if c >= least - 1e-12]
        assert score == pytest.approx(sum(w * v for w, v in near) / sum(w for w, _ in near))


def test_terms_of_texts_do_not_depend_on_the_batch():
    texts = [r[1] for r in ROWS] + ["ABC!!! abc, 12 ###", "a" * 5000, "\x00\x01 \x7f"]
    together = quality_knn.term_vectors(pa.array(texts))
    apart = np.concatenate([quality_knn.term_vectors(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(together, apart) and (np.abs(together).sum(axis=1) > 0).all()
    assert np.allclose(together[0], together[1])  # null and empty


def test_held_out_quality(spark):
    """Labels that were not learned from are told apart; learned and held-out rows are dealt by the id alone."""
    sf = "/root/testdata/sf0.01"
    scored = QUERIES["op11_quality"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality IS NOT NULL")
    rows = [r for r in scored.join(labels, "doc_id").collect()]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [(r.score, r.quality) for r in rows if r.held_out]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    above = sum((g > b) + (g == b) / 2 for g in good for b in bad)
    assert above / (len(good) * len(bad)) > 0.95
    assert sum((s >= 0.7) == (q == 1) for s, q in held) / len(held) > 0.9


def test_scores_of_odd_rows(docs, labels):
    scored = quality_knn.quality_scores(docs, labels)
    got = scored.collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    by_text = defaultdict(set)
    for r, d in zip(sorted(got, key=lambda r: str(r.doc_id)), sorted(ROWS, key=lambda r: str(r[0]))):
        if d[0] is not None:
            by_text[d[1] or ""].add(round(r.score, 9))
    assert all(len(scores) == 1 for scores in by_text.values())
    clashing = docs.withColumns({c: F.lit("x") for c in [*CLASHES, "label", "_terms"]})
    assert rows_of(quality_knn.quality_scores(clashing, labels)) == rows_of(scored)
    assert quality_knn.quality_scores(docs.limit(0), labels).collect() == []
    assert {r.score for r in quality_knn.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
