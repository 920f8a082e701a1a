"""Importance resampling towards a target distribution, over hashed n-gram features.

A feature is a run of 1 to ``n`` consecutive words, and falls into one of ``buckets`` by the CRC-32 of its bytes. How often
each bucket occurs in all documents is counted by segment: line ends part words, so texts are cut into lines, equal lines
are counted, and the features of each distinct line are taken once and multiplied by its occurrences. Runs that reach over a
line end belong to no line and are added from the texts; runs of one word never do.

The gain of a bucket is the scaled logarithm of its share in the target over its share in the documents. The weight of a
document is the mean gain of its features, and a draw without replacement takes the greatest sums of weight and Gumbel
noise, which a seeded digest of the id gives.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.common import slices, small, staged

BUCKETS = 10_000
#: Longest run of words that is a feature.
RUN = 1
SEED = 2024
#: Documents of fewer words are not drawn.
LEAST_WORDS = 20
#: Share of the documents that is drawn, in hundredths.
PERCENT = 10

_COUNTS = "bucket int, features long"
_SCORED = "_id {}, n_features long, n_words long, weight long"


def _word_bytes() -> bytes:
    """Byte by byte: A-Z as a-z, letters, digits and bytes beyond ASCII as they are, the rest as a space."""
    table = bytearray(b" " * 256)
    for b in range(256):
        if b >= 0x80 or chr(b).isalnum():
            table[b] = ord(chr(b).lower()) if b < 0x80 else b
    return bytes(table)


_TABLE = _word_bytes()


def _runs(words: list[bytes], n: int) -> list[list[int]]:
    """For each length up to ``n`` the CRC-32 of every run, by its first word; a run goes on from the one a word shorter."""
    runs = [list(map(crc32, words))]
    for k in range(2, n + 1):
        runs.append([crc32(b" " + word, start) for start, word in zip(runs[-1], words[k - 1 :])])
    return runs


def _utf8(column: pa.Array) -> list[bytes]:
    return column.fill_null("").cast(pa.large_binary()).to_pylist()


def _count_lines(n: int, buckets: int):
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for piece in slices(batches, "line"):
            features, lengths = [], []
            for line in _utf8(piece.column("line")):
                before = len(features)
                for run in _runs(line.translate(_TABLE).split(), n):
                    features.extend(run)
                lengths.append(len(features) - before)
            times = np.repeat(piece.column("n").to_numpy(zero_copy_only=False), lengths)
            np.add.at(total, np.array(features, np.int64) % buckets, times)
        yield _counted(total)

    return counts


def _count_across(n: int, buckets: int):
    """Features of two words or more that reach over a line end."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for piece in slices(batches, "text"):
            for text in _utf8(piece.column("text")):
                lines = [line.translate(_TABLE).split() for line in text.split(b"\n")]
                line_of = np.repeat(np.arange(len(lines)), [len(line) for line in lines])
                for k, run in enumerate(_runs([word for line in lines for word in line], n)):
                    if k and run:
                        across = line_of[k:] != line_of[: len(line_of) - k]
                        np.add.at(total, np.array(run, np.int64)[across] % buckets, 1)
        yield _counted(total)

    return counts


def _counted(total: np.ndarray) -> pa.RecordBatch:
    found = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], ["bucket", "features"])


def feature_counts(texts: DataFrame, text_column: str = "text", n: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """Rows (bucket, features): how many features of all texts fall into each bucket that has any.

    A null text has none. Equal lines are reduced before the shuffle, so a line that very many texts hold sends one row a
    task, and a task sends at most one row a bucket.
    """
    texts = texts.select(F.col(text_column).alias("text")).where("text IS NOT NULL AND text <> ''")
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    found = lines.groupBy("line").agg(F.count("*").alias("n")).mapInArrow(_count_lines(n, buckets), _COUNTS)
    if n > 1:
        found = found.unionByName(texts.mapInArrow(_count_across(n, buckets), _COUNTS))
    return found.groupBy("bucket").agg(F.sum("features").alias("features"))


def _vector(counts: DataFrame, buckets: int) -> np.ndarray:
    """The counts as a vector; one row a bucket comes to the driver."""
    vector = np.zeros(buckets)
    for row in counts.collect():
        vector[row["bucket"]] = row["features"]
    return vector


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares, rounded down, of each bucket."""
    s, t, buckets = documents.sum(), target.sum(), len(documents)
    ratio = (target + 1.0) * (s + buckets) / ((documents + 1.0) * (t + buckets))
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


def _weigh(gain: np.ndarray, n: int):
    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "_text"):
            features, lengths, n_words = [], [], []
            for text in _utf8(piece.column("_text")):
                before = len(features)
                words = text.translate(_TABLE).split()
                for run in _runs(words, n):
                    features.extend(run)
                n_words.append(len(words))
                lengths.append(len(features) - before)
            sums = np.concatenate([[0], np.cumsum(gain[np.array(features, np.int64) % len(gain)])])
            ends = np.cumsum(lengths)
            size = np.array(lengths, np.int64)
            weight = (sums[ends] - sums[ends - size]) // np.maximum(size, 1)
            yield pa.RecordBatch.from_arrays(
                [piece.column("_id"), pa.array(size), pa.array(n_words, pa.int64()), pa.array(weight.astype(np.int64))],
                ["_id", "n_features", "n_words", "weight"],
            )

    return weights


def _noise(seed: int) -> Column:
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000.0 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def importance_scores(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_text: str = "text",
    n: int = RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """Rows (<id>, n_features, n_words, weight, score), one a row of ``docs``; written to the shared folder.

    Null and empty texts, and texts without words, have no features and weight 0. A null id has the noise of an empty one;
    rows of equal ids have equal noise. An empty target leaves the gains to the documents' counts alone. Other columns
    are not read.
    """
    documents = _vector(feature_counts(docs, text_column, n, buckets), buckets)
    gain = gains(documents, _vector(feature_counts(target, target_text, n, buckets), buckets))
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    weighed = texts.mapInArrow(_weigh(gain, n), _SCORED.format(texts.schema["_id"].dataType.simpleString()))
    scored = staged(weighed.withColumn("score", F.col("weight") + _noise(seed)), "importance")
    return scored.withColumnRenamed("_id", id_column)


def draw(
    scored: DataFrame, id_column: str = "doc_id", least_words: int = LEAST_WORDS, percent: int = PERCENT
) -> DataFrame:
    """All rows of ``importance_scores`` with ``rank``: 1, 2, 3 ... for those drawn, null for the others.

    Of the N rows of enough words the floor of ``percent`` N / 100 greatest scores are drawn; ties go to the smaller id, a
    null id last, then to fewer features. A histogram of the scores gives the least score drawn and the first rank of
    each; scores are whole thousandths of a logarithm, so it has some ten thousand rows for any number of documents.
    Equal rows are folded to one with a count before ranks are given, so no score is a large group.
    """
    rows = scored.select(F.col(id_column).alias("_id"), "n_features", "n_words", "weight", "score")
    eligible = F.expr(f"coalesce(n_words >= {int(least_words)}, false)")
    histogram = rows.where(eligible).groupBy("score").agg(F.count("*").alias("n")).collect()
    histogram.sort(key=lambda r: -r["score"])
    wanted = sum(r["n"] for r in histogram) * percent // 100
    first, above = [], 0
    for row in histogram:
        if above >= wanted:
            break
        first.append((row["score"], above))
        above += row["n"]
    spark = scored.sparkSession
    ranks = spark.createDataFrame(first, "score long, _above long")
    least = first[-1][0] if first else None
    near = eligible & (F.col("score") >= least) if first else F.lit(False)
    folded = rows.where(near).groupBy("_id", "n_features", "n_words", "weight", "score").agg(F.count("*").alias("_n"))
    order = Window.partitionBy("score").orderBy(F.asc_nulls_last("_id"), "n_features", "n_words", "weight")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = folded.withColumn("_upto", F.sum("_n").over(upto)).join(small(ranks), "score")
    each = placed.withColumn("_i", F.explode(F.expr("sequence(_upto - _n + 1, _upto)")))
    rank = F.expr(f"CASE WHEN _above + _i <= {wanted} THEN _above + _i END")
    names = ["_id", "n_features", "n_words", "weight", "score"]
    drawn = each.select(*names, rank.alias("rank"))
    rest = rows.where(~near).select(*names, F.lit(None).cast("bigint").alias("rank"))
    return drawn.unionByName(rest).withColumnRenamed("_id", id_column)


def resampled(docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options):
    """The rows of ``docs`` that are drawn, with all their columns; a repeated or null id stays if one row of it is drawn."""
    kept = draw(importance_scores(docs, target, id_column, text_column, **options), id_column).where("rank IS NOT NULL")
    ids = staged(kept.select(F.col(id_column).alias("_drawn")).distinct(), "drawn")
    names = [f"_in_{i}" for i in range(len(docs.columns))]
    at = names[docs.columns.index(id_column)]
    renamed = docs.toDF(*names)
    return renamed.join(small(ids), F.col(at).eqNullSafe(F.col("_drawn")), "left_semi").toDF(*docs.columns)
