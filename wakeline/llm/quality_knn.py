"""A quality score by votes of the nearest labelled documents in a latent space.

A document is a vector of hashed terms in blocks: its words, the shapes of its words (runs of small letters, capitals,
digits, single marks), neighbouring shapes, and how long, repetitive and marked up it is. Terms are weighted by the inverse
of how many labelled documents have them. The singular vectors of the labelled documents span the latent space. The
labelled vectors are sent to every executor, and every document is compared with all of them in blocks, exactly; its
nearest ones vote with their label, by similarity.

Only the labelled rows are sampled, by a bound; every document is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import slices, staged
from wakeline.llm.words import hashed_words, mix, utf8

#: Most labelled documents that the space is fitted on and that vote: those of the smallest digests of their ids. Their
#: term vectors come to the driver (4 MB a thousand), their latent vectors go to every executor (0.3 MB a thousand).
MAX_LABELLED = 6_000
LATENT = 64
NEIGHBOURS = 25
#: Votes count by this power of the cosine.
SHARPNESS = 8
#: A document of at least this score is called good.
GOOD = 0.7
#: Rows whose CRC-32 of the id leaves this remainder are never learned from.
FOLDS, HELD_OUT = 4, 2

WORDS, SHAPES, PAIRS = 512, 512, 512
#: Steps of each of the measures, and their weights beside the word and shape blocks.
STEPS = 16
MEASURES = ("length", "distinct words", "distinct triples", "word length", "marks", "capitals", "digits", "line length")
BLOCKS = (("words", WORDS, 0.3), ("shapes", SHAPES, 1.0), ("pairs", PAIRS, 0.7), *((m, STEPS, 0.5) for m in MEASURES))

_BYTES = np.arange(256)
#: Small letters and all beyond ASCII as a, capitals as b, digits as 0; marks and white space as they are.
_SHAPE = _BYTES.astype(np.uint8)
_SHAPE[(_BYTES >= 97) & (_BYTES <= 122) | (_BYTES >= 128)] = ord("a")
_SHAPE[(_BYTES >= 65) & (_BYTES <= 90)] = ord("b")
_SHAPE[(_BYTES >= 48) & (_BYTES <= 57)] = ord("0")
_CAPITAL, _DIGIT = _SHAPE == ord("b"), _SHAPE == ord("0")
_CAPITAL[ord("b")] = False
_SPACE = (_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D))
_MARK = (_BYTES > 0x20) & ~_CAPITAL & ~_DIGIT & (_SHAPE != ord("a")) & (_BYTES != ord("b"))


def _shape_words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashes of the shapes of all words: a run of one class counts as one character, as does a run of one mark."""
    shaped = _SHAPE[data]
    kept = np.ones(len(data), bool)
    kept[1:] = (shaped[1:] != shaped[:-1]) | _SPACE[data[1:]]
    kept[offsets[offsets < len(data)]] = True
    ends = np.concatenate([[0], np.cumsum(kept)])[offsets]
    buffers = [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(shaped[kept].tobytes())]
    return hashed_words(pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, buffers))[0]


def _counts(rows: np.ndarray, hashes: np.ndarray, n: int, width: int) -> np.ndarray:
    flat = rows * width + (hashes % np.uint64(width)).astype(np.int64)
    return np.log1p(np.bincount(flat, minlength=n * width).reshape(n, width)).astype(np.float32)


def _distinct(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """How many distinct hashes each row has."""
    _, first = np.unique(mix(hashes ^ mix(rows.astype(np.uint64) + np.uint64(1))), return_index=True)
    return np.bincount(rows[first], minlength=n)


def _step(value: np.ndarray) -> np.ndarray:
    """A measure from 0 to 1 as two neighbouring steps, each the more the nearer it is."""
    at = np.clip(value, 0, 1) * (STEPS - 1)
    low = np.minimum(at.astype(np.int64), STEPS - 2)
    out = np.zeros((len(value), STEPS), np.float32)
    rows = np.arange(len(value))
    out[rows, low] = low + 1 - at
    out[rows, low + 1] = at - low
    return out


def term_vectors(column: pa.Array) -> np.ndarray:
    """One row of terms a text; a null text is an empty one, and no row is all zero."""
    n = len(column)
    data, offsets = utf8(column)
    hashes, firsts = hashed_words(column)
    sizes = np.diff(firsts)
    rows = np.repeat(np.arange(n), sizes)
    shapes = _shape_words(data, offsets) if len(data) else hashes
    beside = rows[1:] == rows[:-1]
    pairs = mix(shapes[:-1] + mix(shapes[1:]))[beside]
    inside = rows[2:] == rows[:-2]
    triples = mix(hashes[:-2] + mix(hashes[1:-1] + mix(hashes[2:])))[inside]
    n_triples = np.maximum(sizes - 2, 0)

    def per_text(marked: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(marked[data])])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    n_bytes = np.diff(offsets)
    size, length = np.maximum(sizes, 1), np.maximum(n_bytes, 1)
    measures = (
        np.log2(sizes + 1) / 16,
        _distinct(rows, hashes, n) / size,
        np.where(n_triples > 0, _distinct(rows[2:][inside], triples, n) / np.maximum(n_triples, 1), 1.0),
        np.log2(n_bytes / size + 1) / 6,
        np.sqrt(per_text(_MARK) / length),
        np.sqrt(per_text(_CAPITAL) / length),
        np.sqrt(per_text(_DIGIT) / length),
        np.log2(sizes / (per_text(_BYTES == 10) + 1) + 1) / 12,
    )
    return np.concatenate(
        [
            _counts(rows, hashes, n, WORDS),
            _counts(rows, shapes, n, SHAPES),
            _counts(rows[1:][beside], pairs, n, PAIRS),
            *map(_step, measures),
        ],
        axis=1,
    )


def _weighted(terms: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Each block of length one, times its weight; a block without terms stays zero."""
    out = terms * idf
    start = 0
    for _, width, weight in BLOCKS:
        block = out[:, start : start + width]
        block *= weight / np.maximum(np.linalg.norm(block, axis=1, keepdims=True), 1e-9)
        start += width
    return out


def fit(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(idf, axes) of labelled term vectors: inverse document frequencies and the leading singular vectors."""
    idf = (np.log((len(terms) + 1) / ((terms > 0).sum(axis=0) + 1)) + 1).astype(np.float32)
    weighted = _weighted(terms, idf)
    _, axes = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
    return idf, axes[:, ::-1][:, :LATENT].astype(np.float32)


def latent(terms: np.ndarray, idf: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Vectors of length one in the latent space."""
    placed = _weighted(terms, idf) @ axes
    return placed / np.maximum(np.linalg.norm(placed, axis=1, keepdims=True), 1e-9)


def votes(vectors: np.ndarray, labelled: np.ndarray, labels: np.ndarray, prior: float) -> np.ndarray:
    """The mean label of the nearest labelled vectors, each counting by a power of its cosine.

    All that are as near as the last of NEIGHBOURS vote. Without a positive cosine the score is ``prior``.
    """
    cosines = np.maximum(vectors @ labelled.T, 0)
    k = min(NEIGHBOURS, len(labelled))
    least = np.partition(cosines, -k, axis=1)[:, -k][:, None]
    weights = np.where(cosines >= least, cosines, 0) ** SHARPNESS
    total = weights.sum(axis=1, dtype=np.float64)
    return np.where(total > 0, (weights @ labels) / np.where(total > 0, total, 1), prior)


def held_out(id_column: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def _to_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches, "text"):
        terms = term_vectors(piece.column("text")).astype(np.float16)
        yield pa.RecordBatch.from_arrays(
            [pa.array([row.tobytes() for row in terms], pa.binary()), piece.column("label")], ["terms", "label"]
        )


def training_labels(labels: DataFrame, id_column: str, label_column: str, most: int) -> DataFrame:
    """At most ``most`` rows (_id, label) that may be learned from; of an id labelled more than once the mean label.

    A row without an id or a label is left out. The sample is the ids of the smallest digests, the same in every run.
    """
    usable = labels.select(F.col(id_column).alias("_id"), F.col(label_column).cast("double").alias("label"))
    usable = usable.where("_id IS NOT NULL AND label IS NOT NULL").where(~held_out("_id"))
    return usable.groupBy("_id").agg(F.avg("label").alias("label")).orderBy(F.xxhash64("_id"), "_id").limit(most)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """Rows (<id>, held_out, score, predicted), one a row of ``docs``.

    Learns from at most ``max_labelled`` labelled documents that are not held out; an id that several rows have is
    learned from each. Scores depend on the text alone: null and empty texts score alike, repeated rows too. Without
    any labelled document every score is 0.5. A null id counts as an empty text when it is dealt to the folds.
    """
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("text"))
    known = staged(training_labels(labels, id_column, label_column, max_labelled), "labelled")
    labelled = texts.join(F.broadcast(known), "_id").orderBy(F.xxhash64("_id"), F.xxhash64("text")).limit(max_labelled)
    rows = labelled.select("text", "label").mapInArrow(_to_vectors, "terms binary, label double").collect()
    model = None
    if rows:
        terms = np.stack([np.frombuffer(r["terms"], np.float16) for r in rows]).astype(np.float32)
        y = np.array([r["label"] for r in rows])
        idf, axes = fit(terms)
        model = docs.sparkSession.sparkContext.broadcast((idf, axes, latent(terms, idf, axes), y, float(y.mean())))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            if model is None:
                scores = np.full(len(piece), 0.5)
            else:
                idf, axes, vectors, y, prior = model.value
                scores = votes(latent(term_vectors(piece.column("text")), idf, axes), vectors, y, prior)
            yield pa.RecordBatch.from_arrays([piece.column("_id"), pa.array(np.clip(scores, 0, 1))], ["_id", "score"])

    scored = texts.mapInArrow(score, f"_id {texts.schema['_id'].dataType.simpleString()}, score double")
    return scored.select(
        F.col("_id").alias(id_column),
        held_out("_id").alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )
