"""How filters of documents bear on each other, kept up to date by a stream that takes back what it counted too early.

Five filters judge a document. Four look at its text alone; the fifth, E, fails a document whose text some document of a
smaller id has, and so depends on documents that may come later. All files of the table are processed as micro-batches of
an available-now stream. Keyed state holds the least id of each text, with the counters' share of the rows that have it.
When a smaller id arrives, the earlier rows' mask without E is retracted from the counters of their part and counted with E.
The counters by (part, mask) then give every order of the filters at once.

Each micro-batch writes only folders of its own number and reads state of smaller numbers, so a replay after a crash
leaves the same tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.common import slices, staged
from wakeline.settings import new_folder
from wakeline.sources.folders import is_folder
from wakeline.streaming.tables import EPOCH, get, put

FILTERS = "ABCDE"
#: Micro-batches that the files of a table are dealt to. State is read once in each, so they do not grow with the table.
MICRO_BATCHES = 6
#: Fewest words, and of 100 words the fewest distinct; of 100 characters the most capitals; characters that fail D.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 200, 50, 2, b"#$%&*|"

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SAME = 1 << FILTERS.index("E")
_ROWS = "doc_id {}, part string, digest binary, mask int"
_MEASURES = ("n", "good", "toxic")
_LONG = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def text_mask(text: bytes, n_chars: int) -> int:
    """The bits of A to D that a text fails; A is the lowest. Words part at space and tab to carriage return."""
    words = text.split()
    n = len(words)
    return (
        (n < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT * n) << 1
        | (100 * (len(text) - len(text.translate(None, _CAPITALS))) > MOST_CAPITALS * n_chars) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches, "text"):
        column = piece.column("text").fill_null("")
        texts = column.cast(pa.large_binary()).to_pylist()
        lengths = pc.utf8_length(column).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                piece.column("doc_id"),
                piece.column("part"),
                pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in texts], pa.binary()),
                pa.array([text_mask(t, n) for t, n in zip(texts, lengths)], pa.int32()),
            ],
            ["doc_id", "part", "digest", "mask"],
        )


def _known_labels(labels: DataFrame) -> DataFrame:
    """One row an id, ``good`` and ``toxic`` as 0 or 1; of repeated labels any 1 counts."""
    flags = [F.max(F.coalesce((F.col(c) == 1).cast("bigint"), F.lit(0))).alias(name) for c, name in LABELS.items()]
    return labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*flags)


LABELS = {"quality": "good", "toxic": "toxic"}


def _cells(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a (text, part): its measures, its least id, and the measures of the rows of that id.

    Rows that share an id and a text are counted first, then combined before the shuffle: a text that a third of all
    rows have sends one row a task and part.
    """
    labelled = rows.where("doc_id IS NOT NULL").join(labels, "doc_id", "left")
    one = labelled.groupBy("doc_id", "digest", "part", "mask").agg(
        F.count("*").alias("n"), *[F.sum(F.coalesce(name, F.lit(0))).alias(name) for name in _MEASURES[1:]]
    )
    least = F.min(F.struct("doc_id", *[F.col(m).alias(f"least_{m}") for m in _MEASURES])).alias("_least")
    return one.groupBy("digest", "part", "mask").agg(*[F.sum(m).alias(m) for m in _MEASURES], least).select(
        "digest", "part", "mask", *_MEASURES, "_least.*"
    )


def _fold(batch: DataFrame, epoch: int, root: str, labels: DataFrame) -> None:
    """One micro-batch into ``root/minima`` (keyed state, new versions only) and ``root/counters`` (changes)."""
    spark = batch.sparkSession
    judged = batch.mapInArrow(_judged, _ROWS.format(batch.schema["doc_id"].dataType.simpleString()))
    put(judged, root, "rows", epoch)
    rows = spark.read.schema(judged.schema).parquet(f"{root}/rows/{EPOCH}={epoch}")
    cells = _cells(rows, labels)
    put(cells, root, "cells", epoch)
    cells = spark.read.schema(cells.schema).parquet(f"{root}/cells/{EPOCH}={epoch}")
    kept = ["digest", "part", "mask", "doc_id", *[f"least_{m}" for m in _MEASURES]]
    known = get(spark, root, "minima", cells.select(*kept).schema, upto=epoch - 1).drop(EPOCH)
    both = cells.withColumn("_new", F.lit(True)).unionByName(
        known.withColumn("_new", F.lit(False)), allowMissingColumns=True
    )
    least = both.groupBy("digest").agg(
        F.min("doc_id").alias("_least"), F.min(F.expr("CASE WHEN NOT _new THEN doc_id END")).alias("_before"),
        F.max("_new").alias("_met"),
    )
    met = both.join(least.where("_met"), "digest").where("_new OR doc_id = _before")
    put(met, root, "met", epoch)
    met = spark.read.schema(met.schema).parquet(f"{root}/met/{EPOCH}={epoch}")
    put(met.where("_new AND doc_id = _least").select(*kept), root, "minima", epoch)
    first = "doc_id = _least"
    changes = []
    for m in _MEASURES:
        # New rows count with or without E; earlier rows that have lost the least id move from without to with.
        without = f"CASE WHEN _new AND {first} THEN least_{m} WHEN NOT _new AND NOT {first} THEN -least_{m} ELSE 0 END"
        with_e = f"CASE WHEN _new AND {first} THEN {m} - least_{m} WHEN _new THEN {m} WHEN {first} THEN 0 ELSE least_{m} END"
        changes += [F.sum(F.expr(without)).alias(f"first_{m}"), F.sum(F.expr(with_e)).alias(f"same_{m}")]
    moved = met.groupBy("part", "mask").agg(*changes)
    nameless = rows.where("doc_id IS NULL").groupBy("part", "mask").agg(F.count("*").alias("first_n"))
    put(moved.unionByName(nameless, allowMissingColumns=True), root, "counters", epoch)


def document_stream(
    spark: SparkSession, table: str, id_column: str, text_column: str, part_column: str, micro_batches: int
) -> DataFrame:
    """The table, a file or a folder of files, as a stream of (doc_id, text, part); its files are dealt to micro-batches."""
    stored = spark.read.parquet(table)
    needed = stored.select(*dict.fromkeys([id_column, text_column, part_column])).schema
    options = {"maxFilesPerTrigger": str(-(-len(stored.inputFiles()) // micro_batches) or 1)}
    if not is_folder(spark, table):
        table, options["pathGlobFilter"] = table.rsplit("/", 1)
    files = spark.readStream.schema(needed).options(**options).parquet(table)
    return files.select(
        F.col(id_column).alias("doc_id"),
        F.col(text_column).alias("text"),
        F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
    )


def part_counters(
    spark: SparkSession,
    table: str,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    part_column: str = "source",
    micro_batches: int = MICRO_BATCHES,
    root: str | None = None,
) -> DataFrame:
    """Rows (part, mask, n, good, toxic): documents by the filters they fail, after all files of the table.

    ``root`` keeps checkpoint and state; called again with the same one, only files that are new since are processed.
    A null text is an empty one, a null part an empty one. A row without an id fails no E, and makes none fail; rows of
    one id and text do not make each other fail.
    """
    root = new_folder(spark, "filter-audit") if root is None else root
    stream = document_stream(spark, table, id_column, text_column, part_column, micro_batches)
    known = staged(_known_labels(labels), "labels")

    def fold(batch: DataFrame, epoch: int) -> None:
        _fold(batch, epoch, root, known)

    writer = stream.writeStream.foreachBatch(fold).option("checkpointLocation", f"{root}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    names = [f"{kind}_{m}" for m in _MEASURES for kind in ("first", "same")]
    changes = get(spark, root, "counters", spark.createDataFrame([], ", ".join(["part string", "mask int", *[f"{n} long" for n in names]])).schema)
    counted = changes.groupBy("part", "mask").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    each = [
        F.struct((F.col("mask") + e).alias("mask"), *[F.col(f"{kind}_{m}").alias(m) for m in _MEASURES])
        for kind, e in (("first", 0), ("same", _SAME))
    ]
    return counted.select("part", F.inline(F.array(*each)))


def _steps() -> tuple[list[str], dict[str, np.ndarray]]:
    """All orders, and for each measure which of the 32 masks count at each step of each order."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    own = np.array([1 << FILTERS.index(f) for order in orders for f in order])
    earlier = np.array([sum(1 << FILTERS.index(f) for f in order[:i]) for order in orders for i in range(len(order))])
    masks = np.arange(1 << len(FILTERS))[:, None]
    fails, gone = (masks & own) > 0, (masks & earlier) > 0
    rules = {"kept": ~fails & ~gone, "removed": fails & ~gone, "redundant": fails & gone, "unique_fails": masks == own}
    return orders, {name: rule.astype(np.int64) for name, rule in rules.items()}


def _by_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    orders, rules = _steps()
    letters = np.array([FILTERS.index(f) for order in orders for f in order])
    steps = len(letters)
    for batch in batches:
        for i in range(len(batch)):
            count = {m: np.array(batch.column(m)[i].as_py(), np.int64) for m in _MEASURES}
            at = {name: count["n"] @ rule for name, rule in rules.items()}
            at["good_lost"], at["toxic_lost"] = count["good"] @ rules["removed"], count["toxic"] @ rules["removed"]
            share = np.zeros(len(FILTERS), np.int64)
            np.add.at(share, letters, at["removed"])
            at["shapley"] = share[letters]
            columns = {
                "part": pa.array([batch.column("part")[i].as_py()] * steps, pa.string()),
                "filter_order": pa.array(np.repeat(orders, len(FILTERS)).tolist(), pa.string()),
                "step": pa.array(np.tile(np.arange(1, len(FILTERS) + 1), len(orders)), pa.int32()),
                **{name: pa.array(values) for name, values in at.items()},
            }
            yield pa.RecordBatch.from_pydict(columns)


def filter_audit(counters: DataFrame) -> DataFrame:
    """Rows (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    From rows of ``part_counters``: 600 a part, zeros included, whatever the number of documents. No document, no part.
    """
    masks = range(1 << len(FILTERS))
    vectors = [
        F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == k, F.col(m))), F.lit(0)) for k in masks]).alias(m)
        for m in _MEASURES
    ]
    return counters.groupBy("part").agg(*vectors).mapInArrow(_by_order, _LONG)
