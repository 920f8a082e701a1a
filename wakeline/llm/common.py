"""Shared steps: staged tables, checked broadcasts, cutting batches by bytes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import wakeline.llm
from wakeline.settings import new_folder, stage

# Functions travel to the workers with their code, so these need no installed package.
cloudpickle.register_pickle_by_value(wakeline.llm)

#: Rows of (id, id) that a join side may hold to be sent to every executor; 16 MB of values.
BROADCAST_ROWS = 1_000_000

#: Text bytes that one numpy step works on; a single longer text is one step.
SLICE_BYTES = 1 << 20

#: White space that parts words: space and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Write the frame to the shared folder and read it back: later steps neither recompute it nor hang on its lineage."""
    return stage(frame, f"llm-{name}")


@contextmanager
def bucketed(frame: DataFrame, name: str, key: str, **options: str) -> Iterator[DataFrame]:
    """Like ``staged``, but in buckets of ``key``: joins on it move only the other side, however many there are.

    A frame that an aggregate has just dealt out by ``key`` gives one file a bucket. The catalogue forgets the table at
    the end, so what is read from it must be written before.
    """
    spark = frame.sparkSession
    table = f"wakeline_{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = new_folder(spark, f"llm-{name}")
    frame.write.bucketBy(buckets, key).options(path=folder, **options).format("parquet").saveAsTable(table)
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")


def small(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The staged frame, marked for broadcast if a count shows that it holds at most ``rows`` rows; else it is shuffled."""
    return F.broadcast(frame) if frame.count() <= rows else frame


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about SLICE_BYTES of the text column, or one row."""
    for batch in batches:
        sizes = batch.column(column).fill_null("").cast(pa.large_binary())
        ends = memoryview(sizes.buffers()[1]).cast("q")[sizes.offset : sizes.offset + len(sizes) + 1]
        start = 0
        while start < len(batch):
            stop = start + 1
            while stop < len(batch) and ends[stop + 1] - ends[start] <= SLICE_BYTES:
                stop += 1
            yield batch.slice(start, stop - start)
            start = stop
