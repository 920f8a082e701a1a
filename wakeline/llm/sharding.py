"""Sharding by proportional stratified interleaving.

Each source's rows are shuffled by a seeded hash and ranked; rank / rows of the source places them between 0 and 1.
Each source's places are shifted round the circle by a seeded hash of the source, so that many sources of few rows are
spread too. Sorted by place, all sources run side by side in the mixture's proportion, so equal cuts are shards of the
same mixture.

Ranks over a source, or over everything, are offsets of small ranges plus ranks within a range. The ranges are cut by
the hash and by the place, both spread evenly, so a range holds some thousand rows whatever the size of a source.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.common import staged

#: Mean number of rows that one window ranks.
RANGE_ROWS = 8192
BYTES_A_ROW = 16
_TIES = ("draw", "doc_id", "text_crc32", "size")


def _with_rank(rows: DataFrame, keys: list[str], ranges: str, order: list[str], name: str) -> DataFrame:
    """Add ``name``, the rank from 0 by (range, order) among rows of the same keys, and ``name``_of, their number."""
    counts = rows.groupBy(*keys, ranges).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy(ranges)
    counts = counts.withColumn("_before", F.sum("_n").over(before) - F.col("_n"))
    counts = counts.withColumn(f"{name}_of", F.sum("_n").over(Window.partitionBy(*keys))).drop("_n")
    inside = F.row_number().over(Window.partitionBy(*keys, ranges).orderBy(*order))
    ranked = rows.withColumn("_inside", inside).join(counts, [*keys, ranges])
    return ranked.withColumn(name, F.col("_before") + F.col("_inside") - 1).drop("_before", "_inside")


def interleaved(
    docs: DataFrame,
    shards: int = 40,
    seed: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """Rows (doc_id, source, size, text_crc32, shard, slot), one a row of ``docs``.

    ``size`` is the text's bytes and 16. A null text has no bytes. Rows without a source are a source of their own.
    Rows that repeat an id, or have none, are placed by their text too; rows equal in all that is read have places side
    by side and are interchangeable. With fewer rows than shards some shards are empty. Other columns are not read, whatever their names.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(source_column).cast("string")), F.lit("")).alias("stratum"),
        (F.octet_length(text) + BYTES_A_ROW).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size"), 1)
    rows = rows.withColumn("draw", draw)
    rows = staged(rows, "shard-rows")
    total = rows.count()
    bits = max(0, math.ceil(math.log2(max(1, total) / RANGE_ROWS)))
    rows = rows.withColumn("drawn", F.shiftright("draw", 63 - bits) if bits else F.lit(0).cast("bigint"))
    ranked = _with_rank(rows, ["stratum"], "drawn", list(_TIES), "rank")
    shift = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "stratum"), 11) / float(1 << 53)
    place = (F.col("rank") * 2 + 1) / (F.col("rank_of") * 2) + shift
    place = place - F.floor(place)
    placed = ranked.withColumn("place", place).withColumn("part", F.floor(F.col("place") * (1 << bits)))
    placed = staged(placed.drop("drawn", "rank", "rank_of"), "shard-places")
    every = placed.withColumn("all", F.lit(0))
    ordered = _with_rank(every, ["all"], "part", ["place", "stratum", *_TIES], "position")
    shard = F.expr(f"position * {shards} div {max(1, total)}")
    start = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return (
        ordered.withColumn("shard", shard)
        .withColumn("slot", F.col("position") - start)
        .select(
            "doc_id",
            F.when(F.col("stratum") != "", F.substring("stratum", 2, 1 << 30)).alias("source"),
            "size",
            "text_crc32",
            F.col("shard").cast("int").alias("shard"),
            "slot",
        )
    )
