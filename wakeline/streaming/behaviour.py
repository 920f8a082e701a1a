"""Detectors and crossings on a stream, the same for every cut into micro-batches.

Reports are kept in a table by date and judged with the batch operators. A micro-batch touches some (vessel, hour)
slices. The touched slices and the two listed before and after each are read again, which holds every neighbour of every
report whose flags can have changed; those reports are written anew, and the latest version of a report counts. No row
is late, and a vessel with very many reports is many slices.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from wakeline import constants as C
from wakeline.functions.hexgrid import hex_cell
from wakeline.operators import detect
from wakeline.operators.neighbours import SLICE_MS, with_neighbours
from wakeline.streaming.tables import EPOCH, newest_rows, recall, remember

REPORT = ["mmsi", "ts_ms", "ingest_ms", "seq"]
_GONE = "_gone"


def _listed_once(slices: DataFrame) -> DataFrame:
    return slices.groupBy("mmsi", "slice").agg(F.max(EPOCH).alias(EPOCH))


#: Folds the versions of reports to the last one of each.
last_versions = newest_rows(*REPORT)


def with_withdrawn(enriched: DataFrame, withdrawn: DataFrame | None) -> DataFrame:
    """Enriched reports, and beside them those that the routing has withdrawn, in whichever order they come."""
    routed = F.col("routed_in") if "routed_in" in enriched.columns else F.lit(0)
    rows = enriched.withColumns({_GONE: F.lit(False), "routed_in": routed.cast("int")})
    if withdrawn is None:
        return rows
    gone = withdrawn.where("route = 'enriched'").select(*REPORT, "routed_in").withColumn(_GONE, F.lit(True))
    return rows.unionByName(gone, allowMissingColumns=True)


def _standing(rows: DataFrame, history: DataFrame) -> DataFrame:
    """Rows not withdrawn after they were routed."""
    gone = history.where(_GONE).groupBy(*REPORT).agg(F.max("routed_in").alias("_gone_in"))
    return rows.join(gone, REPORT, "left").where("_gone_in IS NULL OR _gone_in < routed_in").drop("_gone_in")


def context(batch: DataFrame, epoch: int, root: str) -> DataFrame:
    """The reports that this micro-batch may bear on, ``_touched`` where it touches their slice."""
    spark = batch.sparkSession
    rows = batch.where("mmsi IS NOT NULL AND ts_ms IS NOT NULL").withColumns(
        {"slice": F.floor(F.col("ts_ms") / SLICE_MS), "date": F.to_date(F.timestamp_millis("ts_ms"))}
    )
    remember(rows, root, "history", epoch, "date")
    history = recall(spark, root, "history", upto=epoch)
    fresh = history.where(F.col(EPOCH) == epoch).select("mmsi", "slice").distinct()
    remember(fresh, root, "slices", epoch, fold=_listed_once)
    listed = recall(spark, root, "slices", upto=epoch)
    touched = listed.where(F.col(EPOCH) == epoch).select("mmsi", "slice", F.lit(True).alias("_touched"))
    vessels = listed.join(touched.select("mmsi").distinct(), "mmsi", "left_semi").select("mmsi", "slice").distinct()
    # One row a vessel and hour.
    order = Window.partitionBy("mmsi").orderBy("slice").rowsBetween(-2, 2)
    near = vessels.join(touched, ["mmsi", "slice"], "left").withColumn("_near", F.max("_touched").over(order))
    near = near.where("_near").select("mmsi", "slice", F.coalesce("_touched", F.lit(False)).alias("_touched"))
    days = [r[0] for r in near.select(F.to_date(F.timestamp_millis(F.col("slice") * SLICE_MS))).distinct().collect()]
    there = history.where(F.col("date").isin(days)).join(near, ["mmsi", "slice"])
    return _standing(there.where(f"NOT {_GONE}"), there).drop("slice", "date", _GONE, EPOCH)


def _changed() -> Column:
    """Whether a report, or the one before or after it, is in a touched slice."""
    return F.expr("_touched OR coalesce(before._touched, false) OR coalesce(after._touched, false)")


def judge(batch: DataFrame, epoch: int, root: str) -> DataFrame:
    """New versions of the reports that the micro-batch bears on, with both behaviour flags and their neighbours' times."""
    placed = with_neighbours(
        context(batch, epoch, root), before=(*detect.BEFORE, "_touched"), after=(*detect.AFTER, "_touched")
    )
    flagged = placed.where(_changed()).withColumns(
        {
            "loitering": detect.loitering(),
            "speed_anomaly": detect.speed_anomaly(),
            "before_ms": F.col("before.ts_ms"),
            "after_ms": F.col("after.ts_ms"),
        }
    )
    return flagged.drop("before", "after", "_touched")


def _latest(versions: DataFrame, root: str) -> DataFrame:
    """Of each report the version written last, without reports withdrawn since."""
    newest = versions.groupBy(*REPORT).agg(F.max(EPOCH).alias(EPOCH))
    return _standing(versions.join(newest, [*REPORT, EPOCH]), _history(versions.sparkSession, root)).drop(EPOCH)


def _history(spark: SparkSession, root: str) -> DataFrame:
    fields = [StructField("mmsi", StringType()), *(StructField(n, LongType()) for n in REPORT[1:])]
    more = [StructField(_GONE, BooleanType()), StructField("routed_in", IntegerType())]
    return recall(spark, root, "history", StructType([*fields, *more]))


def flagged_table(
    spark: SparkSession, root: str, as_of_ms: int | None = None, limit_ms: int = C.SILENCE_MS
) -> DataFrame:
    """All reports with their three flags as they stand; the clock of open silences is the last arrival."""
    rows = _latest(recall(spark, root, "flags"), root)
    clock = rows.agg(F.max("ingest_ms")).first()[0] if as_of_ms is None else as_of_ms
    silence = F.expr(f"coalesce(after_ms, {0 if clock is None else int(clock)}L) - ts_ms")
    return rows.withColumn("silence_ms", silence).withColumn("dark_vessel", F.expr(f"silence_ms > {int(limit_ms)}L"))


def detections_table(
    spark: SparkSession, root: str, as_of_ms: int | None = None, limit_ms: int = C.SILENCE_MS
) -> DataFrame:
    """The detection feed as it stands: ``behaviour``, ``dark`` and ``back_online`` rows."""
    return _feed(flagged_table(spark, root, as_of_ms, limit_ms), limit_ms)


def _feed(flagged: DataFrame, limit_ms: int) -> DataFrame:
    back = flagged.where(f"ts_ms - before_ms > {int(limit_ms)}L").withColumn("detection", F.lit("back_online"))
    feed = detect.detections(flagged).unionByName(back)
    return feed.drop("before_ms", "after_ms", "silence_ms")


def raised(judged: DataFrame, opened: DataFrame, clock_ms: int, limit_ms: int) -> DataFrame:
    """What one micro-batch tells: the feed of its versions, and of silences that its clock has made long enough.

    ``opened`` are reports of earlier versions with no report after them.
    """
    silence = F.expr(f"coalesce(after_ms, {int(clock_ms)}L) - ts_ms")
    both = judged.withColumn("silence_ms", silence).withColumn("dark_vessel", F.expr(f"silence_ms > {int(limit_ms)}L"))
    quiet = opened.withColumns(
        {"silence_ms": silence, "dark_vessel": F.lit(True), "loitering": F.lit(False), "speed_anomaly": F.lit(False)}
    ).withColumn("before_ms", F.lit(None).cast("bigint"))
    return _feed(both.unionByName(quiet), limit_ms)


def crossings(batch: DataFrame, epoch: int, root: str, cell_fn: Callable[[str, str], Column] = hex_cell) -> DataFrame:
    """New versions of the reports that the micro-batch bears on, with their cell and that of the report before."""
    narrow = batch.select(*REPORT, "latitude", "longitude", "speed", "source_type", "routed_in", _GONE)
    placed = context(narrow, epoch, root).withColumn("to_cell", cell_fn("latitude", "longitude"))
    near = with_neighbours(placed, before=("to_cell", "_touched"))
    moved = near.where("_touched OR coalesce(before._touched, false)")
    return moved.withColumn("from_cell", F.col("before.to_cell")).drop("before", "_touched")


def crossings_table(spark: SparkSession, root: str) -> DataFrame:
    """All crossings as they stand."""
    return _latest(recall(spark, root, "crossings"), root).where("from_cell <> to_cell")
