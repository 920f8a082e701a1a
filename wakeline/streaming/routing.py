"""Routing a stream of raw reports: validation, and deduplication that does not depend on the micro-batches.

Every arrival is kept in a table by date. A micro-batch routes anew all copies of the (vessel, report time) pairs that
it brings, over that table; which copy opens a window follows from arrival times alone, as in the batch. Where an
earlier decision changes, because a copy that arrived earlier was delivered later, the arrival is written to its new
place and withdrawn from the old one.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from wakeline import constants as C
from wakeline.operators.dedup import ARRIVAL, KEY, accept
from wakeline.operators.validate import check, explain_reason
from wakeline.streaming.tables import EPOCH, get, own, put, recall, remember

#: Names one delivered row: the micro-batch that brought it, and its number there.
DELIVERY = ["delivered_in", "delivery"]
WITHDRAWN = StructType(
    [
        StructField("mmsi", StringType()),
        StructField("ts_ms", LongType()),
        StructField("ingest_ms", LongType()),
        StructField("seq", LongType()),
        StructField("delivered_in", IntegerType()),
        StructField("delivery", LongType()),
        StructField("route", StringType()),
        StructField("routed_in", IntegerType()),
    ]
)
_NEWEST = StructType([StructField("ingest_ms", LongType())])


def _greatest(rows: DataFrame) -> DataFrame:
    return rows.agg(F.max("ingest_ms").alias("ingest_ms"), F.max(EPOCH).alias(EPOCH))


def _routes(copies: DataFrame, ttl_ms: int) -> DataFrame:
    """Rows (delivery, accepted) of valid deliveries. Of equal arrivals only the first delivered can be accepted."""
    accepted = accept(copies.select(*ARRIVAL), ttl_ms).select(*ARRIVAL)
    first = copies.groupBy(*ARRIVAL).agg(F.min(F.struct(*DELIVERY)).alias("_first"))
    chosen = first.join(accepted, ARRIVAL).select("_first.*", F.lit(True).alias("_chosen"))
    return copies.select(*DELIVERY).join(chosen, DELIVERY, "left").select(
        *DELIVERY, F.coalesce("_chosen", F.lit(False)).alias("accepted")
    )


def route_batch(
    batch: DataFrame, epoch: int, root: str, ttl_ms: int = C.DEDUP_TTL_MS, lateness_ms: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Reports to enrich and reports to quarantine after this micro-batch; writes what is withdrawn.

    With ``lateness_ms``, valid reports older by arrival than the newest arrival of earlier micro-batches less this are
    quarantined as late, before they can open a window. That depends on the micro-batches, so it is off by default.
    """
    spark = batch.sparkSession
    checked = check(batch)
    if lateness_ms is not None:
        newest = recall(spark, root, "newest", _NEWEST, upto=epoch - 1).agg(F.max("ingest_ms")).first()[0]
        if newest is not None:
            late = f"CASE WHEN ingest_ms < {newest - lateness_ms}L THEN '{C.REASON_LATE}' END"
            checked = checked.withColumn("reason_code", F.expr(f"coalesce(reason_code, {late})"))
    arrived = checked.withColumns(
        {
            "delivered_in": F.lit(epoch).cast("int"),
            "delivery": F.monotonically_increasing_id(),
            "date": F.to_date(F.timestamp_millis("ts_ms")),
        }
    )
    fresh = own(arrived, root, "delivered", epoch)
    remember(fresh.where("reason_code IS NULL"), root, "arrivals", epoch, "date")
    known = recall(spark, root, "arrivals", upto=epoch)
    if lateness_ms is not None:
        remember(fresh.agg(F.max("ingest_ms").alias("ingest_ms")), root, "newest", epoch, fold=_greatest)
    valid = fresh.where("reason_code IS NULL")
    dates = [r["date"] for r in valid.select("date").distinct().collect()]
    earlier = known.where((F.col(EPOCH) < epoch) & F.col("date").isin(dates))
    earlier = earlier.drop(EPOCH).join(valid.select(*KEY).distinct(), KEY, "left_semi").select(*fresh.columns)
    after = _routes(valid.unionByName(earlier), ttl_ms)
    before = _routes(earlier, ttl_ms).withColumnRenamed("accepted", "was_accepted")
    moved = earlier.join(after, DELIVERY).join(before, DELIVERY).where("accepted <> was_accepted")
    put(
        moved.select(
            *ARRIVAL,
            *DELIVERY,
            F.expr("CASE WHEN accepted THEN 'quarantine' ELSE 'enriched' END AS route"),
            F.lit(epoch).cast("int").alias("routed_in"),
        ),
        root,
        "withdrawn",
        epoch,
    )
    routed = valid.join(after, DELIVERY).unionByName(moved.select(*fresh.columns, "accepted"))
    kept = routed.where("accepted").drop("accepted", "reason_code", "date")
    copies = routed.where("NOT accepted").withColumn("reason_code", F.lit(C.REASON_DUPLICATE)).drop("accepted", "date")
    failed = fresh.where("reason_code IS NOT NULL").drop("date").unionByName(copies)
    places = [*DELIVERY, F.lit(epoch).cast("int").alias("routed_in")]
    failed = failed.select(*batch.columns, "reason_code", *places)
    return kept.select(*batch.columns, *places), explain_reason(failed)


def current(spark: SparkSession, root: str, route: str) -> DataFrame:
    """The ``enriched`` or ``quarantine`` table as it stands: without deliveries withdrawn since they were written."""
    table = get(spark, root, route).drop(EPOCH)
    gone = get(spark, root, "withdrawn", WITHDRAWN).where(F.col("route") == route)
    gone = gone.groupBy(*DELIVERY).agg(F.max("routed_in").alias("_gone"))
    standing = table.join(gone, DELIVERY, "left").where("_gone IS NULL OR _gone <= routed_in")
    return standing.select(*table.columns)
