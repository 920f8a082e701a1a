"""The cold tier (history, partitioned by date) and the hot tier (latest state per vessel)."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, LongType, StructField, StructType

from wakeline.schemas import ENRICHED_EVENT, nested_event, to_nested
from wakeline.functions.labels import with_date
from wakeline.sources import segments

FLAGS = ("loitering", "dark_vessel", "speed_anomaly")
COLD_FLAGS = ("loitering", "darkVessel", "speedAnomaly")

COLD = StructType(
    [
        *ENRICHED_EVENT.fields,
        StructField("seq", LongType()),
        StructField("ts_ms", LongType()),
        StructField("ingest_ms", LongType()),
        StructField("rebuilt", BooleanType()),
        StructField("date", DateType()),
    ]
)

# Most rows in one file of the cold tier.
COLD_ROWS_PER_FILE = 20_000_000


def as_cold(flat_enriched: DataFrame) -> DataFrame:
    """Flat enriched rows in the layout of the cold tier.

    Detections may be passed too. The report of a silence is rebuilt from state and lacks heading
    and source; ``rebuilt`` says so, and such a copy gives way to the report itself.
    """
    return to_nested(_with_rebuilt(with_date(flat_enriched)), "seq", "ts_ms", "ingest_ms", "rebuilt", "date")


def _with_rebuilt(flat: DataFrame) -> DataFrame:
    if "rebuilt" in flat.columns:
        return flat
    is_dark = F.expr("coalesce(detection = 'dark', false)") if "detection" in flat.columns else F.lit(False)
    return flat.withColumn("rebuilt", is_dark)


def latest_copy(cold: DataFrame, mmsi: str = "vesselEvent.mmsi") -> DataFrame:
    """Last write per (vessel, report time) wins; flags raised by any copy stay raised.

    An aggregate and not a window: copies are reduced before the shuffle, so a report that was
    written many times does not fill one task.
    """
    kept = "struct(NOT rebuilt, ingest_ms, seq)" if "rebuilt" in cold.columns else "struct(ingest_ms, seq)"
    flags = [name for name in COLD_FLAGS if name in cold.columns]
    copies = cold.select(
        F.col(mmsi).alias("_mmsi"),
        "ts_ms",
        F.struct(*cold.columns).alias("_row"),
        F.expr(kept).alias("_order"),
        *flags,
    )
    folded = copies.groupBy("_mmsi", "ts_ms").agg(
        F.max_by("_row", "_order").alias("_row"), *[F.bool_or(name).alias(name) for name in flags]
    )
    return folded.select(*[name if name in flags else f"_row.{name}" for name in cold.columns])


def write_cold(cold: DataFrame, root: str, fmt: str = "parquet") -> None:
    """Replace the dates present in ``cold``; every other date stays.

    Rebalancing brings the rows of a date together and splits a large date over several tasks, so
    the tier gets files of the advised size, neither one a task and date nor one huge one.
    """
    (
        cold.hint("rebalance", "date")
        .write.partitionBy("date")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", COLD_ROWS_PER_FILE)
        .mode("overwrite")
        .format(fmt)
        .save(root)
    )


def scan_cold(spark: SparkSession, root: str, *dates: str, fmt: str = "parquet") -> DataFrame:
    """The cold tier, or only the given dates of it (partition pruning).

    A tier written by dates is read as it lies, with a fixed schema, so ``date`` is a column and MMSI stays text. Of one
    grown by ``append_cold`` the copies of a report are folded on reading.
    """
    grown = segments.version(spark, root) is not None
    table = segments.read(spark, root) if grown else spark.read.schema(COLD).format(fmt).load(root)
    if dates:
        table = table.where(F.col("date").isin([F.lit(d).cast("date") for d in dates]))
    return latest_copy(table) if grown else table


def append_cold(cold: DataFrame, root: str, number: int) -> None:
    """Add cold rows as one new segment by date; no date that is there is touched, and no copy looked up.

    Copies of a report that come in different segments are folded when the tier is read, and for good when segments are
    folded into larger ones. The same number again changes nothing.
    """
    segments.append(latest_copy(cold).select(*COLD.names), root, number, "date", fold=latest_copy)


# --- hot tier ---

HOT_COLUMNS = [
    "mmsi",
    "risk_level",
    "risk_score",
    "in_restricted_zone",
    "zone_name",
    "zone_type",
    "loitering",
    "dark_vessel",
    "speed_anomaly",
    "payload",
]


def payload() -> Column:
    """The full enriched record of a flat row as JSON."""
    return F.to_json(
        F.struct(
            nested_event().alias("vesselEvent"),
            F.col("in_restricted_zone").alias("inRestrictedZone"),
            F.col("zone_name").alias("zoneName"),
            F.col("zone_type").alias("zoneType"),
            F.col("distance_to_port").alias("distanceToPort"),
            F.col("risk_score").alias("riskScore"),
            F.col("risk_level").alias("riskLevel"),
            "loitering",
            F.col("dark_vessel").alias("darkVessel"),
            F.col("speed_anomaly").alias("speedAnomaly"),
        )
    )


def read_payload(column: Column) -> Column:
    """The record back from its JSON."""
    return F.from_json(column, ENRICHED_EVENT)


def hot_state(flat_enriched: DataFrame) -> DataFrame:
    """One row per vessel: its latest arrival, with the flags any copy of that arrival raised.

    Reduced before the shuffle, whatever the skew.
    """
    rows = _with_rebuilt(flat_enriched)
    others = [name for name in rows.columns if name not in ("mmsi", *FLAGS)]
    # The greatest struct is the latest arrival and, among its copies, a raised flag.
    flags = [F.expr(f"max(struct(ingest_ms, seq, {name})).{name} AS {name}") for name in FLAGS]
    row = F.expr(f"max_by(struct({', '.join(others)}), struct(ingest_ms, seq, NOT rebuilt)) AS _row")
    folded = rows.groupBy("mmsi").agg(row, *flags)
    return folded.select(*[name if name in ("mmsi", *FLAGS) else f"_row.{name}" for name in rows.columns])


def hot_table(flat_enriched: DataFrame) -> DataFrame:
    """The hot tier's columns: the latest state with its payload and arrival."""
    state = hot_state(flat_enriched).withColumn("payload", payload())
    return state.select(*HOT_COLUMNS, "seq", "ingest_ms")


_STATE_COLUMNS = [
    "mmsi",
    "latitude",
    "longitude",
    "speed",
    "heading",
    "ts_ms",
    "source_type",
    "event_type",
    "in_restricted_zone",
    "zone_name",
    "zone_type",
    "distance_to_port",
    "risk_score",
    "risk_level",
    *FLAGS,
    "seq",
    "ingest_ms",
    "rebuilt",
]


def merge_hot(incoming: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """The hot table, payload included, after new enriched rows or detections arrive.

    Later arrivals replace earlier ones; folding the same rows in again gives the same table.
    """
    frames = [_with_rebuilt(incoming).select(*_STATE_COLUMNS)]
    if current is not None:
        frames.append(current.select(*_STATE_COLUMNS))
    state = hot_state(reduce(lambda a, b: a.unionByName(b), frames))
    return state.withColumn("payload", payload())


#: Parts of a stored hot tier, by digest of the vessel. A lookup reads one of them.
HOT_BUCKETS = 64


def _bucket(mmsi: Column) -> Column:
    return F.pmod(F.xxhash64(mmsi), F.lit(HOT_BUCKETS)).cast("int").alias("bucket")


def _states(rows: DataFrame) -> DataFrame:
    return hot_state(rows).select(*_STATE_COLUMNS, _bucket(F.col("mmsi"))).sortWithinPartitions("bucket", "mmsi")


def upsert_hot(incoming: DataFrame, root: str, number: int) -> None:
    """Add the latest states that enriched rows or detections bring, as one new segment in buckets by vessel.

    Only the vessels that come are written, and none is read. The same number again changes nothing.
    """
    rows = _states(_with_rebuilt(incoming).select(*_STATE_COLUMNS))
    segments.append(rows, root, number, "bucket", fold=_states)


def read_hot(spark: SparkSession, root: str) -> DataFrame:
    """The stored hot tier: the latest state of every vessel over all segments, with its payload."""
    state = hot_state(segments.read(spark, root).drop("bucket")).withColumn("payload", payload())
    return state.select(*HOT_COLUMNS, "seq", "ingest_ms")


def lookup_hot(spark: SparkSession, root: str, mmsi: str) -> DataFrame:
    """The state of one vessel; an empty frame when it is unknown. Files of other buckets are not opened."""
    rows = segments.read(spark, root)
    rows = rows.where((F.col("bucket") == _bucket(F.lit(mmsi))) & (F.col("mmsi") == mmsi))
    state = hot_state(rows.drop("bucket")).withColumn("payload", payload())
    return state.select(*HOT_COLUMNS, "seq", "ingest_ms")


def lookup(hot: DataFrame, mmsi: str) -> DataFrame:
    """The state of one vessel in a frame of states; an empty frame when it is unknown."""
    return hot.where(F.col("mmsi") == mmsi)
