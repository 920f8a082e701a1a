"""Starting the streaming queries and their sinks."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from wakeline import constants as C
from wakeline.operators.enrich import enrich, enrich_crossings
from wakeline.sources import tiers
from wakeline.sources.avro_json import parse_lines
from wakeline.streaming.behaviour import crossings, judge, last_versions, raised, with_withdrawn
from wakeline.streaming.routing import route_batch
from wakeline.streaming.tables import EPOCH, newest_rows, own, put, recall, remember

_CLOCK = StructType([StructField("clock_ms", LongType())])


def _furthest(clocks: DataFrame) -> DataFrame:
    return clocks.agg(F.max("clock_ms").alias("clock_ms"), F.max(EPOCH).alias(EPOCH))


def _start(
    stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], available_now: bool
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_etl(
    raw: DataFrame,
    root: str,
    *,
    zones: DataFrame | None = None,
    ports: Sequence[tuple] | DataFrame = C.SEED_PORTS,
    ttl_ms: int = C.DEDUP_TTL_MS,
    lateness_ms: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Raw stream to ``root/enriched`` and ``root/quarantine``, with the reason as code and text.

    Each report stands in exactly one of them, and in the same one for every cut of the input into micro-batches:
    ``routing.current`` reads them without what ``root/withdrawn`` has taken back.
    """

    def sink(batch: DataFrame, epoch: int) -> None:
        kept, failed = route_batch(batch, epoch, root, ttl_ms, lateness_ms)
        put(enrich(kept, zones, ports), root, "enriched", epoch)
        put(failed, root, "quarantine", epoch)

    return _start(raw, f"{root}/checkpoints/etl", sink, available_now)


def start_lines(lines: DataFrame, root: str, *, line: str = "line", available_now: bool = True) -> StreamingQuery:
    """Stream of Avro-JSON lines to ``root/records`` and, for lines that can't be read, ``root/dead-letter``.

    A dead line keeps its text, so that it can be sent again.
    """

    def sink(batch: DataFrame, epoch: int) -> None:
        parsed = parse_lines(own(batch, root, "lines", epoch))
        put(parsed.where("dead").select(*batch.columns), root, "dead-letter", epoch)
        put(parsed.where("NOT dead").select("record.*"), root, "records", epoch)

    return _start(lines.withColumn("line", F.col(line)), f"{root}/checkpoints/lines", sink, available_now)


def start_detection(
    enriched: DataFrame,
    root: str,
    *,
    withdrawn: DataFrame | None = None,
    limit_ms: int = C.SILENCE_MS,
    available_now: bool = True,
) -> StreamingQuery:
    """Enriched stream to ``root/flags``, all versions of every report's flags, and ``root/detections``.

    ``behaviour.detections_table`` reads the feed as it stands. ``root/detections`` is what each micro-batch told, at
    least once: a report judged again is told again, and a later version may differ.
    """

    def sink(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        remember(judge(batch, epoch, root), root, "flags", epoch, fold=last_versions)
        told = recall(spark, root, "flags", upto=epoch).where(F.col(EPOCH) == epoch).drop(EPOCH)
        remember(told.where("after_ms IS NULL"), root, "open", epoch, fold=newest_rows("mmsi"))
        before = recall(spark, root, "clock", _CLOCK, upto=epoch - 1).agg(F.max("clock_ms")).first()[0]
        seen = told.agg(F.max("ingest_ms")).first()[0]
        clock = max((c for c in (before, seen) if c is not None), default=0)
        remember(spark.createDataFrame([(clock,)], _CLOCK), root, "clock", epoch, fold=_furthest)
        opened = newest_rows("mmsi")(recall(spark, root, "open", upto=epoch))
        opened = opened.where(F.col(EPOCH) < epoch).drop(EPOCH)
        due = f"{clock} - ts_ms > {limit_ms} AND {clock if before is None else before} - ts_ms <= {limit_ms}"
        put(raised(told, opened.where(due), clock, limit_ms), root, "detections", epoch)

    return _start(with_withdrawn(enriched, withdrawn), f"{root}/checkpoints/detection", sink, available_now)


def start_crossings(
    enriched: DataFrame,
    root: str,
    *,
    zones: DataFrame | None = None,
    ports: Sequence[tuple] | DataFrame = C.SEED_PORTS,
    withdrawn: DataFrame | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Enriched stream to ``root/crossings``, each crossing with the context of the entered cell.

    Holds all versions of the reports, also those in the cell of the report before; ``behaviour.crossings_table``
    reads the crossings as they stand.
    """

    def sink(batch: DataFrame, epoch: int) -> None:
        entered = enrich_crossings(crossings(batch, epoch, f"{root}/moves"), zones, ports)
        remember(entered, f"{root}/moves", "crossings", epoch, fold=last_versions)

    return _start(with_withdrawn(enriched, withdrawn), f"{root}/checkpoints/crossings", sink, available_now)


def _reports_and_detections(enriched: DataFrame, detections: DataFrame | None) -> DataFrame:
    """What both tiers take in: enriched reports and, beside them, the detections about them."""
    if detections is None:
        return enriched
    raised = detections.where("detection <> 'back_online'")
    return enriched.unionByName(raised, allowMissingColumns=True)


def start_cold_tier(
    enriched: DataFrame, root: str, *, detections: DataFrame | None = None, available_now: bool = True
) -> StreamingQuery:
    """Enriched reports and detections into the cold tier ``root/cold``; a micro-batch adds to it and rewrites no date.

    Whichever of a report and its detection comes first, ``tiers.scan_cold`` gives the report and its flags.
    """

    def sink(batch: DataFrame, epoch: int) -> None:
        tiers.append_cold(tiers.as_cold(batch), f"{root}/cold", epoch)

    return _start(_reports_and_detections(enriched, detections), f"{root}/checkpoints/cold", sink, available_now)


def start_hot_tier(
    enriched: DataFrame, root: str, *, detections: DataFrame | None = None, available_now: bool = True
) -> StreamingQuery:
    """Enriched reports and detections into the hot tier ``root/hot``; a micro-batch writes its own vessels alone.

    ``tiers.read_hot`` and ``tiers.lookup_hot`` read it. A missing earlier version is an error: going on would forget
    vessels.
    """

    def sink(batch: DataFrame, epoch: int) -> None:
        tiers.upsert_hot(batch, f"{root}/hot", epoch)

    return _start(_reports_and_detections(enriched, detections), f"{root}/checkpoints/hot", sink, available_now)
