"""Rates and latencies on streams: panes of a minute, kept as partial aggregates and merged when they are read.

A micro-batch adds the panes of its own rows. Nothing is late and no window is held back: whatever the order and cut of the
input, the windows are those of the batch. Panes of the same minute are folded as segments are.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wakeline.plans import metrics
from wakeline.streaming.tables import EPOCH, recall, remember


def _newest(fold: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """A fold of panes that have their micro-batch beside them, which nobody asks for once it is committed."""

    def folded(panes: DataFrame) -> DataFrame:
        return fold(panes).withColumn(EPOCH, F.lit(-1).cast("int"))

    return folded


def _start(stream: DataFrame, root: str, name: str, panes, merge, available_now: bool) -> StreamingQuery:
    def sink(batch: DataFrame, epoch: int) -> None:
        remember(panes(batch), root, name, epoch, fold=_newest(merge))

    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/checkpoints/{name}")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_rates(routed: DataFrame, root: str, *, available_now: bool = True) -> StreamingQuery:
    """Routed reports into panes by minute; ``rates_table`` reads them."""
    return _start(routed, root, "rate-panes", metrics.rate_panes, metrics.merge_rate_panes, available_now)


def start_latencies(reports: DataFrame, root: str, *, available_now: bool = True) -> StreamingQuery:
    """Reports with ``latency_ms`` into one sketch a minute; ``latencies_table`` reads them."""
    return _start(reports, root, "latency-panes", metrics.latency_panes, metrics.merge_latency_panes, available_now)


def rates_table(spark: SparkSession, root: str) -> DataFrame:
    """Reports per second over tumbling minutes, as it stands."""
    return metrics.rates(metrics.merge_rate_panes(recall(spark, root, "rate-panes")))


def latencies_table(spark: SparkSession, root: str) -> DataFrame:
    """99th percentile of the latency over five minutes, every minute, as it stands."""
    return metrics.latencies(recall(spark, root, "latency-panes"))
