"""Tables that a streaming query keeps beside its checkpoint.

What others read as a stream has one folder a micro-batch (``put``, ``get``). A micro-batch overwrites only its own folder
and reads only those before it, so a replay after a crash finds what the first attempt found and leaves the same table.

What only the query itself reads is kept in segments (``remember``, ``recall``): a micro-batch opens a bounded number of
them however many came before, and rows that later ones make needless are folded away.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from wakeline.sources import segments
from wakeline.sources.folders import drop_path, path_exists

EPOCH = "_epoch"


def put(frame: DataFrame, root: str, name: str, epoch: int, *partitions: str) -> None:
    """Write a micro-batch's rows of a table."""
    writer = frame.write.mode("overwrite")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(f"{root}/{name}/{EPOCH}={epoch}")


def get(
    spark: SparkSession, root: str, name: str, schema: StructType | None = None, *, upto: int | None = None
) -> DataFrame:
    """The rows of all micro-batches, or of those up to one, with the micro-batch in ``_epoch``.

    Without a schema that of the files is taken, so there must be some.
    """
    if schema is None:
        schema = spark.read.parquet(f"{root}/{name}").schema
    full = StructType([*(f for f in schema.fields if f.name != EPOCH), StructField(EPOCH, IntegerType())])
    path = f"{root}/{name}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    table = spark.read.schema(full).parquet(path)
    return table if upto is None else table.where(F.col(EPOCH) <= upto)


def own(frame: DataFrame, root: str, name: str, epoch: int) -> DataFrame:
    """Write a micro-batch's rows and read just them back; nobody else reads them, so those of long before go."""
    put(frame, root, name, epoch)
    drop_path(frame.sparkSession, f"{root}/{name}/{EPOCH}={epoch - segments.KEPT_VERSIONS}")
    return frame.sparkSession.read.schema(frame.schema).parquet(f"{root}/{name}/{EPOCH}={epoch}")


def remember(
    frame: DataFrame, root: str, name: str, epoch: int, *partitions: str, fold: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Commit a micro-batch's rows of a table, with the micro-batch in ``_epoch``; done again, it changes nothing."""
    rows = frame.withColumn(EPOCH, F.lit(epoch).cast("int"))
    segments.append(rows, f"{root}/{name}", epoch, *partitions, fold=fold)


def recall(
    spark: SparkSession, root: str, name: str, schema: StructType | None = None, *, upto: int | None = None
) -> DataFrame:
    """The rows of all micro-batches, or of those up to one. The schema is for a table without any."""
    full = None if schema is None else StructType([*schema.fields, StructField(EPOCH, IntegerType())])
    return segments.read(spark, f"{root}/{name}", upto, full)


def newest_rows(*key: str) -> Callable[[DataFrame], DataFrame]:
    """A fold that keeps, of the rows of a key, those of its last micro-batch."""

    def fold(rows: DataFrame) -> DataFrame:
        last = rows.groupBy(*key).agg(F.max(EPOCH).alias(EPOCH))
        return rows.join(last, [*key, EPOCH]).select(*rows.columns)

    return fold
