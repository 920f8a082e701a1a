"""Writers for the batch result tables."""

from pyspark.sql import DataFrame


def replace_dates(result: DataFrame, root: str) -> None:
    """Write a result table partitioned by date, replacing only the dates it holds.

    An empty result touches nothing: dynamic overwrite creates and drops no partition for it.
    """
    (
        result.hint("rebalance", "date")
        .write.partitionBy("date")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(root)
    )


def append_jdbc(result: DataFrame, url: str, table: str, **options: str) -> None:
    """Append a result to a database table, after its dates were deleted there.

    Deleting first (``DELETE ... WHERE date IN ...``) is left to the database's own client, so a
    rerun replaces its dates and keeps the others.
    """
    result.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()
