"""Grid-cell crossings of a vessel."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions.hexgrid import hex_cell
from wakeline.operators.neighbours import with_neighbours


def hex_crossings(reports: DataFrame, cell_fn: Callable[[str, str], Column] = hex_cell) -> DataFrame:
    """One row for each report in another cell than the report before it.

    The first sighting of a vessel is no crossing.
    """
    placed = reports.withColumn("cell", cell_fn("latitude", "longitude"))
    return (
        with_neighbours(placed, before=("cell",))
        .where(F.col("before.cell") != F.col("cell"))
        .select(
            "mmsi",
            F.col("before.cell").alias("from_cell"),
            F.col("cell").alias("to_cell"),
            "latitude",
            "longitude",
            "speed",
            "source_type",
            "ts_ms",
            "seq",
        )
    )
