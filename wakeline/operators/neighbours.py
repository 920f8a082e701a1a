"""The report before and after each report of the same vessel.

A window over the whole history of a vessel would put one vessel in one task, and a single key may
hold a third of all rows. The history is therefore cut into slices of time: the window runs inside one
(vessel, slice), and only the first and last row of each slice cross over to the neighbouring slices,
through a table of one row per (vessel, slice).

Report times are whole milliseconds and deduplicated, so an hour of one vessel, the default slice, has
at most 3.6 million of them however hot the vessel is, and a year has 8,760 slices.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER = ("ts_ms", "seq")
SLICE_MS = 60 * 60 * 1000

_SLICE = "_slice"
_INSIDE = f"PARTITION BY mmsi, {_SLICE} ORDER BY {', '.join(ORDER)}"
_ACROSS = f"PARTITION BY mmsi ORDER BY {_SLICE}"
_SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _sliced(reports: DataFrame, slice_ms: int, *more: str) -> DataFrame:
    return reports.selectExpr("*", f"floor(ts_ms / {int(slice_ms)}) AS {_SLICE}", *more)


def with_neighbours(
    reports: DataFrame, before: Sequence[str] = (), after: Sequence[str] = (), slice_ms: int = SLICE_MS
) -> DataFrame:
    """Add ``before`` and/or ``after``: the named columns of the neighbouring reports as structs.

    NULL where there is no neighbour. ``reports`` is read twice, the second time only for the
    named columns; pass a table rather than a long computation.
    """
    sliced = _sliced(reports, slice_ms)
    order = f"struct({', '.join(ORDER)})"
    # Per side: the edge row of a slice that the next slice needs, and the step to the neighbour.
    sides = {
        side: (f"struct({', '.join(names)})", edge, step)
        for side, names, edge, step in (("before", before, "max_by", "lag"), ("after", after, "min_by", "lead"))
        if names
    }
    edges = sliced.selectExpr(
        "mmsi", _SLICE, f"{order} AS _at", *[f"{row} AS {side}" for side, (row, _, _) in sides.items()]
    ).groupBy("mmsi", _SLICE)
    first_and_last = edges.agg(*[F.expr(f"{edge}({side}, _at) AS {side}") for side, (_, edge, _) in sides.items()])
    carried = first_and_last.selectExpr(
        "mmsi", _SLICE, *[f"{step}({side}) OVER ({_ACROSS}) AS _{side}" for side, (_, _, step) in sides.items()]
    )
    inside = sliced.selectExpr(
        "*", *[f"{step}({row}) OVER ({_INSIDE}) AS {side}" for side, (row, _, step) in sides.items()]
    )
    return inside.join(carried, ["mmsi", _SLICE], "left").selectExpr(
        *reports.columns, *[f"coalesce({side}, _{side}) AS {side}" for side in sides]
    )


def run_start(reports: DataFrame, in_run: str, name: str, slice_ms: int = SLICE_MS) -> DataFrame:
    """Add ``name``: the time at which the current run of rows satisfying ``in_run`` began.

    NULL on rows outside a run. A run may span many slices; what crosses over is one row per
    (vessel, slice), as above.
    """
    marked = (
        _sliced(reports, slice_ms, f"coalesce({in_run}, false) AS _in")
        .selectExpr(
            "*",
            f"lead(seq) OVER ({_INSIDE}) IS NULL AS _last",
            f"coalesce(lag(_in) OVER ({_INSIDE}), false) AS _was_in",
            f"bool_or(NOT _in) OVER ({_INSIDE} {_SO_FAR}) AS _broken",
        )
        # A run opens on its first row; later rows look back to the latest opening.
        .selectExpr("*", "CASE WHEN _in AND NOT _was_in THEN ts_ms END AS _opens")
        .selectExpr("*", f"last_value(_opens, true) OVER ({_INSIDE} {_SO_FAR}) AS _opened")
        .selectExpr("*", "CASE WHEN _in THEN _opened END AS _start")
    )
    tails = marked.where("_last").selectExpr("mmsi", _SLICE, "_start", "_broken")
    carried = (
        # Slices without a break continue the run of the slice before: they share its stretch.
        tails.selectExpr("*", f"sum(cast(_broken AS int)) OVER ({_ACROSS} {_SO_FAR}) AS _stretch")
        .selectExpr("*", f"min(_start) OVER (PARTITION BY mmsi, _stretch ORDER BY {_SLICE} {_SO_FAR}) AS _began")
        .selectExpr("mmsi", _SLICE, f"lag(_began) OVER ({_ACROSS}) AS _carried")
    )
    # Before the first break of a slice, the run may have begun in an earlier one.
    start = "CASE WHEN _in AND NOT _broken THEN coalesce(_carried, _start) ELSE _start END"
    return marked.join(carried, ["mmsi", _SLICE], "left").selectExpr(*reports.columns, f"{start} AS {name}")
