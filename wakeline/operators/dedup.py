"""Deduplication of (vessel, report time) with a time-to-live.

The first copy to arrive is accepted and opens a window of ``ttl_ms``. Copies arriving inside it
are duplicates and do not extend it; the first copy at or past its end is accepted again and opens
the next window. Of equal arrivals, as replays bring them, one can be accepted.

Nearly all keys have one copy. A count by key finds the others, and only their copies are written and
compared; the rest pass as they are. Any number of copies may share one key, so they are never gathered
in one task: the first one is found by an aggregate that combines before the shuffle. Keys with copies past
their window go on as a chain: each arrival time points to the first one past the window it would open, and
pointers double, so a key of n windows takes about log2 n rounds.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.constants import DEDUP_TTL_MS, REASON_DUPLICATE
from wakeline.operators.validate import check
from wakeline.settings import stage

KEY = ["mmsi", "ts_ms"]
# Most keys with several copies that are sent to every executor; about 30 bytes each.
MAX_BROADCAST_KEYS = 1_000_000
# Names one arrival, but for exact replays.
ARRIVAL = ["mmsi", "ts_ms", "ingest_ms", "seq"]


def _first_copies(reports: DataFrame) -> DataFrame:
    """The first arrival of each key as a whole row, with the last arrival time of the key."""
    rest = [name for name in reports.columns if name not in KEY]
    # A struct compares field by field, so arrival time and number come first.
    ordered = ["ingest_ms", "seq", *[name for name in rest if name not in ("ingest_ms", "seq")]]
    firsts = reports.groupBy(*KEY).agg(
        F.min(F.struct(*ordered)).alias("_first"), F.max("ingest_ms").alias("_last_ms")
    )
    return firsts.select(*KEY, "_first.*", "_last_ms").select(*reports.columns, "_last_ms")


def _repeated(valid_reports: DataFrame) -> DataFrame:
    """The keys with more than one copy; broadcast while they are few."""
    counts = valid_reports.groupBy(*KEY).agg(F.count("*").alias("_n")).where("_n > 1").select(*KEY)
    keys = stage(counts, "repeated-keys")
    return F.broadcast(keys) if keys.count() <= MAX_BROADCAST_KEYS else keys


def _next_times(times: DataFrame, ttl_ms: int) -> DataFrame:
    """Rows (key, ingest_ms, next_ms): the first arrival of the key at or past the end of the window opened here.

    Time is cut into steps of one window. The end of a window falls into the step after its own, so the arrival sought is
    there, or else the first of the next step that has any. A step of one key has at most ``ttl_ms`` distinct times, and a
    key at most 48 h / ``ttl_ms`` steps, since valid reports arrive within a day of their own time.
    """
    stepped = times.withColumn("_step", F.floor(F.col("ingest_ms") / ttl_ms))
    ends = stepped.select(
        *KEY, (F.col("_step") + 1).alias("_step"), (F.col("ingest_ms") + ttl_ms).alias("_at"), F.lit(0).alias("_kind"), "ingest_ms"
    )
    there = stepped.select(*KEY, "_step", F.col("ingest_ms").alias("_at"), F.lit(1).alias("_kind"), "ingest_ms")
    onward = Window.partitionBy(*KEY, "_step").orderBy("_at", "_kind").rowsBetween(0, Window.unboundedFollowing)
    met = ends.unionByName(there).withColumn("next_ms", F.min(F.expr("CASE WHEN _kind = 1 THEN ingest_ms END")).over(onward))
    by_step = Window.partitionBy(*KEY).orderBy("_step")
    firsts = stepped.groupBy(*KEY, "_step").agg(F.min("ingest_ms").alias("_first")).select(
        *KEY,
        (F.col("_step") + 1).alias("_step"),
        F.when(F.lead("_step").over(by_step) > F.col("_step") + 1, F.lead("_first").over(by_step))
        .otherwise(F.lead("_first", 2).over(by_step))
        .alias("_later"),
    )
    found = met.where("_kind = 0").join(firsts, [*KEY, "_step"], "left")
    return found.select(*KEY, "ingest_ms", F.coalesce("next_ms", "_later").alias("next_ms")).where("next_ms IS NOT NULL")


def _chain(times: DataFrame, starts: DataFrame, ttl_ms: int) -> DataFrame:
    """The arrival times (key, ingest_ms) that open windows after the first one of each key.

    Each round follows pointers of twice as many windows from all openings found, and doubles the pointers.
    """
    pointers = stage(_next_times(times, ttl_ms), "window-pointers")
    opened = [starts.select(*KEY, "ingest_ms")]
    while True:
        everyone = reduce(lambda a, b: a.unionByName(b), opened)
        more = everyone.join(pointers, [*KEY, "ingest_ms"]).select(*KEY, F.col("next_ms").alias("ingest_ms"))
        more = stage(more, "window-openings")
        if more.isEmpty():
            return reduce(lambda a, b: a.unionByName(b), opened[1:], more)
        opened.append(more)
        onward = pointers.select(*KEY, F.col("ingest_ms").alias("next_ms"), F.col("next_ms").alias("_after"))
        pointers = stage(
            pointers.join(onward, [*KEY, "next_ms"]).select(*KEY, "ingest_ms", F.col("_after").alias("next_ms")),
            "window-pointers",
        )


def _windows(copies: DataFrame, ttl_ms: int) -> DataFrame:
    """The accepted ones of the copies."""
    if ttl_ms <= 0:
        raise ValueError("the window must be longer than 0 ms")
    firsts = stage(_first_copies(copies), "accepted")
    late = firsts.where(f"_last_ms - ingest_ms >= {int(ttl_ms)}")
    if late.isEmpty():
        return firsts.drop("_last_ms")
    # One row a key and arrival time, of the keys that have copies past their first window.
    past = copies.join(late.select(*KEY), KEY, "left_semi")
    rest = [name for name in copies.columns if name not in (*KEY, "ingest_ms", "seq")]
    at_once = past.groupBy(*KEY, "ingest_ms").agg(F.min(F.struct("seq", *rest)).alias("_row"))
    timed = stage(at_once, "arrival-times")
    openings = _chain(timed.select(*KEY, "ingest_ms"), late, ttl_ms)
    again = timed.join(openings, [*KEY, "ingest_ms"]).select(*KEY, "ingest_ms", "_row.*")
    return firsts.drop("_last_ms").unionByName(again.select(*copies.columns))


def accept(valid_reports: DataFrame, ttl_ms: int = DEDUP_TTL_MS) -> DataFrame:
    """The accepted copies. Only copies of repeated keys are written to the shared folder."""
    repeated = _repeated(valid_reports)
    copies = stage(valid_reports.join(repeated, KEY, "left_semi").select(*valid_reports.columns), "copies")
    single = valid_reports.join(repeated, KEY, "left_anti").select(*valid_reports.columns)
    return single.unionByName(_windows(copies, ttl_ms))


def route(reports: DataFrame, ttl_ms: int = DEDUP_TTL_MS) -> DataFrame:
    """Every raw report with ``reason_code``: NULL if accepted, else why it is quarantined.

    Reports of keys with one copy are not shuffled but for the count. Of equal arrivals one is accepted at most, and
    the others are duplicates.
    """
    checked = check(reports)
    repeated = _repeated(checked.where("reason_code IS NULL"))
    copies = checked.where("reason_code IS NULL").join(repeated, KEY, "left_semi").select(*checked.columns)
    copies = stage(copies.withColumn("_copy", F.monotonically_increasing_id()), "copies")
    accepted = _windows(copies.select(*ARRIVAL), ttl_ms)
    chosen = copies.groupBy(*ARRIVAL).agg(F.min("_copy").alias("_copy")).join(accepted, ARRIVAL).select("_copy")
    marked = copies.join(chosen.withColumn("_accepted", F.lit(True)), "_copy", "left").withColumn(
        "reason_code", F.expr(f"CASE WHEN _accepted IS NULL THEN '{REASON_DUPLICATE}' END")
    )
    # Failed reports and those of keys with one copy, in one pass.
    several = repeated.withColumn("_several", F.lit(True))
    rest = checked.join(several, KEY, "left").where("reason_code IS NOT NULL OR _several IS NULL")
    return rest.select(*checked.columns).unionByName(marked.select(*checked.columns))
