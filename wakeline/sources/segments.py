"""Tables that grow by segments, each a folder that is written once and never changed.

A commit adds one segment and then a small version file, which names the schema and all live segments. A reader takes the
newest version and so sees a commit whole or not at all; a crash before the version file leaves folders that nobody reads
and that the next attempt overwrites. Of ``FAN`` segments of one size class, one of the next is folded, so a row is written
again once a class, and there are at most ``FAN - 1`` segments a class: some twenty after ten thousand commits.
"""

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from wakeline.sources.folders import drop_path, list_names, path_exists, read_text, write_text

#: Segments of one class that are folded into one of the next.
FAN = 8
#: Versions whose segments stay: replays read the version before their own, slow readers an older one.
KEPT_VERSIONS = 3
#: Classes that a commit may fold through: FAN to this power of commits.
MOST_CLASSES = 10
_VERSIONS = "_versions"


@dataclass(frozen=True)
class Version:
    """A table as one commit left it: its segments as (folder, class), oldest first."""

    number: int
    segments: tuple[tuple[str, int], ...]
    schema: StructType
    partitions: tuple[str, ...]


def _numbers(spark: SparkSession, root: str) -> list[int]:
    names = list_names(spark, f"{root}/{_VERSIONS}")
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))


def _load(spark: SparkSession, root: str, number: int) -> Version:
    stored = json.loads(read_text(spark, f"{root}/{_VERSIONS}/{number}.json"))
    segments = tuple((name, size_class) for name, size_class in stored["segments"])
    return Version(number, segments, StructType.fromJson(stored["schema"]), tuple(stored["partitions"]))


def version(spark: SparkSession, root: str, upto: int | None = None) -> Version | None:
    """The newest version, or the newest up to one."""
    numbers = [n for n in _numbers(spark, root) if upto is None or n <= upto]
    return _load(spark, root, numbers[-1]) if numbers else None


def _folder(root: str, name: str) -> str:
    return f"{root}/_segment={name}"


def _scan(spark: SparkSession, root: str, schema: StructType, names: list[str]) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schema)
    folders = [_folder(root, name) for name in names]
    return spark.read.schema(schema).option("basePath", root).parquet(*folders).select(*schema.names)


def read(spark: SparkSession, root: str, upto: int | None = None, schema: StructType | None = None) -> DataFrame:
    """The rows of all live segments. Of a table without a commit, none; that needs a schema."""
    found = version(spark, root, upto)
    if found is None:
        if schema is None:
            raise FileNotFoundError(f"no version of a table in {root}")
        return spark.createDataFrame([], schema)
    return _scan(spark, root, found.schema, [name for name, _ in found.segments])


def _write(frame: DataFrame, path: str, partitions: tuple[str, ...]) -> None:
    """One folder; rebalancing gives each partition few files, and splits a large one."""
    if partitions:
        frame.hint("rebalance", *partitions).write.mode("overwrite").partitionBy(*partitions).parquet(path)
    else:
        frame.write.mode("overwrite").parquet(path)


def append(
    frame: DataFrame,
    root: str,
    number: int,
    *partitions: str,
    fold: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Commit rows as version ``number``; a number that is committed already stays as it is.

    ``fold`` drops rows that later ones make needless, and must give the same rows on reading whether or not it has run
    over some of the segments. Numbers rise by one; a gap is an error, since going on would forget rows.
    """
    spark = frame.sparkSession
    before = version(spark, root)
    if before is not None and before.number >= number:
        return
    if number and (before is None or before.number < number - 1):
        raise FileNotFoundError(f"{root} lacks version {number - 1}")
    segments = list(before.segments) if before else []
    segments.append((f"v{number}-0", 0))
    _write(frame, _folder(root, f"v{number}-0"), partitions)
    while len(segments) >= FAN and segments[-FAN][1] == segments[-1][1]:
        merged, size_class = segments[-FAN:], segments[-1][1] + 1
        name = f"v{number}-{size_class}"
        rows = _scan(spark, root, frame.schema, [name for name, _ in merged])
        _write(fold(rows) if fold else rows, _folder(root, name), partitions)
        segments[-FAN:] = [(name, size_class)]
    stored = {"segments": segments, "schema": frame.schema.jsonValue(), "partitions": partitions}
    write_text(spark, f"{root}/{_VERSIONS}/{number}.json", json.dumps(stored))
    _retire(spark, root, number)


def _retire(spark: SparkSession, root: str, number: int) -> None:
    """Drop versions but the newest ones, and the segments that only they named."""
    numbers = [n for n in _numbers(spark, root) if n <= number]
    if len(numbers) <= KEPT_VERSIONS:
        return
    live = {name for n in numbers[-KEPT_VERSIONS:] for name, _ in _load(spark, root, n).segments}
    for old in numbers[:-KEPT_VERSIONS]:
        # A segment that was folded within its own commit was never in a version.
        named = {name for name, _ in _load(spark, root, old).segments} | {f"v{old}-{c}" for c in range(MOST_CLASSES)}
        for folder in (_folder(root, name) for name in named - live):
            if path_exists(spark, folder):
                drop_path(spark, folder)
        drop_path(spark, f"{root}/{_VERSIONS}/{old}.json")
