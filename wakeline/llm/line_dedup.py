"""Line removal by site-relative frequency.

For each host, the pages that hold a line are divided by the pages of the host; lines above the ratio are boilerplate
and go from all pages of the host. A page counts once for a line, however often it holds it. Lines are compared without
white space at their ends and with one space for any inside; they are known by 64-bit hashes.

With ``copies`` every row is a page, as the SQL of the query says. Without, copies have one vote: rows of a host with the
same lines are one page; and of pages that are by more than half, in characters, frequent lines of prose, those with the
same smallest one are one page, as near copies are. Else the lines of a large group of copies would go from all of them.
Prose is a line of at least five words, the length of the shingles by which near copies are told. Menus and other shorter
lines make no page a copy, however much of it they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import BROADCAST_ROWS, SPACE, staged

RATIO = 0.02
#: Fewer pages than this make no boilerplate, however small the host.
MIN_PAGES = 5
#: Words from which a line counts as prose when near copies are told from pages under the same menu: those of a shingle.
PROSE_WORDS = 5
_SPACES = " \t\x0b\x0c\r"


def _digest(line: Column) -> Column:
    """The line's hash; null for a blank line."""
    bare = F.btrim(F.regexp_replace(line, SPACE, " "), F.lit(_SPACES))
    return F.when(bare != "", F.xxhash64(bare))


def _is_prose(line: Column) -> Column:
    """Whether the line has a word shingle of its own, as near copies share them and the items of a menu have none."""
    return line.rlike(rf"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++{SPACE}){{{PROSE_WORDS - 1}}}[^\x20\x09-\x0D]")


def _host(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def boilerplate(
    docs: DataFrame, host_column: str, text_column: str = "text", ratio: float = RATIO, copies: bool = True
) -> DataFrame:
    """Rows (host, digest, pages, of_pages) of lines on more than ``ratio`` of the pages of their host."""
    pages = docs.select(_host(host_column).alias("host"), F.col(text_column).alias("text"))
    if not copies:
        return _voted(pages, ratio)
    totals = pages.groupBy("host").agg(F.count("*").alias("of_pages"))
    digests = F.array_distinct(F.filter(F.transform(F.split("text", "\n"), _digest), lambda d: d.isNotNull()))
    lines = pages.select("host", F.explode(digests).alias("digest"))
    return _frequent(lines, totals, ratio)


def _frequent(lines: DataFrame, totals: DataFrame, ratio: float) -> DataFrame:
    counts = lines.groupBy("host", "digest").agg(F.count("*").alias("pages")).where(F.col("pages") >= MIN_PAGES)
    return counts.join(totals, "host").where(F.col("pages") > F.col("of_pages") * ratio)


def _voted(pages: DataFrame, ratio: float) -> DataFrame:
    """``boilerplate`` where copies and near copies are one page."""
    sized = F.transform(
        F.split("text", "\n"),
        lambda x: F.struct(_digest(x).alias("digest"), F.length(x).alias("size"), _is_prose(x).alias("prose")),
    )
    sized = F.filter(sized, lambda x: x["digest"].isNotNull())
    digests = F.array_sort(F.array_distinct(F.transform("lines", lambda x: x["digest"])))
    keyed = pages.select("host", sized.alias("lines")).withColumn("page", F.xxhash64(digests))
    distinct = staged(keyed.groupBy("host", "page").agg(F.first("lines").alias("lines")), "pages")

    def held(rows: DataFrame) -> DataFrame:
        return rows.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: x["digest"]))).alias("digest"))

    totals = distinct.groupBy("host").agg(F.count("*").alias("of_pages"))
    found = staged(_frequent(held(distinct), totals, ratio).select("host", "digest"), "frequent")
    hosts = _by_host(found)
    shared = F.filter("lines", lambda x: x["prose"] & F.array_contains("_digests", x["digest"]))
    judged = distinct.join(hosts, "host", "left").withColumn("shared", F.coalesce(shared, F.array()))

    def size(lines: str) -> Column:
        return F.aggregate(lines, F.lit(0).cast("bigint"), lambda a, x: a + x["size"])

    least = F.array_min(F.transform("shared", lambda x: x["digest"]))
    judged = judged.withColumn("voter", F.when(size("shared") * 2 > size("lines"), least)).drop("_digests", "shared")
    judged = staged(judged, "voters")
    alone, together = judged.where("voter is null"), judged.where("voter is not null")
    votes = together.select("host", "voter", F.explode(F.transform("lines", lambda x: x["digest"])).alias("digest"))
    votes = held(alone).unionByName(votes.distinct().select("host", "digest"))
    voters = F.count(F.when(F.col("voter").isNull(), 1)) + F.count_distinct("voter")
    return _frequent(votes, judged.groupBy("host").agg(voters.alias("of_pages")), ratio)


def _by_host(found: DataFrame) -> DataFrame:
    """One array a host of the staged rows (host, digest), marked for broadcast if they are few."""
    hosts = found.groupBy("host").agg(F.collect_list("digest").alias("_digests"))
    return F.broadcast(hosts) if found.count() <= BROADCAST_ROWS else hosts


def drop_boilerplate(
    docs: DataFrame,
    host_column: str = "source",
    text_column: str = "text",
    ratio: float = RATIO,
    copies: bool = True,
) -> DataFrame:
    """``docs`` with boilerplate lines gone from the text, and the columns _n_lines and _n_dropped after its own.

    The lines left are joined as they were. A null text stays null; a text of nothing but boilerplate becomes empty.
    Blank lines stay. Repeated rows are pages each, or without ``copies`` one. Pages without a host are a host of their own.

    A host has at most 1 / ratio boilerplate lines for each line that its pages have on average. They are one array a
    host; if all arrays hold few lines in all they are broadcast, else joined by host, where Spark splits a large host.
    """
    found = boilerplate(docs, host_column, text_column, ratio, copies).select("host", "digest")
    hosts = _by_host(staged(found, "boilerplate"))
    names = [f"_in_{i}" for i in range(len(docs.columns))]
    host, text = (names[docs.columns.index(c)] for c in (host_column, text_column))
    joined = docs.toDF(*names).withColumn("_host", _host(host))
    joined = joined.join(hosts.withColumnRenamed("host", "_host"), "_host", "left")
    joined = joined.withColumn("_all", F.split(text, "\n"))
    kept = F.filter("_all", lambda line: ~F.coalesce(F.array_contains("_digests", _digest(line)), F.lit(False)))
    joined = joined.withColumn("_kept", F.when(F.col("_digests").isNull(), F.col("_all")).otherwise(kept))
    size = F.coalesce(F.size("_all"), F.lit(0))
    out = joined.select(
        *(F.array_join("_kept", "\n").alias(n) if n == text else F.col(n) for n in names),
        F.greatest(size, F.lit(0)).cast("bigint").alias("_n_lines"),
        F.greatest(size - F.size("_kept"), F.lit(0)).cast("bigint").alias("_n_dropped"),
    )
    return out.toDF(*docs.columns, "_n_lines", "_n_dropped")
