"""Main text of web pages: markup where it decides, and repeats across the pages of a host where it does not.

A page is cut into blocks. Blocks inside the article are text; blocks inside menus, footers, forms and the like are not.
What lies in neither is undecided, on pages with an article and without. There the host decides: the token streams of
all its pages are taken together, and runs of at least 8 tokens that a quarter of its distinct pages hold, three at
least, are boilerplate; undecided tokens that no such run covers are kept. Pages with equal text, whatever menus are
around it, are one page, so copies do not make each other boilerplate.

That is what a suffix array of a host's streams finds. It is built as a table: every suffix goes by the hash of its host
and first 8 tokens, so that equal beginnings meet and a host of any size is spread over all tasks. Runs longer than 8 are
covered by their parts. Tokens are compared in lower case (A-Z).
"""

from __future__ import annotations

import hashlib
import html
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import small, staged
from wakeline.llm.words import hashed_words, mix, shingles

RUN = 8
#: Share of the distinct pages of a host, and their number, that make a run boilerplate.
SHARE = 0.25
MIN_PAGES = 3
#: Suffixes that a task counts before it sends counts on.
COUNTED_SUFFIXES = 1 << 20
#: Elements without main text, elements whose content is no markup, and elements that end a block.
OUTSIDE = frozenset("nav footer aside form button select noscript template iframe object svg menu dialog head".split())
RAW = frozenset("script style textarea title".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2"
    " h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset("article main".split())
#: Class, id and role words of boxes without main text.
BOXES = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer masthead"
    " menu modal nav navbar navigation newsletter notice popup promo related respond search share sharing sidebar social"
    " sponsor sponsored subscribe toolbar widget".split()
)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>|[^<]+|<", re.S)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_END = {name: re.compile(rf"</{name}\b[^>]*>|\Z", re.I) for name in RAW}


def _box(tag: str, name: str, place: str) -> str:
    """The place inside a box that a class, id or role names; else the place it is in.

    A whole word decides. A part of a longer name (share-price as well as share-buttons) decides outside an article; inside
    one it only leaves the text open, so that what the host repeats decides.
    """
    for a, b, c in _MARKS.findall(tag):
        for word in (a or b or c).lower().split():
            if word in BOXES:
                return "out"
            parts = re.split(r"[_-]+", word)
            if name not in MAIN and parts[0] not in ("has", "with", "no") and BOXES & {parts[0], parts[-1]}:
                return "" if place == "main" else "out"
    return place


def blocks(page: str) -> list[tuple[str, str]]:
    """The blocks of a page in order, as (place, text); the place is "main", "out" or "" where markup tells nothing."""
    found: list[tuple[str, str]] = []
    parts: list[str] = []
    open_tags: list[tuple[str, str]] = []  # name, and the place that held before it
    place, at = "", 0

    def end_block() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            found.append((place, text))

    while at < len(page):
        match = _TOKEN.match(page, at)
        token, at = match[0], match.end()
        name = _NAME.match(token)
        if token[0] != "<" or token == "<" or name is None:
            if not token.startswith(("<!", "<?")):
                parts.append(token)
            continue
        tag = name[1].lower()
        if token[1] == "/":
            if tag in BLOCKS:
                end_block()
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i][0] == tag:
                    if tag not in BLOCKS and any(t in BLOCKS for t, _ in open_tags[i + 1 :]):
                        break  # an inline end tag does not end blocks around it
                    if place != open_tags[i][1]:
                        end_block()
                    place = open_tags[i][1]
                    del open_tags[i:]
                    break
            continue
        if tag in RAW:
            at = _END[tag].search(page, at).end()
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCKS:
            end_block()
        if tag in VOID or token.endswith("/>"):
            continue
        inner = place
        if place != "out":
            if tag in OUTSIDE or (tag == "header" and place != "main"):
                inner = "out"
            else:
                inner = place if tag in ("html", "body") else _box(token, tag, place)
                if tag in MAIN and inner != "out":
                    inner = "main"
        if inner != place:
            end_block()
        open_tags.append((tag, place))
        place = inner
    end_block()
    return found


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (html): the blocks, their places, and the digest of the text that is not out."""
    for batch in batches:
        texts, places, streams = [], [], []
        for page in batch.column("html"):
            found = blocks(page.as_py() or "")
            texts.append([t for _, t in found])
            places.append([p for p, _ in found])
            streams.append(_digest(" ".join(t for p, t in found if p != "out")))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(texts, pa.list_(pa.string())),
                pa.array(places, pa.list_(pa.string())),
                pa.array(streams, pa.int64()),
            ],
            ["blocks", "places", "stream"],
        )


def _beginnings(host: str, found: list[str]) -> np.ndarray:
    """The hash of host and RUN tokens for each suffix of a page's stream that is so long."""
    tokens, _ = hashed_words(pa.array([" ".join(found)], pa.large_string()))
    if len(tokens) < RUN:
        return np.zeros(0, np.uint64)
    return mix(shingles(tokens, RUN) ^ mix(np.array([_digest(host)], np.int64).view(np.uint64)))


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (host, blocks): rows (beginning, pages), added up over COUNTED_SUFFIXES at a time."""
    held: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], ["beginning", "pages"])

    for batch in batches:
        for host, found in zip(batch.column("host").to_pylist(), batch.column("blocks").to_pylist()):
            held.append(np.unique(_beginnings(host, found)))
        if sum(map(len, held)) >= COUNTED_SUFFIXES:
            yield flush()
    if held:
        yield flush()


def _undecided_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (row, host, blocks, places): rows (row, host, beginning) of runs that reach undecided blocks."""
    for batch in batches:
        rows, hosts, hashes = [], [], []
        for row, host, found, places in zip(*(batch.column(c).to_pylist() for c in ("row", "host", "blocks", "places"))):
            open_ = np.concatenate([np.zeros(0, bool), *(np.full(len(t.split()), p == "") for t, p in zip(found, places))])
            before = np.concatenate([[0], np.cumsum(open_)])
            reached = before[RUN:] > before[: max(0, len(before) - RUN)]
            own = np.unique(_beginnings(host, found)[reached]).view(np.int64).tolist()
            rows.extend([row] * len(own))
            hosts.extend([host] * len(own))
            hashes.extend(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(hosts, pa.string()), pa.array(hashes, pa.int64())],
            ["row", "host", "beginning"],
        )


def _uncovered(words: list[str], covered: list[bool]) -> list[str]:
    """The words of a block outside covered runs; a run that only reaches in from the next block covers nothing."""
    if all(covered):
        return []
    kept: list[str] = []
    for gone, run in itertools.groupby(zip(covered, words), key=lambda x: x[0]):
        part = [w for _, w in run]
        if not gone or len(part) < RUN:
            kept.extend(part)
    return kept


def _unique_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (row, host, blocks, places, repeated): main blocks, and uncovered tokens of undecided ones."""
    for batch in batches:
        texts = []
        columns = (batch.column(c).to_pylist() for c in ("host", "blocks", "places", "repeated"))
        for host, found, places, repeated in zip(*columns):
            size = sum(len(t.split()) for t in found)
            covered = np.zeros(size, dtype=bool)
            if repeated:
                runs = np.isin(_beginnings(host, found), np.array(repeated, np.int64).view(np.uint64))
                for i in np.flatnonzero(runs):
                    covered[i : i + RUN] = True
            lines, at = [], 0
            for block, place in zip(found, places):
                words = block.split()
                kept = words if place == "main" else _uncovered(words, covered[at : at + len(words)].tolist())
                at += len(words)
                if place != "out" and kept:
                    lines.append(" ".join(kept))
            texts.append("\n".join(lines))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])


def main_text(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """Rows (page_id, url, text, n_chars), one a row of ``pages``, repeated rows and null ids too.

    A null or empty page, or one of nothing but boilerplate, has an empty text. Pages without a host in their url, or
    without a url, keep all undecided text, for nothing says which pages are of one site. Other columns are not read.
    """
    numbered = pages.select(
        F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html")
    ).withColumn("row", F.monotonically_increasing_id())
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    numbered = numbered.withColumn("host", host)
    parsed = numbered.select("page_id", "url", "row", "host", "html")
    parsed = staged(_keep_beside(parsed), "parsed")
    hosted = parsed.where("host <> ''")
    streams = hosted.groupBy("host", "stream").agg(F.min("row").alias("first"), F.max("row").alias("last"))
    streams = staged(streams, "streams")
    copied = streams.where("first <> last")
    copies = hosted.select("host", "stream", "row").join(small(copied), ["host", "stream"]).where("row <> first")
    distinct = hosted.select("row", "host", "blocks").join(small(staged(copies.select("row"), "copies")), "row", "left_anti")
    is_open = F.exists("places", lambda p: p == "")
    opened = hosted.where(is_open).select("row", "host", "blocks", "places")
    own = opened.mapInArrow(_undecided_suffixes, "row bigint, host string, beginning bigint")
    own = staged(own, "undecided-suffixes")
    # Suffixes of all pages are counted where an undecided one is like them; the others need not move.
    wanted = small(staged(own.select("beginning").distinct(), "undecided-beginnings"))
    suffixes = distinct.select("host", "blocks").mapInArrow(_suffixes, "beginning bigint, pages bigint")
    shared = suffixes.join(wanted, "beginning", "left_semi")
    shared = shared.groupBy("beginning").agg(F.sum("pages").alias("pages")).where(F.col("pages") >= MIN_PAGES)
    shared = staged(shared, "shared-suffixes")
    totals = streams.groupBy("host").agg(F.count("*").alias("of_pages"))
    own = own.join(shared, "beginning").join(totals, "host").where(F.col("pages") >= SHARE * F.col("of_pages"))
    repeated = own.groupBy("row").agg(F.collect_list("beginning").alias("repeated"))
    judged = opened.join(repeated, "row", "left").mapInArrow(_unique_runs, "row bigint, text string")
    others = hosted.where(is_open).select("page_id", "url", "row").join(judged, "row").select("page_id", "url", "text")
    kept = F.filter(F.arrays_zip("blocks", "places"), lambda b: b["places"] != "out")
    plain = F.array_join(F.transform(kept, lambda b: b["blocks"]), "\n")
    found = parsed.where((F.col("host") == "") | ~is_open).select("page_id", "url", plain.alias("text"))
    return found.unionByName(others).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def _keep_beside(numbered: DataFrame) -> DataFrame:
    """Parse pages with their other columns carried along."""
    kept = ["page_id", "url", "row", "host"]
    kinds = ", ".join(f"{c} {numbered.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for out in _parsed(iter([batch])):
                names = [*kept, "blocks", "places", "stream"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept), *(out.column(c) for c in names[4:])], names
                )

    return numbered.mapInArrow(run, f"{kinds}, blocks array<string>, places array<string>, stream bigint")
