"""N-gram Jaccard join: which documents share at least 75 of 100 of their distinct word n-grams, and their groups.

The overlap of all documents is the product of the document by n-gram incidence matrix with its transpose. It is never
formed whole. Bounds that follow from the sizes of the sets leave out nearly all of it first:

1. Equal sets are one row of the matrix, a class. Each class puts forward its 30 % smallest n-gram hashes. A document
   with n n-grams can only have a link if enough of these are shared with another class (see ``least_shared``).
2. For the classes left, the whole rows are made. Only shared columns count, and a row needs 75 % of its n-grams in
   shared columns.
3. In the matrix left, a row's rarest columns are kept, so many that two linked rows have one of them in common.
   The product is accumulated in blocks. A block takes from each column one pivot, the row with the smallest part of
   its n-grams to itself (of a text and its edited copies, the text), and adds up the overlaps of pivots with the other
   rows of their columns; sizes that cannot reach the threshold are discarded.
   A row found to be linked to pivots is labelled by the least of them, and rows of one label need not be compared; a
   column is done when its rows have one label or it has one row left. When the pairs left, of rows of different labels
   in one column, are few enough, they form the last block. The components of all links found are taken at the end.
4. In the last block, rows around one centre that many have in common are known by what they lack of its base and add to
   it; the base is what more than half of them have, so edits of single copies are not in it.
   Two of them link if they have enough of these differences in common, so many more than copies edited apart have:
   they are paired by their rarest differences, not by the columns that all of them hold.

A group of any size costs rows in proportion to it in each block, since a pivot meets each row of a column once and
the rows it joins need no further comparison. Words, n-grams and sets are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.common import bucketed, slices, small, staged
from wakeline.llm.components import components
from wakeline.llm.words import hashed_words, mix, shingles

#: Two sets link when 100 * intersection >= SIMILARITY * union.
SIMILARITY = 75
WIDTH = 5
#: The last block may hold so many pairs for each row of the columns left, and with each block before it GROWTH times
#: as many: pivots pay for columns that they close, and rows that no pivot joins are compared in the end.
LAST_BLOCK_PAIRS = 4
GROWTH = 4
#: Rows around a centre from which on they are paired by differences; fewer have at most so many pairs each.
CENTRE_ROWS = 16
#: How often a centre gives way to its own.
JUMPS = 3


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, int]]:
    """For each text, its distinct n-gram hashes in order and a key of the set; a text of fewer words is one n-gram."""
    words, firsts = hashed_words(batch.column("text"))
    grams = shingles(words, width)
    for start, end in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if end - start >= width:
            values = np.unique(grams[start : end - width + 1])
        elif end > start:
            values = shingles(words[start:end], end - start)
        else:
            values = words[:0]
        yield values, int(mix(mix(values) + np.uint64(len(values))).sum(dtype=np.uint64).astype(np.int64))


def put_forward(n: int) -> int:
    """How many of its smallest hashes a set of n puts forward: the quarter that a link may miss, and 5 % more."""
    return n // 4 + max(1, -(-n // 20))


def least_shared(n: int) -> int:
    """How many of those must be shared for a link: the surplus of the smallest partner that a link allows.

    Of two linked sets, take the one whose last hash put forward is the smaller. Those of its hashes that the other
    has are put forward by the other too, and it misses a quarter of its set at most. So it has its surplus in common
    with the other, and the other has the same hashes in common with it.
    """
    return max(1, -(-(-(-SIMILARITY * n // 100)) // 20))


def _keys(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, keys = [], []
            for values, key in _sets(batch, width):
                sizes.append(len(values))
                keys.append(key if len(values) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64())],
                ["doc_id", "key", "n_shingles"],
            )

    return run


def _forward(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (h, key, n) of the hashes put forward; equal sets of one slice are put forward once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            seen: dict[int, np.ndarray] = {}
            sizes = []
            for values, key in _sets(batch, width):
                if len(values) and key not in seen:
                    seen[key] = values[: put_forward(len(values))]
                    sizes.append(len(values))
            if seen:
                counts = [len(x) for x in seen.values()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(list(seen.values())).view(np.int64)),
                        pa.array(np.repeat(np.array(list(seen), dtype=np.int64), counts)),
                        pa.array(np.repeat(np.array(sizes, dtype=np.int64), counts)),
                    ],
                    ["h", "key", "n"],
                )

    return run


def _rows(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (id, key, n, hashes): the whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = list(_sets(batch, width))
            offsets = np.cumsum([0, *(len(v) for v, _ in sets)])
            values = np.concatenate([np.zeros(0, np.uint64), *(v for v, _ in sets)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([k for _, k in sets], pa.int64()),
                    pa.array([len(v) for v, _ in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values)),
                ],
                ["doc_id", "key", "n", "hashes"],
            )

    return run


def _least_shared(n: F.Column) -> F.Column:
    return F.greatest(F.lit(1), F.ceil(F.ceil(n * SIMILARITY / 100) / 20))


def _may_link(n: F.Column, m: F.Column) -> F.Column:
    """The smaller set must have 75 % of the larger: else no overlap suffices."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * SIMILARITY


def _candidates(texts: DataFrame, width: int) -> DataFrame:
    """Keys of the classes that share enough of what they put forward."""
    forward = texts.mapInArrow(_forward(width), "h bigint, key bigint, n bigint")
    shared = forward.groupBy("h").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo <> hi").select("h")
    counts = forward.join(shared, "h").groupBy("key").agg(F.count("*").alias("shared"), F.max("n").alias("n"))
    return staged(counts.where(F.col("shared") >= _least_shared(F.col("n"))).select("key"), "candidates")


def _shared_rows(rows: DataFrame) -> DataFrame:
    """The incidence (h, key, n, df) of columns with at least two rows, without rows that lack 75 % of theirs."""
    incidence = rows.select("key", "n", F.explode("hashes").alias("h"))
    columns = incidence.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    shared = incidence.join(columns, "h")
    return shared.groupBy("key").agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "h"))).alias("columns")
    ).where(F.size("columns") * 100 >= F.col("n") * SIMILARITY)


def _overlaps(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Links (a, b) among pairs of keys: the product of their rows, where it reaches the threshold.

    ``rows`` lies in buckets of its key, so that a block moves the rows of its pairs only. Those on the side of ``a``
    are written first: a pivot may have very many partners, and Spark splits such a key only if both sides are shuffled.
    """
    pairs = staged(pairs, "pairs")
    heads = staged(rows.join(pairs.select(F.col("a").alias("key")).distinct(), "key", "left_semi"), "heads")
    left = heads.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("hashes").alias("row_a"))
    right = rows.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("hashes").alias("row_b"))
    overlap = F.size(F.array_intersect("row_a", "row_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "n_a", "n_b", overlap.alias("overlap"))
    return both.where(
        F.col("overlap") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("overlap")) * SIMILARITY
    ).select("a", "b")


def _open_pairs(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose sizes allow a link and that no links join yet."""
    for side in ("a", "b"):
        known = roots.select(F.col("key").alias(side), F.col("n").alias(f"n_{side}"), F.col("root").alias(f"root_{side}"))
        pairs = pairs.join(known, side)
    return pairs.where(_may_link(F.col("n_a"), F.col("n_b")) & (F.col("root_a") != F.col("root_b"))).select("a", "b")


def _of_many(centres: DataFrame, least: int) -> DataFrame:
    """Rows (centre, key, members) of centres with at least so many rows."""
    many = centres.groupBy("centre").agg(F.count("*").alias("members")).where(F.col("members") >= least)
    return centres.join(many, "centre")


def _centres(columns: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows (centre, key, members): the pivot of most columns of a row, or that pivot's own; centres of many rows only.

    A pivot has less to itself than the other rows of its columns, so going on from pivot to pivot leads to an end. Copies
    of one text may end at many pivots, but the bases of these have most n-grams in common: a centre gives way to the
    least one that most n-grams of its base lead to. Any choice of centres gives the same links, at other cost.
    """
    votes = columns.groupBy("key", "pivot").agg(F.count("*").alias("votes"))
    centres = votes.groupBy("key").agg(F.max_by("pivot", F.struct("votes", "pivot")).alias("centre"))
    for _ in range(JUMPS):
        centres = staged(centres, "centres")
        further = centres.where("key <> centre").select(F.col("key").alias("centre"), F.col("centre").alias("further"))
        centres = centres.join(further, "centre", "left").select("key", F.coalesce("further", "centre").alias("centre"))
    centres = staged(centres, "centres")
    bases = _bases(_of_many(centres, CENTRE_ROWS // 4).join(rows, "key"))
    cells = bases.select("centre", F.size("base").alias("size"), F.explode("base").alias("h"))
    votes = cells.join(cells.groupBy("h").agg(F.min("centre").alias("least")), "h").groupBy("centre", "least").agg(
        F.count("*").alias("votes"), F.first("size").alias("size")
    )
    merged = small(staged(votes.where("2 * votes > size").select("centre", "least"), "merged"))
    centres = centres.join(merged, "centre", "left").select("key", F.coalesce("least", "centre").alias("centre"))
    return staged(_of_many(staged(centres, "centres"), CENTRE_ROWS), "centres")


def _bases(members: DataFrame) -> DataFrame:
    """Rows (centre, base): the n-grams that more than half of the rows around a centre have.

    Copies edited apart give back the text that they were made from, also if it is no row or not the one that most pivots
    lead to. Differences from an edited copy would hold its own edits too, which all others then have in common.
    """
    cells = members.select("centre", "members", F.explode("hashes").alias("h"))
    counts = cells.groupBy("centre", "h").agg(F.count("*").alias("df"), F.first("members").alias("members"))
    return staged(counts.where("2 * df > members").groupBy("centre").agg(F.collect_list("h").alias("base")), "bases")


def _differences(centres: DataFrame, rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (centre, key, n, root, needs, delta): what a row lacks of its centre's base and adds to it.

    Let c be the base's size, and let x lack r of it and add a. The overlap of x and y is c - r(x) - r(y) + s with s
    differences in common. So they link if and only if 2 * (100 + SIMILARITY) * s >= needs(x) + needs(y), where
    needs = 2 * (100 * r + SIMILARITY * a) - (100 - SIMILARITY) * c. This holds for any base, also an empty one.
    """
    members = centres.join(rows, "key")
    both = members.join(_bases(members), "centre", "left").withColumn(
        "base", F.coalesce("base", F.array().cast("array<bigint>"))
    ).join(roots.select("key", "root"), "key")
    both = both.withColumn("lacks", F.array_except("base", "hashes")).withColumn("adds", F.array_except("hashes", "base"))
    needs = 2 * (100 * F.size("lacks") + SIMILARITY * F.size("adds")) - (100 - SIMILARITY) * F.size("base")
    both = both.select(
        "centre", "key", "n", "root", needs.cast("bigint").alias("needs"), F.concat("lacks", "adds").alias("delta")
    )
    return staged(both, "differences")


def _near(differences: DataFrame) -> DataFrame:
    """Rows (centre, middle, major, key, root): the rows linked to the middle, the row of least needs, by needs alone.

    ``major`` is the middle's root. A centre whose least needs are over 0 has no such rows.
    """
    first = F.struct("needs", "key")
    middles = differences.groupBy("centre").agg(
        F.min("needs").alias("least"), F.min_by("key", first).alias("middle"), F.min_by("root", first).alias("major")
    )
    middles = small(staged(middles.where("least <= 0"), "middles"))
    near = differences.join(middles, "centre").where("needs + least <= 0")
    return staged(near.select("centre", "middle", "major", "key", "root"), "near")


def _difference_pairs(differences: DataFrame, near: DataFrame) -> DataFrame:
    """Pairs (a, b) of rows around one centre that may have enough differences in common, and no common label.

    A row's label is that of the middle if links join it to that, else its root. Its rarest differences are kept, so many
    that two rows that link have one of them in common, the first of which leaves both enough to come. At the last of
    those that two rows have in common, the ones found so far and what is left of either bound them all.
    """
    joined = small(staged(near.select("centre", "root", "major").distinct(), "joined"))
    main = F.col("major").isNotNull()
    labelled = differences.join(joined, ["centre", "root"], "left").withColumn("main", main)
    labelled = labelled.withColumn("label", F.coalesce("major", "root"))
    cells = staged(
        labelled.select("centre", "key", "n", "needs", "main", "label", F.explode("delta").alias("h")), "cells"
    )
    columns = cells.groupBy("centre", "h").agg(
        F.count("*").alias("df"), F.min("label").alias("lo"), F.max("label").alias("hi")
    ).where("lo <> hi").select("centre", "h", "df")
    bounds = labelled.groupBy("centre").agg(
        F.min("needs").alias("least"), F.min(F.when(~F.col("main"), F.col("needs"))).alias("least_far")
    )
    kept = cells.join(columns, ["centre", "h"]).groupBy("centre", "key").agg(
        *(F.first(name).alias(name) for name in ("n", "needs", "main", "label")),
        F.sort_array(F.collect_list(F.struct("df", "h"))).alias("columns"),
    ).join(bounds, "centre")
    other = F.when(F.col("main"), F.col("least_far")).otherwise(F.col("least"))
    common = F.greatest(F.lit(1), F.ceil((F.col("needs") + other) / (2 * (100 + SIMILARITY))))
    kept = kept.withColumn("most", (F.size("columns") - common + 1).cast("int")).where("most > 0")
    kept = kept.select(
        "centre", "key", "n", "needs", "main", "label", F.size("columns").alias("s"),
        F.posexplode(F.slice("columns", F.lit(1), F.col("most"))).alias("at", "c"),
    ).select(
        "centre", F.col("c.h").alias("h"), "key", "n", "needs", "main", "label", (F.col("s") - F.col("at")).alias("rest")
    )
    kept = staged(kept, "kept")
    names = ("key", "n", "needs", "main", "label", "rest")
    others = kept.select("centre", "h", *(F.col(c).alias(f"{c}_b") for c in names))
    left = F.least("rest", "rest_b")
    asked = F.col("needs") + F.col("needs_b")
    meets = kept.where("not main").join(others, ["centre", "h"]).where(
        (F.col("main_b") | (F.col("key") < F.col("key_b")))
        & (F.col("label") != F.col("label_b"))
        & _may_link(F.col("n"), F.col("n_b"))
        & (left * 2 * (100 + SIMILARITY) >= asked)
    )
    pairs = meets.select(
        F.least("key", "key_b").alias("a"), F.greatest("key", "key_b").alias("b"), left.alias("left"), asked.alias("asked")
    ).groupBy("a", "b").agg(F.count("*").alias("met"), F.min("left").alias("left"), F.first("asked").alias("asked"))
    most = (F.col("met") + F.col("left") - 1) * 2 * (100 + SIMILARITY)
    return pairs.where(most >= F.col("asked")).select("a", "b")


def _labels(rows: DataFrame) -> DataFrame | None:
    """The least key that links reach, (node, root), for all rows with links but the least; None without links."""
    prepared = staged(_shared_rows(rows), "prepared")
    # Columns of one row are the rarest: they come first in a row's order but meet nothing.
    kept = F.size("columns") - F.ceil(F.col("n") * SIMILARITY / 100) + 1
    columns = staged(
        prepared.select(
            "key", "n", F.size("columns").alias("s"), F.posexplode(F.slice("columns", 1, kept.cast("int"))).alias("at", "c")
        ).select(F.col("c.h").alias("h"), "key", "n", (F.col("s") - F.col("at")).cast("bigint").alias("rest")),
        "columns",
    )
    # Part of a row's n-grams that no other row has; the key only tells equal rows apart.
    alone = (F.col("n") - F.size("columns")) / F.col("n") + F.pmod("key", F.lit(1 << 20)) * 1e-12
    sizes = prepared.select("key", "n", alone.alias("alone"))
    found, limit = None, LAST_BLOCK_PAIRS
    while True:
        roots = sizes.withColumn("root", F.col("key"))
        if found is not None:
            pivots = found.groupBy(F.col("b").alias("key")).agg(F.min("a").alias("root"))
            roots = sizes.join(pivots, "key", "left").withColumn("root", F.coalesce("root", "key"))
        roots = small(staged(roots, "roots"))
        by_root = columns.join(roots.select("key", "root", "alone"), "key").groupBy("h", "root")
        by_root = by_root.agg(
            F.min_by("key", "alone").alias("key"), F.min("alone").alias("alone"), F.count("*").alias("n")
        )
        open_columns = by_root.groupBy("h").agg(
            F.min_by("key", "alone").alias("pivot"),
            F.max_by("root", "n").alias("major"),
            F.count("*").alias("roots"),
            F.sum("n").alias("rows"),
            F.sum(F.col("n") * F.col("n")).alias("squares"),
        )
        open_columns = staged(open_columns.where("roots > 1").select("h", "pivot", "major", "rows", "squares"), "open")
        total = open_columns.agg(
            F.sum((F.col("rows") * F.col("rows") - F.col("squares")) / 2).alias("pairs"), F.sum("rows").alias("rows")
        ).first()
        if not total["rows"]:
            break
        last = total["pairs"] <= limit * total["rows"]
        limit *= GROWTH
        columns = columns.join(small(open_columns.select("h", "pivot", "major")), "h")
        if last:
            columns = staged(columns, "columns")
            centres = small(_centres(columns, rows))
            # Rows of the label that most rows of a column have need no comparison with each other.
            labelled = columns.join(roots.select("key", "root"), "key").join(centres.drop("members"), "key", "left")
            labelled = labelled.withColumn("centre", F.coalesce("centre", "key"))
            other = labelled.select("h", *(F.col(c).alias(f"{c}_b") for c in ("key", "n", "rest", "root", "centre")))
            other = other.withColumnRenamed("key_b", "b")
            # At the first column that two rows share, what is left of either bounds their overlap.
            enough = F.least("rest", "rest_b") * (100 + SIMILARITY) >= (F.col("n") + F.col("n_b")) * SIMILARITY
            meets = labelled.where("root <> major").join(other, "h").where(
                (F.col("root") != F.col("root_b"))
                & (F.col("centre") != F.col("centre_b"))
                & _may_link(F.col("n"), F.col("n_b"))
                & enough
            )
            pairs = meets.select(F.least("key", "b").alias("a"), F.greatest("key", "b").alias("b"))
            pairs = _open_pairs(pairs.distinct(), roots)
            if not centres.isEmpty():
                differences = _differences(centres, rows, roots)
                near = _near(differences)
                pairs = pairs.unionByName(_difference_pairs(differences, near))
                near = near.where("key <> middle").select(F.col("middle").alias("a"), F.col("key").alias("b"))
                found = near if found is None else found.unionByName(near)
        else:
            columns = staged(columns.where("key <> pivot"), "columns")
            pairs = columns.select(F.col("pivot").alias("a"), F.col("key").alias("b"))
            pairs = _open_pairs(pairs.distinct(), roots)
            columns = columns.drop("pivot", "major")
        links = staged(_overlaps(pairs, rows), "overlaps")
        found = links if found is None else found.unionByName(links)
        if last:
            break
    return None if found is None else components(found)


def jaccard_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one a row of ``docs``.

    ``component_id`` is the smallest id that links reach, the document's own included. A null, empty or blank text has
    no n-grams and no links. Rows with the same words are in one group; a repeated id is returned as often. Rows with a
    null id are returned with a null group and link nothing. Other columns are not read, whatever their names.
    """
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    named = texts.where("doc_id is not null")
    sets = staged(texts.mapInArrow(_keys(width), f"doc_id {kind}, key bigint, n_shingles bigint"), "sets")
    sets = sets.withColumn("key", F.when(F.col("doc_id").isNotNull(), F.col("key")))
    classes = sets.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    chosen = staged(_candidates(named, width).join(classes, "key"), "chosen")
    rows = named.mapInArrow(_rows(width), f"doc_id {kind}, key bigint, n bigint, hashes array<bigint>")
    rows = rows.join(small(chosen), ["key", "doc_id"], "left_semi").dropDuplicates(["key"])
    with bucketed(rows.select("key", "n", "hashes"), "rows", "key") as incidence:
        labels = _labels(incidence)
    grouped = sets.withColumn("root", F.col("key"))
    if labels is not None:
        grouped = sets.join(labels.withColumnRenamed("node", "key"), "key", "left")
        grouped = grouped.withColumn("root", F.coalesce("root", "key"))
    least = grouped.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return grouped.join(least, "root", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with only the row of the smallest id of each group; of rows that repeat an id, one stays."""
    groups = jaccard_groups(docs, id_column, text_column)
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias(id_column)).distinct()
    return docs.join(kept, id_column, "left_semi")
