"""Benchmark decontamination by winnowed fingerprints.

Of every run of 6 neighbouring 5-word hashes the least is kept as a fingerprint, in documents and benchmark items
alike. A span of 10 shared words holds 6 such hashes and so shares a fingerprint: none is missed. Documents that share
one are compared word by word: every window of an item that occurs extends the hit to all of its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import small, staged

WINDOW = 10
GRAM = 5
_OTHER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(text: Column) -> Column:
    """Runs of ASCII letters, digits and characters beyond ASCII, of a text of which only A-Z are lowered."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{_OTHER}+|{_OTHER}+$", "")
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"{_OTHER}+"))


def _folded(text: Column) -> Column:
    """All letters lowered, each the same wherever it stands: a capital sigma alone lowers by what is around it."""
    return F.lower(F.replace(text, F.lit("Σ"), F.lit("σ")))


def _windows(words: str, width: int) -> str:
    """SQL for all windows of so many words, as texts, in order."""
    return (
        f"CASE WHEN size({words}) < {width} THEN CAST(array() AS array<string>) ELSE "
        f"transform(sequence(1, size({words}) - {width - 1}), i -> array_join(slice({words}, i, {width}), ' ')) END"
    )


def _fingerprints(words: str, lengths: list[int]) -> Column:
    """Winnowed hashes, and for items of fewer words than a window the hashes of all windows of their lengths.

    The words may be folded further than A-Z, as long as a word folds alike in every text: equal windows stay equal.
    """
    span = WINDOW - GRAM + 1
    grams = f"transform(sequence(1, size({words}) - {GRAM - 1}), i -> xxhash64(slice({words}, i, {GRAM})))"
    least = (
        f"CASE WHEN size({words}) < {WINDOW} THEN CAST(array() AS array<bigint>) ELSE aggregate(array({grams}), "
        f"CAST(array() AS array<bigint>), (none, g) -> array_distinct("
        f"transform(sequence(1, size(g) - {span - 1}), i -> array_min(slice(g, i, {span}))))) END"
    )
    whole = [
        f"CASE WHEN size({words}) < {n} THEN CAST(array() AS array<bigint>) ELSE "
        f"transform(sequence(1, size({words}) - {n - 1}), i -> xxhash64(slice({words}, i, {n}))) END"
        for n in lengths
    ]
    return F.expr(f"concat({', '.join([least, *whole])})" if whole else least)


def _item_windows(items: DataFrame) -> DataFrame:
    """Rows (item_id, width, win): the windows of each item, or the whole of one of fewer words."""
    width = F.least(F.size("words"), F.lit(WINDOW))
    words = items.select("item_id", _words(F.translate("text", _UPPER, _UPPER.lower())).alias("words"))
    windows = f"transform(sequence(1, size(words) - width + 1), i -> array_join(slice(words, i, width), ' '))"
    return words.withColumn("width", width).where("width > 0").select(
        "item_id", "width", F.explode(F.expr(windows)).alias("win")
    ).distinct()


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Rows (doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one a row of ``docs``.

    A null, empty or blank text has no words and no hits; an item without words, or without an id, is left out.
    Repeated rows and null document ids are returned as they come. Rows that repeat an id are told apart by their
    texts. Other columns are not read. An empty benchmark leaves every document clean.
    """
    texts = docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    ).withColumn("row", F.xxhash64("doc_id", "text"))
    items = benchmark.select(F.col(item_column).cast("string").alias("item_id"), F.col(item_text).alias("text"))
    windows = staged(_item_windows(items.where("item_id is not null")), "windows")
    lengths = sorted(r["width"] for r in windows.where(F.col("width") < WINDOW).select("width").distinct().collect())
    tests = windows.select(F.split("win", " ").alias("words"))
    lowered = F.transform("words", _folded)
    tests = staged(
        tests.select(lowered.alias("words")).select(F.explode(_fingerprints("words", lengths)).alias("fp")).distinct(),
        "fingerprints",
    )
    trained = texts.select("row", _words(_folded(F.col("text"))).alias("words"))
    trained = trained.select(
        "row", F.size("words").cast("bigint").alias("n_words"), _fingerprints("words", lengths).alias("fps")
    )
    prints = trained.select("row", "n_words", F.explode_outer("fps").alias("fp"))
    found = prints.join(small(tests.withColumn("hit", F.lit(1))), "fp", "left")
    found = staged(found.groupBy("row").agg(F.max("n_words").alias("n_words"), F.max("hit").alias("hit")), "found")
    hit = staged(found.where("hit = 1").select("row"), "hit")
    covered = _covered(texts.join(small(hit), "row", "left_semi"), windows, [*lengths, WINDOW])
    return (
        texts.select("doc_id", "row")
        .join(found.select("row", "n_words"), "row")
        .join(covered, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
            F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


def _covered(texts: DataFrame, windows: DataFrame, widths: list[int]) -> DataFrame:
    """Rows (row, n_hit, n_items, items) of the texts in which a window occurs."""
    words = texts.dropDuplicates(["row"]).select(
        "row", _words(F.translate("text", _UPPER, _UPPER.lower())).alias("words")
    )
    at = None
    for width in widths:
        each = words.select("row", F.posexplode(F.expr(_windows("words", width))).alias("pos", "win"))
        each = each.withColumn("width", F.lit(width))
        at = each if at is None else at.unionByName(each)
    hits = at.join(small(windows), ["win", "width"]).groupBy("row", "pos", "width").agg(
        F.collect_set("item_id").alias("ids")
    )
    per_row = hits.groupBy("row").agg(
        F.collect_list(F.struct("pos", "width")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("ids"),
    )
    words_hit = "size(array_distinct(flatten(transform(spans, s -> sequence(s.pos, s.pos + s.width - 1)))))"
    return per_row.select(
        "row",
        F.expr(words_hit).alias("n_hit"),
        F.size("ids").alias("n_items"),
        F.array_join("ids", ",").alias("items"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text"):
    """The rows of ``docs`` in which no item's window occurs; rows without an id are judged by their text as well."""
    names = [f"_in_{i}" for i in range(len(docs.columns))]
    at = {"id": names[docs.columns.index(id_column)], "text": names[docs.columns.index(text_column)]}
    renamed = docs.toDF(*names).withColumn("_row", F.xxhash64(at["id"], F.coalesce(F.col(at["text"]), F.lit(""))))
    marked = contamination(renamed, benchmark, "_row", at["text"]).where("contaminated").select(
        F.col("doc_id").alias("_row")
    )
    return renamed.join(small(staged(marked.distinct(), "marked")), "_row", "left_anti").select(*names).toDF(*docs.columns)
