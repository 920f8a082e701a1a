"""Quality rules as a ledger of bitmasks.

Every rule is evaluated once. The ledger holds the measurements and one long per document whose bit i says that rule i
failed. Policies are versioned masks over these bits, so that a policy, or what each of its rules takes away, is read
from the ledger by bitwise operations, without the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import SPACE

#: Rule by bit: its name, and what its failure means in terms of the measurements.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 10 * word_chars"),
    ("repeated_lines", "n_lines >= 4 AND 100 * n_dup_lines > 60 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 30 * n_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_words"]
#: Policies by version: the bits that reject a document.
POLICIES = {
    "base": BASE,
    "v1": BASE | BIT["symbols"] | BIT["repeated_lines"] | BIT["short_words"] | BIT["long_words"],
}
MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")
_SPACES = " \t\n\x0b\x0c\r"


def _word_list(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(_SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def repeated_words(words: str = "words") -> Column:
    """How many words of the array column lie in windows of three words that occur twice or more.

    Windows are known by 64-bit hashes. If two agree, each hash gets its position in its low bits, as many as the
    array needs, so that one sort of longs brings equal windows together and tells where they are.
    """
    return F.expr(f"""
        CASE WHEN size({words}) < 4 THEN 0L ELSE
        aggregate(array(transform(sequence(1, size({words}) - 2), i -> xxhash64(slice({words}, i, 3)))), 0L, (z, g) ->
          CASE WHEN size(array_distinct(g)) = size(g) THEN z ELSE
          aggregate(array(shiftleft(1L, CAST(ceil(log2(size(g) + 1)) AS INT))), z, (y, m) ->
            aggregate(array(array_sort(transform(g, (h, i) -> (h & -m) | i))), y, (x, s) ->
              x + size(array_distinct(flatten(transform(
                filter(s, (v, i) -> coalesce((v & -m) = (get(s, i - 1) & -m), false)
                                 OR coalesce((v & -m) = (get(s, i + 1) & -m), false)),
                v -> array(v & (m - 1), (v & (m - 1)) + 1, (v & (m - 1)) + 2))))))) END) END""")


def measure(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with the measurements of each row; a null text has no words.

    They leave a generator of one row, so that a filter on them is not moved below it, where each use of a measurement
    would work it out, and part the text into words, anew.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    values = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_lines": F.size("_lines"),
        "n_repeat_words": repeated_words("_words"),
    }
    parted = docs.withColumn("_text", text).withColumn("_words", _word_list(F.col("_text"))).withColumn("_lines", lines)
    row = F.struct(*(v.cast("bigint").alias(name) for name, v in values.items()))
    return parted.select(*docs.columns, F.explode(F.array(row)).alias("_measured")).select(*docs.columns, "_measured.*")


def failures() -> Column:
    """The bitmask of failed rules, from the measurements."""
    bits = [F.when(F.expr(rule), F.lit(BIT[name])).otherwise(F.lit(0)) for name, rule in RULES]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return total.cast("bigint")


def ledger(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, measurements, failures), one a row of ``docs`` without any shuffle.

    Repeated rows and null ids are kept as they are. A null, empty or blank text has no words and fails ``few_words``.
    Other columns are not read, whatever their names.
    """
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return measure(narrow).select("doc_id", *MEASUREMENTS, failures().alias("failures"))


def passes(policy: str, failed: str = "failures") -> Column:
    """Whether none of the policy's bits is set."""
    return F.col(failed).bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablations(book: DataFrame, policy: str) -> DataFrame:
    """Rows (rule, failed, failed_alone): documents that fail a rule of the policy, and that fail no other of it.

    ``failed_alone`` is what the policy would keep more without the rule. The ledger is counted by mask first, which
    leaves at most 2**rules rows, whatever the number of documents.
    """
    masks = book.groupBy(F.col("failures").bitwiseAND(F.lit(POLICIES[policy])).alias("mask")).agg(
        F.count("*").alias("documents")
    )
    names = [(name, bit) for name, bit in BIT.items() if bit & POLICIES[policy]]
    rules = F.array(*(F.struct(F.lit(n).alias("rule"), F.lit(b).cast("bigint").alias("bit")) for n, b in names))
    each = masks.select("mask", "documents", F.explode(rules).alias("r")).select("mask", "documents", "r.rule", "r.bit")
    failed = F.col("mask").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(failed, F.col("documents")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("mask") == F.col("bit"), F.col("documents")).otherwise(0)).alias("failed_alone"),
    )


def kept_documents(docs: DataFrame, policy: str = "v1", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the policy, with their columns only, even where names clash with measurements."""
    names = [f"_in_{i}" for i in range(len(docs.columns))]
    book = measure(docs.toDF(*names), names[docs.columns.index(text_column)])
    return book.where(failures().bitwiseAND(F.lit(POLICIES[policy])) == 0).select(*names).toDF(*docs.columns)
