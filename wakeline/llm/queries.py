"""One query an operator, over the whole of its table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.settings import table_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wakeline.llm.ngram_join import jaccard_groups

    return jaccard_groups(read(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wakeline.llm.decontaminate import contamination

    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wakeline.llm import quality

    book = quality.ledger(read(spark, sf_dir, "documents"))
    return book.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~quality.passes("base")).alias("base_failed"),
        quality.passes("v1").alias("kept"),
        "failures",
        "n_lines",
    )


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wakeline.llm.lm import score_documents

    return score_documents(read(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wakeline.llm.sharding import interleaved

    return interleaved(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wakeline.llm.secrets import secret_report

    return secret_report(read(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wakeline.llm.line_dedup import drop_boilerplate

    kept = drop_boilerplate(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "source", "text", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wakeline.llm.html_text import main_text

    return main_text(read(spark, sf_dir, "pages"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wakeline.llm.substring_dedup import without_repeats

    spans = F.transform("removed", lambda s: F.concat(s["start"], F.lit(":"), s["end"]))
    return without_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "text",
        F.size("removed").cast("bigint").alias("n_removed"),
        F.array_join(spans, ",").alias("removed_spans"),
        F.col("n_units").alias("of_units"),
    )


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from wakeline.llm.sentencepiece_bpe import encode_decode

    return encode_decode(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wakeline.llm.quality_knn import quality_scores

    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wakeline.llm.importance import draw, importance_scores

    scored = importance_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return draw(scored).select("doc_id", "n_features", "weight", "score", "rank")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wakeline.llm.filter_audit import filter_audit, part_counters

    labels = read(spark, sf_dir, "labels")
    return filter_audit(part_counters(spark, table_path(sf_dir, "documents"), labels))


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_decontaminate": op2_decontaminate,
    "op3_quality_rules": op3_quality_rules,
    "op4_lm_scores": op4_lm_scores,
    "op5_sharding": op5_sharding,
    "op6_secrets": op6_secrets,
    "op7_line_dedup": op7_line_dedup,
    "op8_html_text": op8_html_text,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_quality": op11_quality,
    "op12_importance": op12_importance,
    "op13_filter_audit": op13_filter_audit,
}
