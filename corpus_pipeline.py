"""Cleaning a corpus for training, stage by stage; each stage reads what the one before it wrote.

Quality rules reject documents, boilerplate lines of a source go, one document of each group of near duplicates stays,
documents with benchmark passages go, and what is left is encoded. Every stage but the last returns the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.common import staged
from wakeline.llm.decontaminate import clean_documents
from wakeline.llm.line_dedup import drop_boilerplate
from wakeline.llm.ngram_join import one_of_each_group
from wakeline.llm.quality import kept_documents
from wakeline.llm.sentencepiece_bpe import encode_decode
from wakeline.settings import table_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass policy v1 of the quality rules."""
    return kept_documents(docs, "v1")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that more than 2 % of the documents of their source hold, copies counted once."""
    dropped = drop_boilerplate(docs, "source", copies=False)
    n_chars = F.when(F.col("_n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return dropped.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group that links of five-word shingles join."""
    return one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return clean_documents(docs, spark.read.parquet(table_path(sf_dir, "benchmark")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """For each document the number and digest of its token ids, and the digest of the text that they decode to."""
    return encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: SQL can't express the last stage; tests/llm holds the pipeline against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each writes a table that the next one reads."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
