"""Documents to packed batches: quality rules, near copies, benchmark passages, secrets, packing.

Every stage works on all rows its predecessor kept, and its result is written as Parquet below the
cluster's shared checkpoint folder and read again, so a lost executor repeats one stage at most.
All stages but the last return the columns of ``documents``.

Defined results, as of the operators that the stages call: a missing text has no words and fails the base rules of quality;
rows with a missing or repeated id are judged one by one, and of a group of near copies the one with the smallest id stays (missing ids
last); extra columns pass through all stages but the last; empty tables give empty results, and a row for every piece
of a text comes out of packing, none for a text without tokens.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import decontamination, near_copies, packing, quality_rules, secret_scan, token_lengths
from touchline.llm.text_queries import tokenizer_text
from touchline.session import scratch_dir
from touchline.sources.tables import table


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.kept_documents(docs, table(spark, folder, "labels"))


def copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_copies.without_copies(docs)


def benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that are not contaminated by benchmark passages."""
    return decontamination.clean_documents(docs, table(spark, folder, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with secrets replaced in their texts."""
    clean = secret_scan.without_secrets(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def packs(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of the texts in buckets and batches; lengths in tokens of the byte-level vocabulary."""
    counted = token_lengths.token_lengths(docs, tokenizer_text())
    return packing.packed(counted, "doc_id", "n_tokens")


STAGES = [("quality", quality), ("near_copies", copies), ("decontamination", benchmark), ("secrets", secrets), ("packing", packs)]
# near copies are defined by XXH64 and components, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, rows, folder).write.parquet(path)
        rows = spark.read.parquet(path)
    return rows
