"""Queries that lay out or mend training text: packing, conversations, secrets."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import chat_roles, packing, secret_scan, token_lengths
from touchline.llm.batches import documents
from touchline.llm.registry import query
from touchline.llm.text_queries import tokenizer_text
from touchline.sources.tables import table


@query()
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in optimal buckets and batches; lengths in tokens of the byte-level vocabulary."""
    counted = token_lengths.token_lengths(documents(spark, folder), tokenizer_text())
    return packing.packed(counted, "doc_id", "n_tokens")


@query()
def op7_chat_roles(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn of all conversations with its recovered role, rendered."""
    return chat_roles.recovered(table(spark, folder, "conversations"))


@query()
def op10_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Every candidate of every document with the forest's verdict."""
    docs = documents(spark, folder)
    model, words = secret_scan.trained(docs)
    found = secret_scan.findings(docs, model, ["doc_id"], words=words).select("doc_id", F.inline("findings"))
    return found.select("doc_id", "start", "end", F.round("probability", 6).alias("probability"), "secret")
