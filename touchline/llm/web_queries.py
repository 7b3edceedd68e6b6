"""Queries on web pages and on what texts hold of people: URL filters, archives, personal data."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import personal_data, url_rules, warc
from touchline.llm.batches import documents
from touchline.llm.registry import query
from touchline.session import scratch_dir
from touchline.sources.tables import table

# fixed values: the given rules
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


@query()
def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of personal data: fixed patterns, and identifiers found by their context."""
    spans = personal_data.personal_data(documents(spark, folder))
    return spans.select(
        "doc_id", *[f"n_{k}" for k in personal_data.KINDS], F.sha2(personal_data.listed(F.col("base")), 256).alias("base_sha256"),
        personal_data.listed(F.col("every")).alias("spans"))


@query()
def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Given rules first; other URLs by rules mined from the labels."""
    return url_rules.judged(table(spark, folder, "pages"), table(spark, folder, "labels"), RULES)


@query("""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT), 1)), '')
         AS payload_digest FROM p),
o AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS original FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to FROM o
""")
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written as deduplicated archives and read back."""
    path = scratch_dir(spark, "warc")
    pages = table(spark, folder, "pages")
    warc.write_archives(pages, path)
    return warc.resolved(spark, path, pages.schema["page_id"].dataType.simpleString())
