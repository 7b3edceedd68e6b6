"""Queries on whole documents: token counts, near copies, quality, benchmark passages."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import decontamination, near_copies, quality_rules, token_counts
from touchline.llm.batches import documents
from touchline.llm.registry import query
from touchline.session import cut_lineage
from touchline.sources.tables import table

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024


def tokenizer_text(name: str = VOCABULARY) -> str:
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


@query()
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Exact token counts, and where a text must be cut to keep within the limit, out of stored prefix tables."""
    counted = token_counts.answered(token_counts.written_tables(documents(spark, folder), tokenizer_text()), limits=(LIMIT,))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), f"cut_{LIMIT}")


@query()
def op2_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies.near_copies(documents(spark, folder))


@query(r"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
wins AS (
  SELECT doc_id, i, w[i:i + 2] AS win
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM d) WHERE i + 2 <= len(w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM wins) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(3) AS r(j) GROUP BY doc_id),
base AS (
  SELECT d.doc_id, lang, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
         len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
         len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_capitals
  FROM d LEFT JOIN lines ON d.doc_id = lines.doc_id LEFT JOIN rep ON d.doc_id = rep.doc_id),
shares AS (
  SELECT doc_id, lang, unnest(['symbols', 'repeated_lines', 'repeated_words', 'capitals']) AS rule,
         unnest([n_symbols, n_dup_lines, n_repeat_words, n_capitals]) AS part, unnest([word_chars, n_lines, n_words, n_words]) AS whole FROM base),
levels AS (SELECT doc_id, lang, rule, CASE WHEN whole > 0 THEN (200 * part + whole - 1) // whole ELSE 0 END AS level FROM shares),
held AS (
  SELECT l.*, q.good FROM levels l
  JOIN (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) q ON l.doc_id = q.doc_id),
lost AS (
  SELECT lang, rule, cutoff, count(*) FILTER (good = 1) AS n, count(*) FILTER (good = 1 AND level > cutoff) AS k,
         count(*) FILTER (good <> 1 AND level > cutoff) AS caught
  FROM held, range(200) AS c(cutoff) GROUP BY lang, rule, cutoff),
tails AS (
  SELECT lang, rule, cutoff, k, caught,
         CASE WHEN n = 0 THEN 1 WHEN k > 0.005 * n + 100 THEN 1
         ELSE (SELECT sum(exp(CASE WHEN i = 0 THEN 0 ELSE lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) END
                              + i * ln(0.005) + (n - i) * ln(0.995))) FROM range(k + 1) AS s(i)) END AS tail
  FROM lost),
certified AS (
  SELECT * FROM tails WHERE tail <= 0.05 / (4 * greatest(1, (SELECT count(*) FROM (SELECT DISTINCT lang FROM held))))),
chosen AS (
  SELECT lang, rule, arg_max(cutoff, (caught - 10 * k) * 1000 + cutoff) AS cutoff FROM certified GROUP BY lang, rule),
above AS (
  SELECT doc_id, bool_or(level > cutoff) AS rejected FROM levels l
  JOIN chosen c ON l.lang IS NOT DISTINCT FROM c.lang AND l.rule = c.rule GROUP BY doc_id)
SELECT base.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT coalesce(rejected, FALSE) AS kept
FROM base LEFT JOIN above ON base.doc_id = above.doc_id
""")
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and the verdict under cutoffs certified on the labelled documents, by language."""
    counted = cut_lineage(quality_rules.measures(documents(spark, folder), ["doc_id", "lang"]))
    chosen = quality_rules.cutoffs(counted, table(spark, folder, "labels"))
    return quality_rules.judged(counted, chosen).select(
        "doc_id", *[f"counts.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        quality_rules.base_failed("counts").alias("base_failed"), "kept")


@query(r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS size, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
found AS (
  SELECT p.doc_id, p.i, p.size, x.item_id
  FROM (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
        FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM windows))) p
  JOIN windows x ON p.size = x.size AND p.win = x.win),
hit AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM (SELECT DISTINCT doc_id, i, size FROM found), range(13) AS r(j) WHERE j < size GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
""")
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.verdicts(documents(spark, folder), table(spark, folder, "benchmark"))
