"""Queries that mix, transform and compress: source mixing, fill-in-middle, vector codes."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import fill_middle, mixing, vector_codes
from touchline.llm.batches import documents
from touchline.llm.registry import query
from touchline.sources.tables import table


@query(r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight, 2 * source_size AS cap FROM s),
r AS (SELECT *, cap / weight AS ratio, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM w),
levels AS (
  SELECT ratio, total - coalesce(sum(cap) OVER (ORDER BY ratio RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) AS rest,
         sum(weight) OVER (ORDER BY ratio DESC) AS open_weight FROM r),
chosen AS (SELECT rest, open_weight FROM levels WHERE rest <= ratio * open_weight ORDER BY ratio LIMIT 1),
t AS (
  SELECT source, source_size, CAST(least(cap, rest * weight / open_weight) AS DOUBLE) AS target,
         CAST('0x' || substr(sha256('42:' || coalesce(source, '')), 1, 6) AS BIGINT) AS start
  FROM r, chosen),
e AS (SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size * 16777216) ELSE 0 END AS BIGINT) AS step FROM t),
p AS (
  SELECT doc_id, size, source_size, target, step, start + step * row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) AS stop
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, ((stop >> 24) - ((stop - step) >> 24)) * size AS taken FROM p
""")
def op11_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What a mix of half as many words again takes of every document, by the sources' weights."""
    return mixing.mixed(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")


@query(r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents),
n AS (
  SELECT doc_id, t, w, CAST(len(w) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(w) + 1) AS a,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(w) + 1) AS b, CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS r,
         CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS s FROM d),
f AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r >= 50 THEN 'plain'
            WHEN s < 80 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(w[1:least(a, b)], '') AS p, array_to_string(w[least(a, b) + 1:greatest(a, b)], '') AS m,
         array_to_string(w[greatest(a, b) + 1:], '') AS e FROM n)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || e || '<P>' || p || '<M>' || m
              ELSE '<P>' || p || '<S>' || e || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM f
""")
def op12_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in its fill-in-middle form, out of stored frames, and its digest after restoring."""
    return fill_middle.transformed(fill_middle.written(documents(spark, folder)))


def _code_rounds(rounds: int) -> str:
    """SQL of the codebook rounds: c0 the beginning, a<i> the nearest entries under c<i>, and c<i + 1> the floors of their means."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT row, p, arg_min(e, (away, e)) AS e, min(away) AS away FROM (
    SELECT v.row, v.p, c.e, list_sum(list_transform(range(1, len(v.x) + 1), lambda j: (v.x[j] - c.x[j]) * (v.x[j] - c.x[j])))::BIGINT AS away
    FROM v JOIN c{i} c ON v.p = c.p) GROUP BY row, p)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
    SELECT p, e, list((s - ((s % k) + k) % k) // k ORDER BY j) AS x FROM (
      SELECT p, e, j, sum(y)::BIGINT AS s, count(*) AS k
      FROM (SELECT v.p, a.e, unnest(v.x) AS y, unnest(range(1, len(v.x) + 1)) AS j FROM a{i} a JOIN v ON a.row = v.row AND a.p = v.p)
      GROUP BY p, e, j) GROUP BY p, e) m ON c.p = m.p AND c.e = m.e)""")
    return ",\n".join(steps)


@query(f"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS row, vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * x::DOUBLE) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT row, p, x[CAST(p * len(x) // 8 + 1 AS BIGINT):CAST((p + 1) * len(x) // 8 AS BIGINT)] AS x FROM k, range(8) AS r(p)),
c0 AS (SELECT p, row - 1 AS e, x FROM v WHERE row <= 16),
{_code_rounds(vector_codes.ROUNDS)},
z AS (
  SELECT row, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, sum(away)::BIGINT AS error FROM a{vector_codes.ROUNDS} GROUP BY row),
b AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{vector_codes.ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM k JOIN z ON k.row = z.row, b
""")
def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Product codes of every usable vector, their errors, and the digest of the codebooks."""
    codes, books = vector_codes.compressed(table(spark, folder, "embeddings"))
    rows = vector_codes.with_label_errors(codes)
    digest = F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256")
    return rows.select(F.col("id").alias("vec_id"), "code", "error", "label_error", digest)
