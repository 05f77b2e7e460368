"""Thin queries over the exact de-duplication and mixing operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, mixing


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup.decide(docs)


OP5_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1 AS weight FROM sized GROUP BY source
), running AS (
  SELECT *, sum(source_size) OVER () AS total,
    sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS weight_left,
    coalesce(sum(source_size * 3) OVER earlier, 0) AS given
  FROM sources
  WINDOW earlier AS (ORDER BY source_size * 3.0::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), marked AS (
  SELECT *, source_size * 3.0::DOUBLE * weight_left <= CAST(total - given AS DOUBLE) * weight AS is_full FROM running
), goals AS (
  SELECT source, source_size,
    CASE WHEN is_full THEN source_size * 3.0::DOUBLE
      ELSE CAST(total - coalesce(sum(source_size * 3) FILTER (is_full) OVER (), 0) AS DOUBLE) * weight / (sum(weight) FILTER (NOT is_full) OVER ()) END AS target,
    CAST(('0x' || substr(md5('17:' || coalesce(source, chr(1) || 'null')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS shift
  FROM marked
), ranked AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.shift,
    CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0::DOUBLE END AS rate,
    row_number() OVER (PARTITION BY s.source ORDER BY s.size DESC, s.doc_id NULLS LAST) AS n
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
  CAST(floor(n * rate + shift) - floor((n - 1) * rate + shift) AS BIGINT) * size AS taken
FROM ranked
"""

OP9_SQL = r"""
WITH hashed AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents
), ranked AS (
  SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
    first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id NULLS LAST) AS keep_id
  FROM hashed
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM ranked
"""

QUERIES = {"op5_mixing": op5_mixing, "op9_exact_dedup": op9_exact_dedup}
SQL = {"op5_mixing": OP5_SQL, "op9_exact_dedup": OP9_SQL}
