"""Thin queries over token counts, packing, line de-duplication and WARC, with their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import line_dedup, packing, tokens, warc


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return tokens.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.decide(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc.roundtrip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP8_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), split AS (
  SELECT rid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM texts
), keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM split
), repeated AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT rid) >= 3
), marked AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id IS DISTINCT FROM r.last_doc AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid, doc_id
"""

OP10_SQL = r"""
WITH hashed AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), grouped AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_page FROM hashed
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last_page THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last_page THEN last_page END AS refers_to
FROM grouped
"""

QUERIES = {"op2_packing": op2_packing, "op4_token_counts": op4_token_counts, "op8_line_dedup": op8_line_dedup, "op10_warc": op10_warc}
SQL = {"op8_line_dedup": OP8_SQL, "op10_warc": OP10_SQL}
