"""Thin queries over toxicity, repeated passages and near-duplicates, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embedding_dedup, simhash, substring_dedup, toxicity


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score_documents(docs, labels)
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("spans").alias("n_spans"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.strip_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_text=False).drop("kept")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.group(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP3_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), tokens AS (
  SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM texts
), windows AS (
  SELECT rid, pos, CASE WHEN count(*) OVER w = 35 THEN string_agg(word, ' ') OVER w END AS body FROM tokens
  WINDOW w AS (PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)
), repeated AS (
  SELECT rid, pos FROM (SELECT rid, pos, count(*) OVER (PARTITION BY body) AS n FROM windows WHERE body IS NOT NULL) WHERE n > 1
), gone AS (
  SELECT DISTINCT rid, unnest(range(pos, pos + 35)) AS pos FROM repeated
), kept AS (
  SELECT t.rid, count(*) AS n, string_agg(t.word, ' ' ORDER BY t.pos) AS body FROM tokens t ANTI JOIN gone g ON t.rid = g.rid AND t.pos = g.pos GROUP BY t.rid
)
SELECT x.doc_id, CAST(len(x.words) AS BIGINT) AS n_words, CAST(len(x.words) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.body, '')) AS kept_sha256
FROM texts x LEFT JOIN kept k ON x.rid = k.rid
"""

QUERIES = {"op1_toxicity": op1_toxicity, "op3_substring_dedup": op3_substring_dedup, "op6_simhash": op6_simhash, "op7_embeddings": op7_embeddings}
SQL = {"op3_substring_dedup": OP3_SQL}
