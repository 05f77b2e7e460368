"""A training corpus out of ``documents``: five stages, each of one operator.

``run(spark, sf_dir)`` applies them in order; a driver may instead write each stage's
result as Parquet and read it back as the next one's input.  All stages but the last
return the columns of ``documents``; the last returns the packed pieces.

A stage's result runs when its caller writes it, so each stage leaves the session with
Arrow batches of ``scratch.BATCH_BYTES`` (`spark.sql.execution.arrow.maxBytesPerBatch`).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import line_dedup, mixing, packing, scratch, simhash, toxicity


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    scratch.bound_batches(spark)
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of 20 code points and more that three documents hold; n_chars follows the text."""
    scratch.bound_batches(spark)
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group with five-word shingles alike by 0.8 or more."""
    scratch.bound_batches(spark)
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return mixing.repeated(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the sequences of 2,048 tokens."""
    scratch.bound_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", clean), ("line dedup", lines), ("SimHash near-dedup", near), ("mixing", mixed), ("packing", packed)]

#: The first stage is a trained model and the last a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.materialise(docs, f"stage-{k + 1}")
    return docs
