"""What a Python worker holds at once."""

import public_tokenizers
import pyarrow as pa

import corpus_pipeline
from tessera.llm import scratch, tokens, words


def test_tables_are_written_by_small_arrow_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    rows = spark.range(3_000).selectExpr("id", "repeat('some text ', 500) AS text").coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([b.nbytes], pa.int64())], names=["n", "bytes"])

    got = scratch.materialise(rows.mapInArrow(sizes, "n long, bytes long"), "sizes").collect()
    assert sum(r["n"] for r in got) == 3_000
    assert max(r["bytes"] for r in got) < 1.1 * scratch.BATCH_BYTES
    assert spark.conf.get(name) == before


def test_texts_are_encoded_in_small_slices(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [b"one two three " * 20_000, *[b"some words of a text " * 100] * 1_500, b""]
    taken, encode = [], words.WordEncoder.encode

    def spied(self, part):
        taken.append(sum(map(len, part)))
        return encode(self, part)

    monkeypatch.setattr(words.WordEncoder, "encode", spied)
    ids = list(tokens.encoded(texts, path))
    assert len(ids) == len(texts)
    assert sum(taken) == sum(map(len, texts))
    assert max(taken) <= tokens.ENCODE_BYTES


def test_what_a_stage_returns_runs_by_small_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    try:
        kept = corpus_pipeline.clean(spark, docs, "/root/testdata/sf0.001")
        assert spark.conf.get(name) == str(scratch.BATCH_BYTES)
        assert 0 < kept.count() <= docs.count()
    finally:
        spark.conf.set(name, before)
