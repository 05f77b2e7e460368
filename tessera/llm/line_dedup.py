"""Line de-duplication over levelled sorted runs of line hashes.

``LineRuns`` is a small log-structured store.  A run is a table of 128-bit line keys,
bucketed by key and sorted within each bucket, with the number of documents that hold
each key and the largest id among them.  A new batch is counted by key and merge-anti-joined
with the runs, which lie in buckets already and are not dealt again; what no run holds
becomes a run of level 0, so a key is in one run only.  What a run holds already goes to
the store's list of repeats, which stays small.  Once a level holds ``FANOUT`` runs they are
compacted into one run of the next level.

Two uses: ``LineRuns.admit`` takes batches one after the other and drops from each
all that came before (first come, first kept); ``decide`` takes a whole corpus batch by
batch and then joins the line keys with the repeats to find the lines to drop.

Keys: the line without white space ``[\\x20\\x09-\\x0D]`` at both ends, A-Z in
lower case.  Defined results: a null or empty text is one empty line; keys below
``MIN_CHARS`` code points are never dropped; repeated rows are documents of their
own (with equal ids, all of them keep a line that the id keeps); rows with a null
id yield to rows with an id; very long texts are taken whole; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrow, scratch, skew

MIN_CHARS = 20
MIN_DOCS = 3
FANOUT = 4
BATCHES = 4
WHITE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    return line.strip(WHITE).lower()  # bytes.lower changes A-Z only


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (key.isascii() or len(key.decode("utf-8", "replace")) >= least)


def line_hashes(text: bytes, least: int = MIN_CHARS) -> set[bytes]:
    """The distinct 128-bit hashes of the line keys of at least ``least`` code points."""
    return {xxhash.xxh3_128_digest(k) for k in map(line_key, text.split(b"\n")) if _long_enough(k, least)}


def _keys_of(least: int):
    def keys(batch: pa.RecordBatch) -> dict:
        ids, found = batch.column(0), [line_hashes(t, least) for t in arrow.texts(batch.column(1))]
        sizes = [len(x) for x in found]
        both = np.frombuffer(b"".join(h for x in found for h in x), dtype="<i8").reshape(-1, 2)
        return {"doc_id": ids.take(pa.array(np.repeat(np.arange(len(sizes)), sizes))), "h1": both[:, 0], "h2": both[:, 1]}

    return keys


def line_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = MIN_CHARS) -> DataFrame:
    """doc_id, h1, h2: the distinct line keys of each row."""
    cols = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return arrow.mapped(cols, _keys_of(least), "doc_id long, h1 long, h2 long")


class LineRuns:
    """Levelled sorted runs of line keys: h1, h2, n_docs, last_doc."""

    KEY = ("h1", "h2")

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout, self.levels, self.again = spark, fanout, [[]], []
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _write(self, rows: DataFrame) -> DataFrame:
        """A run: sorted files by bucket, read in a way that tells Spark of the buckets."""
        name = f"line_run_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, *self.KEY).sortBy(*self.KEY).option("path", scratch.new_path(self.spark, "line-run")).saveAsTable(name)
        run = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay, and the plan of ``run`` knows them
        return run

    @staticmethod
    def counted(parts: list[DataFrame]) -> DataFrame:
        """One row a key out of several tables of counts."""
        return reduce(DataFrame.unionByName, parts).groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def add(self, keys: DataFrame) -> None:
        """Add the (doc_id, h1, h2) of a batch: its new keys as a run, the others as repeats; and compact full levels."""
        batch = keys.groupBy(*self.KEY).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))
        if self.runs():
            batch = self._write(batch)
            run = self._write(self.unseen(batch))
            self.again.append(scratch.materialise(batch.join(run.hint("merge"), [*self.KEY], "left_anti"), "line-seen"))
        else:
            run = self._write(batch)
        self.levels[0].append(run)
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fanout:
                if level + 1 == len(self.levels):
                    self.levels.append([])
                full = self.levels[level]
                self.levels[level + 1].append(self._write(reduce(DataFrame.unionByName, full)))
                self.levels[level] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys`` whose key no run holds: a merge anti-join with each run."""
        for run in self.runs():
            keys = keys.join(run.hint("merge"), [*self.KEY], "left_anti")
        return keys

    def held_by(self, least: int) -> DataFrame:
        """h1, h2, n_docs, last_doc of the keys in ``least`` documents or more (two at least) of all batches."""
        often = [run.filter(F.col("n_docs") >= least) for run in self.runs()]
        if not self.again:
            return reduce(DataFrame.unionByName, often)
        again = scratch.materialise(self.counted(self.again), "line-again")
        first = [run.join(again.select(*self.KEY), [*self.KEY], "left_semi") for run in self.runs()]
        both = self.counted([again, *first]).filter(F.col("n_docs") >= least)
        return reduce(DataFrame.unionByName, [both, *[run.join(again.select(*self.KEY), [*self.KEY], "left_anti") for run in often]])

    def admit(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """``docs`` without the lines that earlier batches hold; then adds this batch.

        Lines that repeat within the batch stay; run `decide` over it for those.
        """
        keys = scratch.materialise(line_keys(docs, doc_id, text), "line-keys")
        fresh = self.unseen(keys)
        drops = scratch.materialise(keys.join(fresh, ["doc_id", "h1", "h2"], "left_anti"), "line-drops")
        self.add(keys)
        return without_lines(docs, drops, doc_id, text)


def _apply(keep_text: bool, least: int):
    def apply(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"n_lines": [], "n_dropped": [], "kept_sha256": [], "kept": []}
        drops = batch.column("drops").to_pylist()
        nulls = batch.column("text").is_null().to_pylist()
        for text, gone, null in zip(arrow.texts(batch.column("text")), drops, nulls, strict=True):
            lines = text.split(b"\n")
            n = len(lines)
            if gone:
                bad = set(gone)
                lines = [x for x in lines if not (_long_enough(k := line_key(x), least) and int.from_bytes(xxhash.xxh3_128_digest(k)[:8], "little", signed=True) in bad)]
                text = b"\n".join(lines)
            out["n_lines"].append(n)
            out["n_dropped"].append(n - len(lines))
            out["kept_sha256"].append(hashlib.sha256(text).hexdigest())
            out["kept"].append(text if keep_text and (text or not null) else None)
        kept = pa.array(out.pop("kept"), type=pa.binary()).cast(pa.string())
        return out | {"row": batch.column("row"), "kept": kept}

    return apply


def _dropped(docs: DataFrame, drops: DataFrame, doc_id: str, text: str, keep_text: bool, least: int) -> DataFrame:
    """A row for each row of ``docs``: row (its other columns), n_lines, n_dropped, kept_sha256, kept (the text)."""
    lists = drops.groupBy(F.col("doc_id").alias("of")).agg(F.collect_set("h1").alias("drops"))
    rows = docs.select(docs[doc_id].cast("long").alias("id"), docs[text].alias("text"), F.struct("*").dropFields(f"`{text}`").alias("row"))
    rows = rows.join(lists, F.col("id").eqNullSafe(F.col("of")), "left").select("row", "text", "drops")
    return arrow.mapped(rows, _apply(keep_text, least), arrow.with_column("row", rows.schema["row"].dataType, "n_lines long, n_dropped long, kept_sha256 string, kept string"))


def without_lines(docs: DataFrame, drops: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = MIN_CHARS) -> DataFrame:
    """``docs`` with its columns as they are, but for the lines of ``drops`` (doc_id, h1, h2)."""
    done = _dropped(docs, drops, doc_id, text, True, least)
    return done.select(*[F.col("kept").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])


def corpus_drops(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", batches: int = BATCHES, least: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, h1, h2) of the lines to drop: keys in ``min_docs`` documents stay only in the largest id."""
    keys = line_keys(docs, doc_id, text, least).withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int"))
    keys = scratch.materialise(keys, "line-keys", ["batch"])
    store = LineRuns(docs.sparkSession)
    for k in range(batches):
        store.add(keys.filter(F.col("batch") == k).drop("batch"))
    repeated = scratch.materialise(store.held_by(min_docs), "line-repeats")
    hits = skew.join_by_group(keys.drop("batch"), repeated, ["h1", "h2"], "n_docs", keys.count())
    return hits.filter(~F.col("doc_id").eqNullSafe(F.col("last_doc"))).select("doc_id", "h1", "h2")


def decide(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_lines, n_dropped, kept_sha256."""
    done = _dropped(docs.select(doc_id, text), corpus_drops(docs, doc_id, text), doc_id, text, False, MIN_CHARS)
    return done.select(F.col("row").getField(doc_id).alias("doc_id"), "n_lines", "n_dropped", "kept_sha256")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated lines dropped and all columns kept."""
    return without_lines(docs, corpus_drops(docs, doc_id, text), doc_id, text)
