"""Token counts with a digest cache, and fast exact encoding by units of text.

A tokenizer that splits text into words before it merges can encode a text unit
by unit; units repeat, so a bounded table of encoded units replaces most calls of
the library.  ``Units`` knows two kinds of tokenizers files whose cuts are safe:

* words split with white space dropped: a cut at any space or line end;
* byte-level BPE whose words begin with their space: a cut before a space or line
  end between two characters that are no white space.

Any other text or file goes to the library whole.  Either way the ids are the
library's own.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrow, scratch, skew
from .exact_dedup import RepeatFilter
from .words import WordEncoder, slices

#: Units that one Python worker remembers at most.
MAX_UNITS = 300_000
#: Longer units are not remembered.
MAX_UNIT_CHARS = 64
LIMIT = 512
#: Texts are encoded in slices of about so many bytes: arrays over their words take twenty times as much.
ENCODE_BYTES = 1 << 20

#: White space other than single spaces and line ends between words.
_UNEVEN = re.compile("[ \n][ \n]|^[ \n]|[ \n]$|[^\\S \n]|[\x1c-\x1f\x85\u180e\u200b\ufeff]")


class Units:
    """Encodes texts by units; ``value`` turns the ids of a unit into what is kept of them."""

    def __init__(self, path: str, value):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.value, self.known = Tokenizer.from_file(path), value, {}
        with open(path, encoding="utf-8") as f:
            self.kind = self._kind(json.load(f))

    @staticmethod
    def _kind(spec: dict) -> str:
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        if any(" " in t["content"] or "\n" in t["content"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", [])):
            return "whole"
        if spec["model"].get("type") != "BPE" or spec["model"].get("dropout"):
            return "whole"
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
            return "spaced"
        steps = pre.get("pretokenizers", []) if pre.get("type") == "Sequence" else []
        removes = bool(steps) and steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert") and "\\s" in str(steps[0].get("pattern"))
        local = norm is not None and all(n["type"] in ("NFC", "Lowercase", "Replace") for n in norm.get("normalizers", [norm]))
        return "blanks" if removes and local else "whole"

    def _encode(self, texts: list[str]) -> list:
        return [self.value(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def cut(self, text: str) -> list[str]:
        if self.kind == "blanks":
            return text.replace("\n", " ").split(" ")
        if self.kind == "spaced" and text and not _UNEVEN.search(text):
            pieces = text.replace("\n", " \n").split(" ")
            # A piece stands for itself with a space before it, unless it begins with a line end; the first has none.
            pieces[0] = "\0" + pieces[0]
            return pieces
        return ["\1" + text]

    def _whole(self, piece: str) -> str:
        if self.kind == "blanks":
            return piece
        if piece[:1] in ("\0", "\1"):
            return piece[1:]
        return piece if piece[:1] == "\n" else " " + piece

    def values(self, texts: list[str]) -> tuple[list, list[int]]:
        """The values of the units of all texts in order, and each text's number of units."""
        known, cuts = self.known, [self.cut(t) for t in texts]
        flat = list(chain.from_iterable(cuts))
        missing = list(set(flat).difference(known))
        for a in range(0, len(missing), 20_000):
            part = missing[a : a + 20_000]
            known.update(zip(part, self._encode([self._whole(p) for p in part]), strict=True))
        found = list(map(known.__getitem__, flat))
        if len(known) > MAX_UNITS:  # what came last goes; frequent units came early
            for p in missing[-(len(known) - MAX_UNITS) :]:
                del known[p]
        for p in missing:
            if len(p) > MAX_UNIT_CHARS:
                known.pop(p, None)
        return found, [len(c) for c in cuts]


_units: dict[str, Units] = {}


def units(path: str) -> Units:
    """The worker's own table of token counts for a tokenizer."""
    if path not in _units:
        _units[path] = Units(path, len)
    return _units[path]


def encoded(texts: list[bytes], path: str):
    """The ids of each text as little-endian 32-bit integers."""
    if path not in _encoders:
        table = Units(path, None)
        _encoders[path] = WordEncoder(path) if table.kind == "blanks" else table.library
        del table
        arrow.release()  # what reading the file took
    encoder = _encoders[path]
    for a, b in slices(texts, ENCODE_BYTES):
        if isinstance(encoder, WordEncoder):
            ids, at = encoder.encode(texts[a:b])
            data = ids.astype("<u4").tobytes()
            yield from (data[4 * x : 4 * y] for x, y in itertools.pairwise(at))
        else:
            for e in encoder.encode_batch_fast([t.decode("utf-8", "replace") for t in texts[a:b]], add_special_tokens=False):
                yield np.array(e.ids, dtype="<u4").tobytes()


_encoders: dict = {}


def _counts(path: str):
    def counts(batch: pa.RecordBatch) -> dict:
        table, texts, out = units(path), arrow.texts(batch.column("text")), []
        for a, b in slices(texts):
            found, sizes = table.values([t.decode("utf-8", "replace") for t in texts[a:b]])
            out += np.add.reduceat(np.array(found, dtype=np.int64), np.cumsum([0, *sizes[:-1]])).tolist()
        return {"digest": batch.column("digest"), "n_tokens": out}

    return counts


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class DigestCache:
    """A table of token counts by tokenizer digest and content digest, which grows by appending."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch.new_path(spark, "token-cache")

    def read(self, tokenizer: str) -> DataFrame | None:
        """digest and n_tokens of a tokenizer; None while nothing is stored."""
        spark = self.spark
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return None
        stored = spark.read.schema("digest binary, n_tokens long, tokenizer string").parquet(self.path)
        # Two writers may have appended one digest, with equal counts.
        return stored.filter(F.col("tokenizer") == tokenizer).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, rows: DataFrame, tokenizer: str) -> None:
        rows.withColumn("tokenizer", F.lit(tokenizer)).write.mode("append").partitionBy("tokenizer").parquet(self.path)


def token_counts(docs: DataFrame, tokenizer_path: str, cache: DigestCache | None = None, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs``.

    Texts are normalised (null: empty) and digested; only distinct digests that the
    cache lacks are encoded, and then appended to it.  Rows whose digest occurs
    once pass to the encoder without a shuffle; others are reduced to one text a
    digest first.

    Defined results: a null or empty text has 0 bytes and 0 tokens; very long texts
    are encoded whole; repeated rows each get their row; ids may be null or repeat;
    an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    cache = cache or DigestCache(spark)
    version = tokenizer_digest(tokenizer_path)
    clean = F.coalesce(docs[text], F.lit(""))
    full = docs.select(docs[doc_id].alias("doc_id"), clean.alias("text"), F.unhex(F.sha2(clean, 256)).alias("digest"))
    narrow = scratch.materialise(full.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "token-digests")
    rows = narrow.count()
    repeats = RepeatFilter(narrow, "digest", rows)
    tested = repeats.test(full.select("digest", "text"))
    alone = tested.filter(~F.col("may_repeat")).select("digest", "text")
    again = tested.filter("may_repeat").groupBy("digest").agg(F.first("text").alias("text"))
    misses = alone.unionByName(again)
    if (stored := cache.read(version)) is not None:
        misses = misses.join(stored, "digest", "left_anti")
    cache.append(arrow.mapped(misses, _counts(tokenizer_path), "digest binary, n_tokens long"), version)
    # Only digests that may repeat can be heavy; `join_by_group` asks for the sizes of those.
    sizes = repeats.test(narrow.select("digest")).filter("may_repeat").groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
    sizes = F.broadcast(scratch.materialise(sizes.filter(F.col("copies") >= skew.least_heavy(rows)), "token-heavy"))  # at most 1,000 digests
    known = scratch.materialise(cache.read(version).join(sizes, "digest", "left").withColumn("copies", F.coalesce("copies", F.lit(1))), "token-counts")
    return skew.join_by_group(narrow, known, ["digest"], "copies", rows).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
