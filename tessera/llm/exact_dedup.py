"""Exact de-duplication by two-pass Bloom filtering (DataFrame functions only).

Pass 1 gives every normalised text one place in a Bloom filter by its hash and keeps the
places that more than one row has, so what is left marks hashes that *may* occur
twice.  Only these places (one long a row, counted before they are shuffled) move, never a
row.  Pass 2 tests every row against that filter in one scan.  Rows that fail the test are
unique for certain and pass straight through; only the others are shuffled, grouped
by their SHA-256 and resolved exactly.

The filter has ``BITS_PER_ROW`` bits a row, in blocks of 32,768 bits, and ``MAX_FILTER_BITS``
(32 MB) at most: more rows share these bits, down to ``LEAST_BITS`` a row, which lets more
unique rows be shuffled and loses nothing.  With still more rows the filter has its
full size and is not broadcast: hashes are dealt to the blocks, in one scan as well.

Defined results: null text counts as the empty text and equals every text of
white space only; rows with a null id take part and yield to any row with an id;
repeated rows (same id, same text) form a group like any other and share one
decision; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scratch, skew

BITS_PER_ROW = 32
LEAST_BITS = 2
BLOCK_BITS = 32_768
MAX_FILTER_BITS = 1 << 28

WHITE_SPACE = r"[\x20\x09-\x0D]"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE + "+", "")


class RepeatFilter:
    """A blocked Bloom filter of the hashes that occur at least twice."""

    def __init__(self, keys: DataFrame, key: str, rows: int, bits_per_row: int = BITS_PER_ROW):
        self.key, self.fits = key, rows * LEAST_BITS <= MAX_FILTER_BITS
        bits = min(rows * bits_per_row, MAX_FILTER_BITS) if self.fits else rows * bits_per_row
        self.blocks = max(1, -(-bits // BLOCK_BITS))
        twice = keys.select(self._place().alias("place")).groupBy("place").count().filter("count >= 2")
        filters = twice.groupBy(F.expr(f"place div {BLOCK_BITS}").alias("block")).agg(F.bitmap_construct_agg(F.col("place") % BLOCK_BITS).alias("bits"))
        self.table = scratch.materialise(filters, "repeat-filter")

    def _place(self) -> Column:
        return F.pmod(F.xxhash64(self.key, F.lit(1)), F.lit(self.blocks * BLOCK_BITS))

    def test(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a column ``may_repeat``, which is false only for keys that occur once."""
        bits = F.broadcast(self.table) if self.fits else self.table
        found = rows.withColumn("__place", self._place()).withColumn("block", F.expr(f"__place div {BLOCK_BITS}")).join(bits, "block", "left")
        bit = F.col("__place") % BLOCK_BITS
        byte = F.conv(F.hex(F.substring(F.col("bits"), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        has = F.call_function("shiftright", byte, F.pmod(bit, F.lit(8)).cast("int")).bitwiseAND(1) == 1
        return found.withColumn("may_repeat", F.coalesce(F.col("bits").isNotNull() & has, F.lit(False))).drop("block", "bits", "__place")


def decide(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    clean = F.coalesce(docs[text], F.lit(""))
    narrow = scratch.materialise(
        docs.select(docs[doc_id].alias("doc_id"), F.unhex(F.sha2(normalised(docs[text]), 256)).alias("sha"), F.char_length(clean).alias("n_chars")), "exact-hashes"
    )
    rows = narrow.count()
    tested = scratch.materialise(RepeatFilter(narrow, "sha", rows).test(narrow), "exact-tested")
    alone = tested.filter(~F.col("may_repeat")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha")
    again = tested.filter("may_repeat").select("doc_id", "sha", "n_chars")
    first = F.max_by("doc_id", F.struct("n_chars", F.col("doc_id").isNotNull(), -F.col("doc_id")))
    groups = scratch.materialise(again.groupBy("sha").agg(first.alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "exact-groups")
    resolved = skew.join_by_group(again.select("doc_id", "sha"), groups, ["sha"], "group_size", rows).select("doc_id", "keep_id", "group_size", "sha")
    return alone.unionByName(resolved).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that the filter clears keep their place; only possible repeats are
    joined with the decisions on them.
    """
    sha = F.unhex(F.sha2(normalised(docs[text]), 256)).alias("sha")
    keyed = docs.select(docs[doc_id].alias("doc_id"), sha, F.char_length(F.coalesce(docs[text], F.lit(""))).alias("n_chars"), F.struct("*").alias("row"))
    narrow = scratch.materialise(keyed.select("sha"), "exact-hashes")
    tested = RepeatFilter(narrow, "sha", narrow.count()).test(keyed)
    again = tested.filter("may_repeat")
    first = F.max_by("doc_id", F.struct("n_chars", F.col("doc_id").isNotNull(), -F.col("doc_id")))
    stays = scratch.materialise(again.groupBy("sha").agg(first.alias("doc_id")), "exact-groups")
    kept = again.join(stays.filter(F.col("doc_id").isNotNull()), ["doc_id", "sha"], "left_semi")
    return tested.filter(~F.col("may_repeat")).unionByName(kept.select(*tested.columns)).select("row.*")
