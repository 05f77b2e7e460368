"""A cache of a model's answers that outlives runs, keyed by content, model and prompt version.

The table is partitioned by the first two digits of the key.  A lookup reads only the
partitions that its keys touch; a write replaces only those, by dynamic partition
overwrite, with what was there and the new entries, the newest entry of a key winning.
Writers take turns (an exclusive file), so none loses what another wrote and no key is
there twice.  Answers are computed before the turn is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import storage

#: Only so many characters of a text count in its key.
KEY_CHARS = 8000
ENTRY = "key string, result string, model string, prompt_version string, stored_at timestamp, tokens_used long"


def cache_key(content: Column, model: str, version: str) -> Column:
    return F.sha2(F.concat(F.substring(F.coalesce(content, F.lit("")), 1, KEY_CHARS), F.lit(f"|{model}|{version}")), 256)


def shard(key: Column) -> Column:
    return F.substring(key, 1, 2)


class AnswerCache:
    """The cache at ``path``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, stale: float = 600.0):
        self.spark, self.path, self.stale = spark, path.rstrip("/"), stale

    def entries(self, shards: list[str] | None = None) -> DataFrame:
        """All entries, or those of ``shards``; an entry that holds no JSON is left out."""
        if not storage.exists(self.spark, self.path):
            return self.spark.createDataFrame([], f"{ENTRY}, shard string")
        # A schema of its own: digits like 00 or 1e would else be read as numbers.
        rows = self.spark.read.schema(f"{ENTRY}, shard string").parquet(self.path)
        if shards is not None:
            rows = rows.filter(F.col("shard").isin(shards))
        return rows.filter(F.try_parse_json("result").isNotNull())

    def touched(self, keys: DataFrame) -> list[str]:
        """The shards of ``keys`` (key), of which there are 256 at most."""
        return sorted(r[0] for r in keys.select(shard(F.col("key"))).distinct().collect() if r[0])

    def get(self, keys: DataFrame) -> DataFrame:
        """``keys`` (key and any other columns) with result and tokens_used of their entries, null for a miss."""
        found = self.entries(self.touched(keys)).select(F.col("key").alias("__key"), "result", "tokens_used")
        return keys.join(found, F.col("key") == F.col("__key"), "left").drop("__key")

    def put(self, entries: DataFrame) -> None:
        """Store ``entries`` (the columns of ``ENTRY``), which should be a table on disk."""
        shards = self.touched(entries)
        if not shards:
            return
        parent = self.path.rpartition("/")[0]
        with storage.exclusive(self.spark, f"{parent}/_turn-{self.path.rpartition('/')[2]}", self.stale):
            both = self.entries(shards).drop("shard").unionByName(entries.select("key", "result", "model", "prompt_version", "stored_at", "tokens_used"))
            newest = both.groupBy("key").agg(F.max_by(F.struct("result", "model", "prompt_version", "stored_at", "tokens_used"), F.struct("stored_at", "result")).alias("e"))
            # What is read is what will be replaced, so it is written aside first.
            rows = storage.stored(newest.select("key", "e.*").withColumn("shard", shard(F.col("key"))))
            rows.repartition("shard").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(self.path)

    def clear(self) -> int:
        """Remove all entries; returns how many there were."""
        n = self.entries().count()
        storage.delete(self.spark, self.path)
        return n

    def statistics(self, looked_up: DataFrame) -> DataFrame:
        """hits, misses, entries and hit_rate (0 if nothing was looked up) of a lookup (as ``get`` gives it)."""
        hits = F.count_if(F.col("result").isNotNull())
        every = F.count(F.lit(1))
        one = looked_up.agg(hits.alias("hits"), (every - hits).alias("misses"), F.when(every > 0, hits / every).otherwise(F.lit(0.0)).alias("hit_rate"))
        return one.withColumn("entries", F.lit(self.entries().count()).cast("long"))
