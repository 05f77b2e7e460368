"""The scrape: discovered addresses to sections, with a manifest that later runs resume from.

The manifest is a log of attempts.  A run works through its sections batch by batch; a
batch is committed when its pages and sections are stored, so a run that is killed
loses at most the batch it was in, and the next run goes on from there.  The newest
attempt at a section counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import crawl, fetch, ranking
from ..sources import section_pages, storage
from .config import Config

MANIFEST = "source string, section_code string, url string, status string, content_hash string, word_count long, error_type string, error_message string"
LOG = f"{MANIFEST}, attempt long"
KEY = ["source", "section_code"]
#: The log is rewritten as one part when it has more parts than this.
COMPACT_AT = 50


def words_of_page(html: str) -> int:
    """Words of the page's markdown."""
    return len(section_pages.to_markdown(html).split())


def newest(log: DataFrame) -> DataFrame:
    """The last attempt at each section."""
    own = F.struct(*[F.col(c) for c in log.columns if c not in KEY])
    return log.groupBy(*KEY).agg(F.max_by(own, F.struct("attempt", "url")).alias("x")).select(*KEY, "x.*")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of earlier runs; empty where there is none."""
    rows = newest(storage.Parts(spark, path).read(LOG))
    return rows.select(*[c.partition(" ")[0] for c in MANIFEST.split(", ")])


def frontier(found: DataFrame, done: DataFrame, config: Config) -> DataFrame:
    """What to fetch: the head of the discovered sections (if limited) without finished ones."""
    head = found.orderBy("section_code").limit(config.max_sections) if config.max_sections else found
    finished = done.filter(F.col("status").isin("success", "quality_warning")).select(*KEY)
    return crawl.changed(head, finished, KEY)


def scrape(spark: SparkSession, found: DataFrame, folder: str, make: Callable[[], fetch.Fetcher], config: Config, base_delay: float = 0.0, workers: int = 1) -> DataFrame:
    """Fetch, parse and store; returns the new manifest.

    Below ``folder``: pages (as fetched) and sections, one part a batch, and manifest.  A
    batch has the sections that each worker is to fetch before it saves
    (``manifest_save_interval``), and is named by the version of the log it starts from; a
    batch that died before its commit is done again in the same place.
    """
    log = storage.Parts(spark, f"{folder}/manifest")
    todo = frontier(found, manifest(spark, log.path), config)
    todo = storage.stored(ranking.ranked(todo, [F.col("section_code"), F.col("source"), F.col("url")]))
    size = config.manifest_save_interval * workers
    for first in range(0, todo.count(), size):
        version = log.version()
        name = f"run={version:09}"
        batch = todo.filter((F.col("rank") > first) & (F.col("rank") <= first + size)).drop("rank")
        pages = f"{folder}/pages/{name}"
        fetch.fetched(batch, make, config, base_delay, workers, words_of_page).write.mode("overwrite").parquet(pages)
        got = spark.read.parquet(pages)
        section_pages.parsed(got.filter("html is not null")).write.mode("overwrite").partitionBy("source").parquet(f"{folder}/sections/{name}")
        rows = got.select(*KEY, "url", "status", F.sha2("html", 256).alias("content_hash"), "word_count", "error_type", "error_message", F.lit(version).cast("long").alias("attempt"))
        rows.write.mode("overwrite").parquet(f"{log.path}/log/{name}")
        log.commit({name: f"log/{name}"}, base=version)
    if len(log.current()) > COMPACT_AT:
        compact(spark, log)
    return manifest(spark, log.path)


def sections(spark: SparkSession, folder: str) -> DataFrame:
    """The stored sections, of each the one that was parsed last."""
    rows = spark.read.parquet(f"{folder}/sections")  # a folder a batch, named in the order of the log
    own = F.struct(*[c for c in rows.columns if c not in KEY])
    return rows.groupBy(*KEY).agg(F.max_by(own, F.col("run").cast("string")).alias("x")).select(*KEY, "x.*").drop("run")


def forget(spark: SparkSession, folder: str, found: DataFrame) -> None:
    """Log ``found`` as not done, so that the next scrape fetches them again."""
    log = storage.Parts(spark, f"{folder}/manifest")
    version = log.version()
    old = manifest(spark, log.path).join(found.select(*KEY), KEY, "left_semi")
    rows = old.withColumn("status", F.lit("forgotten")).withColumn("attempt", F.lit(version).cast("long"))
    at = f"log/run={version:09}"
    rows.select(*[c.partition(" ")[0] for c in LOG.split(", ")]).write.mode("overwrite").parquet(f"{log.path}/{at}")
    log.commit({f"run={version:09}": at}, base=version)


def markdown_files(spark: SparkSession, folder: str) -> DataFrame:
    """source and path of the section files below ``folder``; their texts are not read."""
    if not storage.exists(spark, folder):
        return spark.createDataFrame([], "source string, path string")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").load(folder)
    return found.select(F.element_at(F.split(F.lit(folder.rstrip("/")), "/"), -1).alias("source"), "path")


def report(done: DataFrame, found: DataFrame) -> DataFrame:
    """Counters and files (source, path) by source; a source with files alone has its row too."""
    counted = found.groupBy("source").agg(F.count(F.lit(1)).alias("files"))
    by = crawl.counters(done, "source", "status").join(counted, "source", "full")
    return by.select(*[F.col(c) if c == "source" else F.coalesce(c, F.lit(0)).alias(c) for c in by.columns])


def compact(spark: SparkSession, log: storage.Parts) -> None:
    """Rewrite the log with the newest attempts alone; what was there stays until the new part is committed."""
    version, old = log.version(), log.current()
    at = log.new_folder("log")
    newest(log.read(LOG)).select(*[c.partition(" ")[0] for c in LOG.split(", ")]).write.parquet(f"{log.path}/{at}")
    log.commit({**dict.fromkeys(old), f"until={version:09}": at}, base=version)
    log.vacuum()


def status(done: DataFrame) -> DataFrame:
    """Counters by source."""
    return crawl.counters(done, "source", "status")


def first_errors(done: DataFrame, most: int = 5) -> DataFrame:
    """source, section_code, error_type and error_message of the first failures in order of the codes."""
    failed = done.filter(F.col("status") == "failed")
    return failed.select(*KEY, "error_type", "error_message").orderBy("section_code", "source").limit(most)
