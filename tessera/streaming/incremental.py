"""Incremental enrichment as a stream: new or changed files of a tree, batch by batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import crawl
from ..plans import enrich
from ..sources import files, storage


def enriched(sections: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Enriched chunks of parsed files (as `files.sections` gives them), linked with sections ``known`` as well."""
    c = F.col
    numbered = sections.filter("error is null and section_code <> ''").select("source", "section_code", "title", "body", (c("table_count") > 0).alias("has_tables"), F.xxhash64("path").alias("section_id"), "path", "content_hash")
    return enrich.enrich(numbered, known=known)


#: Buckets of the tables, by path; a batch rewrites the buckets of the files that changed.
BUCKETS = 64
STATE = "path string, content_hash string"


def tables(spark: SparkSession, folder: str) -> storage.Parts:
    """The parts below ``folder``: chunks and state, by bucket."""
    return storage.Parts(spark, folder)


def bucket(path: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(path), F.lit(buckets)).cast("int")


def state(spark: SparkSession, folder: str) -> DataFrame:
    """path, content_hash of the files as last enriched."""
    return tables(spark, folder).read(STATE, prefix="state/")


def chunks(spark: SparkSession, folder: str) -> DataFrame:
    """The chunks of all files as last enriched; empty, with the path alone, before the first batch."""
    parts = tables(spark, folder)
    return _read(parts, [p for p in parts.current() if p.startswith("chunks/")])


def _read(parts: storage.Parts, names: list[str]) -> DataFrame:
    now = parts.current()
    folders = [f"{parts.path}/{now[n]}" for n in names if n in now]
    return parts.spark.read.parquet(*folders) if folders else parts.spark.createDataFrame([], "path string, source string, section_code string")


def index(spark: SparkSession, folder: str) -> DataFrame:
    """The index entries (chunk_id, entry) of all chunks."""
    return files.index_entries(chunks(spark, folder))


def update(spark: SparkSession, batch: DataFrame, folder: str) -> None:
    """Enrich what changed in ``batch`` (path, value) and replace it in the tables below ``folder``.

    Rows of a file are replaced whole.  Only the buckets of changed files are written,
    to new folders, and one commit points to them, chunks and state alike: a batch that
    fails at any step leaves both as they were and is done again.  New chunks are linked
    with the sections of all files, not of this batch alone.
    """
    parts = tables(spark, folder)
    version = parts.version()
    now = storage.stored(files.sections(batch).withColumn("bucket", bucket(F.col("path"))))
    fresh = storage.stored(crawl.changed(now, state(spark, folder), ["path", "content_hash"]))
    touched = [r[0] for r in fresh.select("bucket").distinct().collect()]  # at most BUCKETS
    if not touched:
        return
    old = _read(parts, [f"chunks/{b}" for b in touched])
    others = chunks(spark, folder).select("path", "source", "section_code")
    known = crawl.changed(others, fresh.select("path"), ["path"]).select("source", "section_code").distinct()
    rows = enriched(fresh.drop("bucket"), known)
    if old.columns != ["path", "source", "section_code"]:
        rows = crawl.changed(old, fresh.select("path"), ["path"]).unionByName(rows)
    kept = crawl.changed(parts.read(STATE, parts=[f"state/{b}" for b in touched]), fresh.select("path"), ["path"])
    states = kept.unionByName(fresh.select("path", "content_hash"))
    _commit(parts, rows, states, touched, version)


def replace(spark: SparkSession, sections: DataFrame, folder: str) -> None:
    """Enrich all ``sections`` and put them in the place of everything below ``folder``, in one commit."""
    parts = tables(spark, folder)
    version = parts.version()
    found = storage.stored(sections)
    _commit(parts, enriched(found), found.select("path", "content_hash"), list(range(BUCKETS)), version)


def _commit(parts: storage.Parts, rows: DataFrame, states: DataFrame, touched: list[int], version: int) -> None:
    """Write the ``touched`` buckets of chunks and state and point to them."""
    changes: dict[str, str | None] = {}
    for kind, table in (("chunks", rows), ("state", states)):
        at = parts.new_folder(kind)
        table.withColumn("bucket", bucket(F.col("path"))).repartition("bucket").write.partitionBy("bucket").parquet(f"{parts.path}/{at}")
        there = set(storage.names(parts.spark, f"{parts.path}/{at}"))
        changes |= {f"{kind}/{b}": f"{at}/bucket={b}" if f"bucket={b}" in there else None for b in touched}
    parts.commit(changes, base=version)
    parts.vacuum()


def _table(spark: SparkSession, path: str, schema: str | None) -> DataFrame | None:
    """The table at ``path``, taken back first from where a run that died midway had put it."""
    fs, here, before = _places(spark, path, "", "-before")
    if not fs.exists(here) and fs.exists(before):
        fs.rename(before, here)
    if fs.exists(here):
        return spark.read.parquet(path)
    return spark.createDataFrame([], schema) if schema else None


def _places(spark: SparkSession, path: str, *ends: str) -> list:
    """The file system of ``path``, and ``path`` with each of the ``ends``."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    found = [hadoop.Path(f"{path}{end}") for end in ends]
    return [found[0].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), *found]


def replace_table(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Write next to the table, then take its place: the new rows may come from the old table.

    The old table is moved and deleted last, so at any time it or the new one is there.
    """
    files.write_table(df, f"{path}-next")
    fs, here, new, before = _places(spark, path, "", "-next", "-before")
    if fs.exists(here):
        fs.delete(before, True)
        fs.rename(here, before)
    if not fs.rename(new, here):
        raise OSError(f"{path} could not be replaced")
    fs.delete(before, True)


_replace = replace_table


def watch(spark: SparkSession, tree: str, folder: str) -> StreamingQuery:
    """A query that enriches the files of ``tree`` that are new since it last ran, and then stops."""
    stream = spark.readStream.schema("value string").option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").format("text").load(tree)
    rows = stream.select(F.col("_metadata.file_path").alias("path"), "value")
    return rows.writeStream.foreachBatch(lambda df, _: update(df.sparkSession, df, folder)).option("checkpointLocation", f"{folder}/stream").trigger(availableNow=True).start()
