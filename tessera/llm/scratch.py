"""Tables that cut lineage, in the folder that all executors share.

``spark.checkpoint.dir`` names that folder.  Each table is plain Parquet under a
name of its own, so a lost executor costs a re-read and never a recomputation,
and a retried task can only rewrite its own part.  The folder of one
application is removed when its JVM ends.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Arrow batches that go to Python while a table is written have about this size, not 10,000 rows of any size.
BATCH_BYTES = 4 << 20

_marked: set[str] = set()
#: Folders of local sessions that name none, by application.
_own: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder of this application.

    Where ``spark.checkpoint.dir`` is unset a local session gets a temporary
    folder; a cluster session must name one, since local folders are not shared.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="tessera-")
        base = _own[app]
    root = f"{base.rstrip('/')}/tessera-{spark.sparkContext.applicationId}"
    if root not in _marked:
        jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
        path = jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _marked.add(root)
    return root


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """From now on jobs of the session send Python batches of ``BATCH_BYTES``, which bounds them on both sides."""
    spark.conf.set(_BATCH, str(BATCH_BYTES))


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """`bound_batches` for the jobs that start meanwhile."""
    before = spark.conf.get(_BATCH)
    bound_batches(spark)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def materialise(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and read it back: later plans start from the files."""
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with small_batches(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
