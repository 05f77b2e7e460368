"""Folders that executors share: scratch tables, exclusive sections, and tables of parts behind a pointer."""

from __future__ import annotations

import contextlib
import json
import tempfile
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Scratch folders by application.
_scratch: dict[str, str] = {}


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and ``path`` for it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none where there is no folder."""
    fs, at = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = file_system(spark, path)
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole; False if there is one already."""
    jvm = spark.sparkContext._jvm
    fs, at = file_system(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(at.getParent(), f"_{at.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(aside)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(aside, at, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception:
        fs.delete(aside, False)
        if fs.exists(at):
            return False
        raise
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file whole."""
    jvm = spark.sparkContext._jvm
    fs, at = file_system(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(at.getParent(), f"_{at.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(aside)
    stream.write(bytearray(text.encode()))
    stream.close()
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(aside, at, how)


@contextlib.contextmanager
def exclusive(spark: SparkSession, path: str, stale: float = 600.0, wait: float = 0.2) -> Iterator[None]:
    """Hold the file ``path`` while the body runs; one left by a dead holder goes after ``stale`` seconds."""
    fs, at = file_system(spark, path)
    mine = uuid.uuid4().hex
    while not create_text(spark, path, mine):
        with contextlib.suppress(Exception):  # it may go meanwhile
            if time.time() - fs.getFileStatus(at).getModificationTime() / 1000 > stale:
                fs.delete(at, False)
                continue
        time.sleep(wait)
    try:
        yield
    finally:
        with contextlib.suppress(Exception):
            if read_text(spark, path) == mine:
                fs.delete(at, False)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for tables that cut lineage, below ``spark.checkpoint.dir``; a local session may do without the setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _scratch.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="tessera-guide-"))
    path = f"{base.rstrip('/')}/guide-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}"
    fs, at = file_system(spark, path)
    fs.deleteOnExit(at)
    return path


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to a scratch folder and read back."""
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Parts:
    """A table of named parts, each a folder of Parquet; a pointer says which folder is a part's current one.

    A commit writes a pointer of the next number, whole or not at all, and only if no
    other writer took that number.  Folders that no pointer names are invisible, so a
    run that dies at any step leaves the table as it was.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _numbers(self) -> list[int]:
        return sorted(int(n.removeprefix("pointer-").removesuffix(".json")) for n in names(self.spark, f"{self.path}/_pointers") if n.startswith("pointer-"))

    def _pointer(self, number: int) -> str:
        return f"{self.path}/_pointers/pointer-{number:09}.json"

    def version(self) -> int:
        return max(self._numbers(), default=0)

    def current(self) -> dict[str, str]:
        """Folder (below the table's path) by part."""
        number = self.version()
        return json.loads(read_text(self.spark, self._pointer(number))) if number else {}

    def read(self, schema: str, prefix: str = "", parts: list[str] | None = None) -> DataFrame:
        """Rows of the parts whose names begin with ``prefix``, or of ``parts``."""
        now = self.current()
        folders = [f"{self.path}/{now[p]}" for p in (parts if parts is not None else now) if p in now and p.startswith(prefix)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def new_folder(self, kind: str) -> str:
        """A folder below the table's path that nothing uses yet."""
        return f"{kind}/version={self.version() + 1:09}-{uuid.uuid4().hex[:8]}"

    def commit(self, changes: dict[str, str | None], base: int | None = None) -> int:
        """Point to new folders, or to none; ``base`` is the version that the changes start from.

        Raises if another writer committed after ``base``.
        """
        number = self.version()
        if base is not None and base != number:
            raise RuntimeError(f"{self.path} went from version {base} to {number} meanwhile")
        now = {k: v for k, v in (self.current() | changes).items() if v is not None}
        if not create_text(self.spark, self._pointer(number + 1), json.dumps(now, indent=1)):
            raise RuntimeError(f"another writer took version {number + 1} of {self.path}")
        return number + 1

    def vacuum(self) -> int:
        """Delete folders and pointers that are not current; returns the number of folders deleted."""
        now, gone = set(self.current().values()), 0
        for number in self._numbers()[:-1]:
            delete(self.spark, self._pointer(number))
        for kind in sorted({folder.partition("/")[0] for folder in now}):  # what else lies there is not the table's
            for version in names(self.spark, f"{self.path}/{kind}"):
                at = f"{kind}/{version}"
                inside = [f"{at}/{n}" for n in names(self.spark, f"{self.path}/{at}")]
                used = [x for x in inside if x in now]
                if at not in now and not used:
                    delete(self.spark, f"{self.path}/{at}")
                    gone += 1
                elif used:
                    for x in inside:
                        if x not in now and not x.rpartition("/")[2].startswith("_"):
                            delete(self.spark, f"{self.path}/{x}")
                            gone += 1
        return gone
