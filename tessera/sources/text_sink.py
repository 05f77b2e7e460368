"""A writer of text files: one a row, of which only those of finished tasks appear.

``df.write.format("tessera_text")`` takes rows (name, text).  Each attempt of a task
writes to a folder of its own next to the target; the commit of the job moves the files
of the attempts that count to their place, so a reader sees all of a job's files or, if
it failed, none of them.  Options: ``path`` (a folder that all executors share, as a
URI), and ``layout``: ``flat`` puts every file below ``path`` under its name, which takes
a move a file; ``tasks`` keeps a folder for each task, which takes a move a task, and in
it a folder for each ``FOLDER`` files.  What ``tasks`` wrote is read back task by task:
the driver lists the folders of tasks alone, and a task one folder of files at a time.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import Row, StructType

NAME = "tessera_text"
STAGED = "_staged"
#: Moves that the commit makes at a time.
MOVES = 16
#: Files of a folder below that of a task, and bytes of a batch on reading.
FOLDER, BATCH_BYTES = 1000, 4 << 20


@dataclass
class Written(WriterCommitMessage):
    """What an attempt left: its folder, the files in it and their bytes."""

    attempt: str
    task: int
    files: int
    bytes: int


class TextWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path = options["path"].rstrip("/")
        self.flat = options.get("layout", "flat") == "flat"
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex

    def _open(self):
        from pyarrow.fs import FileSystem

        return FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        from pyspark import TaskContext

        fs, base = self._open()
        context = TaskContext.get()
        attempt = f"{STAGED}/{self.job}/{context.partitionId():06}-{context.taskAttemptId()}"
        files = size = 0
        for row in iterator:
            name, text = row[0], row[1]
            if not name or name.startswith("/") or ".." in name.split("/"):
                raise ValueError(f"no name of a file below the folder: {name!r}")
            at = f"{base}/{attempt}/{name}" if self.flat else f"{base}/{attempt}/{files // FOLDER:06}/{name}"
            fs.create_dir(at.rpartition("/")[0], recursive=True)
            with fs.open_output_stream(at) as out:
                out.write(data := (text or "").encode())
            files, size = files + 1, size + len(data)
        return Written(attempt, context.partitionId(), files, size)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow.fs import FileSelector, FileType

        fs, base = self._open()
        fs.create_dir(base, recursive=True)
        if self.overwrite:
            for x in fs.get_file_info(FileSelector(base)):
                if x.base_name != STAGED:
                    fs.delete_dir(x.path) if x.type == FileType.Directory else fs.delete_file(x.path)

        def moved(pair: tuple[str, str]) -> None:
            fs.create_dir(pair[1].rpartition("/")[0], recursive=True)
            fs.move(*pair)

        with ThreadPoolExecutor(MOVES) as pool:
            for m in messages:
                if m is None or not m.files:
                    continue
                own = f"{base}/{m.attempt}"
                if self.flat:
                    found = fs.get_file_info(FileSelector(own, recursive=True))
                    pairs = [(x.path, f"{base}/{x.path[x.path.index(m.attempt) + len(m.attempt) + 1 :]}") for x in found if x.type == FileType.File]
                else:
                    pairs = [(own, f"{base}/task-{m.task:06}-{self.job[:8]}")]
                list(pool.map(moved, pairs))
        self._clear(fs, base)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, base = self._open()
        for _ in range(10):  # tasks that are being stopped may still write for a moment
            self._clear(fs, base)
            time.sleep(0.3)

    def _clear(self, fs, base: str) -> None:
        from pyarrow.fs import FileSelector, FileType

        if fs.get_file_info(f"{base}/{STAGED}/{self.job}").type == FileType.Directory:
            fs.delete_dir(f"{base}/{STAGED}/{self.job}")
        if fs.get_file_info(f"{base}/{STAGED}").type == FileType.Directory and not fs.get_file_info(FileSelector(f"{base}/{STAGED}")):
            fs.delete_dir(f"{base}/{STAGED}")


class TextReader(DataSourceReader):
    """The files of a folder that ``tasks`` wrote; a partition a task."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"].rstrip("/")

    def partitions(self) -> list[InputPartition]:
        from pyarrow.fs import FileSelector, FileSystem, FileType

        fs, base = FileSystem.from_uri(self.path)
        found = [x for x in fs.get_file_info(FileSelector(base, allow_not_found=True)) if x.base_name != STAGED]
        if any(x.type != FileType.Directory for x in found):
            raise ValueError(f"{self.path} has files that belong to no task")
        return [InputPartition(x.base_name) for x in sorted(found, key=lambda x: x.base_name)] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator:
        """Arrow batches of (name, text)."""
        import pyarrow as pa
        from pyarrow.fs import FileSelector, FileSystem, FileType

        if partition.value is None:
            return
        fs, base = FileSystem.from_uri(self.path)

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["name", "text"])

        names, texts, size = [], [], 0
        for folder in fs.get_file_info(FileSelector(f"{base}/{partition.value}")):
            for x in fs.get_file_info(FileSelector(folder.path, recursive=True)):
                if x.type != FileType.File:
                    continue
                with fs.open_input_stream(x.path) as file:
                    data = file.read()
                names.append(x.path[len(folder.path) + 1 :])
                texts.append(data.decode())
                size += len(data) + 100
                if size > BATCH_BYTES:
                    yield batch()
                    names, texts, size = [], [], 0
        if names:
            yield batch()


class TextFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "name string, text string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return TextWriter(self.options, overwrite)

    def reader(self, schema: StructType) -> DataSourceReader:
        return TextReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TextFiles)


def write_texts(df: DataFrame, path: str, layout: str = "flat", mode: str = "append") -> None:
    """Write ``df`` (name, text) below ``path``."""
    register(df.sparkSession)
    df.select("name", "text").write.format(NAME).option("path", path).option("layout", layout).mode(mode).save()


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """name, text of what ``write_texts`` wrote below ``path`` with the layout ``tasks``."""
    register(spark)
    return spark.read.format(NAME).option("path", path).load()
