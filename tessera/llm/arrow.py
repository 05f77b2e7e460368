"""Small helpers for functions over Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, StructField, StructType


def texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null becomes the empty text."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def with_column(name: str, kind: DataType, rest: str) -> StructType:
    """A schema of a column of any type and of the columns of ``rest``; names inside ``kind`` may be anything."""
    return StructType([StructField(name, kind), *StructType.fromDDL(rest).fields])


#: Arrow batches are worked on in slices of about this size, which bounds what Python holds at once.
SLICE_BYTES = 2 << 20


def release() -> None:
    """Give memory that nothing uses back to the system: a worker lives on between tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` of about ``SLICE_BYTES`` (rows are never cut)."""
    step = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def mapped(df: DataFrame, batch_of: Callable[[pa.RecordBatch], Iterator[dict] | dict], schema: str | StructType) -> DataFrame:
    """``df`` with each Arrow batch replaced by the columns that ``batch_of`` returns."""
    from pyspark.sql.pandas.types import to_arrow_schema

    types = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                cols = batch_of(part)
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for f, c in ((f, cols[f.name]) for f in types)], schema=types)
        release()

    return df.mapInArrow(run, schema)


def grouped(df: DataFrame, keys: list[str], of: Callable[[dict, list[tuple[int, int]]], dict], schema: str) -> DataFrame:
    """``of`` (columns, ranges of rows with equal ``keys``) over ``df``, dealt and sorted by these keys (integers).

    Groups are never cut, and a task holds one batch and the group that runs on, so
    groups should be bounded.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    types = to_arrow_schema(StructType.fromDDL(schema))

    def ranges(table: pa.Table) -> np.ndarray:
        cols = [table.column(k).to_numpy() for k in keys]
        new = np.zeros(table.num_rows, dtype=bool)
        new[:1] = True
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        return np.flatnonzero(new)

    def done(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        cols = {c: table.column(c).combine_chunks() for c in table.column_names}
        out = of(cols, list(zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows], strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in types], schema=types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                table = pa.concat_tables([held, table]) if held is not None else table
                starts = ranges(table)
                if len(starts) > 1:
                    yield done(table.slice(0, starts[-1]), starts[:-1])
                held = table.slice(starts[-1])
        if held is not None:
            yield done(held, np.zeros(1, dtype=np.int64))
        release()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
