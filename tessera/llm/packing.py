"""Packing documents into sequences: shortest-pack-first over the length histogram.

Each document is cut into full sequences and a rest.  Only the histogram of piece
lengths (one number for each length up to ``SEQ_LEN``) reaches the driver.  There
lengths are placed longest first, each into the packs that are shortest so far;
what is kept of packs are patterns (their lengths, and how many packs have them),
so the work follows the number of lengths and not the number of documents.  The
patterns are then joined back: pieces are numbered within their length, and a run
of numbers of a length belongs to one slot of one pattern.

Defined results: a null or empty text is the document of the end token alone; very
long texts become many pieces; repeated rows are documents of their own; ids may
be null or repeat; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import arrow, ranks, scratch, tokens

SEQ_LEN = 2048
END_ID = 1


def plan(histogram: dict[int, int], seq_len: int = SEQ_LEN) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in order of their place, number of packs) that hold the whole histogram."""
    open_packs: list[tuple[int, int, tuple[int, ...]]] = []  # a heap by length: length, packs, pattern
    full: list[tuple[tuple[int, ...], int]] = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if open_packs and open_packs[0][0] + length <= seq_len:
                used, packs, pattern = heapq.heappop(open_packs)
                n = min(left, packs)
                if n < packs:
                    heapq.heappush(open_packs, (used, packs - n, pattern))
                used, pattern = used + length, (*pattern, length)
            else:
                n, used, pattern = left, length, (length,)
            left -= n
            if used == seq_len:
                full.append((pattern, n))
            else:
                heapq.heappush(open_packs, (used, n, pattern))
    return full + [(pattern, packs) for _, packs, pattern in sorted(open_packs)]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For runs of numbers of a length, sorted: length, first (from 0), base (sequence of the first), offset."""
    rows, given, base = [], {}, 0
    for pattern, packs in patterns:
        at = 0
        for length in pattern:
            first = given.get(length, 0)
            rows.append((length, first, base, at))
            given[length], at = first + packs, at + length
        base += packs
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return dict(zip(("length", "first", "base", "offset"), table.T.copy(), strict=True))


def place(pieces: DataFrame, seq_len: int = SEQ_LEN, order: tuple[str, ...] = ("doc_id", "start")) -> DataFrame:
    """``pieces`` (a table on disk with a column length) with sequence_id and offset."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most seq_len rows
    table = slots(plan(histogram, seq_len))
    ranked = ranks.numbered(pieces, "length", [F.col(c).asc_nulls_last() for c in order])

    keys, columns = (table["length"] << 44) | table["first"], pieces.columns

    def locate(batch: pa.RecordBatch) -> dict:
        length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
        k = np.searchsorted(keys, (length << 44) | (rank - 1), side="right") - 1
        out = {c: batch.column(c) for c in columns}
        return out | {"sequence_id": table["base"][k] + rank - 1 - table["first"][k], "offset": table["offset"][k]}

    return arrow.mapped(ranked, locate, StructType([*pieces.schema.fields, *StructType.fromDDL("sequence_id long, offset long").fields]))


def _cut(path: str, seq_len: int, end_id: int, with_ids: bool):
    def cut(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("at", "start", "length", "ids_crc32", "doc_tokens", "ids")}
        end = int(end_id).to_bytes(4, "little")
        for k, ids in enumerate(tokens.encoded(arrow.texts(batch.column(1)), path)):
            ids += end
            n = len(ids) // 4
            for start in range(0, n, seq_len):
                piece = ids[4 * start : 4 * (start + seq_len)]
                out["at"].append(k)
                out["start"].append(start)
                out["length"].append(len(piece) // 4)
                out["ids_crc32"].append(zlib.crc32(piece))
                out["doc_tokens"].append(n)
                out["ids"].append(piece if with_ids else None)
        return out | {"doc_id": batch.column(0).take(pa.array(out.pop("at"), type=pa.int64()))}

    return cut


def pieces(docs: DataFrame, tokenizer_path: str, seq_len: int = SEQ_LEN, end_id: int = END_ID, with_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, ids (little-endian 32-bit, or null)."""
    cols = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return arrow.mapped(cols, _cut(tokenizer_path, seq_len, end_id, with_ids), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")


def pack(docs: DataFrame, tokenizer_path: str, seq_len: int = SEQ_LEN, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Where each piece goes: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    cut = scratch.materialise(pieces(docs, tokenizer_path, seq_len, end_id, False, doc_id, text).drop("ids"), "pieces")
    return place(cut, seq_len)


def packed_sequences(docs: DataFrame, tokenizer_path: str, seq_len: int = SEQ_LEN, end_id: int = END_ID, pad_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """sequence_id, ids and segments (number of the piece within the sequence, from 1; padding: 0).

    A sequence is padded to ``seq_len``, unless its length is a power of two.
    """
    cut = scratch.materialise(pieces(docs, tokenizer_path, seq_len, end_id, True, doc_id, text), "pieces")
    placed = place(cut, seq_len)

    def join(key, table):
        table = table.sort_by("offset")
        parts = [np.frombuffer(x, dtype="<u4").astype(np.int32) for x in table.column("ids").to_pylist()]
        ids, segments = np.concatenate(parts), np.repeat(np.arange(1, len(parts) + 1, dtype=np.int32), [len(p) for p in parts])
        gap = 0 if len(ids) & (len(ids) - 1) == 0 else seq_len - len(ids)
        ids, segments = np.append(ids, np.full(gap, pad_id, np.int32)), np.append(segments, np.zeros(gap, np.int32))
        return pa.table({"sequence_id": pa.array([key[0].as_py()], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int32())), "segments": pa.array([segments], pa.list_(pa.int32()))})

    return placed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInArrow(join, "sequence_id long, ids array<int>, segments array<int>")
