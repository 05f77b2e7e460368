"""WARC archives: writing, normalising monolithic gzip files, and reading by index.

``write_archives`` writes each task's records as one gzip stream (a *monolithic*
archive, which cannot be entered in the middle).  ``normalise`` inflates each such
stream once, in bounded memory, rewrites every record as a gzip member of its own,
and writes a sidecar index of the members' offsets.  ``read_archives`` reads the
members that the index names.

Archives lie in the shared scratch folder (or any folder that pyarrow's file
systems open).  Names are unique to a task attempt and only those that a finished
task reported are used, so a retried or lost task leaves at most an unused file.

``with_revisits`` decides record types: of records with equal payloads of at least
``MIN_REVISIT`` bytes the largest page id is the response, the others revisit it.
Only digests are shuffled for that.

Defined results: null html is the empty payload; payloads below the limit, empty
ones included, are all responses; rows that share id and payload are one page and
have one record type; a null id is never referred to while another id has the
payload; a null url leaves its header out; very long payloads are streamed through
the archive; an empty table gives no archive and an empty result; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrow, scratch, skew

MIN_REVISIT = 1000
ARCHIVE_BYTES = 256 << 20
CHUNK = 1 << 20
LEVEL = 6
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def with_revisits(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, html, digest, refers_to (null for responses) for each row of ``pages``."""
    body = F.encode(F.coalesce(pages[html], F.lit("")), "UTF-8")
    rows = pages.select(pages[page_id].cast("long").alias("page_id"), pages[url].alias("url"), pages[html].alias("html"), F.sha1(body).alias("digest"), F.octet_length(body).alias("size"))
    narrow = scratch.materialise(rows.filter(F.col("size") >= least).select("page_id", "digest"), "warc-digests")
    groups = narrow.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("refers_to")).filter("n > 1")
    groups = scratch.materialise(groups, "warc-groups")
    revisits = skew.join_by_group(narrow, groups, ["digest"], "n", narrow.count()).filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    revisits = revisits.select(F.col("page_id").alias("of"), F.col("digest").alias("of_digest"), "refers_to").distinct()
    revisits = skew.small(scratch.materialise(revisits, "warc-revisits"))
    same = F.col("page_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest"))
    return rows.join(revisits, same, "left").select("page_id", "url", "html", "digest", "refers_to")


def record_id(page: int | None) -> str:
    return f"<urn:page:{'null' if page is None else page}>"


def page_of(uri: str) -> int | None:
    found = re.search(r"urn:page:(-?\d+)", uri)
    return int(found[1]) if found else None


def record(page: int | None, url: bytes | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record.  A revisit holds the HTTP head only."""
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    head = [b"WARC/1.1", f"WARC-Type: {kind}".encode(), f"WARC-Record-ID: {record_id(page)}".encode(), f"WARC-Date: {DATE}".encode()]
    if url is not None:
        head.append(b"WARC-Target-URI: " + re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], url))
    head.append(b"WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}".encode(), f"WARC-Profile: {PROFILE}".encode()]
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


class Archive:
    """Writes records as one gzip stream."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.mono.warc.gz"
        fs, inner = FileSystem.from_uri(self.path)
        self.out, self.zip, self.records, self.bytes = fs.open_output_stream(inner, compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0, 0

    def add(self, data: bytes) -> None:
        self.out.write(self.zip.compress(data))
        self.records, self.bytes = self.records + 1, self.bytes + len(data)

    def close(self) -> tuple[str, int, int]:
        self.out.write(self.zip.flush())
        self.out.close()
        return self.path, self.records, self.bytes


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write the rows of `with_revisits`; path, records, bytes of each archive, as a table on disk."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for batch in batches:
            pages, digests, refers = (batch.column(c).to_pylist() for c in ("page_id", "digest", "refers_to"))
            urls = batch.column("url").cast(pa.binary()).to_pylist()
            for page, url, payload, digest, to in zip(pages, urls, arrow.texts(batch.column("html")), digests, refers, strict=True):
                archive = archive or Archive(folder)
                archive.add(record(page, url, payload, digest, to))
                if archive.bytes >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive:
            done.append(archive.close())
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["path", "records", "bytes"])

    FileSystem.from_uri(folder)[0].create_dir(FileSystem.from_uri(folder)[1], recursive=True)
    return scratch.materialise(records.mapInArrow(write, "path string, records long, bytes long"), "warc-archives")


def records_of(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The records of an inflated WARC stream, one at a time."""
    buffer = bytearray()

    def fill(least: int) -> bool:
        while len(buffer) < least:
            data = next(chunks, None)
            if data is None:
                return False
            buffer.extend(data)
        return True

    while fill(1):
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not fill(len(buffer) + 1):
                raise ValueError("a WARC record ends within its header")
        found = re.search(rb"\r\nContent-Length:[ \t]*(\d+)", buffer[:end], re.IGNORECASE)
        if not buffer.startswith(b"WARC/") or not found:
            raise ValueError("not a WARC record")
        size = end + 4 + int(found[1]) + 4
        if not fill(size):
            raise ValueError("a WARC record ends within its block")
        yield bytes(buffer[:size])
        del buffer[:size]


def inflated(path: str) -> Iterator[bytes]:
    """A gzip file of any number of members, inflated piece by piece."""
    fs, inner = FileSystem.from_uri(path)
    with fs.open_input_stream(inner, compression=None, buffer_size=0) as source:
        engine, data = zlib.decompressobj(31), b""
        while data or (data := source.read(CHUNK)):
            if engine.eof:
                engine = zlib.decompressobj(31)
            yield engine.decompress(data, 4 * CHUNK)
            data = engine.unconsumed_tail or engine.unused_data
        if not engine.eof:
            raise ValueError(f"{path} ends within a gzip member")


def normalise_file(path: str) -> tuple[str, str, int]:
    """Rewrite an archive with a member for each record, and index it: (new path, index path, records)."""
    stem = f"{path.removesuffix('.gz').removesuffix('.warc').removesuffix('.mono')}-{uuid.uuid4().hex[:8]}"
    fs, inner = FileSystem.from_uri(stem)
    at, entries = 0, 0
    with fs.open_output_stream(f"{inner}.warc.gz", compression=None) as out, fs.open_output_stream(f"{inner}.idx.jsonl", compression=None) as index:
        for data in records_of(inflated(path)):
            zipper = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            member = zipper.compress(data) + zipper.flush()
            out.write(member)
            uri = re.search(rb"\r\nWARC-Record-ID:[ \t]*([^\r\n]*)", data)
            index.write(json.dumps({"offset": at, "length": len(member), "record": uri[1].decode() if uri else None}).encode() + b"\n")
            at, entries = at + len(member), entries + 1
    return f"{stem}.warc.gz", f"{stem}.idx.jsonl", entries


def _each(paths: DataFrame, column: str, work, schema: str) -> DataFrame:
    """``work(row) -> RecordBatch iterator`` for each row, spread over as many tasks as there are rows."""
    spread = paths.repartition(max(1, paths.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from work(row)

    return spread.mapInArrow(run, schema)


def normalise(archives: DataFrame) -> DataFrame:
    """path, index_path, records of the rewritten archives, as a table on disk."""

    def work(row: dict) -> Iterator[pa.RecordBatch]:
        done = normalise_file(row["path"])
        yield pa.RecordBatch.from_arrays([pa.array([done[0]]), pa.array([done[1]]), pa.array([done[2]], pa.int64())], ["path", "index_path", "records"])

    return scratch.materialise(_each(archives, "path", work, "path string, index_path string, records long"), "warc-normal")


def parse(data: bytes) -> dict:
    """The facts of one record; payload is None for a revisit."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:])}
    block = block[: int(fields[b"content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = re.search(rb"\r\nContent-Length:[ \t]*(\d+)", http, re.IGNORECASE)
    kind = fields[b"warc-type"].decode()
    digest = base64.b32decode(fields[b"warc-payload-digest"].partition(b":")[2]).hex()
    out = {"page_id": page_of(fields[b"warc-record-id"].decode()), "record_type": kind, "refers_to": page_of(fields.get(b"warc-refers-to", b"").decode())}
    if kind == "revisit":
        return out | {"payload_bytes": int(size[1]), "payload_digest": digest, "payload": None, "url": fields.get(b"warc-target-uri")}
    if hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"the payload of {fields[b'warc-record-id']!r} does not have its digest")
    return out | {"payload_bytes": len(payload), "payload_digest": digest, "payload": payload, "url": fields.get(b"warc-target-uri")}


READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(normal: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of normalised archives, each read from the offset that the index gives."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = READ_SCHEMA + ", url binary, payload binary" * with_payload
    types = to_arrow_schema(StructType.fromDDL(schema))

    def work(row: dict) -> Iterator[pa.RecordBatch]:
        fs, inner = FileSystem.from_uri(row["path"])
        ifs, iinner = FileSystem.from_uri(row["index_path"])
        with ifs.open_input_stream(iinner, compression=None) as source:
            entries = [json.loads(x) for x in source.read().splitlines()]
        rows, size = [], 0
        with fs.open_input_file(inner) as archive:
            for entry in entries:
                archive.seek(entry["offset"])
                rows.append(parse(zlib.decompress(archive.read(entry["length"]), 31)))
                size += (rows[-1]["payload_bytes"] if with_payload else 0) + 200
                if size > 8 * CHUNK:
                    yield pa.RecordBatch.from_pylist([{k: r[k] for k in types.names} for r in rows], schema=types)
                    rows, size = [], 0
        yield pa.RecordBatch.from_pylist([{k: r[k] for k in types.names} for r in rows], schema=types)

    return _each(normal, "path", work, schema)


def roundtrip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write ``pages`` to archives, normalise them and read them back."""
    folder = scratch.new_path(pages.sparkSession, "warc")
    return read_archives(normalise(write_archives(with_revisits(pages, page_id, url, html), folder)))
