"""Ranked lexical search by a bit-sliced impact index.

Documents lie in blocks of at most ``BLOCK``, in order of their ids, and a document's
place in its block is its bit.  For each block and term the index has the places of the
documents with the term and, for each bit of their impacts (what the term adds to a
document's score), a bitmap over these documents.  A query's scores are the sum of its
terms' bitmaps, made by bitwise carry arithmetic over whole words of bits: never a loop
over documents.  The best documents are found from the highest bitmap of the sum down:
at each, the candidates that have the bit either fill the places that are left (the
others go) or are all taken.  What is left at the last bitmap are ties, of which those
of the least ids are taken.

Statistics, ``N``, ``L`` and the terms' document counts, come from all documents.  Each
block yields a query's best ``k``; Spark merges these.  Texts are read once and never
shuffled; what is shuffled are index rows, by block.  If the queries have
few terms (``MAX_TERMS``) only those are indexed; else every term is.  Queries are answered in
groups of about ``QUERY_BYTES`` of text, each of which passes over the index once.

Score of a document: the sum over the query's terms, once each, of
``w * ((1000000000 * tf) div (1000 * tf + 8 * m))`` with
``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and ``m = 10 + (90 * n * N) div L``.

Defined results: null and empty texts have no terms and are never found; only scores
above 0 count; equal scores go by ascending id, null last; repeated rows are documents
of their own; a query with no terms, or none that a document has, gives no rows, and a
repeated query is answered again; empty tables give an empty result; very long texts
count whole; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import arrow, scratch, skew

#: Documents of a block, at most 65,536 as places have 16 bits.
BLOCK = 4096
#: Entries (a term of a document) after which a block ends.
BLOCK_ENTRIES = 2_000_000
#: Terms, and their bytes, that are sent to every task; of more, all terms are indexed and joined.
MAX_TERMS = 100_000
MAX_TERM_BYTES = 8 << 20
QUERY_BYTES = 2 << 20
#: Maximal runs of ASCII letters, digits and all that is not ASCII, over UTF-8.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

_ENTRIES = "block long, term binary, docs array<long>, lengths array<long>, places binary, tfs binary, sizes binary, df long"
_INDEX = "block long, term binary, docs array<long>, places binary, n_bits int, bits binary"


def terms_of(text: bytes) -> list[bytes]:
    return TERM.findall(text.lower())  # bytes.lower changes A to Z only


def _entries(docs: DataFrame, wanted: frozenset[bytes] | None) -> DataFrame:
    """For each block a row of its documents (term null), and a row for each of its terms.

    docs, lengths: ids and numbers of terms, by place.  places, tfs, sizes: of the
    documents with the term, their place, occurrences and number of terms.
    """
    from pyspark import TaskContext
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    types = to_arrow_schema(StructType.fromDDL(_ENTRIES))

    def block(number: int, ids: list, counts: list[tuple[int, dict]]) -> pa.RecordBatch:
        order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0))
        sizes = np.array([counts[k][0] for k in order], dtype=np.int64)
        places: dict[bytes, list[int]] = {}
        tfs: dict[bytes, list[int]] = {}
        for place, k in enumerate(order):
            for term, tf in counts[k][1].items():
                places.setdefault(term, []).append(place)
                tfs.setdefault(term, []).append(tf)
        own = {t: np.array(p, dtype=np.uint16) for t, p in places.items()}
        cols = {
            "block": [number] * (len(own) + 1),
            "term": [None, *own],
            "docs": [[ids[k] for k in order], *[None] * len(own)],
            "lengths": [sizes.tolist(), *[None] * len(own)],
            "places": [None, *[p.tobytes() for p in own.values()]],
            "tfs": [None, *[np.array(tfs[t], dtype=np.uint32).tobytes() for t in own]],
            "sizes": [None, *[sizes[p].astype(np.uint32).tobytes() for p in own.values()]],
            "df": [0, *[len(p) for p in own.values()]],
        }
        return pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) for f in types], schema=types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list = []
        counts: list[tuple[int, dict]] = []
        held = 0
        for batch in batches:
            for part in arrow.sliced(batch):
                for d, text in zip(part.column("doc_id").to_pylist(), arrow.texts(part.column("text")), strict=True):
                    found = terms_of(text)
                    by = Counter(found)
                    if wanted is not None:
                        by = {t: n for t, n in by.items() if t in wanted}
                    ids.append(d)
                    counts.append((len(found), by))
                    held += len(by)
                    if len(ids) == BLOCK or held >= BLOCK_ENTRIES:
                        yield block(number, ids, counts)
                        number, ids, counts, held = number + 1, [], [], 0
        if ids:
            yield block(number, ids, counts)
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, _ENTRIES)


def few(terms: DataFrame, column: str) -> bool:
    """Whether a table of distinct terms is small enough to be sent to every task."""
    n, size = terms.agg(F.count(F.lit(1)), F.sum(F.octet_length(column))).first()
    return n <= MAX_TERMS and (size or 0) <= MAX_TERM_BYTES


def weight(n_docs: int, df) -> F.Column:
    """The weight of a term that ``df`` documents hold."""
    return F.floor(1000 * F.log((F.lit(2 * n_docs + 2).cast("double")) / (2 * df + 1).cast("double"))).cast("long")


def sliced_bits(values: np.ndarray) -> tuple[int, bytes]:
    """The number of bitmaps of ``values`` (from the lowest bit) and the bitmaps."""
    n = int(values.max(initial=0)).bit_length()
    bits = (values[None, :] >> np.arange(n, dtype=np.int64)[:, None]) & 1
    return n, np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").tobytes()


def build_index(docs: DataFrame, terms: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of ``docs``, as a table on disk; of ``terms`` (term: binary; a ``few``) or of all terms."""
    wanted = None if terms is None else frozenset(bytes(r["term"]) for r in terms.collect())
    entries = scratch.materialise(_entries(docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text")), wanted), "impact-entries")
    lengths = F.filter("lengths", lambda n: n > 0)
    sums = entries.filter("term IS NULL").agg(F.sum(F.size(lengths)), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n))).first()
    n_docs, n_terms = int(sums[0] or 0), int(sums[1] or 0)
    of_docs = entries.filter("term IS NULL").select("block", "term", "docs", "places", F.lit(0).alias("n_bits"), F.lit(None).cast("binary").alias("bits"))
    own = entries.filter("term IS NOT NULL")
    weights = own.groupBy("term").agg(F.sum("df").alias("df")).select(F.col("term").alias("of"), weight(n_docs, F.col("df")).alias("w"))
    weights = scratch.materialise(weights, "impact-weights")
    weighed = own.join(F.broadcast(weights) if few(weights, "of") else weights, F.col("term") == F.col("of"))

    def impacts(batch: pa.RecordBatch) -> dict:
        n_bits, bits = [], []
        for w, tf, size in zip(*(batch.column(c).to_pylist() for c in ("w", "tfs", "sizes")), strict=True):
            tf, size = np.frombuffer(tf, dtype=np.uint32).astype(np.int64), np.frombuffer(size, dtype=np.uint32)
            if 90 * n_docs * int(size.max()) < 1 << 63:
                m = 10 + 90 * size.astype(np.int64) * n_docs // n_terms
            else:
                m = np.array([10 + 90 * int(s) * n_docs // n_terms for s in size])
            n, packed = sliced_bits(w * (1_000_000_000 * tf // (1000 * tf + 8 * m)))
            n_bits.append(n)
            bits.append(packed)
        return {"block": batch.column("block"), "term": batch.column("term"), "docs": [None] * len(bits), "places": batch.column("places"), "n_bits": n_bits, "bits": bits}

    rows = arrow.mapped(weighed.select("block", "term", "places", "tfs", "sizes", "w"), impacts, _INDEX)
    return scratch.materialise(rows.unionByName(of_docs), "impact-index")


def spread(places: np.ndarray, n_bits: int, bits: bytes, words: int, width: int) -> np.ndarray:
    """Bitmaps over the documents with a term as ``width`` bitmaps over all places of the block."""
    out = np.zeros((width, words), dtype=np.uint64)
    if n_bits:
        own = np.unpackbits(np.frombuffer(bits, dtype=np.uint8).reshape(n_bits, -1), axis=1, count=len(places), bitorder="little")
        if len(places) < 48:
            at, shift = places >> 6, (places & 63).astype(np.uint64)
            for k in range(len(places)):
                out[:n_bits, at[k]] |= own[:, k].astype(np.uint64) << shift[k]
        else:
            every = np.zeros((n_bits, words * 64), dtype=np.uint8)
            every[:, places] = own
            out[:n_bits] = np.packbits(every, axis=1, bitorder="little").view(np.uint64)
    return out


def added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of pairs of numbers that are given as bitmaps (pair, bit, word), with one bit more."""
    n, width, words = a.shape
    out = np.empty((n, width + 1, words), dtype=np.uint64)
    carry = np.zeros((n, words), dtype=np.uint64)
    for k in range(width):
        x, y = a[:, k], b[:, k]
        half = x ^ y
        out[:, k] = half ^ carry
        carry = (x & y) | (half & carry)
    out[:, width] = carry
    return out


def summed(parts: np.ndarray) -> np.ndarray:
    """The sum of ``parts`` (number, bit, word) as bitmaps (bit, word), pair by pair."""
    while len(parts) > 1:
        if len(parts) % 2:
            parts = np.concatenate([parts, np.zeros((1, *parts.shape[1:]), dtype=np.uint64)])
        parts = added(parts[0::2], parts[1::2])
    return parts[0]


def best(total: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(place, number) of the ``k`` largest numbers above 0 of bitmaps (bit, word), of ties those of the least places."""
    some = np.bitwise_or.reduce(total, axis=0)
    taken, left = np.zeros_like(some), some
    if int(np.bitwise_count(some).sum()) > k:
        for level in total[::-1]:
            with_bit = left & level
            n = int(np.bitwise_count(taken | with_bit).sum())
            if n > k:
                left = with_bit
            else:
                taken, left = taken | with_bit, left & ~level
                if n == k:
                    left = np.zeros_like(left)
                    break
    ties = np.flatnonzero(np.unpackbits(left.view(np.uint8), bitorder="little"))
    sure = np.flatnonzero(np.unpackbits(taken.view(np.uint8), bitorder="little"))
    places = np.concatenate([sure, ties[: k - len(sure)]])
    values = np.zeros(len(places), dtype=np.int64)
    for bit, level in enumerate(total):
        values |= ((level[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << bit
    return list(zip(places.tolist(), values.tolist(), strict=True))


def _answers(index: DataFrame, asked: list[tuple[int, list[bytes]]], k: int) -> DataFrame:
    """query, doc_id, score: the best ``k`` of each block for each of ``asked`` (a bounded group of queries)."""

    def of(cols: dict, ranges: list[tuple[int, int]]) -> dict:
        out: dict[str, list] = {"query": [], "doc_id": [], "score": []}
        for a, b in ranges:
            part = {c: v.slice(a, b - a).to_pylist() for c, v in cols.items()}
            ids = next(d for d in part["docs"] if d is not None)
            words, width = -(-len(ids) // 64), max([1, *part["n_bits"]])
            maps = {}
            for term, places, n, bits in zip(part["term"], part["places"], part["n_bits"], part["bits"], strict=True):
                if n:
                    maps[term] = (np.frombuffer(places, dtype=np.uint16).astype(np.int64), n, bits)
            cache = {t: spread(*x, words, width) for t, x in maps.items()}
            for query, terms in asked:
                found = [cache[t] for t in terms if t in cache]
                if found:
                    for place, value in best(summed(np.stack(found)), k):
                        out["query"].append(query)
                        out["doc_id"].append(ids[place])
                        out["score"].append(value)
        return out

    return arrow.grouped(index, ["block"], of, "query long, doc_id long, score long")


def queries_of(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """query (a number of its own), item_id and distinct terms of each item, as a table on disk."""

    def of(batch: pa.RecordBatch) -> dict:
        return {"query": batch.column("query"), "item_id": batch.column("item_id"), "terms": [sorted(set(terms_of(t))) for t in arrow.texts(batch.column("text"))]}

    rows = items.select(F.monotonically_increasing_id().alias("query"), items[item_id].cast("long").alias("item_id"), items[text].alias("text"))
    return scratch.materialise(arrow.mapped(rows, of, "query long, item_id long, terms array<binary>"), "impact-queries")


def search(index: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``k`` best documents of each of ``queries``."""
    total = queries.agg(F.sum(F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t)))).first()[0] or 0
    groups = -(-total // QUERY_BYTES) or 1
    found = None
    for group in range(groups):
        own = queries.filter(F.pmod(F.xxhash64("query"), F.lit(groups)) == group)
        asked = [(r["query"], [bytes(t) for t in r["terms"]]) for r in own.collect()]
        terms = index.sparkSession.createDataFrame([(t,) for t in sorted({t for _, ts in asked for t in ts})], "of binary")
        # A bounded group of queries, so a bounded table of terms.
        rows = index.join(F.broadcast(terms), F.col("term") == F.col("of"), "left_semi").unionByName(index.filter("term IS NULL"))
        part = _answers(rows, asked, k)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = skew.small(queries.select(F.col("query").alias("of"), "item_id"))
    return top.join(names, F.col("query") == F.col("of")).select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best of ``docs`` for each of ``items``."""
    queries = queries_of(items)
    terms = scratch.materialise(queries.select(F.explode("terms").alias("term")).distinct(), "impact-terms")
    return search(build_index(docs, terms if few(terms, "term") else None), queries, k)
