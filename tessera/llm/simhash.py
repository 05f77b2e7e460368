"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints that differ in at most ``RADIUS`` bits are linked.  The 64 bits are
grouped into partitions so that correlated bits lie together.  If the thresholds t
of m partitions add up to ``RADIUS - m + 1``, any two linked fingerprints are
within t of each other in some partition.  Dynamic programming picks m and unequal
thresholds (-1 skips a partition) that minimise the estimated number of candidate
pairs and of keys; the estimate follows a Markov chain over the bits of each
partition, from counts of bits and pairs of bits over all fingerprints.

Only distinct fingerprints are probed.  A key is a mask of bits and the
fingerprint's bits under it (a partition with threshold t gives a key for each t
of its bits left out), so members of a bucket agree on all masked bits.  A bucket of more
than ``BUCKET`` fingerprints is not compared; its members must still differ outside
the mask, so it is split by longer masks by the same principle.  Masks grow
until a bucket cannot be larger, so this ends and misses nothing.  A bucket gives the
edges of a star for each of its components and never all its pairs.

Defined results: a null or empty text has fingerprint zero, linked like any other;
fewer words than ``SHINGLE`` are one shingle; very long texts are taken whole;
repeated rows share a fingerprint; a null id is ignored as a representative while
another id is there; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import arrow, scratch, skew
from .components import components
from .exact_dedup import RepeatFilter
from .words import Words, hashes, mixed, slices

RADIUS = 2
SHINGLE = 3
SEED = 42
BUCKET = 256
BITS = 64
FULL = (1 << BITS) - 1
#: Cost of a key against that of a compared pair.
KEY_COST = 20.0

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words between ``[\\x20\\x09-\\x0D]``, with A-Z in lower case."""
    return text.translate(_LOWER).split()  # bytes.split cuts at these six only


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = words_of(text)
    if not words:
        return 0
    parts = [b" ".join(words)] if len(words) <= shingle else map(b" ".join, zip(*[words[k:] for k in range(shingle)], strict=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, itertools.repeat(SEED)), dtype="<u8")
    ones = sum(np.unpackbits(hashes[a : a + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64) for a in range(0, len(hashes), 65_536))
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of each row."""

    def of(batch: pa.RecordBatch) -> dict:
        found = np.array([fingerprint(t, shingle) for t in arrow.texts(batch.column(1))], dtype=np.uint64)
        return {"doc_id": batch.column(0), "fp": found.view(np.int64)}

    return arrow.mapped(docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text")), of, "doc_id long, fp long")


def bit_counts(fps: DataFrame) -> np.ndarray:
    """How often each two bits (and each bit, on the diagonal) are both set, over all rows."""

    def count(batch: pa.RecordBatch) -> dict:
        bits = np.unpackbits(batch.column(0).to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
        both = (bits.T @ bits).astype(np.int64)
        i, j = np.triu_indices(BITS)
        return {"i": i.astype(np.int32), "j": j.astype(np.int32), "n": both[i, j]}

    rows = arrow.mapped(fps.select("fp"), count, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()  # at most 2,080 rows
    table = np.zeros((BITS, BITS))
    for r in rows:
        table[r["i"], r["j"]] = table[r["j"], r["i"]] = r["n"]
    return table


def partitions(counts: np.ndarray, rows: int, m: int) -> list[list[int]]:
    """The bits in m parts of about equal width; each part draws the bits most correlated with it."""
    p = np.diag(counts) / rows
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs(counts / rows - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    left, parts = set(range(BITS)), []
    for k in range(m):
        width = (BITS - sum(map(len, parts))) // (m - k)
        part = [max(left, key=lambda b: (corr[b, list(left)].sum(), -b))]
        left.remove(part[0])
        while len(part) < width:
            part.append(max(left, key=lambda b: (corr[b, part].mean(), -b)))
            left.remove(part[-1])
        parts.append(part)
    return parts


def near_share(counts: np.ndarray, rows: int, part: list[int], most: int) -> list[float]:
    """The estimated share of pairs that differ in at most 0, 1, ... ``most`` bits of ``part``.

    A chain over the bits: whether two random rows agree on a bit depends on
    whether they agree on the bit before it.
    """
    c, n = counts, float(rows)

    def joint(i: int, j: int) -> np.ndarray:
        p11, p1, q1 = c[i, j] / n, c[i, i] / n, c[j, j] / n
        p = np.array([[1 - p1 - q1 + p11, q1 - p11], [p1 - p11, p11]]).clip(0)
        out = np.zeros((2, 2))  # [differ on i][differ on j]
        for a, b, d, e in itertools.product((0, 1), repeat=4):
            out[int(a != d), int(b != e)] += p[a, b] * p[d, e]
        return out

    p = c[part[0], part[0]] / n
    state = np.zeros((most + 2, 2))  # [bits that differ so far][whether the last bit differs]
    state[0, 0], state[1, 1] = p * p + (1 - p) ** 2, 2 * p * (1 - p)
    for i, j in itertools.pairwise(part):
        t = joint(i, j)
        t = t / np.maximum(t.sum(axis=1, keepdims=True), 1e-12)
        new = np.zeros_like(state)
        new[:, 0] = state @ t[:, 0]
        new[1:, 1] = (state @ t[:, 1])[:-1]
        new[-1] = 0  # too many
        state = new
    return np.cumsum(state.sum(axis=1))[: most + 1].tolist()


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds, one a part, that add up to ``total`` at the least cost; costs[part][t + 1] for t from -1."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for so_far, (price, chosen) in best.items():
            for k, c in enumerate(cost):
                at = so_far + k - 1
                if at not in new or price + c < new[at][0]:
                    new[at] = (price + c, [*chosen, k - 1])
        best = new
    return best[total]


def mask_of(bits) -> int:
    return reduce(lambda m, b: m | (1 << b), bits, 0)


def masks(counts: np.ndarray, rows: int, radius: int = RADIUS, key_cost: float = KEY_COST, most: int = 5) -> list[int]:
    """The masks of the keys: of the cheapest number (2 to ``most``) of partitions and their thresholds."""
    choices = []
    for m in range(2, most + 1):
        parts, costs = partitions(counts, rows, m), []
        for part in parts:
            share = near_share(counts, rows, part, radius)
            costs.append([0.0] + [rows * rows / 2 * share[t] + key_cost * rows * math.comb(len(part), t) for t in range(min(radius, len(part)) + 1)])
        price, chosen = allocate(costs, radius - m + 1)
        choices.append((price, m, parts, chosen))
    _, _, parts, chosen = min(choices, key=lambda c: c[:2])
    return [mask_of(set(part) - set(out)) for part, t in zip(parts, chosen, strict=True) if t >= 0 for out in itertools.combinations(part, t)]


def refined(mask: int, radius: int = RADIUS) -> list[int]:
    """Longer masks: those that agree under ``mask`` and are linked agree under one of these."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | mask_of(free[k :: radius + 1]) for k in range(radius + 1)]


def star(values: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each value to the first of its component within a bucket; none for single values."""
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
    label = np.arange(len(values))
    while True:
        new = np.where(near, label[None, :], len(values)).min(axis=1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = np.flatnonzero(label != np.arange(len(values)))
    return values[own], values[label[own]]


def _stars(radius: int):
    def stars(batch: pa.RecordBatch) -> dict:
        lists = batch.column(0)
        flat, at = lists.flatten().to_numpy().view(np.uint64), np.cumsum([0, *[len(x) for x in lists]])
        found = [star(flat[a:b], radius) for a, b in itertools.pairwise(at)]
        return {k: np.concatenate([f[i] for f in found]).view(np.int64) for i, k in enumerate("ab")}

    return stars


def links(fps: DataFrame, rows: int, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """a, b: edges that connect distinct fingerprints ``fps`` (a table on disk) within ``radius``."""
    spark = fps.sparkSession
    current = masks(bit_counts(fps), rows, radius)
    keyed = fps.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in current])).alias("mask"))
    edges = []
    while current:
        keyed = scratch.materialise(keyed.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value")), "simhash-keys")
        large = scratch.materialise(keyed.groupBy("mask", "value").count().filter(F.col("count") > bucket), "simhash-large")
        again = {r["mask"] & FULL for r in large.select("mask").distinct().collect()}  # at most one row a mask
        large = skew.small(large.drop("count"))
        fine = keyed.join(large, ["mask", "value"], "left_anti") if again else keyed
        lists = fine.groupBy("mask", "value").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1).select("fps")
        edges.append(scratch.materialise(arrow.mapped(lists, _stars(radius), "a long, b long"), "simhash-edges"))
        deeper = {m: refined(m, radius) for m in sorted(again)}
        if deeper:
            longer = F.create_map(*[x for m, ms in deeper.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(k)) for k in ms]))])
            keyed = keyed.join(large, ["mask", "value"], "left_semi").select("fp", F.explode(longer[F.col("mask")]).alias("mask"))
        current = sorted({k for ms in deeper.values() for k in ms})
    return reduce(DataFrame.unionByName, edges) if edges else spark.createDataFrame([], "a long, b long")


def group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id that links reach) for each row."""
    prints = scratch.materialise(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    fps = scratch.materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "distinct-fingerprints")
    rows = fps.count()
    classes = fps.select("fp", "n", F.col("first").alias("component_id"))
    if rows > 1:
        labels = components(links(fps, rows, radius))
        members = scratch.materialise(labels.join(fps, labels["node"] == fps["fp"]).select("fp", "label", "first"), "simhash-members")
        least = scratch.materialise(members.groupBy("label").agg(F.min("first").alias("component_id")), "simhash-components")
        linked = scratch.materialise(members.join(least, "label").select("fp", F.col("component_id").alias("linked_id")), "simhash-linked")
        classes = scratch.materialise(fps.join(linked, "fp", "left").select("fp", "n", F.coalesce("linked_id", "first").alias("component_id")), "simhash-classes")
    return skew.join_by_group(prints, classes, ["fp"], "n", prints.count()).select("doc_id", "fp", "component_id")


#: Texts alike by ``NEAR_SIMILARITY`` of their five-word shingles are probed within this many bits of
#: their words' fingerprints; links further apart are found by prefixes, so results do not depend on it.
NEAR_RADIUS = 7
NEAR_SHINGLE = 5
NEAR_SIMILARITY = 0.8
#: Cost of a key against that of a compared pair where members are compared as whole arrays.
NEAR_KEY_COST = 500.0
#: A bucket of more nodes than this is compared block by block.
BLOCK = 1024
#: A cell with more than so many pairs a node gives stars instead of pairs.
DENSE = 2
#: Cells of the histogram of a shingle set that bounds what two sets can share.
CELLS = 64
#: Sets of more than this many shingles also have a histogram of ``FINE`` cells, a byte each.
LONG = 1000
FINE = 2048
#: A pair that shares several keys is compared under the first of the ``FIRST_KEYS`` least of each node that both have.
FIRST_KEYS = 16
#: Bits of the filter of repeated keys for each key.
KEY_BITS = 8
#: A shingle is common if more texts than this, and than a thousandth of all, hold it among their ``LOW`` least.
COMMON = 256
LOW = 16


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """The sorted distinct hashes of the word shingles (fewer words: of the whole sequence)."""
    parts = [b" ".join(words)] if len(words) <= size else map(b" ".join, zip(*[words[k:] for k in range(size)], strict=False))
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, parts), dtype="<u8"))


def word_sets(texts: list[bytes], size: int):
    """For each text its distinct word hashes and its distinct shingle hashes, sorted; of whole arrays of texts at a time."""
    for a, b in slices(texts):
        words = Words(texts[a:b], lower=True)
        h = hashes(words.data, words.starts, words.ends)
        run = h
        for k in range(1, size):
            run = mixed(run, np.append(h[k:], np.zeros(min(k, len(h)), np.uint64))[: len(h)])
        for lo, hi in itertools.pairwise(words.first):
            own = h[lo:hi]
            shingles = np.unique(run[lo : hi - size + 1]) if hi - lo >= size else np.array([xxhash.xxh3_64_intdigest(own.tobytes(), len(own))], dtype=np.uint64)
            yield np.unique(own), shingles


def words_fingerprint(words: np.ndarray) -> int:
    """SimHash of a set of word hashes."""
    if not len(words):
        return 0
    bits = np.unpackbits(mixed(words, words).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(words), bitorder="little").view("<u8")[0])


def histogram(shingles: np.ndarray) -> np.ndarray:
    """How many shingles lie in each cell; two sets share at most the sum of the lesser counts."""
    return np.bincount((shingles & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS).astype("<u4")


def fine_histogram(shingles: np.ndarray) -> bytes | None:
    """The same of a long set over more cells; none where a byte cannot hold a count."""
    if len(shingles) <= LONG:
        return None
    counts = np.bincount((shingles & np.uint64(FINE - 1)).astype(np.int64), minlength=FINE)
    return counts.astype(np.uint8).tobytes() if counts.max() <= 255 else None


def prefix(shingles: np.ndarray, common: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles in an order that all sets share (by hash, ``common`` ones last): of two sets
    alike by ``similarity`` each prefix holds one of the other's, else too few would be left to share."""
    keep = len(shingles) - math.ceil(similarity * len(shingles) - 1e-9) + 1
    late = np.isin(shingles, common)
    return np.concatenate([shingles[~late], shingles[late]])[:keep]


def probed(codes: np.ndarray, sizes: np.ndarray, own: np.ndarray, earlier: np.ndarray, radius: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs to verify (positions) among the members of one cell.

    They lie within ``radius``, are of sizes that allow the similarity, and did not
    meet under an ``earlier`` mask.  Where these are many, stars that cover the
    members stand for them.
    """
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= radius
    near &= np.minimum(sizes[:, None], sizes[None, :]) >= similarity * np.maximum(sizes[:, None], sizes[None, :])
    if own.max() != own.min():  # blocks of one bucket: their own pairs are in other cells
        near &= own[:, None] != own[None, :]
    np.fill_diagonal(near, False)
    i, j = np.nonzero(np.triu(near))
    if len(i):
        first = np.ones(len(i), dtype=bool)
        differ = codes[i] ^ codes[j]
        for mask in earlier:
            first &= (differ & mask) != 0
        i, j = i[first], j[first]
    if len(i) <= DENSE * len(codes):
        return i, j
    left, right, todo, degree = [], [], np.ones(len(codes), dtype=bool), near.sum(axis=1)
    while degree.max() > DENSE:
        hub = int(degree.argmax())
        reached = near[hub] & todo
        left.append(np.full(int(reached.sum()), hub))
        right.append(np.flatnonzero(reached))
        todo[reached] = False
        degree = degree - near[:, reached].sum(axis=1)
    i, j = np.nonzero(np.triu(near & todo[:, None] & todo[None, :]))
    return np.concatenate([*left, i]), np.concatenate([*right, j])


def bucket_pairs(key: int, nodes: np.ndarray, labels: np.ndarray, own: np.ndarray, least: np.ndarray, cells: np.ndarray, fine: list[bytes | None], similarity: float) -> np.ndarray:
    """Pairs of a cell with different labels, without those that cannot be alike by ``similarity``
    and those that share a lesser one of their ``least`` keys: they are compared there."""
    sizes, found = cells.sum(axis=1, dtype=np.int64), []
    lesser = [x[x < key] for x in least]
    apart = own.max() != own.min()
    for k in range(len(nodes) - 1):
        ok = (labels[k + 1 :] != labels[k]) & (np.minimum(sizes[k + 1 :], sizes[k]) >= similarity * np.maximum(sizes[k + 1 :], sizes[k]))
        if apart:
            ok &= own[k + 1 :] != own[k]
        rest = k + 1 + np.flatnonzero(ok)
        if len(rest) and len(lesser[k]):
            rest = rest[~np.isin(least[rest], lesser[k]).any(axis=1)]
        if len(rest):
            share = np.minimum(cells[rest], cells[k]).sum(axis=1, dtype=np.int64)
            rest = rest[share >= similarity * (sizes[rest] + sizes[k] - share)]
            if fine[k] is not None and len(rest):
                mine = np.frombuffer(fine[k], np.uint8)
                share = np.array([sizes[k] if fine[j] is None else np.minimum(mine, np.frombuffer(fine[j], np.uint8)).sum(dtype=np.int64) for j in rest])
                rest = rest[share >= similarity * (sizes[rest] + sizes[k] - share)]
            found.append(np.stack([np.minimum(nodes[rest], nodes[k]), np.maximum(nodes[rest], nodes[k])], axis=1))
    return np.concatenate(found) if found else np.empty((0, 2), dtype=np.int64)


def in_blocks(rows: DataFrame, count: str, block: int = BLOCK) -> DataFrame:
    """``rows`` with own (the block of a node in its bucket of ``count`` rows) and cell (a pair of blocks), once a cell."""
    blocks = F.ceil(F.col(count) / block).cast("long")
    own = F.pmod(F.xxhash64("node", F.lit(5)), blocks)
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return rows.withColumn("cell", F.least("own", "other") * (1 << 31) + F.greatest("own", "other")).drop("other", count)


class NearTexts:
    """Classes and links of the rows of one table.

    Rows with equal shingle sets are one node (its least row).  Pairs are found twice:

    1. *SimHash.*  Fingerprints of the words within ``NEAR_RADIUS`` bits meet under a
       mask of the generalised pigeonhole principle and are verified by their shingles.
       A cell of many pairs gives stars instead.
    2. *What fingerprints cannot promise.*  Two texts alike by the similarity share a
       shingle of their prefixes.  Nodes that do and are not linked yet are compared, so no link
       is lost to a fingerprint's chance or to a star.
    """

    def __init__(self, docs: DataFrame, doc_id: str, text: str, shingle: int, similarity: float):
        self.size, self.similarity = shingle, similarity

        def sign(batch: pa.RecordBatch) -> dict:
            rows = [(xxhash.xxh3_128_digest(x.tobytes()), words_fingerprint(w), len(x), x[:LOW].view(np.int64)) for w, x in word_sets(arrow.texts(batch.column("text")), shingle)]
            sig, fp, n, low = zip(*rows, strict=True)
            out = {k: batch.column(k) for k in ("row", "id", "text", "data")}
            return out | {"sig": list(sig), "fp": np.array(fp, dtype=np.uint64).view(np.int64), "size": list(n), "low": pa.array(low, pa.list_(pa.int64()))}

        cols = docs.select(F.monotonically_increasing_id().alias("row"), docs[doc_id].cast("long").alias("id"), docs[text].alias("text"), F.struct("*").dropFields(f"`{text}`").alias("data"))
        kind = StructType([*cols.schema.fields, *StructType.fromDDL("sig binary, fp long, size long, low array<long>").fields])
        self.signed = scratch.materialise(arrow.mapped(cols, sign, kind), "near-signed")
        best = F.struct(F.col("id").isNull().alias("nil"), "id", "row")
        nodes = self.signed.groupBy("sig").agg(F.min("row").alias("node"), F.min(best).alias("best"), F.count(F.lit(1)).alias("n"), F.any_value("fp").alias("fp"), F.any_value("size").alias("size"))
        self.nodes = scratch.materialise(nodes, "near-nodes")
        self.count = self.nodes.count()
        copies = self.signed.select("row", "sig").join(self.nodes.filter("n > 1").select("sig", "node"), "sig").filter("row <> node").select("row")
        self.copies = skew.small(scratch.materialise(copies, "near-copies"), skew.NARROW_ROWS)

    def of_nodes(self, nodes: DataFrame, of, columns: str) -> DataFrame:
        """node and the ``columns`` that ``of`` makes of the shingle sets of ``nodes``."""
        size, label = self.size, columns.split()[0]

        def made(batch: pa.RecordBatch) -> dict:
            return {"node": batch.column(0)} | of([x for _, x in word_sets(arrow.texts(batch.column(1)), size)])

        wanted = skew.small(scratch.materialise(nodes.select("node").distinct(), "near-wanted"), skew.NARROW_ROWS)
        texts = self.signed.select(F.col("row").alias("node"), "text").join(wanted, "node", "left_semi")
        return scratch.materialise(arrow.mapped(texts, made, f"node long, {columns}"), f"near-{label}")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """a, b: those of the ``pairs`` (a table on disk) that are alike."""
        similarity = self.similarity
        sets = self.of_nodes(pairs.select(F.explode(F.array("a", "b")).alias("node")), lambda found: {"set": pa.array([x.tobytes() for x in found], pa.binary())}, "set binary")

        def verify(batch: pa.RecordBatch) -> dict:
            keep = []
            for k, (x, y) in enumerate(zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True)):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                if min(len(x), len(y)) >= similarity * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if both >= similarity * (len(x) + len(y) - both):
                        keep.append(k)
            at = pa.array(keep, pa.int64())
            return {k: batch.column(k).take(at) for k in "ab"}

        left, right = (sets.select(F.col("node").alias(k), F.col("set").alias(f"set_{k}")) for k in "ab")
        full = pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
        return scratch.materialise(arrow.mapped(full, verify, "a long, b long"), "near-links")

    def by_fingerprint(self) -> DataFrame:
        """a, b: links found by SimHash."""
        current = masks(bit_counts(self.nodes), self.count, NEAR_RADIUS, NEAR_KEY_COST, NEAR_RADIUS)
        keys = self.nodes.select("node", "fp", "size", F.posexplode(F.array(*[F.lit(_signed(m)) for m in current])).alias("t", "mask"))
        keys = keys.select("t", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "node", "fp", "size")
        large = scratch.materialise(keys.groupBy("t", "value").agg(F.count(F.lit(1)).alias("many")).filter(F.col("many") > BLOCK), "near-large")
        if large.isEmpty():
            dealt = keys.withColumn("own", F.lit(0).cast("long")).withColumn("cell", F.lit(0).cast("long"))
        else:
            counted = keys.join(skew.small(large, skew.NARROW_ROWS), ["t", "value"], "left")
            dealt = in_blocks(counted.withColumn("many", F.coalesce("many", F.lit(1))), "many")
        all_masks, similarity = np.array(current, dtype=np.uint64), self.similarity

        def pairs(cols: dict[str, pa.Array], groups: list[tuple[int, int]]) -> dict:
            t, node, code, size, own = (cols[k].to_numpy() for k in ("t", "node", "fp", "size", "own"))
            code, found = code.view(np.uint64), [np.empty((0, 2), dtype=np.int64)]
            for a, b in groups:
                if b - a > 1:
                    i, j = probed(code[a:b], size[a:b], own[a:b], all_masks[: t[a]], NEAR_RADIUS, similarity)
                    if len(i):
                        found.append(np.sort(node[a:b][np.stack([i, j], axis=1)], axis=1))
            both = np.unique(np.concatenate(found), axis=0)
            return {"a": both[:, 0], "b": both[:, 1]}

        found = scratch.materialise(arrow.grouped(dealt, ["t", "value", "cell"], pairs, "a long, b long").distinct(), "near-probed")
        return self.verified(found)

    def by_prefix(self, labels: DataFrame) -> DataFrame:
        """a, b: links between nodes of different ``labels`` (node, label; others are their own), out of all that share a shingle of their prefixes."""
        size, similarity = self.size, self.similarity
        # Any choice of common shingles is right; a good one keeps buckets small.
        texts = self.signed.join(self.copies, "row", "left_anti")
        seen = texts.select(F.explode("low").alias("key")).groupBy("key").count()
        common = np.array([r["key"] for r in seen.filter(F.col("count") > max(COMMON, self.count // 1000)).collect()], dtype=np.int64).view(np.uint64)  # at most 1,000 LOW rows

        def keys(batch: pa.RecordBatch) -> dict:
            found = [prefix(x, common, similarity) for _, x in word_sets(arrow.texts(batch.column(1)), size)]
            many = [len(x) for x in found]
            return {"key": np.concatenate(found).view(np.int64), "node": np.repeat(batch.column(0).to_numpy(), many), "size": np.repeat(batch.column(2).to_numpy(), many)}

        rows = scratch.materialise(arrow.mapped(texts.select("row", "text", "size"), keys, "key long, node long, size long"), "near-keys")
        # Most keys occur once, and their rows need not be shuffled.
        again = RepeatFilter(rows, "key", rows.count(), KEY_BITS).test(rows).filter("may_repeat").drop("may_repeat")
        rows = scratch.materialise(again, "near-again")
        shared = scratch.materialise(rows.groupBy("key").agg(F.count(F.lit(1)).alias("many")).filter("many > 1"), "near-shared")
        if shared.count() <= skew.NARROW_ROWS:
            members = rows.join(F.broadcast(shared), "key")
        else:
            members = skew.join_by_group(rows, shared, ["key"], "many", rows.count())
        members = scratch.materialise(members, "near-shared")
        # Of keys with equal members one is enough.
        alike = members.groupBy("key", "many").agg(*[F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"x{k}") for k in (1, 2)])
        buckets = skew.small(scratch.materialise(alike.groupBy("many", "x1", "x2").agg(F.min("key").alias("key")).select("key"), "near-buckets"), skew.NARROW_ROWS)
        members = members.join(buckets, "key", "left_semi")
        members = members.join(skew.small(labels, skew.NARROW_ROWS), "node", "left").select("key", "many", "node", "size", F.coalesce("label", "node").alias("label"))
        members = scratch.materialise(members, "near-members")
        mixed_ = members.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("key")
        members = in_blocks(members.join(skew.small(scratch.materialise(mixed_, "near-mixed"), skew.NARROW_ROWS), "key", "left_semi"), "many")
        # A node with a partner of a size near enough has one next to it in order of size.
        by_size = Window.partitionBy("key", "cell").orderBy("size")
        near = (F.lag("size").over(by_size) >= similarity * F.col("size")) | (F.col("size") >= similarity * F.lead("size").over(by_size))
        members = scratch.materialise(members.withColumn("near", near).filter("near").drop("near", "size"), "near-open")

        def features(found: list[np.ndarray]) -> dict:
            return {"cells": pa.array([histogram(x).tobytes() for x in found], pa.binary()), "fine": pa.array(list(map(fine_histogram, found)), pa.binary())}

        def pairs(cols: dict[str, pa.Array], groups: list[tuple[int, int]]) -> dict:
            key, node, label, own = (cols[k].to_numpy() for k in ("key", "node", "label", "own"))
            cells, fine, found = cols["cells"].to_pylist(), cols["fine"].to_pylist(), [np.empty((0, 2), dtype=np.int64)]
            least = cols["least"].flatten().to_numpy().reshape(-1, FIRST_KEYS)
            for a, b in groups:
                if b - a > 1:
                    found.append(bucket_pairs(key[a], node[a:b], label[a:b], own[a:b], least[a:b], np.frombuffer(b"".join(cells[a:b]), "<u4").reshape(-1, CELLS), fine[a:b], similarity))
            both = np.unique(np.concatenate(found), axis=0)
            return {"a": both[:, 0], "b": both[:, 1]}

        # As many keys as a node's own prefix has at most.
        own = F.array_sort(F.collect_set("key"))
        least = members.groupBy("node").agg(F.slice(F.concat(own, F.array_repeat(F.array_max(own), FIRST_KEYS)), 1, FIRST_KEYS).alias("least"))
        known = self.of_nodes(members, features, "cells binary, fine binary").join(least, "node")
        full = members.join(scratch.materialise(known, "near-features"), "node")
        found = arrow.grouped(full.select("key", "cell", "node", "label", "own", "least", "cells", "fine"), ["key", "cell"], pairs, "a long, b long").distinct()
        return self.verified(scratch.materialise(found, "near-candidates"))

    def classes(self) -> DataFrame:
        """sig, n, best: of each class the row that stays of its component, that of the least id (null ids come last), then the first."""
        if self.count < 2:
            return self.nodes.select("sig", "n", "best")
        links = self.by_fingerprint()
        labels = components(links)
        more = self.by_prefix(labels)
        if not more.isEmpty():
            labels = components(links.unionByName(more))
        linked = scratch.materialise(labels.join(self.nodes, "node").select("sig", "label", "best"), "near-linked")
        least = scratch.materialise(linked.groupBy("label").agg(F.min("best").alias("least")), "near-least")
        known = scratch.materialise(linked.join(least, "label").select("sig", "least"), "near-known")
        return scratch.materialise(self.nodes.join(known, "sig", "left").select("sig", "n", F.coalesce("least", "best").alias("best")), "near-classes")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = NEAR_SHINGLE, similarity: float = NEAR_SIMILARITY) -> DataFrame:
    """doc_id, component_id: documents linked by a similarity of word shingles of at least ``similarity``.

    The links are those of all pairs.  Defined results: null and empty texts are equal;
    ``component_id`` is null only if all ids of a component are; repeated rows are copies
    of each other; very long texts are taken whole; an empty table gives an empty
    result; other columns are ignored.
    """
    near = NearTexts(docs, doc_id, text, shingle, similarity)
    return skew.join_by_group(near.signed.select("id", "sig"), near.classes(), ["sig"], "n", near.signed.count()).select(F.col("id").alias("doc_id"), F.col("best.id").alias("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all columns, reduced to one row of each group of near-duplicates.

    That is the row of the smallest id; a null id comes after all others, and of rows
    with equal ids one stays.  Rows are told apart by place, not by id, so null and
    repeated ids cost no other row.  Null and empty texts are equal, very long ones
    are taken whole, other columns may have any names, and an empty table stays empty.
    """
    near = NearTexts(docs, doc_id, text, NEAR_SHINGLE, NEAR_SIMILARITY)
    rows = skew.join_by_group(near.signed.select("row", "sig"), near.classes(), ["sig"], "n", near.signed.count())
    gone = scratch.materialise(rows.filter("row <> best.row").select("row"), "near-gone")
    kept = near.signed.select("row", "text", "data").join(skew.small(gone, skew.NARROW_ROWS), "row", "left_anti")
    return kept.select(*[F.col("text").alias(c) if c == text else F.col("data").getField(c).alias(c) for c in docs.columns])
