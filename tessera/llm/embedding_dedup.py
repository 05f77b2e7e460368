"""Near-duplicate embeddings: iterative quantisation, multi-index Hamming tables, exact reranking.

A rotation of the leading principal axes that makes signs balanced codes (iterative
quantisation) is fitted on at most ``SAMPLE`` vectors; every vector is coded and
indexed.  The code is cut into m substrings, m so that a substring has about as many
bits as the number of vectors asks for.  Two codes within ``RADIUS`` agree in some substring
up to ``RADIUS // m`` bits, so each vector is stored under its substrings and probes
those next to them.  Members of a bucket whose whole codes are within ``CHECK_RADIUS``
are candidates; these alone fetch their vectors, and cosines in double precision
decide.  Nothing below the threshold is linked; how many of the pairs above it are
found is measured against brute force in the tests (0.97 and more there).

Equal vectors are one class with a weight.  A bucket of more than ``BLOCK`` rows a side
is cut into blocks and compared block by block in tasks of their own; a pair counts in the
first table that finds it, so counts add up.  A task returns, for each of its vectors,
a count and one edge of a star: never its pairs.

Cost: with m substrings a vector has 8 to 361 entries (m is 8 at some hundred rows
and 3 from 3 million rows on, the least), nearly half of them probes, and buckets grow with the
rows from there: of 1e10 vectors a bucket of 21 bits has some 5,000.

Defined results: vectors that are null, empty, zero, or that hold null or non-finite
components link with nothing and are components of their own; vectors of different
lengths do not link, and each length has an index of its own; a repeated row is another vector equal to the first; rows with a null id
link with nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import arrow, scratch, skew
from .components import components

THRESHOLD = 0.95
SAMPLE = 10_000
BITS = 64
RADIUS = 7
CHECK_RADIUS = 14
BLOCK = 1024
#: At least so many tables, which bounds the entries of a vector.
LEAST_TABLES = 3
ROUNDS = 40


def usable(v: Column) -> Column:
    big = float(np.finfo(np.float64).max)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= big))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_itq(sample: np.ndarray, bits: int = BITS, rounds: int = ROUNDS, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The centre, and the projection whose signs are the code, from unit vectors."""
    centre = sample.mean(axis=0)
    x = sample - centre
    _, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, ::-1][:, : min(bits, x.shape[1])]
    v = x @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(axes.shape[1],) * 2))
    for _ in range(rounds):
        code = np.where(v @ turn >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(code.T @ v)
        turn = (left @ right).T
    return centre, axes @ turn


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def encode(x: np.ndarray, centre: np.ndarray, projection: np.ndarray) -> np.ndarray:
    on = (unit(x) - centre) @ projection >= 0
    wide = np.zeros((len(x), BITS), dtype=bool)
    wide[:, : on.shape[1]] = on
    return np.packbits(wide, axis=1, bitorder="little").view("<u8").ravel()


def tables(rows: int, bits: int = BITS, radius: int = RADIUS) -> tuple[list[int], int]:
    """The masks of the substrings and the radius within each."""
    m = min(8, max(LEAST_TABLES, round(bits / max(1.0, math.log2(max(2, rows))))))
    edges = [bits * k // m for k in range(m + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(edges)], radius // m


def _entries(masks: list[int], near: int):
    """Index entries (side 0) and probes (side 1) of each code; of two neighbours the greater probes."""

    def entries(batch: pa.RecordBatch) -> dict:
        code = batch.column("code").to_numpy().view(np.uint64)
        rows, buckets, sides = [], [], []
        for t, mask in enumerate(masks):
            low = (mask & -mask).bit_length() - 1
            width = mask.bit_count()
            sub = (code & np.uint64(mask)) >> np.uint64(low)
            for k in range(near + 1):
                for flips in itertools.combinations(range(width), k):
                    other = sub ^ np.uint64(sum(1 << f for f in flips))
                    own = np.arange(len(code)) if k == 0 else np.flatnonzero(other < sub)
                    rows.append(own)
                    buckets.append((other[own] | np.uint64(t << 56)).view(np.int64))  # a substring has 32 bits at most
                    sides.append(np.full(len(own), min(k, 1), dtype=np.int32))
        at = np.concatenate(rows)
        return {"bucket": np.concatenate(buckets), "side": np.concatenate(sides), "cid": batch.column("cid").take(pa.array(at)), "code": code[at].view(np.int64)}

    return entries


def in_cells(entries: DataFrame, block: int = BLOCK) -> DataFrame:
    """``entries`` (a table on disk) with a column cell: pairs of blocks of large buckets, else 0.

    A cell of kind 0 compares its index entries with each other and with the probes;
    of kind 1 compares its two sides only.
    """
    sizes = entries.groupBy("bucket").agg(F.count_if(F.col("side") == 0).alias("na"), F.count_if(F.col("side") == 1).alias("np"))
    sizes = sizes.select("bucket", F.ceil(F.col("na") / block).cast("int").alias("ga"), F.ceil(F.col("np") / block).cast("int").alias("gp")).filter("ga > 1 or gp > 1")
    large = scratch.materialise(sizes, "itq-large")
    if large.isEmpty():
        return entries.withColumn("cell", F.lit(0).cast("long")).withColumn("kind", F.lit(0))
    marked = entries.join(skew.small(large), "bucket", "left")
    fine = marked.filter("ga is null").drop("ga", "gp").withColumn("cell", F.lit(0).cast("long")).withColumn("kind", F.lit(0))
    own = F.pmod(F.xxhash64("cid", F.lit(5)), F.when(F.col("side") == 0, F.col("ga")).otherwise(F.col("gp"))).cast("int")
    blocks = marked.filter("ga is not null").withColumn("own", own)

    def cell(kind: int, i: Column, j: Column) -> Column:
        return F.lit(1 + kind).cast("long") * (1 << 48) + i.cast("long") * (1 << 24) + j.cast("long")

    def place(kind: int, side: Column, at: Column) -> Column:
        return F.struct(at.alias("cell"), F.lit(kind).alias("kind"), side.cast("int").alias("side"))

    upto = lambda n: F.sequence(F.lit(0), n - 1)
    i = F.col("own")
    within = F.transform(upto(F.col("ga")), lambda j: F.when(i == j, place(0, F.lit(0), cell(0, i, i))).otherwise(place(1, (i > j).cast("int"), cell(0, F.least(i, j), F.greatest(i, j)))))
    index = F.when(F.col("gp") > 0, F.concat(within, F.transform(upto(F.greatest(F.col("gp"), F.lit(1))), lambda j: place(1, F.lit(0), cell(1, i, j))))).otherwise(within)
    probe = F.when(F.col("ga") > 0, F.transform(upto(F.greatest(F.col("ga"), F.lit(1))), lambda j: place(1, F.lit(1), cell(1, j, i))))
    places = blocks.select("bucket", "cid", "code", F.explode(F.when(F.col("side") == 0, index).otherwise(probe)).alias("p"))
    return fine.unionByName(places.select("bucket", "p.side", "cid", "code", "p.cell", "p.kind"))


def _pairs(code: np.ndarray, side: np.ndarray, kind: int, table: int, masks: list[int], near: int) -> np.ndarray:
    """[row of side 0, any row]: whether the two are compared here and are candidates."""
    a = np.flatnonzero(side == 0)
    differ = code[a, None] ^ code[None, :]
    ok = np.bitwise_count(differ) <= CHECK_RADIUS
    if kind == 0:
        ok &= (side == 1)[None, :] | (np.arange(len(code))[None, :] > a[:, None])
    else:
        ok &= (side == 1)[None, :]
    if ok.any():
        for mask in masks[:table]:  # a pair belongs to the first table that finds it
            ok &= np.bitwise_count(differ & np.uint64(mask)) > near
    return ok


def _table_of(bucket: np.ndarray) -> np.ndarray:
    return (bucket.view(np.uint64) >> np.uint64(56)).astype(int)


def _survivors(masks: list[int], near: int):
    def survivors(batch: pa.RecordBatch) -> dict:
        lists = batch.column("rows")
        at = np.cumsum([0, *[len(x) for x in lists]])
        flat = lists.flatten()
        cid, code, side = (flat.field(k).to_numpy() for k in ("cid", "code", "side"))
        code, table, kinds = code.view(np.uint64), _table_of(batch.column("bucket").to_numpy()), batch.column("kind").to_numpy()
        keep, groups = [], []
        for k, (a, b) in enumerate(itertools.pairwise(at)):
            own_side = side[a:b]
            if not (own_side == 0).any():
                continue
            ok = _pairs(code[a:b], own_side, int(kinds[k]), int(table[k]), masks, near)
            if ok.any():
                hit = ok.any(axis=0)
                hit[np.flatnonzero(own_side == 0)] |= ok.any(axis=1)
                keep.append(a + np.flatnonzero(hit))
                groups.append(np.full(int(hit.sum()), k))
        at = np.concatenate(keep) if keep else np.zeros(0, np.int64)
        of = pa.array(np.concatenate(groups) if groups else np.zeros(0, np.int64))
        return {k: batch.column(k).take(of) for k in ("bucket", "cell", "kind")} | {"cid": cid[at], "code": code[at].view(np.int64), "side": side[at]}

    return survivors


def _exact(masks: list[int], near: int, threshold: float):
    def exact(batch: pa.RecordBatch) -> dict:
        lists = batch.column("rows")
        at = np.cumsum([0, *[len(x) for x in lists]])
        flat = lists.flatten()
        cid, code, side, n = (flat.field(k).to_numpy() for k in ("cid", "code", "side", "n"))
        x = unit(matrix(flat.field("embedding"))) if len(flat) else np.zeros((0, 1))
        code, table, kinds = code.view(np.uint64), _table_of(batch.column("bucket").to_numpy()), batch.column("kind").to_numpy()
        out: dict[str, list] = {"cid": [], "links": [], "root": []}
        for k, (a, b) in enumerate(itertools.pairwise(at)):
            own = side[a:b]
            left = np.flatnonzero(own == 0)
            ok = _pairs(code[a:b], own, int(kinds[k]), int(table[k]), masks, near)
            ok &= x[a:b][left] @ x[a:b].T >= threshold
            if not ok.any():
                continue
            links = np.zeros(b - a, dtype=np.int64)
            links[left] += (ok * n[a:b][None, :]).sum(axis=1)
            links += (ok * n[a:b][left][:, None]).sum(axis=0)
            near_by = np.zeros((b - a, b - a), dtype=bool)
            near_by[left] = ok
            near_by |= near_by.T | np.eye(b - a, dtype=bool)
            label = np.arange(b - a)
            while (new := np.where(near_by, label[None, :], b - a).min(axis=1)).tolist() != label.tolist():
                label = new[new]
            hit = np.flatnonzero(links)
            out["cid"].append(cid[a:b][hit])
            out["links"].append(links[hit])
            out["root"].append(cid[a:b][label[hit]])
        return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}

    return exact


def links_of(classes: DataFrame, threshold: float) -> DataFrame:
    """cid, links, root: counts of links and edges of stars among ``classes`` (cid, n, embedding; one length), a table on disk."""
    total = classes.count()
    sample = classes.orderBy(F.xxhash64("cid", F.lit(9)), "cid").limit(SAMPLE).select("embedding").toArrow().column(0).combine_chunks()
    centre, projection = fit_itq(unit(matrix(sample)))
    masks, near = tables(total)
    codes = arrow.mapped(classes.select("cid", "embedding"), lambda b: {"cid": b.column("cid"), "code": encode(matrix(b.column("embedding")), centre, projection).view(np.int64)}, "cid long, code long")
    entries = scratch.materialise(arrow.mapped(codes, _entries(masks, near), "bucket long, side int, cid long, code long"), "itq-entries")
    cells = in_cells(entries).groupBy("bucket", "cell", "kind").agg(F.collect_list(F.struct("cid", "code", "side")).alias("rows")).filter(F.size("rows") > 1)
    found = scratch.materialise(arrow.mapped(cells, _survivors(masks, near), "bucket long, cell long, kind int, cid long, code long, side int"), "itq-candidates")
    full = found.join(classes.select("cid", "n", "embedding"), "cid")
    full = full.groupBy("bucket", "cell", "kind").agg(F.collect_list(F.struct("cid", "code", "side", "n", "embedding")).alias("rows"))
    return scratch.materialise(arrow.mapped(full, _exact(masks, near, threshold), "cid long, links long, root long"), "itq-links")


def link(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors``."""
    rows = vectors.select(vectors[vec_id].cast("long").alias("vec_id"), vectors[embedding].cast("array<double>").alias("embedding"))
    fits = usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    # Equal vectors are known by 128 bits of hash.
    h1, h2 = (F.when(fits, F.xxhash64(F.lit(k), "embedding")) for k in (1, 2))
    keyed = scratch.materialise(rows.select("vec_id", "embedding", h1.alias("h1"), h2.alias("h2")), "itq-rows")
    classes = keyed.filter("h1 is not null").groupBy("h1", "h2").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"), F.any_value("embedding").alias("embedding"))
    classes = scratch.materialise(classes.withColumn("cid", F.monotonically_increasing_id()).withColumn("length", F.size("embedding")), "itq-classes")
    lengths = [r["length"] for r in classes.groupBy("length").count().filter("count > 1").orderBy("length").collect()]  # a model each, so few
    parts = [classes.filter(F.col("length") == k) for k in lengths]
    counted = reduce(DataFrame.unionByName, [links_of(p.select("cid", "n", "embedding"), threshold) for p in parts]) if parts else vectors.sparkSession.createDataFrame([], "cid long, links long, root long")

    links = counted.groupBy("cid").agg(F.sum("links").alias("links"))
    labels = components(counted.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    members = scratch.materialise(labels.join(classes.select("cid", "first"), labels["node"] == F.col("cid")).select("cid", "label", "first"), "itq-members")
    least = scratch.materialise(members.groupBy("label").agg(F.min("first").alias("least")), "itq-least")
    known = scratch.materialise(members.join(least, "label").select("cid", "least"), "itq-known")
    decided = classes.select("h1", "h2", "cid", "n", "first").join(links, "cid", "left").join(known, "cid", "left")
    decided = decided.select("h1", "h2", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("least", "first").alias("component_id"))
    decided = scratch.materialise(decided, "itq-decided")
    done = skew.join_by_group(keyed.filter("h1 is not null").select("vec_id", "h1", "h2"), decided, ["h1", "h2"], "n", keyed.count())
    alone = keyed.filter("h1 is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = done.select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
