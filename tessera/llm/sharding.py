"""Sharding along a Hilbert curve over several metadata dimensions (DataFrame functions only).

Each dimension is quantised to cells of about equal numbers of rows, in the order of
its values: a dictionary has the rows of each distinct value, and running sums over it
(by ranges) give the cell.  The cells of a row are a point of a cube, whose place on
the Hilbert curve is its curve index.  Rows are sorted by that index and cut into runs,
so a shard is a compact part of the cube and the least and largest values of a file
tell most files apart from what a query asks for.

Rows are sorted with a few numbers each, never with their texts; equal texts of equal
metadata follow each other, so a cut parts at most one group of them.  Dictionaries are
broadcast if they are small by count; beyond that values of many rows are broadcast
and the others shuffled, so a value of any share of the rows is no task of its own.

Laws: ``rows`` cuts runs whose numbers of rows are at most one apart; ``bytes`` puts a
row where the middle of its bytes lies, so a shard differs from an equal share by less
than its two outermost rows.

Defined results: a null text has no bytes (size 1) and the CRC of the empty text; null
metadata is a value of its own after all others; rows that are equal in all that orders
them are taken as they are stored; ids may repeat or be null; fewer rows than shards
leave shards empty; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ranks, scratch, skew

SHARDS = 16
#: Bits of a cell of a dimension; at most 62 over all dimensions.
BITS = 8
#: Name of the folder level of written shards.
SHARD = "curve_shard"


def category(value: Column) -> Column:
    """A dimension in code-point order, null last."""
    return F.coalesce(F.concat(F.lit("v"), value.cast("string")), F.lit("w"))


def magnitude(value: Column) -> Column:
    """A dimension of whole numbers: four steps for each power of two, null and less than 1 first; at most 253 values."""
    power = F.length(F.bin(value)) - 1
    quarter = F.when(power >= 2, F.call_function("shiftright", value, power - 2)).otherwise(value * F.pow(F.lit(2), 2 - power).cast("long")).bitwiseAND(F.lit(3))
    return F.lpad(F.when(value >= 1, power * 4 + quarter + 1).otherwise(0).cast("string"), 3, "0")


def curve_index(cells: list[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve of a point of ``len(cells)`` coordinates of ``bits`` bits each.

    By Skilling's rule: from the highest bit down the point is turned into the frame of
    its sub-cube, which leaves the bits of the index, Gray-coded and spread over the
    coordinates.
    """
    n = len(cells)
    if n * bits > 62:
        raise ValueError("a curve index has 62 bits at most")
    turns = [F.struct(F.lit(1 << k).cast("long").alias("bit"), F.lit(i).alias("axis")) for k in range(bits - 1, 0, -1) for i in range(n)]

    def turn(at: Column, step: Column) -> Column:
        bit, axis = step["bit"], step["axis"]
        low = bit - 1
        own = F.get(at, axis)
        is_set = own.bitwiseAND(bit) != 0
        swap = at[0].bitwiseXOR(own).bitwiseAND(low)
        none = F.lit(0).cast("long")
        return F.transform(at, lambda x, i: x.bitwiseXOR(F.when(i == 0, F.when(is_set, low).otherwise(swap)).when((i == axis) & ~is_set, swap).otherwise(none)))

    def xor(parts: list[Column]) -> Column:
        out = parts[0]
        for x in parts[1:]:
            out = out.bitwiseXOR(x)
        return out

    def named(value: Column, of) -> Column:
        """``of(value)`` with ``value`` worked out once."""
        return F.transform(F.array(value), of)[0]

    def gray(at: Column) -> Column:
        last = xor([at[i] for i in range(n)])
        flip = xor([F.lit(0).cast("long"), *[F.when(last.bitwiseAND(F.lit(1 << k)) != 0, F.lit((1 << k) - 1).cast("long")).otherwise(F.lit(0).cast("long")) for k in range(1, bits)]])
        return named(flip, lambda t: F.array(*[xor([*[at[j] for j in range(i + 1)], t]) for i in range(n)]))

    def woven(at: Column) -> Column:
        out = F.lit(0).cast("long")
        for k in range(bits):
            for i in range(n):
                out = out.bitwiseOR(F.shiftleft(F.shiftright(at[i], k).bitwiseAND(F.lit(1)), k * n + n - 1 - i))
        return out

    point = F.array(*[c.cast("long") for c in cells])
    turned = F.aggregate(F.array(*turns), point, turn) if turns else point
    return named(named(turned, gray), woven)


def dictionary(rows: DataFrame, names: list[str], total: int, bits: int = BITS) -> DataFrame:
    """dim (number of the name), value, n (its rows) and cell of each distinct value: the cell at the middle of its rows."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("dim"), F.col(name).alias("value")) for k, name in enumerate(names)])).alias("x")
    by = scratch.materialise(rows.select(each).groupBy("x.dim", "x.value").agg(F.count(F.lit(1)).alias("n")), "shard-values")
    by = ranks.running(by, [F.col("dim"), F.col("value")], ["n"])
    # Each dimension has all rows, so `total` rows come before each later one.
    cell = F.expr(f"((2 * (n_before - dim * {total}L) + n) * {1 << bits}) div {2 * max(total, 1)}")
    return scratch.materialise(by.select("dim", "value", "n", cell.cast("int").alias("cell")), "shard-cells")


def with_cells(rows: DataFrame, names: list[str], codes: DataFrame, total: int) -> DataFrame:
    """``rows`` with ``<name>_cell`` for each of ``names``."""
    few = codes.count() <= skew.BROADCAST_ROWS
    for k, name in enumerate(names):
        own = codes.filter(F.col("dim") == k).select(F.col("value").alias(name), "n", F.col("cell").alias(f"{name}_cell"))
        rows = rows.join(F.broadcast(own.drop("n")), name) if few else skew.join_by_group(rows, own, [name], "n", total).drop("n")
    return rows


def metadata(docs: DataFrame) -> dict[str, Column]:
    """The dimensions of ``documents``: language, source and length."""
    return {"lang": category(docs["lang"]), "source": category(docs["source"]), "bytes": magnitude(size_of(docs["text"]))}


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


class Curve:
    """``docs`` along the curve; ``rows`` has a row for each document, with its sort key and what lies before it."""

    KEY = ["curve", "size", "text_crc32", "doc_id", "place"]

    def __init__(self, docs: DataFrame, dimensions: dict[str, Column], doc_id: str = "doc_id", text: str = "text", bits: int = BITS):
        self.dimensions, self.bits = dimensions, bits
        self.names = {name: f"dim_{k}" for k, name in enumerate(dimensions)}
        rows = docs.select(
            docs[doc_id].alias("doc_id"),
            size_of(docs[text]).alias("size"),
            F.crc32(F.coalesce(docs[text], F.lit("")).cast("binary")).alias("text_crc32"),
            *[dimensions[name].alias(column) for name, column in self.names.items()],
        )
        rows = scratch.materialise(rows.withColumn("place", F.monotonically_increasing_id()), "shard-rows")
        n, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
        self.n, self.total = n, total or 0
        self.codes = dictionary(rows, list(self.names.values()), n, bits)
        rows = self.with_index(rows)
        self.rows = ranks.running(rows.select(*self.KEY), [F.col(c).asc_nulls_last() for c in self.KEY], ["size"])

    def with_index(self, rows: DataFrame) -> DataFrame:
        """``rows``, which have the dimensions under the names of ``names``, with their place on the curve."""
        columns = list(self.names.values())
        return with_cells(rows, columns, self.codes, self.n).withColumn("curve", curve_index([F.col(f"{c}_cell") for c in columns], self.bits))

    def cut(self, shards: int = SHARDS, law: str = "rows") -> DataFrame:
        """``rows`` with shard and slot (from 0 without a gap in each shard)."""
        if law == "rows":
            out = self.rows.withColumn("shard", F.expr(f"(row_before * {shards}) div {max(self.n, 1)}").cast("int"))
            return out.withColumn("slot", F.col("row_before") - F.expr(f"(shard * {self.n}L + {shards - 1}) div {shards}"))
        if law != "bytes":
            raise ValueError(f"unknown law {law}")
        out = self.rows.withColumn("shard", F.expr(f"((2 * size_before + size) * {shards}) div {2 * max(self.total, 1)}").cast("int"))
        out = scratch.materialise(out, "shard-bytes")
        first = out.groupBy("shard").agg(F.min("row_before").alias("first"))  # one row a shard
        return out.join(F.broadcast(first), "shard").withColumn("slot", F.col("row_before") - F.col("first"))


def decide(docs: DataFrame, dimensions: dict[str, Column] | None = None, shards: int = SHARDS, law: str = "rows", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null, as no key decides) for each row."""
    curve = Curve(docs, metadata(docs) if dimensions is None else dimensions, doc_id, text)
    return curve.cut(shards, law).select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, dimensions: dict[str, Column] | None = None, shards: int = SHARDS, law: str = "rows", files: int | None = None, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write ``docs`` to ``path`` as Parquet, a folder for each shard and about ``files`` files in all, in the order of the curve.

    The first keys of the shards are found on narrow rows; whole rows are then dealt once,
    by range.  Rows with the first key of a shard all go into it, so twins (equal in metadata,
    size, CRC and id) may leave a shard a few rows above its share here.
    """
    dimensions = metadata(docs) if dimensions is None else dimensions
    curve = Curve(docs, dimensions, doc_id, text)
    last = (1 << 63) - 1
    firsts = curve.cut(shards, law).filter("slot = 0").select("shard", "curve", "size", "text_crc32", F.coalesce(F.col("doc_id").cast("long"), F.lit(last)).alias("id")).sort("shard").collect()
    rows = docs.select(
        F.struct("*").alias("row"),
        size_of(docs[text]).alias("size"),
        F.crc32(F.coalesce(docs[text], F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(docs[doc_id].cast("long"), F.lit(last)).alias("id"),
        *[dimensions[name].alias(column) for name, column in curve.names.items()],
    )
    rows = curve.with_index(rows)
    key = F.struct("curve", "size", "text_crc32", "id")
    starts = F.array(*[F.struct(*[F.lit(x).cast("long").alias(c) for c, x in (("curve", r["curve"]), ("size", r["size"]), ("text_crc32", r["text_crc32"]), ("id", r["id"]))]) for r in firsts]) if firsts else F.array()
    numbers = F.array(*[F.lit(r["shard"]) for r in firsts]) if firsts else F.array(F.lit(0))
    rows = rows.withColumn(SHARD, F.get(numbers, F.size(F.filter(starts, lambda s: s <= key)) - 1) if firsts else F.lit(0))
    order = ["curve", "size", "text_crc32", "id"]
    rows = rows.repartitionByRange(files or max(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), SHARD, *order).sortWithinPartitions(SHARD, *order)
    rows.select("row.*", SHARD).write.partitionBy(SHARD).parquet(path)


def zone_map(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """file, n_rows and ``<column>_min``, ``_max`` and ``_nulls`` for each file; reads these columns only."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), *columns)
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), *[x for c in columns for x in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"))])


def files_for(zones: DataFrame, between: dict[str, tuple]) -> DataFrame:
    """The rows of ``zones`` whose files may hold rows with each column within its bounds."""
    for column, (low, high) in between.items():
        zones = zones.filter((F.col(f"{column}_max") >= F.lit(low)) & (F.col(f"{column}_min") <= F.lit(high)))
    return zones


def read_between(spark: SparkSession, path: str, zones: DataFrame, between: dict[str, tuple]) -> DataFrame:
    """Rows of the shards at ``path`` with each column within its bounds, from no other files than ``files_for`` names."""
    files = [r["file"] for r in files_for(zones, between).select("file").collect()]
    whole = spark.read.parquet(path)
    rows = spark.read.option("basePath", path).schema(whole.schema).parquet(*files) if files else whole.limit(0)
    for column, (low, high) in between.items():
        rows = rows.filter(F.col(column).between(F.lit(low), F.lit(high)))
    return rows.drop(SHARD)
