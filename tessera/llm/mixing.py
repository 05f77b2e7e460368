"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Each document of a source expects ``target / source size`` copies.  The expected
copies are prefix-summed within the source, one random offset is added, and a
document is emitted once for each integer boundary that its interval crosses.
Documents are taken in order of size, largest first, so the words taken differ
from the target by less than about one largest document.

All documents of a source expect the same number of copies, so the prefix sum is
the document's rank within the source times that number.  Ranks are found by
ranges (see ``ranks``); a source of any share of the rows spreads over many tasks.

Defined results: a null or empty text has size 0 and is never taken; the null
source is a source of its own and comes last; repeated rows are documents of
their own; ids may repeat or be null; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ranks, scratch, skew

WORD = r"[^\x20\x09-\x0D]+"
MAX_COPIES = 3
WEIGHTS = (1, 2, 3)


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def offset_of(source: Column, seed: int) -> Column:
    """A fixed pseudo-random number in [0, 1) for each source."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\u0001null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """source, source_size -> also target: shares by weight, none above ``most`` times its size.

    Sources in order of ``most * size / weight`` reach their limit one after the
    other, so the excess is reshared in one pass of running sums over the sources.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    ratio = [(F.col("source_size") * float(most) / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    before, every = Window.orderBy(*ratio).rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    by = by.select(
        "*",
        F.sum("source_size").over(every).alias("total"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weight_left"),
        F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0)).alias("given"),
    )
    full = F.col("source_size") * float(most) * F.col("weight_left") <= (F.col("total") - F.col("given")).cast("double") * F.col("weight")
    by = by.withColumn("full", full)
    by = by.select(
        "*",
        F.coalesce(F.sum(F.when(F.col("full"), F.col("source_size") * most)).over(every), F.lit(0)).alias("given_all"),
        F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(every), F.lit(0)).alias("weight_rest"),
    )
    rest = (F.col("total") - F.col("given_all")).cast("double") * F.col("weight") / F.col("weight_rest")
    return by.select("source", "source_size", F.when(F.col("full"), F.col("source_size") * float(most)).otherwise(rest).alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MAX_COPIES, seed: int = 17) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies and source for each document."""
    sized = scratch.materialise(docs.select(docs[doc_id].alias("doc_id"), docs[source].alias("source"), word_count(docs[text]).alias("size")), "mix-sizes")
    goal = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goal = scratch.materialise(goal.select(F.col("source").alias("of"), "source_size", "target", rate.alias("rate"), offset_of(F.col("source"), seed).alias("shift")), "mix-targets")

    ranked = ranks.numbered(sized, "source", [F.col("size").desc(), F.col("doc_id").asc_nulls_last()])
    ranked = ranked.join(skew.small(goal), F.col("source").eqNullSafe(F.col("of")))
    rank = F.col("rank")
    copies = F.floor(rank * F.col("rate") + F.col("shift")) - F.floor((rank - 1) * F.col("rate") + F.col("shift"))
    return ranked.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"), "source")


def repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MAX_COPIES, seed: int = 17) -> DataFrame:
    """``docs`` with all columns, each row as many times as the mix takes it.

    Copies are joined back by id, source and size, broadcast where they are few enough, so
    that texts stay where they are.  Rows that share all three are numbered by a hash of
    their texts, and each takes the copies of one of them.
    """
    found = mix(docs, doc_id, text, source, weights, most, seed)
    by = found.groupBy(F.col("doc_id").alias("id"), F.col("source").alias("from"), F.col("size").alias("of")).agg(F.sort_array(F.collect_list("copies"), asc=False).alias("copies"))
    by = skew.small(scratch.materialise(by.filter(F.col("copies")[0] > 0), "mix-copies"), skew.NARROW_ROWS // 2)
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[source].alias("source"), word_count(docs[text]).alias("size"), F.struct("*").alias("row"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & F.col("source").eqNullSafe(F.col("from")) & (F.col("size") == F.col("of"))
    rows = rows.join(by, same).select("doc_id", "source", "size", "copies", "row")
    twins = Window.partitionBy("doc_id", "source", "size").orderBy(F.xxhash64(F.col("row").getField(text)))
    alone = rows.filter(F.size("copies") == 1).select("row", F.col("copies")[0].alias("times"))
    others = rows.filter(F.size("copies") > 1).withColumn("k", F.row_number().over(twins)).select("row", F.get("copies", F.col("k") - 1).alias("times"))
    taken = alone.unionByName(others).filter("times > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy")).select("row.*")
