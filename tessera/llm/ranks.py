"""Distributed numbering of rows within a key of any share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scratch, skew


def numbered(df: DataFrame, key: str, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with a column ``name``: 1, 2, ... in ``order`` within each value of ``key``.

    Rows are dealt into ranges of (key, order); each range counts its rows by
    key, the counts are summed over the ranges before it, and rows are numbered
    within their range.  Nulls are a key like any other.  ``df`` should be a
    table on disk, since the ranges are sampled from it.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, F.col(key).asc_nulls_last(), *order).withColumn("__range", F.spark_partition_id())
    dealt = scratch.materialise(dealt, "ranges")
    counts = dealt.groupBy(key, "__range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(key).alias("__key"), F.col("__range").alias("__r"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__start"))
    starts = skew.small(scratch.materialise(starts, "range-starts"))
    within = Window.partitionBy("__range", key).orderBy(*order)
    rows = dealt.withColumn("__number", F.row_number().over(within))
    rows = rows.join(starts, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__range") == F.col("__r")))
    return rows.withColumn(name, F.col("__start") + F.col("__number")).select(*df.columns, name)


def running(df: DataFrame, order: list[Column], values: list[str]) -> DataFrame:
    """``df`` with ``row_before`` and ``<value>_before``: rows, and sums of each of ``values``, before each row.

    The order should tell all rows apart.  Works as ``numbered`` does, by ranges of the
    order, of which each gets the sums of the ranges before it; no task sees all rows.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = scratch.materialise(df.repartitionByRange(parts, *order).withColumn("__range", F.spark_partition_id()), "running")
    sums = {"row": F.count(F.lit(1)), **{v: F.sum(v) for v in values}}
    # One row for each range: so few that a window without a partition may hold them.
    by = dealt.groupBy("__range").agg(*[s.alias(f"__{v}") for v, s in sums.items()])
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = by.select(F.col("__range").alias("__r"), *[F.coalesce(F.sum(f"__{v}").over(earlier), F.lit(0)).alias(f"__{v}") for v in sums])
    starts = skew.small(scratch.materialise(starts, "running-starts"))
    within = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = dealt.select("*", *[F.coalesce((F.count(F.lit(1)) if v == "row" else F.sum(v)).over(within), F.lit(0)).alias(f"__in_{v}") for v in sums])
    rows = rows.join(starts, F.col("__range") == F.col("__r"))
    return rows.select(*df.columns, *[(F.col(f"__{v}") + F.col(f"__in_{v}")).alias(f"{v}_before") for v in sums])
