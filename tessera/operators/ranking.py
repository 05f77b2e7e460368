"""Places of rows in one order over a whole table, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import storage


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with its place (from 1) in ``order``, which should tell rows apart.

    Rows are dealt into sampled ranges of the order and counted by range; the places
    of a range begin after the rows of the ranges before it.  The counts, one a range,
    are all that the driver sees.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = storage.stored(storage.stored(df).repartitionByRange(parts, *order).withColumn("__range", F.spark_partition_id()))
    before, starts = 0, []
    for r in dealt.groupBy("__range").count().orderBy("__range").collect():
        starts.append((r["__range"], before))
        before += r["count"]
    starts = F.broadcast(spark.createDataFrame(starts, "__range int, __start long"))  # a row a range
    within = Window.partitionBy("__range").orderBy(*order)
    return dealt.withColumn("__n", F.row_number().over(within)).join(starts, "__range").select(*df.columns, (F.col("__start") + F.col("__n")).alias(name))


def ranked_within(df: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with its place (from 1) in ``order`` among the rows of its ``keys``, of which one may have most rows.

    Ranges are of (keys, order), so the rows of a key that is frequent lie in many of
    them; the places of a range begin after the key's rows in the ranges before it.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = storage.stored(storage.stored(df).repartitionByRange(parts, *[F.col(k) for k in keys], *order).withColumn("__range", F.spark_partition_id()))
    counts = dealt.groupBy(*keys, "__range").agg(F.count(F.lit(1)).alias("__rows"))
    earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "__range", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__start"))
    within = Window.partitionBy("__range", *keys).orderBy(*order)
    numbered = dealt.withColumn("__n", F.row_number().over(within))
    return numbered.join(starts, ["__range", *keys]).select(*df.columns, (F.col("__start") + F.col("__n")).alias(name))
