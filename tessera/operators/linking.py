"""Links between equivalent sections of the two guides.

The alignment map has 16 rows.  It is resolved once against the section codes, and what
a row of it links to is kept in blocks.  Sections keep the numbers of their rows of the
map, so what is stored grows with the sections; pairs of sections are formed on reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocabulary as V
from ..sources import storage
from . import graph


def alignment(spark: SparkSession) -> DataFrame:
    rows = [(i, *r) for i, r in enumerate(V.CROSS_SOURCE)]
    return F.broadcast(spark.createDataFrame(rows, "ord int, prefix string, low int, high int, topic string, relationship string"))


def _codes(sections: DataFrame, source: str) -> DataFrame:
    return sections.filter(F.col("source") == source).select(F.col("section_code").alias("code")).distinct()


def first_to_map(sections: DataFrame) -> DataFrame:
    """First-guide sections by the prefixes of the map that their code has."""
    own = sections.filter(F.col("source") == "fannie_mae").select("source", "section_code")
    return own.join(alignment(sections.sparkSession), F.upper("section_code").startswith(F.upper("prefix")))


def second_to_map(sections: DataFrame) -> DataFrame:
    """Second-guide sections by the ranges of the map that hold their chapter."""
    own = sections.filter(F.col("source") == "freddie_mac").select("source", "section_code")
    chapter = T.chapter_number(F.col("section_code"))
    return own.join(alignment(sections.sparkSession), chapter.between(F.col("low"), F.col("high")))


def map_to_second(sections: DataFrame) -> DataFrame:
    """Each row of the map with the second-guide sections in its range, or the range itself."""
    codes = _codes(sections, "freddie_mac")
    chapter = T.chapter_number(F.col("code"))
    hits = codes.join(alignment(sections.sparkSession), chapter.between(F.col("low"), F.col("high"))).select("ord", "code")
    span = F.concat(F.col("low").cast("string"), F.lit("-"), F.col("high").cast("string"))
    return alignment(sections.sparkSession).join(hits, "ord", "left").select("ord", "topic", "relationship", F.coalesce("code", span).alias("target"))


def map_to_first(sections: DataFrame) -> DataFrame:
    """Each row of the map with the first-guide sections that have its prefix, or the prefix itself."""
    codes = _codes(sections, "fannie_mae")
    hits = codes.join(alignment(sections.sparkSession), F.upper("code").startswith(F.upper("prefix"))).select("ord", "code")
    return alignment(sections.sparkSession).join(hits, "ord", "left").select("ord", "topic", "relationship", F.coalesce("code", "prefix").alias("target"))


#: Longest list of a block of targets, and blocks that are sent to every task.
BLOCK, BROADCAST_BLOCKS = 4096, 64


def section_map(sections: DataFrame) -> DataFrame:
    """source, section_code, ords: the rows of the map that a section belongs to, one row a section."""
    both = first_to_map(sections).unionByName(second_to_map(sections)).select("source", "section_code", "ord")
    return both.groupBy("source", "section_code").agg(F.array_sort(F.collect_set("ord")).alias("ords"))  # at most the map's rows


def targets(sections: DataFrame) -> DataFrame:
    """source (of the section that links), ord, link_source, block, topic, relationship, codes: what a row of the map links to."""
    forward = map_to_second(sections).select(F.lit("fannie_mae").alias("source"), "ord", F.lit("freddie_mac").alias("link_source"), "topic", "relationship", "target")
    backward = map_to_first(sections).select(F.lit("freddie_mac").alias("source"), "ord", F.lit("fannie_mae").alias("link_source"), "topic", "relationship", "target")
    keys = ["source", "ord", "link_source", "topic", "relationship"]
    cut = graph.blocks(forward.unionByName(backward), keys, [F.col("target")], "target", BLOCK)
    return cut.withColumnRenamed("items", "codes")


def expanded(own: DataFrame, of: DataFrame) -> DataFrame:
    """The links of sections (as ``section_map`` gives them) by ``targets`` (a table on disk): one row a pair."""
    of = F.broadcast(of) if of.count() <= BROADCAST_BLOCKS else of
    each = own.select("source", "section_code", F.explode("ords").alias("ord")).join(of, ["source", "ord"])
    return each.select("source", "section_code", "ord", "link_source", F.explode("codes").alias("link_code"), "topic", "relationship")


def links(sections: DataFrame) -> DataFrame:
    """source, section_code, ord, link_source, link_code, topic, relationship of each occurrence of a section."""
    each = first_to_map(sections).unionByName(second_to_map(sections)).select("source", "section_code", F.array("ord").alias("ords"))
    return expanded(each, storage.stored(targets(sections)))


def link_counts(sections: DataFrame) -> DataFrame:
    """source, section_code, links: how many links each section has, without forming them."""
    sizes = targets(sections).groupBy("source", "ord").agg(F.sum(F.size("codes")).alias("n"))  # one row a side of the map's rows
    own = section_map(sections).select("source", "section_code", F.explode("ords").alias("ord"))
    return own.join(F.broadcast(sizes), ["source", "ord"]).groupBy("source", "section_code").agg(F.sum("n").alias("links"))


def _lists(each: DataFrame, by: list[str], most: int | None) -> DataFrame:
    """``by``, cross_source_links: the links of ``each`` in the order of the map and then of the code; the first ``most``, if given."""
    item = F.struct("ord", "link_code", "link_source", "topic", "relationship")
    tidy = lambda x: F.struct(x["link_source"].alias("source"), x["link_code"].alias("section_code"), x["topic"].alias("topic"), x["relationship"].alias("relationship"))
    found = F.array_sort(F.collect_list(item))
    return each.groupBy(*by).agg(F.transform(found if most is None else F.slice(found, 1, most), tidy).alias("cross_source_links"))


def link_lists(sections: DataFrame, most: int | None = None) -> DataFrame:
    """source, section_code, cross_source_links in the order of the map and then of the code; the first ``most`` of a section, if given."""
    each = links(sections.select("source", "section_code").distinct())
    return storage.stored(_lists(each, ["source", "section_code"], most))


#: Most links of all lists together that are sent to every task.
LISTED = 100_000


def map_rows(source: Column, code: Column) -> Column:
    """The rows of the map that a section belongs to, in order, without a join (see `first_to_map` and `second_to_map`)."""
    row = lambda hit, i: F.when(hit, F.lit(i))
    first = T.let(F.upper(code), lambda x: F.array_compact(F.array(*[row(x.startswith(p.upper()), i) for i, (p, *_) in enumerate(V.CROSS_SOURCE)])))
    second = T.let(T.chapter_number(code), lambda x: F.array_compact(F.array(*[row(x.between(r[1], r[2]), i) for i, r in enumerate(V.CROSS_SOURCE)])))
    return F.when(source == "fannie_mae", first).when(source == "freddie_mac", second).otherwise(F.array().cast("array<int>"))


def shared_lists(codes: DataFrame, most: int | None = None) -> DataFrame | None:
    """source, ords, cross_source_links: the list of all sections that belong to the same rows of the map.

    There are as many lists as the map has such sets of rows, not one a section.  None if
    they hold more than ``LISTED`` links; ``most``: see `link_lists`.
    """
    of = storage.stored(targets(codes))
    sets = storage.stored(codes.select("source", map_rows(F.col("source"), F.col("section_code")).alias("ords")).distinct())
    each = sets.select("source", "ords", F.explode("ords").alias("ord")).join(of, ["source", "ord"])
    if each.agg(F.coalesce(F.sum(F.size("codes")), F.lit(0))).first()[0] > LISTED:
        return None
    rows = each.select("source", "ords", "ord", "link_source", F.explode("codes").alias("link_code"), "topic", "relationship")
    return storage.stored(_lists(rows, ["source", "ords"], most))
