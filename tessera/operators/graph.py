"""The knowledge graph: five layers of edges, the reverse index and the limit roll-up.

Chunks have section_id and seq (their order), chunk_id, source, section_code,
entities, conditional_refs, numeric_constraints and, where links are needed, cross_source_links.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from . import ranking

ORDER = ["section_id", "seq"]
_NONE = "map<string,string>"


def _edges(df: DataFrame, kind: str, source: Column, target: Column, metadata: Column | None = None) -> DataFrame:
    return df.select(F.lit(kind).alias("type"), source.alias("source"), target.alias("target"), (F.lit(None) if metadata is None else metadata).cast(_NONE).alias("metadata"))


def applies_to(chunks: DataFrame) -> DataFrame:
    rows = chunks.select("chunk_id", F.explode("entities").alias("entity"))
    return _edges(rows, "APPLIES_TO", F.col("chunk_id"), F.col("entity"))


def conditional(chunks: DataFrame) -> DataFrame:
    rows = chunks.select("chunk_id", F.explode("conditional_refs").alias("r"))
    return _edges(rows, "CONDITIONAL", F.col("chunk_id"), F.col("r.then_see"), F.create_map(F.lit("if_entity"), F.col("r.if_entity")))


def implies(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(V.IMPLICATIONS, "entity string, kind string, goal string, description string")
    return _edges(rows, "IMPLIES", F.col("entity"), F.col("goal"), F.create_map(F.lit("relationship"), F.col("kind"), F.lit("description"), F.col("description")))


def constrains(chunks: DataFrame) -> DataFrame:
    rows = chunks.select("chunk_id", F.explode("numeric_constraints").alias("c")).select("chunk_id", "c", F.explode("c.conditions").alias("condition"))
    limit = F.concat(F.col("c.metric"), F.lit(" "), F.col("c.operator"), F.lit(" "), F.col("c.value"), F.col("c.unit"))
    return _edges(rows, "CONSTRAINS", F.col("condition"), limit, F.create_map(F.lit("chunk_id"), F.col("chunk_id"), F.lit("source_text"), F.col("c.source_text")))


def first_chunks(chunks: DataFrame) -> DataFrame:
    """ORDER, source, section_code of each section's first chunk; sections are summed up before they are shuffled."""
    first = chunks.groupBy("source", "section_code").agg(F.min(F.struct(*ORDER)).alias("at"))
    return first.select("at.*", "source", "section_code")


def _first_lists(chunks: DataFrame) -> DataFrame:
    """Chunks with cross_source_links, of each section and list of links (told apart by a hash) the first."""
    own = chunks.select(*ORDER, "source", "section_code", F.xxhash64("cross_source_links").alias("__list"))
    first = own.groupBy("source", "section_code", "__list").agg(F.min(F.struct(*ORDER)).alias("__at"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__at.{c}")) for c in ORDER])
    return chunks.select(*ORDER, "source", "section_code", "cross_source_links").join(first.select("__at"), same, "left_semi")


def equivalent(chunks: DataFrame, lists: DataFrame | None = None) -> DataFrame:
    """One edge for each unordered pair of sections: the first in chunk order.

    All chunks of a section have its links, so only the first of them is expanded.  With
    ``lists`` (`linking.link_lists`) the links come from there and chunks need not have them.
    """
    own = _first_lists(chunks) if lists is None else first_chunks(chunks).join(lists.hint("merge"), ["source", "section_code"])
    rows = own.select(*ORDER, "source", "section_code", F.posexplode("cross_source_links").alias("k", "l"))
    pair = [F.least("section_code", "l.section_code"), F.greatest("section_code", "l.section_code")]
    own = F.struct(*ORDER, "k", "source", "section_code", "l")
    first = rows.groupBy(pair[0].alias("lo"), pair[1].alias("hi")).agg(F.min_by(own, F.struct(*ORDER, "k")).alias("e"))
    path = lambda s, c: F.concat(F.col(s), F.lit("/"), F.col(c))
    return _edges(first, "EQUIVALENT", path("e.source", "e.section_code"), path("e.l.source", "e.l.section_code"), F.create_map(F.lit("topic"), F.col("e.l.topic"), F.lit("relationship"), F.col("e.l.relationship")))


def chunk_edges(chunks: DataFrame) -> DataFrame:
    """The three layers that come from single chunks, in one pass over them."""
    kind = "array<struct<type:string,source:string,target:string,metadata:map<string,string>>>"

    def edge(name: str, source: Column, target: Column, metadata: Column) -> Column:
        return F.struct(F.lit(name).alias("type"), source.alias("source"), target.alias("target"), metadata.alias("metadata"))

    own, none = F.col("chunk_id"), F.lit(None).cast(_NONE)
    applies = F.transform("entities", lambda e: edge("APPLIES_TO", own, e, none)).cast(kind)
    refers = F.transform("conditional_refs", lambda r: edge("CONDITIONAL", own, r["then_see"], F.create_map(F.lit("if_entity"), r["if_entity"]))).cast(kind)
    limit = lambda x: F.concat(x["metric"], F.lit(" "), x["operator"], F.lit(" "), x["value"], x["unit"])
    bounds = F.flatten(F.transform("numeric_constraints", lambda x: F.transform(x["conditions"], lambda c: edge("CONSTRAINS", c, limit(x), F.create_map(F.lit("chunk_id"), own, F.lit("source_text"), x["source_text"]))))).cast(kind)
    return chunks.select(F.explode(F.concat(applies, refers, bounds)).alias("e")).select("e.*")


def edges(chunks: DataFrame, lists: DataFrame | None = None) -> DataFrame:
    """All five layers (``lists``: see `equivalent`); chunks are read twice."""
    return chunk_edges(chunks).unionByName(implies(chunks.sparkSession)).unionByName(equivalent(chunks, lists))


#: Longest list of a block of postings.
BLOCK = 4096
LIMIT = ["metric", "operator", "value", "unit"]


def blocks(rows: DataFrame, keys: list[str], order: list[Column], item: str, size: int = BLOCK) -> DataFrame:
    """keys, block (from 0) and items: the ``item`` of each row of a key in ``order``, at most ``size`` a block.

    A key may have any share of the rows; no task gathers more than a block.
    """
    placed = ranking.ranked_within(rows, keys, order, "__place")
    cut = placed.withColumn("block", ((F.col("__place") - 1) / size).cast("long"))
    lists = cut.groupBy(*keys, "block").agg(F.array_sort(F.collect_list(F.struct("__place", F.col(item).alias("item")))).alias("c"))
    return lists.select(*keys, "block", F.transform("c", lambda x: x["item"]).alias("items"))


def entity_postings(chunks: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """entity, block, items: the chunk_ids of an entity (of ``wanted``, or of each) in the order in which they are first seen."""
    named = F.col("entities") if wanted is None else F.filter("entities", lambda e: e.isin(wanted))
    rows = chunks.select(*ORDER, "chunk_id", F.explode(named).alias("entity"))
    first = rows.groupBy("entity", "chunk_id").agg(F.min(F.struct(*ORDER)).alias("at"))
    return blocks(first, ["entity"], [F.col("at"), F.col("chunk_id")], "chunk_id")


def with_more(old: DataFrame, more: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks ``old`` with blocks ``more`` of later chunks after them; nothing that is stored is rewritten.

    Items of ``more`` that ``old`` has as well stay twice: later chunks have ids of their own.
    """
    last = old.groupBy(*keys).agg((F.max("block") + 1).alias("__next"))
    moved = more.join(last, keys, "left").withColumn("block", F.col("block") + F.coalesce("__next", F.lit(0))).select(*more.columns)
    return old.unionByName(moved)


def read_postings(postings: DataFrame, wanted: list[str]) -> DataFrame:
    """entity, chunk_id of the postings of some entities, from their blocks alone."""
    return postings.filter(F.col("entity").isin(wanted)).select("entity", F.explode("items").alias("chunk_id"))


def in_all(postings: DataFrame, wanted: list[str]) -> DataFrame:
    """chunk_id of the chunks that the postings have under all wanted entities."""
    found = read_postings(postings, wanted).groupBy("chunk_id").agg(F.count_distinct("entity").alias("n"))
    return found.filter(F.col("n") == len(set(wanted))).select("chunk_id")


def reverse_index(chunks: DataFrame) -> DataFrame:
    """entity, chunk_ids in the order in which they are first seen, merged from blocks: for exports of bounded size."""
    by = entity_postings(chunks).groupBy("entity").agg(F.array_sort(F.collect_list(F.struct("block", "items"))).alias("b"))
    return by.select("entity", F.flatten(F.transform("b", lambda x: x["items"])).alias("chunk_ids"))


def intersection(chunks: DataFrame, wanted: list[str]) -> DataFrame:
    """chunk_id of the chunks that have all wanted entities."""
    return in_all(entity_postings(chunks, wanted), wanted)


def limit_postings(chunks: DataFrame) -> DataFrame:
    """metric, operator, value, unit, kind, block, items: the sections that state a limit and its conditions, in order of first sight.

    One pass: each limit gives its section and its conditions, of which the first sight is kept.
    """
    rows = chunks.select(*ORDER, "section_code", F.posexplode("numeric_constraints").alias("k", "c"))
    kind = "array<struct<kind:string,j:int,item:string>>"
    own = F.array(F.struct(F.lit("section").alias("kind"), F.lit(0).alias("j"), F.col("section_code").alias("item"))).cast(kind)
    given = F.transform("c.conditions", lambda x, j: F.struct(F.lit("condition").alias("kind"), j.alias("j"), x.alias("item"))).cast(kind)
    facts = rows.select(*[F.col(f"c.{n}").alias(n) for n in LIMIT], *ORDER, "k", F.explode(F.concat(own, given)).alias("f"))
    first = facts.groupBy(*LIMIT, "f.kind", "f.item").agg(F.min(F.struct(*ORDER, "k", "f.j")).alias("at"))
    return blocks(first, [*LIMIT, "kind"], [F.col("at"), F.col("item")], "item")


def limits(chunks: DataFrame) -> DataFrame:
    """metric, operator, value, unit, source_sections and conditions, merged from blocks: for exports of bounded size."""
    of = lambda kind: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("block", "items"))))
    by = limit_postings(chunks).groupBy(*LIMIT).agg(of("section").alias("s"), of("condition").alias("d"))
    return by.select(*LIMIT, F.flatten(F.transform("s", lambda x: x["items"])).alias("source_sections"), F.flatten(F.transform("d", lambda x: x["items"])).alias("conditions"))


def vocabulary_table(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([(k, v) for k, v, *_ in V.ENTITIES], "entity_type string, value string")
    return rows.groupBy("entity_type").agg(F.array_sort(F.collect_list("value")).alias("vals"), F.count(F.lit(1)).alias("n"))


def statistics(chunks: DataFrame, lists: DataFrame | None = None) -> DataFrame:
    """total_edges, total_entity_values (pairs of entity and chunk), total_constraints: one row (``lists``: see `equivalent`).

    Each chunk gives its number of edges, its entities and its limits in one pass; the
    pairs of sections take another.
    """
    kind = "array<struct<kind:string,key:string,n:int>>"
    bounds = F.aggregate(F.transform("numeric_constraints", lambda x: F.size(x["conditions"])), F.lit(0), lambda a, x: a + x)
    own = F.array(F.struct(F.lit("edges").alias("kind"), F.lit(None).cast("string").alias("key"), (F.size("entities") + F.size("conditional_refs") + bounds).alias("n"))).cast(kind)
    found = F.transform("entities", lambda e: F.struct(F.lit("entity").alias("kind"), F.concat_ws("\x01", "chunk_id", e).alias("key"), F.lit(0).alias("n"))).cast(kind)
    limit = F.transform("numeric_constraints", lambda x: F.struct(F.lit("limit").alias("kind"), F.concat_ws("\x01", x["metric"], x["operator"], x["value"], x["unit"]).alias("key"), F.lit(0).alias("n"))).cast(kind)
    facts = chunks.select(F.explode(F.concat(own, found, limit)).alias("f")).select("f.*")
    of = lambda k: F.count_distinct(F.when(F.col("kind") == k, F.col("key")))
    counts = facts.groupBy("kind", "key").agg(F.sum("n").alias("n")).agg(F.sum("n").alias("edges"), of("entity").alias("total_entity_values"), of("limit").alias("total_constraints"))
    pairs = equivalent(chunks, lists).agg(F.count(F.lit(1)).alias("pairs"))
    both = counts.crossJoin(F.broadcast(pairs))  # one row each
    return both.select((F.col("edges") + F.col("pairs") + len(V.IMPLICATIONS)).alias("total_edges"), "total_entity_values", "total_constraints")


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in ``order``.

    Rows are summed up by a digest of their keys before they are shuffled, so of a key of
    any size a task passes on one row.
    """
    rest = [c for c in df.columns if c not in keys]
    own = F.struct(*[F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest")]) if rest else F.struct(F.lit(1).alias("rest"))
    digest = F.sha2(F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys]), {"ignoreNullFields": "false"}), 256)
    places = df.select(digest.alias("__digest"), F.struct(*[F.col(f"`{c}`") for c in order]).alias("__at"), own.alias("__own"), F.struct(*[F.col(f"`{k}`") for k in keys]).alias("__keys"))
    first = places.groupBy("__digest").agg(F.min_by(F.struct("__keys", "__own"), "__at").alias("x"))
    return first.select(*[(F.col(f"x.__keys.`{c}`") if c in keys else F.col(f"x.__own.rest.`{c}`")).alias(c) for c in df.columns])
