"""The enrichment pass: sections to chunks with tags, entities, limits and links."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import text as T
from ..operators import chunking, linking
from ..sources import storage


def _content_type() -> Column:
    c = F.col
    return R.content_type(c("source"), c("section_code"), c("title"), c("body"), c("has_tables"))


def tagged_sections(sections: DataFrame) -> DataFrame:
    """Sections (source, section_code, title, body, has_tables) with section-level tags, computed once."""
    c = F.col
    return sections.select(
        "*",
        _content_type().alias("content_type"),
        R.domains(c("source"), c("section_code"), c("body")).alias("domains"),
        R.enumerations(c("body")).alias("enumerations"),
    )


def text_tags(chunks: DataFrame) -> DataFrame:
    """Chunks with what their text alone says: entities, terms, limits, references, severity and requirement type."""
    text = F.col("content")
    first = chunks.select("*", R.entities(text).alias("entities"), R.terms(text).alias("key_terms"))
    return first.select(
        "*",
        R.constraints(text, F.col("entities")).alias("numeric_constraints"),
        R.references(text).alias("references"),
        R.severity(text).alias("severity"),
        R.severity_signals(text).alias("severity_signals"),
        R.requirement_type(text).alias("requirement_type"),
    )


def _named_tags(texts: DataFrame, body: Column, split: Column) -> DataFrame:
    """The chunks of ``texts`` with what the texts alone say, and the last part of their ids."""
    cut = chunking.cut(texts.withColumn("enumerations", R.enumerations(body)), split)
    return text_tags(cut.withColumn("name", T.chunk_name(F.col("heading"), F.col("seq"))))


def _once_a_text(own: DataFrame) -> DataFrame:
    """The chunks of ``own`` (own, body, content_type) by the adaptive chunker.

    Sections may repeat a text: each is cut and searched once, and its chunks are joined
    back to the sections that have it (whole texts are compared, the hash is to sort by).
    """
    c = F.col
    spark = own.sparkSession
    key = {"hash": F.xxhash64("body"), "defined": c("content_type") == "definition", "text": c("body")}
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    texts = own.select(*[k.alias(n) for n, k in key.items()]).distinct().repartition(tasks)  # few bytes, much work
    found = _named_tags(texts, c("text"), chunking.adaptive(c("text"), F.when(c("defined"), F.lit("definition"))))
    same = reduce(operator.and_, [c(f"{n}_of").eqNullSafe(c(n)) for n in key])
    return own.select("own", *[k.alias(f"{n}_of") for n, k in key.items()]).join(found.hint("merge"), same)  # not sent through the driver


def tagged_chunks(sections: DataFrame, split: Column | None = None) -> DataFrame:
    """Chunks with all tags and without links; ``split`` replaces the adaptive chunker (it is an array of chunks)."""
    c = F.col
    typed = sections.withColumn("content_type", _content_type())
    kept = [n for n in sections.columns if n != "body"]
    domains = R.domains(c("source"), c("section_code"), c("body")).alias("domains")
    own = typed.select(F.struct(*kept, "content_type", domains).alias("own"), *([] if split is None else kept), "body", "content_type")
    rows = _once_a_text(own) if split is None else _named_tags(own, c("body"), split)
    of_section = lambda n: c(f"own.{n}")
    code, title = of_section("section_code"), of_section("title")
    return rows.select(
        "own.*",
        *["enumerations", "seq", "heading", "content", "word_count", "has_table"],
        T.chunk_id(of_section("source"), code, c("name")).alias("chunk_id"),
        *["entities", "key_terms", "numeric_constraints"],
        R.to_others(c("references"), code).alias("conditional_refs"),
        *["severity", "severity_signals", "requirement_type"],
        F.when(c("seq") == 0, T.summary(code, title, of_section("domains"), c("key_terms"))).otherwise(F.lit("")).alias("summary"),
    )


def enrich(sections: DataFrame, split: Column | None = None, known: DataFrame | None = None, most: int | None = None, as_json: bool = False) -> DataFrame:
    """Enriched chunks (``split``: see `tagged_chunks`).

    Links go to ``sections`` and to those ``known`` beside them (source, section_code);
    ``most`` keeps the first so many of each chunk, where no more of them are shown.
    With ``as_json`` the links are JSON text, as long as their lists are few.
    """
    c = F.col
    codes = sections.select("source", "section_code")
    codes = storage.stored((codes if known is None else codes.unionByName(known.select("source", "section_code"))).distinct())
    chunks = tagged_chunks(sections, split)
    name, none = "cross_source_links", F.array().cast("array<struct<source:string,section_code:string,topic:string,relationship:string>>")
    if (lists := linking.shared_lists(codes, most)) is not None:
        if as_json:
            lists, none = lists.withColumn(name, F.to_json(name)), F.lit("[]")
        own = chunks.withColumn("ords", linking.map_rows(c("source"), c("section_code")))
        found = own.join(F.broadcast(lists), ["source", "ords"], "left").drop("ords")
    else:  # as small as files, but the lists may be long, so they are not sent through the driver
        found = chunks.join(linking.link_lists(codes, most).hint("merge"), ["source", "section_code"], "left")
    rest = [n for n in chunks.columns if n not in ("source", "section_code")]
    return found.select("source", "section_code", *rest, F.coalesce(name, none).alias(name))
