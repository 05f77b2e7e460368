"""Sinks of the engine's file forms: section and chunk files, the index and the ontology.

Section and chunk files are written by the tasks (see `text_sink`); of a job that fails
none appears.  The index and the ontology are one JSON document each, replaced whole.
Their totals come from one pass.  Up to ``INLINE`` rows their long lists are in the
document; beyond that they are JSON lines in part files next to it, which the document
names, so neither the driver nor a task ever holds them.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocabulary as V
from ..operators import graph, ranking
from . import files, storage, text_sink

#: Longest list inside a document.
INLINE = 20_000
VERSION = "1.0"


def chunk_filename(chunk_id: Column, k: Column) -> Column:
    """The name of the file of the ``k``-th chunk with an id."""
    return F.concat(F.replace(chunk_id, F.lit("/"), F.lit("_")), F.when(k > 1, F.concat(F.lit("_"), k.cast("string"))).otherwise(F.lit("")), F.lit(".txt"))


def chunk_files(chunks: DataFrame) -> DataFrame:
    """name, text of each chunk's file."""
    numbered = chunks.withColumn("__k", F.row_number().over(Window.partitionBy("chunk_id").orderBy(*graph.ORDER)))
    text = files.chunk_header(model_pass="llm_model" in chunks.columns)
    return numbered.select(F.concat(F.lit("chunks/"), chunk_filename(F.col("chunk_id"), F.col("__k"))).alias("name"), text.alias("text"))


def section_files(sections: DataFrame) -> DataFrame:
    """name, text of each parsed section's markdown file (see `section_pages.parsed`)."""
    c = F.col
    announced = F.transform("related_announcements", lambda a: F.when(F.coalesce(a["date"], F.lit("")) != "", F.concat(a["code"], F.lit(" ("), a["date"], F.lit(")"))).otherwise(a["code"]))
    own = {"part_code": "part", "part_name": "part_name", "chapter_code": "chapter", "chapter_name": "chapter_name", "subpart_code": "subpart", "subpart_name": "subpart_name"}
    fields = F.struct(*["source", "section_code", "title", "url"], *[c(k).alias(v) for k, v in own.items()], c("effective_date").cast("string").alias("effective_date"), "word_count", "table_count", "cross_references", "content_markdown", announced.alias("announcements"))
    name = F.concat(c("source"), F.lit("/"), T.output_path(c("source"), c("section_code"), c("title"), c("part_code"), c("chapter_code")))
    return sections.select(name.alias("name"), files.section_file(fields).alias("text"))


def write_chunks(chunks: DataFrame, folder: str, layout: str = "flat") -> None:
    text_sink.write_texts(chunk_files(chunks), folder, layout)


def write_sections(sections: DataFrame, folder: str, layout: str = "flat") -> None:
    text_sink.write_texts(section_files(sections), folder, layout)


def totals(chunks: DataFrame) -> DataFrame:
    """kind (total, domain, content_type), value, n: what the index counts, in one pass."""
    pair = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    facts = F.concat(F.array(pair("total", F.lit("")), pair("content_type", F.col("content_type"))), F.transform("domains", lambda d: pair("domain", d)))
    return chunks.select(F.explode(facts).alias("f")).groupBy("f.kind", "f.value").agg(F.count(F.lit(1)).alias("n"))


def _listed(df: DataFrame, order: list, value: str, folder: str, name: str, n: int) -> dict:
    """``df``'s JSON column as {name: list}, or as {name + _files: files} where there are too many rows."""
    if n <= INLINE:
        return {name: [json.loads(r[value]) for r in df.orderBy(*order).select(value).collect()]}
    spark = df.sparkSession
    ranking.ranked(df, order, "__n").repartitionByRange("__n").sortWithinPartitions("__n").select(F.col(value).alias("value")).write.mode("overwrite").text(f"{folder}/{name}")
    return {f"{name}_files": [f"{name}/{x}" for x in storage.names(spark, f"{folder}/{name}") if x.startswith("part-")]}


def index_document(chunks: DataFrame, folder: str) -> dict:
    """The index: version, totals and distributions (most frequent first), and the entries of the chunks in their order."""
    counts: dict[str, dict] = {"total": {}, "domain": {}, "content_type": {}}
    for r in totals(chunks).orderBy(F.desc("n"), "value").collect():  # as many as there are domains and types
        counts[r["kind"]][r["value"]] = r["n"]
    n = counts["total"].get("", 0)
    entries = files.index_entries(chunks, keep=graph.ORDER)
    return {"version": VERSION, "total_chunks": n, "domain_distribution": counts["domain"], "content_type_distribution": counts["content_type"], **_listed(entries, [*graph.ORDER, "chunk_id"], "entry", folder, "chunks", n)}


def write_index(chunks: DataFrame, folder: str) -> None:
    """Write ``folder``/index.json; ``chunks`` should be a table on disk."""
    storage.write_text(chunks.sparkSession, f"{folder}/index.json", json.dumps(index_document(chunks, folder), indent=2))


_LAYERS = ["APPLIES_TO", "CONDITIONAL", "IMPLIES", "CONSTRAINS", "EQUIVALENT"]


def ontology_document(chunks: DataFrame, folder: str) -> dict:
    """The ontology: vocabulary, edges by layer, chunks by entity, rules, limits and statistics."""
    stats = graph.statistics(chunks).first().asDict()
    layer = F.array_position(F.array(*map(F.lit, _LAYERS)), F.col("type"))
    order = [F.col("layer"), F.col("source"), F.col("target"), F.col("value")]
    edges = graph.edges(chunks).select(layer.alias("layer"), "source", "target", F.to_json(F.struct("type", "source", "target", "metadata")).alias("value"))
    postings = storage.stored(graph.entity_postings(chunks))
    limits = storage.stored(graph.limit_postings(chunks))
    entities = {}
    for kind, value, *_ in V.ENTITIES:
        entities.setdefault(kind, []).append(value)
    by_entity, limit_rows = {}, []
    if stats["total_entity_values"] <= INLINE:
        for r in postings.orderBy("entity", "block").collect():
            by_entity.setdefault(r["entity"], []).extend(r["items"])
        found = {"sections_by_entity": by_entity}
    else:
        found = _listed(postings.withColumn("value", F.to_json(F.struct("entity", "block", "items"))), ["entity", "block"], "value", folder, "sections_by_entity", INLINE + 1)
    size = limits.agg(F.coalesce(F.sum(F.size("items")), F.lit(0))).first()[0]
    if size <= INLINE:
        by: dict[tuple, dict] = {}
        for r in limits.orderBy("metric", "value", "operator", "unit", "kind", "block").collect():
            own = by.setdefault((r["metric"], r["operator"], r["value"], r["unit"]), {**{n: r[n] for n in graph.LIMIT}, "conditions": [], "source_sections": []})
            own["conditions" if r["kind"] == "condition" else "source_sections"].extend(r["items"])
        limit_rows = list(by.values())
        stated = {"numeric_constraints": limit_rows}
    else:
        stated = _listed(limits.withColumn("json", F.to_json(F.struct(*graph.LIMIT, "kind", "block", "items"))), [*graph.LIMIT, "kind", "block"], "json", folder, "numeric_constraints", INLINE + 1)
    return {
        "version": VERSION,
        "entity_types": {k: {"values": sorted(v), "count": len(v)} for k, v in entities.items()},
        **_listed(edges, order, "value", folder, "edges", stats["total_edges"]),
        **found,
        "implication_rules": [{"if": a, "then": k, "target": b, "description": d} for a, k, b, d in V.IMPLICATIONS],
        **stated,
        "stats": {n: stats[n] for n in ("total_edges", "total_entity_values", "total_constraints")},
    }


def write_ontology(chunks: DataFrame, folder: str) -> None:
    """Write ``folder``/ontology.json; ``chunks`` should be a table on disk."""
    storage.write_text(chunks.sparkSession, f"{folder}/ontology.json", json.dumps(ontology_document(chunks, folder), indent=2))


def read_document(spark: SparkSession, path: str) -> dict:
    """A document as it was written; {} where there is none or it is corrupt."""
    try:
        return json.loads(storage.read_text(spark, path)) if storage.exists(spark, path) else {}
    except ValueError:
        return {}
