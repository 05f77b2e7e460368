"""Registry of the queries of the guide engine and of their SQL, by operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import text as T
from ..functions import vocabulary as V
from ..operators import chunking, graph, linking
from ..sources import storage
from . import enrich, guide
from . import oracle as O

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        _QUERIES[name] = f
        if sql:
            _SQL[name] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import catalog_more  # noqa: F401  registers the rest

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import catalog_more  # noqa: F401

    return dict(_SQL)


def sections(spark: SparkSession, sf: str) -> DataFrame:
    return guide.sections(spark, sf)


def headed(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks by headings alone."""
    return chunking.chunked(sections(spark, sf), chunking.by_headings(F.col("body")))


def with_entities(spark: SparkSession, sf: str) -> DataFrame:
    return headed(spark, sf).withColumn("entities", R.entities(F.col("content")))


def with_limits(spark: SparkSession, sf: str) -> DataFrame:
    return with_entities(spark, sf).withColumn("numeric_constraints", R.constraints(F.col("content"), F.col("entities")))


def with_references(spark: SparkSession, sf: str) -> DataFrame:
    return headed(spark, sf).withColumn("conditional_refs", R.conditional_references(F.col("content"), F.col("section_code")))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


ID = ["section_id", "seq"]
c = F.col


# --- Scalars ---------------------------------------------------------------------------------------

@query("htm_16_word_count", rf"SELECT section_id, CAST({O.words('body')} AS BIGINT) AS word_count FROM ({guide.SECTIONS_SQL})")
def _(spark, sf):
    return sections(spark, sf).select("section_id", T.word_count(c("body")).alias("word_count"))


@query("scl_01_slugify", f"SELECT section_id, {O.slug('title')} AS slug FROM ({guide.SECTIONS_SQL})")
def _(spark, sf):
    return sections(spark, sf).select("section_id", T.slugify(c("title")).alias("slug"))


@query("scl_02_safe_path", r"SELECT page_id, coalesce(nullif(replace(replace(replace(url, '..', ''), '/', ''), '\', ''), ''), '_unknown') AS safe FROM pages")
def _(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet").select("page_id", T.safe_path_component(c("url")).alias("safe"))


_PATH = f"CASE WHEN source = 'fannie_mae' THEN 'part_' || lower(left(section_code, 1)) || '/' || lower(section_code) || '_' || {O.slug('title')} || '.md' ELSE 'chapter_' || split_part(section_code, '.', 1) || '/' || section_code || '_' || {O.slug('title')} || '.md' END"


@query("scl_03_output_path", f"SELECT section_id, {_PATH} AS path FROM ({guide.SECTIONS_SQL})")
def _(spark, sf):
    path = T.output_path(c("source"), c("section_code"), c("title"), F.substring("section_code", 1, 1), F.split_part(c("section_code"), F.lit("."), F.lit(1)))
    return sections(spark, sf).select("section_id", path.alias("path"))


@query("scl_04_path_from_code", f"SELECT section_id, CASE WHEN source = 'fannie_mae' THEN 'part_' || lower(left(section_code, 1)) || '/' || lower(section_code) ELSE 'chapter_' || split_part(section_code, '.', 1) || '/' || section_code END AS prefix FROM ({guide.SECTIONS_SQL})")
def _(spark, sf):
    return sections(spark, sf).select("section_id", T.path_prefix(c("source"), c("section_code")).alias("prefix"))


_HIER = "SELECT section_id, CASE WHEN section_id % 3 = 0 THEN '' ELSE 'Part ' || left(section_code, 1) END AS part_name, CASE WHEN section_id % 4 = 0 THEN 'Limits' ELSE '' END AS chapter_name, CASE WHEN section_id % 2 = 0 THEN split_part(section_code, '-', 1) ELSE '' END AS chapter, CASE WHEN section_id % 5 = 0 THEN title ELSE '' END AS subpart_name, CASE WHEN section_id % 7 = 0 THEN 's' || section_id ELSE '' END AS subpart, section_code FROM "


def _hierarchy(spark, sf):
    parts = _HIER.removeprefix("SELECT ").removesuffix(" FROM ")
    return sections(spark, sf).selectExpr(*[p if p.startswith("CASE") or " " not in p else p for p in _split_top(parts)])


def _split_top(expressions: str) -> list[str]:
    """Cut a select list at its top-level commas."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(expressions):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(expressions[start:i].strip())
            start = i + 1
    return [*out, expressions[start:].strip()]


@query("scl_05_hierarchy_path", f"SELECT section_id, coalesce(nullif(concat_ws(' > ', nullif(part_name, ''), coalesce(nullif(chapter_name, ''), 'Chapter ' || nullif(chapter, '')), nullif(subpart_name, '')), ''), section_code) AS path FROM ({_HIER} ({guide.SECTIONS_SQL}))")
def _(spark, sf):
    path = T.hierarchy_path(c("part_name"), c("chapter_name"), c("chapter"), c("subpart_name"), c("section_code"))
    return _hierarchy(spark, sf).select("section_id", path.alias("path"))


@query("scl_06_semantic_path", f"SELECT section_id, concat_ws(' > ', nullif(part_name, ''), coalesce(nullif(chapter_name, ''), 'Chapter ' || nullif(chapter, '')), coalesce(nullif(subpart_name, ''), 'Section ' || nullif(subpart, '')), section_code) AS path FROM ({_HIER} ({guide.SECTIONS_SQL}))")
def _(spark, sf):
    path = T.semantic_path(c("part_name"), c("chapter_name"), c("chapter"), c("subpart_name"), c("subpart"), c("section_code"))
    return _hierarchy(spark, sf).select("section_id", path.alias("path"))


_SUMMARY = "section_code || ' (' || title || ') covers ' || array_to_string(list_transform(list_slice(domains, 1, 3), lambda d: replace(string_split(d, '.')[-1], '_', ' ')), ', ') || '. Key topics: ' || CASE WHEN len(terms) > 0 THEN array_to_string(list_slice(terms, 1, 5), ', ') ELSE 'general guidelines' END || '.'"


@query("scl_07_summary", f"{O.WITH_SECTIONS}, t AS (SELECT *, {O.domains()} AS domains, {O.listed(O.term_list('body'))} AS terms FROM sections), s AS (SELECT section_id, {_SUMMARY} AS text FROM t) SELECT section_id, CASE WHEN length(text) > 200 THEN left(text, 197) || '...' ELSE text END AS summary FROM s")
def _(spark, sf):
    tagged = sections(spark, sf).select("*", R.domains(c("source"), c("section_code"), c("body")).alias("domains"), R.terms(c("body")).alias("terms"))
    return tagged.select("section_id", T.summary(c("section_code"), c("title"), c("domains"), c("terms")).alias("summary"))


@query("scl_08_content_hash", "SELECT doc_id, sha256(text) AS hash FROM documents")
def _(spark, sf):
    return documents(spark, sf).select("doc_id", T.content_hash(c("text")).alias("hash"))


@query("scl_14_context_prefix", f"{O.WITH_CHUNKS} SELECT section_id, seq, '*Section: ' || section_code || '*' || chr(10) || CASE WHEN heading IS NOT NULL THEN '*Subsection: ' || heading || '*' || chr(10) ELSE '' END || chr(10) AS prefix FROM chunks")
def _(spark, sf):
    return headed(spark, sf).select(*ID[:1], c("seq").cast("long").alias("seq"), T.context_prefix(c("section_code"), c("heading")).alias("prefix"))


# --- Chunks ----------------------------------------------------------------------------------------

@query("chk_02_split_headings", f"{O.WITH_CHUNKS} SELECT section_id, seq, heading, content FROM chunks")
def _(spark, sf):
    return headed(spark, sf).select("section_id", c("seq").cast("long").alias("seq"), "heading", "content")


@query("chk_06_chunk_metadata", rf"{O.WITH_CHUNKS} SELECT section_id, seq, CAST({O.words('content')} AS BIGINT) AS word_count, regexp_matches(content, '\|.*\|.*\|') AS has_table FROM chunks")
def _(spark, sf):
    return headed(spark, sf).select("section_id", c("seq").cast("long").alias("seq"), "word_count", "has_table")


@query("chk_09_chunk_id", f"{O.WITH_CHUNKS} SELECT section_id, seq, chunk_id FROM chunks")
def _(spark, sf):
    return headed(spark, sf).select("section_id", c("seq").cast("long").alias("seq"), "chunk_id")


@query("chk_10_chunk_filename", f"{O.WITH_CHUNKS}, n AS (SELECT section_id, seq, chunk_id, row_number() OVER (PARTITION BY chunk_id ORDER BY section_id, seq) AS k FROM chunks) SELECT section_id, seq, replace(chunk_id, '/', '_') || CASE WHEN k > 1 THEN '_' || k ELSE '' END || '.txt' AS filename FROM n")
def _(spark, sf):
    from pyspark.sql import Window

    from ..sources import exports

    name = exports.chunk_filename(c("chunk_id"), F.row_number().over(Window.partitionBy("chunk_id").orderBy(*ID)))
    return headed(spark, sf).select("section_id", c("seq").cast("long").alias("seq"), name.alias("filename"))


@query("chk_01_adaptive_chunks", f"{O.WITH_ADAPTIVE} SELECT section_id, seq, heading, content, CAST({O.words('content')} AS BIGINT) AS word_count FROM chunks")
def _(spark, sf):
    tagged = enrich.tagged_sections(sections(spark, sf))
    return chunking.chunked(tagged, chunking.adaptive(c("body"), c("content_type"))).select("section_id", c("seq").cast("long").alias("seq"), "heading", "content", "word_count")


_PARAGRAPHS = rf"""WITH RECURSIVE t AS (
  SELECT doc_id, {O.any_strip("'## Text' || chr(10) || chr(10) || replace(text, chr(10), chr(10) || chr(10))")} AS content FROM documents WHERE text IS NOT NULL
), marked AS (
  SELECT *, {O.any_words('content')} > 800 AND NOT regexp_matches(content, '\|.*\|.*\|') AS long FROM t
), listed AS (
  SELECT doc_id, regexp_split_to_array(content, '\n\n+') AS ps FROM marked WHERE long
), pieces AS (
  SELECT doc_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS k FROM listed
), counted AS (
  SELECT *, {O.any_words('p')} AS words FROM pieces
), fold AS (
  SELECT doc_id, k, 0 AS run, words AS n FROM counted WHERE k = 1
  UNION ALL
  SELECT c.doc_id, c.k, CASE WHEN f.n + c.words > 800 THEN f.run + 1 ELSE f.run END, CASE WHEN f.n + c.words > 800 THEN c.words ELSE f.n + c.words END FROM fold f JOIN counted c ON c.doc_id = f.doc_id AND c.k = f.k + 1
)"""


@query(
    "chk_04_split_oversize",
    f"{_PARAGRAPHS} SELECT doc_id, 0 AS seq, 'Text' AS heading, content FROM marked WHERE NOT long UNION ALL SELECT doc_id, run, 'Text', {O.any_strip('string_agg(p, chr(10) || chr(10) ORDER BY k)')} FROM counted JOIN fold USING (doc_id, k) GROUP BY doc_id, run",
)
def _(spark, sf):
    text = F.concat(F.lit("## Text\n\n"), F.replace(c("text"), F.lit("\n"), F.lit("\n\n")))
    docs = documents(spark, sf).select("doc_id", chunking.split_oversize(chunking.by_headings(text)).alias("chunks"))
    return docs.select("doc_id", F.posexplode("chunks").alias("seq", "chunk")).select("doc_id", "seq", "chunk.heading", "chunk.content")


# --- Classification and tags -----------------------------------------------------------------------

@query("cls_01_content_type", f"{O.WITH_SECTIONS} SELECT section_id, {O.content_type()} AS content_type FROM sections")
def _(spark, sf):
    kind = R.content_type(c("source"), c("section_code"), c("title"), c("body"), c("has_tables"))
    return sections(spark, sf).select("section_id", kind.alias("content_type"))


@query("cls_02_severity", f"{O.WITH_CHUNKS} SELECT section_id, seq, {O.severity('content')} AS severity FROM chunks")
def _(spark, sf):
    return headed(spark, sf).select("section_id", c("seq").cast("long").alias("seq"), R.severity(c("content")).alias("severity"))


_SIGNALS = O.listed([(f"{k}:{p}", O.matches("content", p)) for k, ps in V.SEVERITY_SIGNALS for p in ps])


@query("cls_03_severity_signals", f"{O.WITH_CHUNKS} SELECT section_id, seq, array_to_string(list_slice({_SIGNALS}, 1, 10), ' ; ') AS signals FROM chunks")
def _(spark, sf):
    return headed(spark, sf).select("section_id", c("seq").cast("long").alias("seq"), F.array_join(R.severity_signals(c("content")), " ; ").alias("signals"))


@query("cls_04_requirement_type", f"{O.WITH_CHUNKS} SELECT section_id, seq, {O.requirement('content')} AS requirement_type FROM chunks")
def _(spark, sf):
    return headed(spark, sf).select("section_id", c("seq").cast("long").alias("seq"), R.requirement_type(c("content")).alias("requirement_type"))


@query("tag_01_prefix_domains", f"{O.WITH_SECTIONS} SELECT section_id, array_to_string({O.prefix_domains('section_code')}, ',') AS domains FROM sections")
def _(spark, sf):
    return sections(spark, sf).select("section_id", F.array_join(R.prefix_domains(c("section_code")), ",").alias("domains"))


@query("tag_02_range_domains", f"{O.WITH_SECTIONS} SELECT section_id, array_to_string({O.range_domains('section_code')}, ',') AS domains FROM sections")
def _(spark, sf):
    return sections(spark, sf).select("section_id", F.array_join(R.range_domains(c("section_code")), ",").alias("domains"))


@query("tag_03_keyword_domains", f"{O.WITH_SECTIONS} SELECT section_id, array_to_string({O.keyword_domains('body')}, ',') AS domains FROM sections")
def _(spark, sf):
    return sections(spark, sf).select("section_id", F.array_join(R.keyword_domains(c("body")), ",").alias("domains"))


@query("tag_04_domains", f"{O.WITH_SECTIONS} SELECT section_id, array_to_string({O.domains()}, ',') AS domains FROM sections")
def _(spark, sf):
    return sections(spark, sf).select("section_id", F.array_join(R.domains(c("source"), c("section_code"), c("body")), ",").alias("domains"))


_ENUMS = O.listed([(f"{e}.{v}", O.matches("body", p)) for e, v, p in V.ENUMERATIONS])


@query("ext_01_enumerations", f"{O.WITH_SECTIONS} SELECT section_id, array_to_string({_ENUMS}, ',') AS enumerations FROM sections")
def _(spark, sf):
    return sections(spark, sf).select("section_id", F.array_join(R.enumerations(c("body")), ",").alias("enumerations"))


@query("ext_03_terms", f"{O.WITH_CHUNKS} SELECT section_id, seq, array_to_string({O.listed(O.term_list('content'))}, ',') AS terms FROM chunks")
def _(spark, sf):
    return headed(spark, sf).select("section_id", c("seq").cast("long").alias("seq"), F.array_join(R.terms(c("content")), ",").alias("terms"))


@query("ext_04_entities", f"{O.WITH_ENTITIES} SELECT section_id, seq, array_to_string(entities, ',') AS entities FROM tagged")
def _(spark, sf):
    return with_entities(spark, sf).select("section_id", c("seq").cast("long").alias("seq"), F.array_join("entities", ",").alias("entities"))


@query("ext_05_constraints", f"{O.WITH_LIMITS} SELECT section_id, seq, k, metric, operator, value, unit, source_text FROM limits")
def _(spark, sf):
    rows = with_limits(spark, sf).select("section_id", c("seq").cast("long").alias("seq"), F.posexplode("numeric_constraints").alias("k", "x"))
    return rows.select("section_id", "seq", c("k").cast("long").alias("k"), "x.metric", "x.operator", "x.value", "x.unit", "x.source_text")


@query("ext_09_conditions", f"{O.WITH_LIMITS} SELECT section_id, seq, k, condition FROM scoped")
def _(spark, sf):
    rows = with_limits(spark, sf).select("section_id", c("seq").cast("long").alias("seq"), F.posexplode("numeric_constraints").alias("k", "x"))
    return rows.select("section_id", "seq", c("k").cast("long").alias("k"), F.explode("x.conditions").alias("condition"))


@query("ext_10_conditional_references", f"{O.WITH_REFERENCES} SELECT section_id, seq, if_entity, t AS then_see FROM resolved")
def _(spark, sf):
    rows = with_references(spark, sf).select("section_id", c("seq").cast("long").alias("seq"), F.explode("conditional_refs").alias("r"))
    return rows.select("section_id", "seq", "r.if_entity", "r.then_see")


# --- Joins -----------------------------------------------------------------------------------------

@query("jon_01_first_to_map", f"{O.WITH_LINKS} SELECT source, section_code, ord FROM first_map")
def _(spark, sf):
    return linking.first_to_map(sections(spark, sf)).select("source", "section_code", "ord")


@query("jon_02_map_to_second", f"{O.WITH_LINKS} SELECT ord, topic, relationship, target FROM to_second")
def _(spark, sf):
    return linking.map_to_second(sections(spark, sf))


@query("jon_03_second_to_map", f"{O.WITH_LINKS} SELECT source, section_code, ord FROM second_map")
def _(spark, sf):
    return linking.second_to_map(sections(spark, sf)).select("source", "section_code", "ord")


@query("jon_04_map_to_first", f"{O.WITH_LINKS} SELECT ord, topic, relationship, target FROM to_first")
def _(spark, sf):
    return linking.map_to_first(sections(spark, sf))


@query("jon_05_links", f"{O.WITH_LINKS} SELECT source, section_code, ord, link_source, link_code, topic, relationship FROM links")
def _(spark, sf):
    return linking.links(sections(spark, sf))


@query("jon_05_section_map", f"{O.WITH_LINKS}, both_maps AS (SELECT DISTINCT source, section_code, ord FROM first_map UNION SELECT DISTINCT source, section_code, ord FROM second_map) SELECT source, section_code, string_agg(CAST(ord AS VARCHAR), ',' ORDER BY ord) AS ords FROM both_maps GROUP BY ALL")
def _(spark, sf):
    return linking.section_map(sections(spark, sf)).select("source", "section_code", F.array_join("ords", ",").alias("ords"))


@query("jon_05_targets", f"{O.WITH_LINKS}, t AS (SELECT 'fannie_mae' AS source, ord, 'freddie_mac' AS link_source, topic, relationship, target FROM to_second UNION ALL SELECT 'freddie_mac', ord, 'fannie_mae', topic, relationship, target FROM to_first), n AS (SELECT *, row_number() OVER (PARTITION BY source, ord ORDER BY target) - 1 AS n FROM t) SELECT source, ord, link_source, topic, relationship, n // {linking.BLOCK} AS block, string_agg(target, ',' ORDER BY n) AS codes FROM n GROUP BY ALL")
def _(spark, sf):
    return linking.targets(sections(spark, sf)).withColumn("codes", F.array_join("codes", ","))


@query("jon_11_entity_intersection", f"{O.WITH_ENTITIES} SELECT chunk_id FROM found WHERE entity IN ('property_types.Condo', 'asset_types.MutualFunds') GROUP BY chunk_id HAVING count(DISTINCT entity) = 2")
def _(spark, sf):
    return graph.intersection(with_entities(spark, sf), ["property_types.Condo", "asset_types.MutualFunds"])


@query("jon_12_point_lookup", f"{O.WITH_SECTIONS} SELECT section_id, section_code FROM sections WHERE upper(section_code) = 'B3-5-03' ORDER BY section_id LIMIT 1")
def _(spark, sf):
    return sections(spark, sf).filter(F.upper("section_code") == "B3-5-03").orderBy("section_id").limit(1).select("section_id", "section_code")


# --- Aggregations ----------------------------------------------------------------------------------

@query("agg_01_domain_distribution", f"{O.WITH_SECTIONS}, d AS (SELECT unnest({O.domains()}) AS domain FROM sections) SELECT domain, count(*) AS n FROM d GROUP BY domain")
def _(spark, sf):
    tagged = sections(spark, sf).select(F.explode(R.domains(c("source"), c("section_code"), c("body"))).alias("domain"))
    return tagged.groupBy("domain").agg(F.count(F.lit(1)).alias("n"))


@query("agg_02_content_types", f"{O.WITH_SECTIONS} SELECT {O.content_type()} AS content_type, count(*) AS n FROM sections GROUP BY 1")
def _(spark, sf):
    kind = R.content_type(c("source"), c("section_code"), c("title"), c("body"), c("has_tables"))
    return sections(spark, sf).groupBy(kind.alias("content_type")).agg(F.count(F.lit(1)).alias("n"))


@query("agg_03_entity_distribution", f"{O.WITH_ENTITIES} SELECT entity, count(*) AS n FROM found GROUP BY entity")
def _(spark, sf):
    return with_entities(spark, sf).select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n"))


@query("agg_04_severity_distribution", f"{O.WITH_CHUNKS} SELECT {O.severity('content')} AS severity, count(*) AS n FROM chunks GROUP BY 1")
def _(spark, sf):
    return headed(spark, sf).groupBy(R.severity(c("content")).alias("severity")).agg(F.count(F.lit(1)).alias("n"))


@query("agg_05_totals", rf"{O.WITH_LIMITS}{O.WITH_LINKS.removeprefix(O.WITH_SECTIONS)} SELECT (SELECT count(*) FROM sections) AS sections, count(*) AS chunks, (SELECT count(*) FROM limits) AS constraints, CAST(sum({O.words('content')}) // count(*) AS BIGINT) AS avg_words, (SELECT count(*) FROM chunks JOIN (SELECT DISTINCT * FROM links) l USING (source, section_code)) AS cross_source_links FROM chunks")
def _(spark, sf):
    rows = with_limits(spark, sf).join(linking.link_counts(sections(spark, sf)), ["source", "section_code"], "left")
    return rows.agg(
        F.count_distinct("section_id").alias("sections"), F.count(F.lit(1)).alias("chunks"), F.sum(F.size("numeric_constraints")).alias("constraints"), F.floor(F.sum("word_count") / F.count(F.lit(1))).alias("avg_words"),
        F.sum(F.coalesce("links", F.lit(0))).alias("cross_source_links"),
    )


@query("agg_06_reverse_index", f"{O.WITH_ENTITIES}, f AS (SELECT entity, chunk_id, min(section_id * 1000 + seq) AS place FROM found GROUP BY ALL), p AS (SELECT entity, chunk_id, row_number() OVER (PARTITION BY entity ORDER BY place, chunk_id) - 1 AS n FROM f) SELECT entity, n // {graph.BLOCK} AS block, string_agg(chunk_id, ',' ORDER BY n) AS chunk_ids FROM p GROUP BY ALL")
def _(spark, sf):
    return graph.entity_postings(with_entities(spark, sf)).select("entity", "block", F.array_join("items", ",").alias("chunk_ids"))


@query(
    "agg_07_limits",
    f"{O.WITH_LIMITS}, s AS (SELECT metric, operator, value, unit, section_code, min(section_id * 1000000 + seq * 1000 + k) AS place FROM limits GROUP BY ALL), s2 AS (SELECT *, row_number() OVER (PARTITION BY metric, operator, value, unit ORDER BY place) - 1 AS n FROM s), "
    "d AS (SELECT DISTINCT metric, operator, value, unit, condition FROM scoped) "
    f"SELECT metric, operator, value, unit, 'section' AS kind, n // {graph.BLOCK} AS block, string_agg(section_code, ',' ORDER BY n) AS items FROM s2 GROUP BY ALL "
    "UNION ALL SELECT metric, operator, value, unit, 'condition', 0, string_agg(condition, ',' ORDER BY condition) FROM d GROUP BY ALL",
)
def _(spark, sf):
    rows = graph.limit_postings(with_limits(spark, sf))
    # The vocabulary has fewer conditions than a block; among them the order is by name here.
    items = F.when(c("kind") == "condition", F.array_sort("items")).otherwise(c("items"))
    return rows.select("metric", "operator", "value", "unit", "kind", "block", F.array_join(items, ",").alias("items"))


@query("agg_09_vocabulary", "SELECT * FROM (VALUES " + ", ".join(f"({O.quote(k)}, {O.quote(','.join(sorted(v for t, v, *_ in V.ENTITIES if t == k)))}, CAST({sum(t == k for t, *_ in V.ENTITIES)} AS BIGINT))" for k in dict.fromkeys(t for t, *_ in V.ENTITIES)) + ") AS t(entity_type, vals, n)")
def _(spark, sf):
    return graph.vocabulary_table(spark).select("entity_type", F.array_join("vals", ",").alias("vals"), "n")


# --- Graph -----------------------------------------------------------------------------------------

@query("grf_01_applies_to", f"{O.WITH_ENTITIES} SELECT 'APPLIES_TO' AS type, chunk_id AS source, entity AS target FROM found")
def _(spark, sf):
    return graph.applies_to(with_entities(spark, sf)).drop("metadata")


@query("grf_02_conditional", f"{O.WITH_REFERENCES} SELECT 'CONDITIONAL' AS type, chunk_id AS source, t AS target, if_entity FROM resolved")
def _(spark, sf):
    return graph.conditional(with_references(spark, sf)).select("type", "source", "target", c("metadata")["if_entity"].alias("if_entity"))


@query("grf_03_implies", "SELECT 'IMPLIES' AS type, * FROM (VALUES " + ", ".join(f"({', '.join(map(O.quote, (e, g, k, d)))})" for e, k, g, d in V.IMPLICATIONS) + ") AS t(source, target, relationship, description)")
def _(spark, sf):
    return graph.implies(spark).select("type", "source", "target", c("metadata")["relationship"].alias("relationship"), c("metadata")["description"].alias("description"))


@query("grf_04_constrains", f"{O.WITH_LIMITS} SELECT 'CONSTRAINS' AS type, condition AS source, metric || ' ' || operator || ' ' || value || unit AS target, chunk_id, source_text FROM scoped")
def _(spark, sf):
    return graph.constrains(with_limits(spark, sf)).select("type", "source", "target", c("metadata")["chunk_id"].alias("chunk_id"), c("metadata")["source_text"].alias("source_text"))


def graph_chunks(own: DataFrame) -> DataFrame:
    """What the graph needs of the chunks, worked out once."""
    return storage.stored(enrich.tagged_chunks(own).select(*graph.ORDER, "chunk_id", "source", "section_code", "entities", "conditional_refs", "numeric_constraints"))


_EQUIVALENT = f"""{O.WITH_LINKS}, seen AS (
  SELECT s.section_id, l.*, least(l.section_code, l.link_code) AS lo, greatest(l.section_code, l.link_code) AS hi,
    row_number() OVER (PARTITION BY least(l.section_code, l.link_code), greatest(l.section_code, l.link_code) ORDER BY s.section_id, l.ord, l.link_code) AS n
  FROM sections s JOIN (SELECT DISTINCT * FROM links) l USING (source, section_code)
) SELECT 'EQUIVALENT' AS type, source || '/' || section_code AS source, link_source || '/' || link_code AS target, topic, relationship FROM seen WHERE n = 1"""


@query("grf_05_equivalent", _EQUIVALENT)
def _(spark, sf):
    own = sections(spark, sf)
    rows = own.withColumn("seq", F.lit(0))
    return graph.equivalent(rows, linking.link_lists(own)).select("type", "source", "target", c("metadata")["topic"].alias("topic"), c("metadata")["relationship"].alias("relationship"))


@query(
    "grf_06_edges",
    f"{O.WITH_ENRICHED}, seen AS (SELECT l.*, row_number() OVER (PARTITION BY least(l.section_code, l.link_code), greatest(l.section_code, l.link_code) ORDER BY s.section_id, l.ord, l.link_code) AS n FROM sections s JOIN (SELECT DISTINCT * FROM links) l USING (source, section_code)) "
    "SELECT 'APPLIES_TO' AS type, chunk_id AS source, entity AS target FROM found UNION ALL SELECT 'CONDITIONAL', chunk_id, t FROM resolved UNION ALL SELECT 'CONSTRAINS', condition, metric || ' ' || operator || ' ' || value || unit FROM scoped "
    "UNION ALL SELECT 'EQUIVALENT', source || '/' || section_code, link_source || '/' || link_code FROM seen WHERE n = 1 UNION ALL SELECT 'IMPLIES', * FROM (VALUES " + ", ".join(f"({O.quote(e)}, {O.quote(g)})" for e, _, g, _ in V.IMPLICATIONS) + ")",
)
def _(spark, sf):
    own = sections(spark, sf)
    return graph.edges(graph_chunks(own), linking.link_lists(own)).select("type", "source", "target")


@query(
    "agg_08_ontology_statistics",
    f"{O.WITH_ENRICHED}, pairs AS (SELECT DISTINCT least(section_code, link_code) AS lo, greatest(section_code, link_code) AS hi FROM links) "
    f"SELECT (SELECT count(*) FROM found) + (SELECT count(*) FROM resolved) + (SELECT count(*) FROM scoped) + (SELECT count(*) FROM pairs) + {len(V.IMPLICATIONS)} AS total_edges, "
    "(SELECT count(*) FROM (SELECT DISTINCT entity, chunk_id FROM found)) AS total_entity_values, (SELECT count(*) FROM (SELECT DISTINCT metric, operator, value, unit FROM limits)) AS total_constraints",
)
def _(spark, sf):
    own = sections(spark, sf)
    return graph.statistics(graph_chunks(own), linking.link_lists(own))
