"""More queries: sources, page analysis, crawl analytics, ordering, set operations and the model pass."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import answers, crawl, model_pass, ranking
from ..operators.answer_cache import AnswerCache, cache_key
from ..sources import pages as P
from ..sources import sitemaps, storage
from . import catalog as C
from . import guide
from . import oracle as O
from .catalog import c, query


def pages(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet")


def events(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet")


def orders(spark, sf):
    return spark.read.parquet(f"{sf}/orders.parquet")


# --- Sources and addresses -------------------------------------------------------------------------

_CODES = "SELECT section_id, CASE WHEN source = 'fannie_mae' THEN 'https://guide.example.com/sel/' || lower(section_code) || CASE WHEN section_id % 2 = 0 THEN '/' || title ELSE '' END ELSE 'http' || CASE WHEN section_id % 3 = 0 THEN '' ELSE 's' END || '://rules.example.com/app/guide/section/' || section_code END AS url FROM "


def addresses(spark, sf):
    parts = C._split_top(_CODES.removeprefix("SELECT ").removesuffix(" FROM "))
    return C.sections(spark, sf).selectExpr(*parts)


_URLS = f"{_CODES} ({guide.SECTIONS_SQL})"


@query("src_03_discover_codes", f"{O.WITH_SECTIONS} SELECT DISTINCT source, section_code FROM sections WHERE section_code <> ''")
def _(spark, sf):
    return C.sections(spark, sf).filter("section_code <> ''").select("source", "section_code").distinct()


@query("src_04_source_filter", f"{O.WITH_SECTIONS} SELECT section_id FROM sections WHERE source = 'freddie_mac'")
def _(spark, sf):
    return sitemaps.of_source(C.sections(spark, sf), "freddie-mac").select("section_id")


@query("src_07_toc_fallback", f"{O.WITH_SECTIONS}, site AS (SELECT DISTINCT section_code FROM sections WHERE section_id % 2 = 0), toc AS (SELECT section_code, min(section_id) AS section_id FROM sections WHERE source = 'fannie_mae' GROUP BY section_code) SELECT section_code, 'sitemap' AS origin FROM site UNION ALL SELECT section_code, 'toc' FROM toc WHERE section_code NOT IN (SELECT section_code FROM site)")
def _(spark, sf):
    every = C.sections(spark, sf)
    site = every.filter("section_id % 2 = 0").select("section_code").distinct()
    toc = every.filter("source = 'fannie_mae'").select("section_code", c("section_id").alias("place"))
    return sitemaps.with_fallback(site, toc, "section_code", "place")


@query("src_08_second_guide_urls", rf"WITH u AS ({_URLS}) SELECT section_id, regexp_extract(url, '/section/([0-9]+(?:\.[0-9]+)?)', 1) AS code FROM u WHERE contains(url, '/app/guide/section/') AND starts_with(url, 'https://rules.example.com/') AND regexp_matches(url, '/section/[0-9]+')")
def _(spark, sf):
    return sitemaps.second_guide(addresses(spark, sf), "rules.example.com").select("section_id", "code")


@query("src_09_section_code", r"WITH u AS (" + _URLS + r"), x AS (SELECT section_id, upper(coalesce(nullif(regexp_extract(url, '/sel/([^/]+)/', 1), ''), nullif(regexp_extract(url, '/sel/([^/]+)$', 1), ''))) AS code FROM u) SELECT section_id, CASE WHEN regexp_matches(code, '^[A-E]') THEN code END AS code FROM x")
def _(spark, sf):
    return addresses(spark, sf).select("section_id", sitemaps.section_code(c("url")).alias("code"))


@query("src_10_slug", "SELECT page_id, string_split(rtrim(url, '/'), '/')[-1] AS slug FROM pages")
def _(spark, sf):
    return pages(spark, sf).select("page_id", sitemaps.url_slug(c("url")).alias("slug"))


@query("src_11_valid_url", f"WITH u AS ({_URLS}) SELECT section_id, starts_with(url, 'https://rules.example.com/') AS valid FROM u")
def _(spark, sf):
    return addresses(spark, sf).select("section_id", sitemaps.valid_url(c("url"), "rules.example.com").alias("valid"))


# --- Page analysis ---------------------------------------------------------------------------------

@query("htm_01_markdown")
def _(spark, sf):
    return pages(spark, sf).select("page_id", P.markdown(c("html")).alias("markdown"))


@query("htm_02_cross_reference_links", rf"WITH t AS (SELECT section_id, 'see [this](/app/guide/section/' || section_code || ') and [that](/sel/b3-' || (section_id % 9) || '/x)' AS text FROM ({guide.SECTIONS_SQL}) WHERE source = 'freddie_mac') SELECT section_id, regexp_replace(regexp_replace(text, '\[([^\]]+)\]\([^)]*/app/guide/section/([0-9.]+)[^)]*\)', '[\1](\2)', 'g'), '\(/sel/b3-([0-9])/x\)', '(B3-\1)', 'g') AS text FROM t")
def _(spark, sf):
    text = F.concat(F.lit("see [this](/app/guide/section/"), c("section_code"), F.lit(") and [that](/sel/b3-"), (c("section_id") % 9).cast("string"), F.lit("/x)"))
    return C.sections(spark, sf).filter("source = 'freddie_mac'").select("section_id", P.short_links(text).alias("text"))


#: The white space of Unicode without the line feed, as a character class.
_BLANK = r"\t\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_ENDS = rf"[{_BLANK}\n\x1c-\x1f]+"


@query("htm_03_white_space", rf"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '(?m)[{_BLANK}]+$', '', 'g'), '\n{{4,}}', chr(10) || chr(10) || chr(10), 'g'), '\A{_ENDS}', ''), '{_ENDS}\z', '') AS text FROM documents")
def _(spark, sf):
    return C.documents(spark, sf).select("doc_id", P.tidy(c("text")).alias("text"))


_DATED = f"SELECT section_id, CASE section_id % 4 WHEN 0 THEN 'Effective: ' || (1 + section_id % 12) || '/' || (1 + section_id % 28) || '/2023' WHEN 1 THEN 'Updated 13/40/2021 and 2/3/2022' WHEN 2 THEN 'on 7/9/2020 only' ELSE 'none' END AS text FROM ({guide.SECTIONS_SQL})"


def dated(spark, sf):
    d = "CASE section_id % 4 WHEN 0 THEN 'Effective: ' || (1 + section_id % 12) || '/' || (1 + section_id % 28) || '/2023' WHEN 1 THEN 'Updated 13/40/2021 and 2/3/2022' WHEN 2 THEN 'on 7/9/2020 only' ELSE 'none' END"
    return C.sections(spark, sf).selectExpr("section_id", f"{d} AS text")


@query("htm_08_effective_date", f"WITH t AS ({_DATED}) SELECT section_id, CASE section_id % 4 WHEN 0 THEN strftime(make_date(2023, CAST(1 + section_id % 12 AS INTEGER), CAST(1 + section_id % 28 AS INTEGER)), '%Y-%m-%d') WHEN 2 THEN '2020-07-09' END AS effective_date FROM t")
def _(spark, sf):
    return dated(spark, sf).select("section_id", P.effective_date(c("text"), anywhere=True).alias("effective_date"))


@query("htm_09_labelled_date", f"WITH t AS ({_DATED}) SELECT section_id, CASE section_id % 4 WHEN 0 THEN strftime(make_date(2023, CAST(1 + section_id % 12 AS INTEGER), CAST(1 + section_id % 28 AS INTEGER)), '%Y-%m-%d') END AS effective_date FROM t")
def _(spark, sf):
    return dated(spark, sf).select("section_id", P.effective_date(c("text"), anywhere=False).alias("effective_date"))


@query("htm_10_first_guide_hierarchy", r"WITH s AS (SELECT DISTINCT section_code FROM (" + guide.SECTIONS_SQL + r") WHERE source = 'fannie_mae') SELECT section_code, left(section_code, 1) AS part, CASE WHEN regexp_matches(section_code, '^[A-E]\d+-\d+\.\d+-\d+$') THEN regexp_extract(section_code, '^([A-E]\d+-\d+)\.', 1) WHEN regexp_matches(section_code, '^[A-E]\d*-\d+-\d+$') THEN regexp_extract(section_code, '^([A-E]\d*-\d+)-', 1) ELSE section_code END AS chapter, CASE WHEN regexp_matches(section_code, '^[A-E]\d+-\d+\.\d+-\d+$') THEN regexp_extract(section_code, '^([A-E]\d+-\d+\.\d+)-', 1) END AS subpart FROM s")
def _(spark, sf):
    own = C.sections(spark, sf).filter("source = 'fannie_mae'").select("section_code").distinct()
    part, chapter, subpart = P.code_hierarchy(c("section_code"))
    return own.select("section_code", part.alias("part"), chapter.alias("chapter"), subpart.alias("subpart"))


@query("htm_12_second_guide_hierarchy", f"WITH s AS (SELECT DISTINCT section_code, CAST(split_part(section_code, '.', 1) AS INTEGER) // 1000 AS k FROM ({guide.SECTIONS_SQL}) WHERE source = 'freddie_mac') SELECT section_code, split_part(section_code, '.', 1) AS chapter, CASE WHEN k BETWEEN 1 AND 6 THEN CAST(k AS VARCHAR) ELSE '' END AS part, CASE k WHEN 1 THEN 'General' WHEN 2 THEN 'Requirements' WHEN 3 THEN 'Underwriting' WHEN 4 THEN 'Origination' WHEN 5 THEN 'Special Programs' WHEN 6 THEN 'Quality Control' ELSE '' END AS part_name FROM s")
def _(spark, sf):
    from ..sources import section_pages

    part, name, chapter = section_pages.second_hierarchy(c("section_code"))
    own = C.sections(spark, sf).filter("source = 'freddie_mac'").select("section_code").distinct()
    return own.select("section_code", chapter.alias("chapter"), part.alias("part"), name.alias("part_name"))


@query("htm_14_lateral_links", """WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<a (?:[^>]* )?href="([^"]*)"', 1)) AS target, generate_subscripts(regexp_extract_all(html, '<a (?:[^>]* )?href="([^"]*)"', 1), 1) AS place FROM pages) SELECT page_id, CAST(place AS INTEGER) AS place, replace(target, '&amp;', '&') AS target FROM l""")
def _(spark, sf):
    from ..sources import page_parts

    return page_parts.parts(pages(spark, sf).select("page_id", "html")).filter("kind = 'link'").select("page_id", "place", "target")


@query("htm_13_lateral_headings", """WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, '<h([1-6])[ >]', 1)) AS level, generate_subscripts(regexp_extract_all(html, '<h([1-6])[ >]', 1), 1) AS place FROM pages) SELECT page_id, CAST(place AS INTEGER) AS place, CAST(level AS INTEGER) AS level FROM h""")
def _(spark, sf):
    from ..sources import page_parts

    return page_parts.parts(pages(spark, sf).select("page_id", "html")).filter("kind = 'heading'").select("page_id", "place", "level")


@query("htm_14_page_links")
def _(spark, sf):
    found = pages(spark, sf).select("page_id", F.posexplode(P.links(c("html"))).alias("place", "link"))
    once = found.groupBy("page_id", c("link.href").alias("href")).agg(F.min_by(F.struct("place", "link"), "place").alias("x"))
    return once.select("page_id", "href", "x.link.text", "x.place")


@query("htm_16_table_count", "SELECT page_id, CAST(len(regexp_extract_all(lower(html), '<table[ >]')) AS BIGINT) AS tables, CAST(len(regexp_extract_all(lower(html), '<li[ >]')) AS BIGINT) AS items FROM pages")
def _(spark, sf):
    low = F.lower("html")
    return pages(spark, sf).select("page_id", F.regexp_count(low, F.lit("<table[ >]")).cast("long").alias("tables"), F.regexp_count(low, F.lit("<li[ >]")).cast("long").alias("items"))


# --- Ordering, limits, windows, sets ---------------------------------------------------------------

@query("scl_09_sort_key", f"SELECT section_id, CASE WHEN TRY_CAST(split_part(section_code, '.', 1) AS INTEGER) IS NOT NULL AND TRY_CAST(split_part(section_code, '.', 2) AS INTEGER) IS NOT NULL THEN CAST(split_part(section_code, '.', 1) AS INTEGER) ELSE 0 END AS major, CASE WHEN TRY_CAST(split_part(section_code, '.', 1) AS INTEGER) IS NOT NULL AND TRY_CAST(split_part(section_code, '.', 2) AS INTEGER) IS NOT NULL THEN CAST(split_part(section_code, '.', 2) AS INTEGER) ELSE 0 END AS minor FROM ({guide.SECTIONS_SQL})")
def _(spark, sf):
    major, minor = T.sort_key(c("section_code"))
    return C.sections(spark, sf).select("section_id", major.alias("major"), minor.alias("minor"))


@query("scl_10_chapter_label", f"SELECT section_id, 'chapter_' || split_part(section_code, '.', 1) AS label FROM ({guide.SECTIONS_SQL}) WHERE source = 'freddie_mac'")
def _(spark, sf):
    return C.sections(spark, sf).filter("source = 'freddie_mac'").select("section_id", T.chapter_label(c("section_code")).alias("label"))


@query("srt_01_sort_codes", f"SELECT section_code, row_number() OVER (ORDER BY section_code) AS place FROM (SELECT DISTINCT section_code FROM ({guide.SECTIONS_SQL}) WHERE source = 'fannie_mae')")
def _(spark, sf):
    own = C.sections(spark, sf).filter("source = 'fannie_mae'").select("section_code").distinct()
    return ranking.ranked(own, [c("section_code")], "place")


@query("srt_02_numeric_sort", f"SELECT section_code, row_number() OVER (ORDER BY CAST(split_part(section_code, '.', 1) AS INTEGER), CAST(split_part(section_code, '.', 2) AS INTEGER)) AS place FROM (SELECT DISTINCT section_code FROM ({guide.SECTIONS_SQL}) WHERE source = 'freddie_mac')")
def _(spark, sf):
    own = C.sections(spark, sf).filter("source = 'freddie_mac'").select("section_code").distinct()
    return ranking.ranked(own, list(T.sort_key(c("section_code"))), "place")


@query("srt_03_sorted_distribution", f"{O.WITH_ENTITIES}, d AS (SELECT entity, count(*) AS n, min(section_id * 1000 + seq) AS first_seen FROM found GROUP BY entity) SELECT entity, n, row_number() OVER (ORDER BY n DESC, first_seen, entity) AS place FROM d")
def _(spark, sf):
    rows = C.with_entities(spark, sf).select("section_id", "seq", F.explode("entities").alias("entity"))
    counts = rows.groupBy("entity").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("section_id", "seq")).alias("seen"))
    return ranking.ranked(counts, [F.desc("n"), c("seen"), c("entity")], "place").drop("seen")


@query("lim_01_head_then_skip", "WITH head AS (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 100) SELECT o_orderkey FROM head WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def _(spark, sf):
    every = orders(spark, sf)
    done = every.filter("o_orderstatus = 'F'").select("o_orderkey")
    return crawl.frontier(every.select("o_orderkey"), done, "o_orderkey", 100)


@query("lim_03_file_caps", f"{O.WITH_LIMITS}, l AS (SELECT section_id, seq, string_agg(metric || operator || value || unit, '; ' ORDER BY k) FILTER (k < 5) AS constraints FROM limits GROUP BY ALL) SELECT section_id, seq, array_to_string(list_slice({O.listed(O.term_list('content'))}, 1, 15), ', ') AS terms, coalesce(constraints, '') AS constraints FROM chunks LEFT JOIN l USING (section_id, seq)")
def _(spark, sf):
    from ..functions import rules as R
    from ..sources import files

    rows = C.with_limits(spark, sf).withColumn("key_terms", R.terms(c("content")))
    limits = F.transform(files.shown("numeric_constraints"), lambda x: F.concat(x["metric"], x["operator"], x["value"], x["unit"]))
    return rows.select("section_id", c("seq").cast("long").alias("seq"), F.array_join(files.shown("key_terms"), ", ").alias("terms"), F.array_join(limits, "; ").alias("constraints"))


@query("lim_03_row_caps", f"{O.WITH_CHUNKS} SELECT section_id, seq, array_to_string(list_slice({O.listed(O.term_list('content'))}, 1, 3), ',') AS terms FROM chunks")
def _(spark, sf):
    from ..functions import rules as R

    return C.headed(spark, sf).select("section_id", c("seq").cast("long").alias("seq"), F.array_join(F.slice(R.terms(c("content")), 1, 3), ",").alias("terms"))


@query("lim_04_error_head", "SELECT event_id FROM events WHERE event_type = 'error' ORDER BY ts, event_id LIMIT 10")
def _(spark, sf):
    return events(spark, sf).filter("event_type = 'error'").orderBy("ts", "event_id").limit(10).select("event_id")


@query("win_01_failure_runs", "WITH g AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS grp FROM events) SELECT event_id, CASE WHEN event_type = 'error' THEN count(*) FILTER (event_type = 'error') OVER (PARTITION BY user_id, grp ORDER BY ts, event_id) ELSE 0 END AS run FROM g")
def _(spark, sf):
    rows = events(spark, sf).select("event_id", "user_id", "ts", (c("event_type") != "error").alias("ok"))
    return crawl.failure_runs(rows, "user_id", ["ts", "event_id"], "ok").select("event_id", "run")


#: Each user's requests one after the other: the delay, the run of errors and the trips at two in a row.
_FOLD = """WITH RECURSIVE e AS (
  SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, CASE event_type WHEN 'error' THEN 429 WHEN 'signup' THEN 503 ELSE 200 END AS code, event_type = 'error' AS bad FROM events
), fold AS (
  SELECT user_id, 0::BIGINT AS n, 1.0::DOUBLE AS delay, 0 AS good, 0 AS run, 0 AS trips FROM (SELECT DISTINCT user_id FROM e)
  UNION ALL
  SELECT f.user_id, e.n, CASE WHEN code IN (429, 503) THEN least(30.0::DOUBLE, delay * 2) WHEN good = 2 THEN greatest(1.0::DOUBLE, delay * 0.75::DOUBLE) ELSE delay END, CASE WHEN code IN (429, 503) OR good = 2 THEN 0 ELSE good + 1 END,
    CASE WHEN bad AND run = 0 THEN 1 ELSE 0 END, trips + CASE WHEN bad AND run = 1 THEN 1 ELSE 0 END
  FROM fold f JOIN e ON e.user_id = f.user_id AND e.n = f.n + 1
)"""


def status_of_event():
    return F.when(c("event_type") == "error", 429).when(c("event_type") == "signup", 503).otherwise(200)


@query("win_02_adaptive_delay", f"{_FOLD} SELECT user_id, arg_max(delay, n) AS delay FROM fold GROUP BY user_id")
def _(spark, sf):
    status = status_of_event()
    rows = events(spark, sf).select("user_id", "ts", "event_id", status.alias("status"))
    return crawl.adaptive_delays(rows, "user_id", ["ts", "event_id"], "status")


@query("win_02_stream_pace", f"{_FOLD} SELECT CAST(user_id AS VARCHAR) AS host, arg_max(delay, n) AS delay, CAST(arg_max(trips, n) AS BIGINT) AS trips FROM fold GROUP BY user_id")
def _(spark, sf):
    from ..streaming import pacing

    stream = spark.readStream.schema(events(spark, sf).schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    requests = stream.select(c("user_id").cast("string").alias("host"), c("ts").cast("timestamp").alias("at"), c("event_id").alias("id"), status_of_event().alias("status"), (c("event_type") != "error").alias("ok"))
    folder = storage.scratch_folder(spark)
    pacing.written(requests, f"{folder}/paced", f"{folder}/state", threshold=2)
    rows = spark.read.parquet(f"{folder}/paced").filter("kind = 'request'")
    return rows.groupBy("host").agg(F.max_by("delay", F.struct("at", "id")).alias("delay"), F.count_if("opened").alias("trips"))


@query("set_01_right_biased_merge", "SELECT coalesce(n.k, o.k) AS k, coalesce(n.h, o.h) AS h FROM (SELECT doc_id AS k, sha256(text) AS h FROM documents WHERE lang <> 'en') n FULL JOIN (SELECT doc_id AS k, lang AS h FROM documents) o ON n.k = o.k")
def _(spark, sf):
    docs = C.documents(spark, sf)
    new = docs.filter("lang <> 'en'").select(c("doc_id").alias("k"), F.sha2("text", 256).alias("h"))
    old = docs.select(c("doc_id").alias("k"), c("lang").alias("h"))
    return crawl.right_biased_merge(old, new, "k", "h")


# --- Crawl and increments --------------------------------------------------------------------------

@query("jon_08_resume_skip", "SELECT o_orderkey FROM orders WHERE o_orderstatus NOT IN ('F', 'O') OR o_orderkey % 5 = 0")
def _(spark, sf):
    every = orders(spark, sf)
    manifest = every.select(c("o_orderkey").alias("key"), F.when(c("o_orderstatus") == "F", "success").when(c("o_orderstatus") == "O", "quality_warning").otherwise("failed").alias("status"))
    files = every.filter("o_orderkey % 5 <> 0").select(c("o_orderkey").alias("key"))
    return crawl.to_fetch(every.select(c("o_orderkey").alias("key")), manifest, files, "key").select(c("key").alias("o_orderkey"))


@query("jon_09_incremental_skip", "SELECT d.doc_id FROM documents d LEFT JOIN (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'old' ELSE sha256(text) END AS hash FROM documents WHERE doc_id % 3 <> 0) s ON d.doc_id = s.doc_id AND sha256(d.text) = s.hash WHERE s.doc_id IS NULL")
def _(spark, sf):
    now = C.documents(spark, sf).select("doc_id", F.sha2("text", 256).alias("hash"))
    state = now.filter("doc_id % 3 <> 0").select("doc_id", F.when(c("doc_id") % 4 == 0, F.lit("old")).otherwise(c("hash")).alias("hash"))
    return crawl.changed(now, state, ["doc_id", "hash"]).select("doc_id")


@query("agg_10_manifest_counters", "SELECT user_id, count(*) AS discovered, count(*) FILTER (event_type IN ('view', 'click')) AS scraped, count(*) FILTER (event_type = 'signup') AS warnings, count(*) FILTER (event_type = 'error') AS failed, count(*) FILTER (event_type = 'purchase') AS skipped FROM events GROUP BY user_id")
def _(spark, sf):
    status = F.when(c("event_type") == "error", "failed").when(c("event_type") == "signup", "quality_warning").when(c("event_type") == "purchase", "skipped").otherwise("success")
    return crawl.counters(events(spark, sf).select("user_id", status.alias("status")), "user_id", "status")


@query("agg_15_first_wins", "SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text")
def _(spark, sf):
    from ..operators import graph

    return graph.first_by(C.documents(spark, sf).select("doc_id", "text"), ["text"], ["doc_id"])


@query("res_03_quality_gate", "WITH a AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS n FROM events) SELECT user_id, event_id, CASE WHEN value < 50 THEN 'quality_warning' ELSE 'success' END AS status FROM a WHERE n = 1 AND value IS NOT NULL")
def _(spark, sf):
    rows = events(spark, sf).filter("value is not null").select("user_id", "event_id", "value")
    return crawl.quality_gate(rows, "user_id", "event_id", "value", 50)


@query("res_06_circuit_breaker", "WITH g AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS grp FROM events), r AS (SELECT user_id, event_id, event_type, count(*) FILTER (event_type = 'error') OVER (PARTITION BY user_id, grp ORDER BY ts, event_id) AS run FROM g) SELECT event_id, user_id FROM r WHERE event_type = 'error' AND run % 2 = 0")
def _(spark, sf):
    rows = events(spark, sf).select("event_id", "user_id", "ts", (c("event_type") != "error").alias("ok"))
    return crawl.breaker_trips(rows, "user_id", ["ts", "event_id"], "ok", 2).select("event_id", "user_id")


# --- Model pass ------------------------------------------------------------------------------------

_STUB = model_pass.StubModel()
#: So many chunks, in order, has an earlier pass seen where a query looks at a second pass.
SEEN = 100
CHUNK = ["section_id", "seq"]
_FORM = O.quote(model_pass.FORM)
_PROMPTS = (
    O.WITH_LIMITS
    + """, kinds AS (
  SELECT section_id, seq, string_agg(k || ': ' || vs, '; ' ORDER BY p) AS ents FROM (
    SELECT section_id, seq, split_part(e, '.', 1) AS k, min(pos) AS p, string_agg(substr(e, length(split_part(e, '.', 1)) + 2), ', ' ORDER BY pos) AS vs
    FROM (SELECT section_id, seq, unnest(entities) AS e, generate_subscripts(entities, 1) AS pos FROM tagged) GROUP BY ALL
  ) GROUP BY ALL
), found_limits AS (
  SELECT section_id, seq, string_agg(metric || operator || value || unit, '; ' ORDER BY k) AS lims FROM limits GROUP BY ALL
), prompts AS (
  SELECT c.section_id, c.seq, c.section_code, c.title, c.content, 'SECTION: ' || section_code || ' - ' || title || chr(10) || 'SOURCE: ' || source || chr(10) || 'ENTITIES FOUND BY RULES: ' || coalesce(ents, 'None')
    || chr(10) || 'LIMITS FOUND BY RULES: ' || coalesce(lims, 'None') || chr(10) || chr(10) || 'CONTENT:' || chr(10) || content || """
    + _FORM
    + """ AS prompt
  FROM chunks c LEFT JOIN kinds USING (section_id, seq) LEFT JOIN found_limits USING (section_id, seq)
), numbered AS (
  SELECT *, sha256(left(content, 8000) || '|stub|1.0') AS key, row_number() OVER (ORDER BY section_id, seq) AS n FROM prompts
), seen AS (
  SELECT DISTINCT key FROM numbered WHERE n <= """
    + str(SEEN)
    + rf"""
), passed AS (
  SELECT k.*, s.key IS NOT NULL AS hit, s.key IS NULL AND row_number() OVER w = 1 AS called, {O.words('prompt')} AS prompt_words, first_value(section_code || ' - ' || title) OVER w AS summary
  FROM numbered k LEFT JOIN seen s ON k.key = s.key WINDOW w AS (PARTITION BY k.key ORDER BY n)
)"""
)
_KEY = f"{O.WITH_SECTIONS}, k AS (SELECT section_id, body, sha256(left(body, 8000) || '|stub|v1') AS key FROM sections), cache AS (SELECT DISTINCT key FROM k WHERE section_id % 3 = 0)"


def asked_chunks(spark, sf):
    return C.with_limits(spark, sf).select(*CHUNK, "source", "section_code", "title", "content", "entities", "numeric_constraints")


def stored_chunks(spark, sf):
    """The chunks of two passes, worked out once."""
    return storage.stored(asked_chunks(spark, sf))


def seen_cache(spark, chunks):
    """A cache of the answers of a pass over the first chunks."""
    cache = AnswerCache(spark, f"{storage.scratch_folder(spark)}/answers")
    model_pass.enriched(chunks, _STUB, cache, CHUNK, most=SEEN)
    return cache


def second_pass(spark, sf):
    chunks = stored_chunks(spark, sf)
    return model_pass.enriched(chunks, _STUB, seen_cache(spark, chunks), CHUNK)


def entries_of(rows, tokens):
    return rows.select("key", F.lit('{"summary":"s"}').alias("result"), F.lit("stub").alias("model"), F.lit("v1").alias("prompt_version"), F.current_timestamp().alias("stored_at"), F.lit(tokens).cast("long").alias("tokens_used"))


def keyed(spark, sf):
    return C.sections(spark, sf).select("section_id", cache_key(c("body"), "stub", "v1").alias("key"))


@query("jon_10_cache_lookup", f"{_KEY} SELECT section_id, cache.key IS NOT NULL AS hit FROM k LEFT JOIN cache USING (key)")
def _(spark, sf):
    own, cache = keyed(spark, sf), AnswerCache(spark, f"{storage.scratch_folder(spark)}/answers")
    cache.put(storage.stored(entries_of(own.filter("section_id % 3 = 0"), 1)))
    return cache.get(own).select("section_id", c("result").isNotNull().alias("hit"))


@query("llm_09_cache_shards", f"{_KEY} SELECT left(k.key, 2) AS shard, count(DISTINCT k.key) AS entries, CAST(sum(CASE WHEN cache.key IS NULL THEN 1 ELSE 2 END) AS BIGINT) AS tokens FROM (SELECT DISTINCT key FROM k) k LEFT JOIN cache ON k.key = cache.key GROUP BY 1")
def _(spark, sf):
    own, cache = keyed(spark, sf), AnswerCache(spark, f"{storage.scratch_folder(spark)}/answers")
    cache.put(storage.stored(entries_of(own, 1)))
    cache.put(storage.stored(entries_of(own.filter("section_id % 3 = 0"), 2)))  # later entries of a key win
    return cache.entries().groupBy("shard").agg(F.count(F.lit(1)).alias("entries"), F.sum("tokens_used").alias("tokens"))


@query("agg_13_dry_run", f"{_PROMPTS}, t AS (SELECT count(*) AS total_chunks, count(*) FILTER (hit) AS hits, count(*) FILTER (NOT hit) AS misses, CAST(coalesce(sum((prompt_words * 13) // 10) FILTER (NOT hit), 0) AS BIGINT) AS input_tokens FROM passed) SELECT *, misses * 300 AS output_tokens, round(input_tokens / 1000.0::DOUBLE * 0.00025::DOUBLE + misses * 300 / 1000.0::DOUBLE * 0.00125::DOUBLE, 4) AS estimated_cost, 'stub' AS model FROM t")
def _(spark, sf):
    chunks = stored_chunks(spark, sf)
    return model_pass.dry_run(chunks, _STUB, seen_cache(spark, chunks), CHUNK)


@query("agg_14_cache_statistics", f"{_KEY}, l AS (SELECT k.*, c.key IS NOT NULL AS hit FROM k LEFT JOIN cache c USING (key)) SELECT count(*) FILTER (hit) AS hits, count(*) FILTER (NOT hit) AS misses, (SELECT count(*) FROM cache) AS entries, count(*) FILTER (hit) / count(*)::DOUBLE AS hit_rate FROM l")
def _(spark, sf):
    own, cache = keyed(spark, sf), AnswerCache(spark, f"{storage.scratch_folder(spark)}/answers")
    cache.put(storage.stored(entries_of(own.filter("section_id % 3 = 0"), 1)))
    return cache.statistics(cache.get(own))


@query("lim_02_first_chunks_only", f"{O.WITH_CHUNKS} SELECT section_id, seq, row_number() OVER (ORDER BY section_id, seq) <= 50 AS chosen FROM chunks")
def _(spark, sf):
    return model_pass.first_rows(C.headed(spark, sf), ["section_id", "seq"], 50).select("section_id", c("seq").cast("long").alias("seq"), "chosen")


@query("llm_04_prompt", f"{_PROMPTS} SELECT section_id, seq, prompt FROM prompts")
def _(spark, sf):
    return asked_chunks(spark, sf).select("section_id", c("seq").cast("long").alias("seq"), model_pass.chunk_prompt().alias("prompt"))


#: Answers by section_id % 7: fenced, no JSON, no object, fields of other types, partial, odd entries, whole.
_ANSWERS = [
    """concat('```json\n{"summary": "', section_code, '", "entities": {"a": ["b", 1]}, "numeric_constraints": [{"metric": "LTV", "value": 80}]}\n```')""",
    "'no json'",
    "'[1, 2]'",
    """'{"summary": 5, "entities": "x", "numeric_constraints": {"metric": 1}, "relationships": [1, {"type": "REQUIRES"}]}'""",
    """'{"entities": {"k": "v", "l": []}}'""",
    """'{"summary": "odd", "numeric_constraints": [{"metric": "DTI"}, 7, {"metric": "DTI", "value": "45", "conditions": ["a", 2], "unit": ""}], "relationships": null}'""",
    """'{"summary": "s", "entities": {}, "numeric_constraints": [{"metric": "LTV", "operator": ">=", "value": "80", "unit": "%", "conditions": [], "source_text": "t"}], "relationships": [{"type": "EXCEPTION", "target_section": "B1", "condition": "c", "description": "d"}]}'""",
]


@query(
    "llm_05_response",
    f"{O.WITH_SECTIONS} SELECT section_id, CASE section_id % 7 WHEN 0 THEN section_code WHEN 3 THEN '5' WHEN 5 THEN 'odd' WHEN 6 THEN 's' ELSE '' END AS summary, CASE section_id % 7 WHEN 0 THEN 'a=b,1' WHEN 4 THEN 'l=' ELSE '' END AS entities, "
    "CASE section_id % 7 WHEN 0 THEN 'LTV<=80%||' WHEN 5 THEN 'DTI<=45|a|' WHEN 6 THEN 'LTV>=80%||t' ELSE '' END AS limits, CASE section_id % 7 WHEN 3 THEN 'REQUIRES->||' WHEN 6 THEN 'EXCEPTION->B1|c|d' ELSE '' END AS relations FROM sections",
)
def _(spark, sf):
    text = F.expr("CASE section_id % 7 " + " ".join(f"WHEN {k} THEN {a}" for k, a in enumerate(_ANSWERS)) + " END")
    own = C.sections(spark, sf).select("section_id", answers.parsed(text).alias("r"))
    limits = F.transform("r.numeric_constraints", lambda x: F.concat(x["metric"], x["operator"], x["value"], x["unit"], F.lit("|"), F.array_join(x["conditions"], ","), F.lit("|"), x["source_text"]))
    relations = F.transform("r.relationships", lambda x: F.concat(x["type"], F.lit("->"), x["target_section"], F.lit("|"), x["condition"], F.lit("|"), x["description"]))
    entities = F.transform(F.map_entries("r.entities"), lambda x: F.concat(x["key"], F.lit("="), F.array_join(x["value"], ",")))
    return own.select("section_id", "r.summary", F.array_join(entities, ";").alias("entities"), F.array_join(limits, ";").alias("limits"), F.array_join(relations, ";").alias("relations"))


@query("llm_08_enrich_batch", f"{_PROMPTS} SELECT section_id, seq, summary AS llm_summary, 'stub' AS llm_model, CASE WHEN called THEN prompt_words ELSE 0 END AS llm_tokens, NOT called AS llm_cached FROM passed")
def _(spark, sf):
    return second_pass(spark, sf).select("section_id", c("seq").cast("long").alias("seq"), "llm_summary", "llm_model", "llm_tokens", "llm_cached")


@query("llm_11_provenance", f"{_PROMPTS} SELECT p.section_id, p.seq, coalesce(kinds.ents, 'None') AS entities, coalesce(f.lims, 'None') AS limits, 'LLM Summary: ' || summary || chr(10) || 'LLM Model: stub' AS llm_lines FROM passed p LEFT JOIN kinds USING (section_id, seq) LEFT JOIN found_limits f USING (section_id, seq)")
def _(spark, sf):
    from ..sources import files

    some = lambda a: F.when(F.size(a) > 0, F.array_join(a, "; ")).otherwise(F.lit("None"))
    kinds = F.transform(files.by_kind("entities"), lambda x: F.concat(x["kind"], F.lit(": "), F.array_join(x["values"], ", ")))
    limits = F.transform("numeric_constraints", lambda x: F.concat(x["metric"], x["operator"], x["value"], x["unit"]))
    return second_pass(spark, sf).select("section_id", c("seq").cast("long").alias("seq"), some(kinds).alias("entities"), some(limits).alias("limits"), files.model_lines().alias("llm_lines"))


# --- Pieces of the enrichment pass -----------------------------------------------------------------

def _hits(spark, sf):
    """Each statement of a limit: the text matched and the number in it."""
    from ..functions import rules as R

    found = [F.arrays_zip(F.regexp_extract_all("content", F.lit(p), F.lit(0)).alias("hit"), F.regexp_extract_all("content", F.lit(p), F.lit(1)).alias("value")).cast("array<struct<hit:string,value:string>>") for p in R.constraint_patterns()]
    rows = C.headed(spark, sf).select("section_id", c("seq").cast("long").alias("seq"), F.explode(F.concat(*found)).alias("x"))
    return rows.select("section_id", "seq", "x.hit", "x.value")


@query("ext_06_metric", f"{O.WITH_LIMITS} SELECT section_id, seq, hit, metric FROM named")
def _(spark, sf):
    from ..functions import rules as R

    return _hits(spark, sf).select("section_id", "seq", "hit", R.metric(c("hit")).alias("metric"))


@query("ext_07_operator", f"{O.WITH_LIMITS} SELECT section_id, seq, hit, operator FROM full_hits")
def _(spark, sf):
    from ..functions import rules as R

    return _hits(spark, sf).withColumn("metric", R.metric(c("hit"))).filter("metric is not null and value <> ''").select("section_id", "seq", "hit", R.operator(c("hit"), c("metric")).alias("operator"))


@query("ext_08_unit", f"{O.WITH_LIMITS} SELECT section_id, seq, hit, unit FROM full_hits")
def _(spark, sf):
    from ..functions import rules as R

    return _hits(spark, sf).withColumn("metric", R.metric(c("hit"))).filter("metric is not null and value <> ''").select("section_id", "seq", "hit", R.unit(c("metric")).alias("unit"))


@query("ext_02_merged_enumerations", f"{O.WITH_CHUNKS}, s AS (SELECT section_id, {C._ENUMS} AS own FROM sections), t AS (SELECT section_id, seq, {C._ENUMS.replace('body', 'content')} AS more FROM chunks) SELECT section_id, seq, array_to_string(list_sort(list_distinct(list_concat(own, more))), ',') AS enumerations FROM t JOIN s USING (section_id)")
def _(spark, sf):
    from ..functions import rules as R
    from ..operators import chunking

    rows = chunking.chunked(C.sections(spark, sf).withColumn("own", R.enumerations(c("body"))), chunking.by_headings(c("body")))
    merged = F.array_sort(F.array_union("own", R.enumerations(c("content"))))
    return rows.select("section_id", c("seq").cast("long").alias("seq"), F.array_join(merged, ",").alias("enumerations"))


@query("ext_11_resolved_entity", f"{O.WITH_REFERENCES} SELECT section_id, seq, p AS phrase, if_entity FROM resolved")
def _(spark, sf):
    from ..functions import rules as R

    shape = R.V.CONDITIONAL_SHAPES
    tidy = lambda x: F.regexp_replace(T.strip(x), r"[.,;:]+\z", "")
    pairs = []
    for k, p in enumerate(shape):
        one, two = (F.regexp_extract_all("content", F.lit(R.FLAGS + p), F.lit(g)) for g in (1, 2))
        pairs.append(F.arrays_zip(*((two, one) if k == 2 else (one, two))).cast("array<struct<phrase:string,target:string>>"))
    rows = C.headed(spark, sf).select("section_id", "seq", "section_code", F.explode(F.concat(*pairs)).alias("x"))
    rows = rows.select("section_id", c("seq").cast("long").alias("seq"), "section_code", tidy(c("x.phrase")).alias("phrase"), tidy(c("x.target")).alias("target"))
    once = rows.filter("target <> section_code").dropDuplicates(["section_id", "seq", "phrase", "target"])
    return once.select("section_id", "seq", "phrase", R.resolved_entity(c("phrase")).alias("if_entity"))


@query("jon_06_section_attributes", f"{O.WITH_CHUNKS}, s AS (SELECT section_id, {O.content_type()} AS content_type, array_to_string({O.domains()}, ',') AS domains FROM sections) SELECT section_id, seq, content_type, domains FROM chunks JOIN s USING (section_id)")
def _(spark, sf):
    from ..operators import chunking
    from . import enrich

    rows = chunking.chunked(enrich.tagged_sections(C.sections(spark, sf)), chunking.by_headings(c("body")))
    return rows.select("section_id", c("seq").cast("long").alias("seq"), "content_type", F.array_join("domains", ",").alias("domains"))


@query("jon_07_result_by_key", f"{_PROMPTS} SELECT section_id, seq, CASE WHEN hit THEN summary END AS summary FROM passed")
def _(spark, sf):
    chunks = stored_chunks(spark, sf)
    keys = chunks.select("section_id", "seq", cache_key(c("content"), _STUB.name, model_pass.PROMPT_VERSION).alias("key"))
    found = seen_cache(spark, chunks).get(keys)
    return found.select("section_id", c("seq").cast("long").alias("seq"), answers.restored(c("result"))["summary"].alias("summary"))


_ORDER_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'failed' ELSE 'quality_warning' END"


@query("agg_11_status_report", f"WITH o AS (SELECT o_orderpriority AS source, {_ORDER_STATUS} AS status FROM orders), f AS (SELECT source, count(*) AS files FROM o WHERE status <> 'failed' GROUP BY source) SELECT source, count(*) AS discovered, count(*) FILTER (status = 'success') AS scraped, count(*) FILTER (status = 'quality_warning') AS warnings, count(*) FILTER (status = 'failed') AS failed, 0 AS skipped, any_value(files) AS files FROM o JOIN f USING (source) GROUP BY source")
def _(spark, sf):
    from . import scrape

    done = orders(spark, sf).select(c("o_orderpriority").alias("source"), c("o_orderkey").cast("string").alias("section_code"), F.expr(_ORDER_STATUS).alias("status"))
    found = done.filter("status <> 'failed'").select("source", c("section_code").alias("path"))
    return scrape.report(done, found)


@query("agg_11_first_errors", "SELECT o_orderpriority AS source, CAST(o_orderkey AS VARCHAR) AS section_code, 'OrderPending' AS error_type, o_orderpriority AS error_message FROM orders WHERE o_orderstatus = 'P' ORDER BY CAST(o_orderkey AS VARCHAR), o_orderpriority LIMIT 5")
def _(spark, sf):
    from . import scrape

    done = orders(spark, sf).select(c("o_orderpriority").alias("source"), c("o_orderkey").cast("string").alias("section_code"), F.expr(_ORDER_STATUS).alias("status"), F.lit("OrderPending").alias("error_type"), c("o_orderpriority").alias("error_message"))
    return scrape.first_errors(done)


@query("agg_12_model_totals", f"{_PROMPTS}, t AS (SELECT count(*) AS processed, count(*) FILTER (NOT called) AS cached, CAST(sum(CASE WHEN called THEN prompt_words ELSE 0 END) AS BIGINT) AS tokens, CAST(sum(CASE WHEN called THEN prompt_words * 7 // 10 ELSE 0 END) AS BIGINT) AS input_tokens, CAST(sum(CASE WHEN called THEN prompt_words * 3 // 10 ELSE 0 END) AS BIGINT) AS output_tokens FROM passed) SELECT *, round(input_tokens / 1000.0::DOUBLE * 0.00025::DOUBLE + output_tokens / 1000.0::DOUBLE * 0.00125::DOUBLE, 6) AS cost FROM t")
def _(spark, sf):
    return model_pass.totals(second_pass(spark, sf), _STUB)


@query("chk_03_definition_terms", f"{O.WITH_SECTIONS}, s AS (SELECT *, CASE WHEN {O.words('body')} > 10 THEN 1 ELSE 0 END AS k FROM sections), lines AS (SELECT *, chr(10) AS nl FROM s) SELECT section_id, 0 AS seq, NULL AS heading, {O.strip('body')} AS content FROM lines WHERE k = 1 UNION ALL SELECT section_id, k, title, '**' || title || '**' || nl || 'first meaning' FROM lines UNION ALL SELECT section_id, k + 1, 'second', '__second__' || nl || 'meaning two' FROM lines UNION ALL SELECT section_id, k + 2, 'third', '**third**' || nl || 'meaning three' FROM lines")
def _(spark, sf):
    from ..operators import chunking

    body = F.concat(c("body"), F.lit("\n\n**"), c("title"), F.lit("**\nfirst meaning\n\n__second__\nmeaning two\n\n**third**\nmeaning three"))
    return chunking.chunked(C.sections(spark, sf).withColumn("body", body), chunking.by_terms(c("body"))).select("section_id", "seq", "heading", "content")


@query("chk_05_merge_undersize", f"{O.WITH_ADAPTIVE} SELECT section_id, seq, heading, content, CAST({O.words('content')} AS BIGINT) AS word_count FROM chunks")
def _(spark, sf):
    from ..operators import chunking

    return chunking.chunked(C.sections(spark, sf), chunking.merge_undersize(chunking.by_headings(c("body")))).select("section_id", c("seq").cast("long").alias("seq"), "heading", "content", "word_count")


_LINES = r"""WITH RECURSIVE lines AS (
  SELECT doc_id, k, 'Line ' || k AS heading, line, len(regexp_extract_all(line, '[^\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+')) AS words FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents)
), fold AS (
  SELECT doc_id, k, 0::BIGINT AS run, words AS n FROM lines WHERE k = 1
  UNION ALL
  SELECT l.doc_id, l.k, CASE WHEN f.n >= 50 THEN f.run + 1 ELSE f.run END, CASE WHEN f.n >= 50 THEN l.words ELSE f.n + l.words END FROM fold f JOIN lines l ON l.doc_id = f.doc_id AND l.k = f.k + 1
), whole AS (
  SELECT doc_id, count(*) AS n, CAST(sum(words) AS BIGINT) AS words FROM lines GROUP BY doc_id
)"""


@query("chk_07_semantic_chunks", f"{_LINES} SELECT doc_id, 'section' AS chunk_type, NULL AS heading, words AS word_count FROM whole UNION ALL SELECT doc_id, 'subsection', first(heading ORDER BY k), CAST(sum(l.words) AS BIGINT) FROM lines l JOIN fold USING (doc_id, k) JOIN whole w USING (doc_id) WHERE w.words > 2000 AND w.n > 1 GROUP BY doc_id, run")
def _(spark, sf):
    """Documents as sections whose subsections are their lines."""
    from ..operators import chunking

    none = F.lit("")
    lines = F.transform(F.split("text", "\n"), lambda x, k: F.struct(F.concat(F.lit("Line "), (k + 1).cast("string")).alias("heading"), x.alias("content"), T.word_count(x).alias("words"), F.lit(False).alias("tables"), F.lit(False).alias("lists")))
    own = C.documents(spark, sf).filter("text IS NOT NULL").select(F.lit("documents").alias("source"), c("doc_id").cast("string").alias("section_code"), F.coalesce("lang", none).alias("title"), c("text").alias("content_markdown"), T.word_count(c("text")).alias("word_count"), lines.alias("subsections"), *[none.alias(n) for n in ("part_name", "chapter_name", "chapter_code", "subpart_name", "subpart_code")])
    return chunking.semantic(own).select(c("section_code").cast("long").alias("doc_id"), "chunk_type", "heading", "word_count")


@query("chk_08_merge_subsections", f"{O.WITH_SUBSECTIONS} SELECT section_id, CAST(run AS INTEGER) AS seq, coalesce(first(heading ORDER BY c.seq), '') AS heading, CAST(sum(words) AS BIGINT) AS words FROM counted c JOIN fold f USING (section_id, seq) GROUP BY section_id, run")
def _(spark, sf):
    from ..operators import chunking

    parts = F.transform(chunking.by_headings(c("body")), lambda x: F.struct(F.coalesce(x["heading"], F.lit("")).alias("heading"), x["content"].alias("content"), T.word_count(x["content"]).alias("words"), chunking.has_table(x["content"]).alias("tables"), F.lit(False).alias("lists")))
    return C.sections(spark, sf).select("section_id", F.posexplode(chunking.merge_small_subsections(parts)).alias("seq", "x")).select("section_id", "seq", "x.heading", "x.words")


def _enriched(spark, sf, **more):
    from . import enrich

    return enrich.enrich(C.sections(spark, sf), **more)


@query("scl_11_chunk_header")
def _(spark, sf):
    from ..sources import files

    return _enriched(spark, sf, most=files.SHOWN["cross_source_links"]).select("chunk_id", "seq", files.chunk_header().alias("text"))


@query("snk_03_index_entries")
def _(spark, sf):
    from ..sources import files

    return files.index_entries(_enriched(spark, sf, as_json=True))


@query("htm_17_parsed_pages")
def _(spark, sf):
    from ..sources import section_pages

    source = F.when(c("page_id") % 2 == 0, "fannie_mae").otherwise("freddie_mac")
    code = F.when(c("page_id") % 2 == 0, F.format_string("B3-%d-01", c("page_id") % 9)).otherwise(F.format_string("%d.1", 1101 + c("page_id") % 6000))
    fetched = pages(spark, sf).select("url", source.alias("source"), code.alias("section_code"), "html")
    return section_pages.parsed(fetched).select("url", "title", "part_code", "chapter_code", "word_count", "table_count", F.size("subsections").alias("subsections"), F.size("cross_references").alias("references"))


# --- Files -----------------------------------------------------------------------------------------

def _files(spark, sf, *kept):
    """Each section as its markdown file, with its columns ``kept``."""
    from ..sources import files

    part, chapter, subpart = P.code_hierarchy(c("section_code"))
    fields = F.struct(
        "source", "section_code", "title", F.lit("https://h/x").alias("url"), part.alias("part"), F.lit("").alias("part_name"), chapter.alias("chapter"), F.lit("").alias("chapter_name"), subpart.alias("subpart"),
        T.word_count(c("body")).alias("word_count"), F.array(c("section_code"), F.lit("B1-1-01")).alias("cross_references"), c("body").alias("content_markdown"), F.array(F.lit("SEL-2024-01 (May 1)")).alias("announcements"),
    )
    return C.sections(spark, sf).select("section_id", *kept, files.section_file(fields).alias("value"))


@query("scl_12_section_files")
def _(spark, sf):
    return _files(spark, sf)


@query("src_02_front_matter", rf"SELECT section_id, source, section_code, title, CAST({O.words('body')} AS BIGINT) AS words FROM ({guide.SECTIONS_SQL})")
def _(spark, sf):
    from ..sources import files

    rows = _files(spark, sf).select("section_id", files.front_matter(c("value")).alias("f"))
    field = lambda k: F.try_element_at("f.fields", F.lit(k)).alias(k)
    return rows.select("section_id", field("source"), field("section_code"), field("title"), F.try_element_at("f.fields", F.lit("word_count")).cast("long").alias("words"))


@query("scl_13_chunk_markers", f"{O.WITH_CHUNKS}, numbered AS (SELECT r.*, row_number() OVER (PARTITION BY section_id ORDER BY k) - 1 AS seq FROM raw r WHERE k > 1 OR {O.strip('piece')} <> '') SELECT section_id, '<!-- chunk: ' || first(chunk_id ORDER BY k) || ' -->' || chr(10) || chr(10) || string_agg(CASE WHEN k > 1 THEN '<!-- chunk: ' || chunk_id || ' -->' || chr(10) ELSE '' END || piece, '' ORDER BY k) AS text FROM numbered JOIN chunks USING (section_id, seq) GROUP BY section_id")
def _(spark, sf):
    from ..sources import files

    chunks = C.headed(spark, sf)
    lists = chunks.groupBy("section_id").agg(F.array_sort(F.collect_list(F.struct("seq", "heading", "chunk_id"))).alias("p"))
    rows = C.sections(spark, sf).join(lists, "section_id")
    parts = F.transform("p", lambda x: F.struct(x["heading"].alias("heading"), x["chunk_id"].alias("chunk_id")))
    return rows.select("section_id", files.chunk_markers(c("body"), c("p")[0]["chunk_id"], parts).alias("text"))


def _section_pages(spark, sf):
    """Sections as pages of the first guide: four kinds of breadcrumbs, one to three subsections, links by section."""
    k = c("section_id")
    number = lambda n: (k % n).cast("string")
    crumbs = (
        F.when(k % 4 == 0, F.concat(F.lit("<nav aria-label='breadcrumb'><a>Part B</a><a>Chapter "), c("section_code"), F.lit("</a></nav>")))
        .when(k % 4 == 1, F.concat(F.lit("<div class='breadcrumb-bar'><a>Part C</a> <span>Chapter "), c("section_code"), F.lit("</span></div>")))
        .when(k % 4 == 2, F.lit("<nav aria-label='Breadcrumb'><a>Part D</a></nav>"))
        .otherwise(F.lit(""))
    )
    more = F.array_join(F.transform(F.sequence(F.lit(1), (k % 3).cast("int") + 1), lambda i: F.concat(F.lit("<h3>Scores "), i.cast("string"), F.lit("</h3><ul><li>"), c("title"), F.lit("<li>two</ul>"))), "")
    links = F.concat(F.lit("<a href='/sel/b"), number(5), F.lit("-1.2-01/x'>LTV</a> and <a href='/sel/b"), number(5), F.lit("-1.2-01'>LTV</a>, <a href='/sel/c"), number(7), F.lit("-2-0"), number(3), F.lit("'>rules</a> or <a href='/other/b1-1-01'>no</a>"))
    body = F.concat(crumbs, F.lit("<h1>"), c("section_code"), F.lit(", "), c("title"), F.lit(" (01/02/2024)</h1><div class='body-field'><p>"), F.repeat(F.lit("Some words to read here. "), 6), F.lit("</p><h2>Limits</h2><p>See "), links, F.lit(".</p>"), more, F.lit("</div><h3>Related Announcements</h3><table><tr><th>Code<th>Date</tr><tr><td>SEL-2024-"), k.cast("string"), F.lit("<td>May 1</tr></table>"))
    first = C.sections(spark, sf).filter("source = 'fannie_mae'")
    return first.select(F.concat(F.lit("u"), c("section_id").cast("string")).alias("url"), "source", "section_code", body.alias("html"))


_FIRST = f"SELECT * FROM ({guide.SECTIONS_SQL}) WHERE source = 'fannie_mae'"


@query("htm_06_titles", f"SELECT 'u' || section_id AS url, CASE WHEN section_code LIKE 'ZZ%' THEN section_code || ', ' || title ELSE title END AS title, '2024-01-02' AS effective_date FROM ({_FIRST})")
def _(spark, sf):
    from ..sources import section_pages

    return section_pages.parsed(_section_pages(spark, sf)).select("url", "title", "effective_date")


@query("htm_11_breadcrumbs", f"SELECT 'u' || section_id AS url, CASE WHEN section_id % 4 < 2 THEN 'Chapter ' || section_code ELSE '' END AS chapter_name FROM ({_FIRST})")
def _(spark, sf):
    from ..sources import section_pages

    return section_pages.parsed(_section_pages(spark, sf)).select("url", "chapter_name")


@query("htm_13_subsections", f"SELECT 'u' || section_id AS url, CASE WHEN k = 0 THEN 'Limits' ELSE 'Scores ' || k END AS heading, CASE WHEN k = 0 THEN 2 ELSE 3 END AS level, k > 0 AS has_lists FROM (SELECT *, unnest(range(0, section_id % 3 + 2)) AS k FROM ({_FIRST}))")
def _(spark, sf):
    from ..sources import section_pages

    rows = section_pages.parsed(_section_pages(spark, sf)).select("url", F.explode("subsections").alias("s"))
    return rows.select("url", "s.heading", c("s.heading_level").alias("level"), "s.has_lists")


@query("htm_14_cross_references", f"SELECT 'u' || section_id AS url, 'B' || (section_id % 5) || '-1.2-01' AS code, 'LTV' AS text FROM ({_FIRST}) UNION ALL SELECT 'u' || section_id, 'C' || (section_id % 7) || '-2-0' || (section_id % 3), 'rules' FROM ({_FIRST})")
def _(spark, sf):
    from ..sources import section_pages

    rows = section_pages.parsed(_section_pages(spark, sf)).select("url", F.explode("cross_references").alias("r"))
    return rows.select("url", c("r.target_section_code").alias("code"), c("r.link_text").alias("text"))


@query("htm_15_announcements", f"SELECT 'u' || section_id AS url, 'SEL-2024-' || section_id AS code, 'May 1' AS date FROM ({_FIRST})")
def _(spark, sf):
    from ..sources import section_pages

    rows = section_pages.parsed(_section_pages(spark, sf)).select("url", F.explode("related_announcements").alias("a"))
    return rows.select("url", "a.code", "a.date")


@query("res_02_fetch")
def _(spark, sf):
    """The table of pages asked of a fetcher that knows none of them."""
    from ..operators import fetch
    from .config import Config

    found = pages(spark, sf).select("url", F.lit("freddie_mac").alias("source"), c("page_id").cast("string").alias("section_code"))
    return fetch.fetched(found, lambda: fetch.TableFetcher({}), Config(max_retries=0, breaker_threshold=10**9), 0.0, 4, len).select("url", "status", "attempts")


# --- Storage ---------------------------------------------------------------------------------------

@query("snk_02_text_files", f"{O.WITH_CHUNKS}, n AS (SELECT chunk_id, content, row_number() OVER (PARTITION BY chunk_id ORDER BY section_id, seq) AS k FROM chunks) SELECT replace(chunk_id, '/', '_') || CASE WHEN k > 1 THEN '_' || k ELSE '' END || '.txt' AS name, content AS text FROM n")
def _(spark, sf):
    from ..sources import exports, text_sink

    rows = C.headed(spark, sf).withColumn("k", F.row_number().over(Window.partitionBy("chunk_id").orderBy("section_id", "seq")))
    folder = f"{storage.scratch_folder(spark)}/texts"
    text_sink.write_texts(rows.select(exports.chunk_filename(c("chunk_id"), c("k")).alias("name"), c("content").alias("text")), folder, layout="tasks")
    return text_sink.read_texts(spark, folder)


@query("snk_03_index_totals", f"{O.WITH_SECTIONS}, t AS (SELECT {O.content_type()} AS content_type, {O.domains()} AS domains FROM sections) SELECT 'total' AS kind, '' AS value, count(*) AS n FROM t UNION ALL SELECT 'content_type', content_type, count(*) FROM t GROUP BY content_type UNION ALL SELECT 'domain', d, count(*) FROM (SELECT unnest(domains) AS d FROM t) GROUP BY d")
def _(spark, sf):
    from ..sources import exports
    from . import enrich

    return exports.totals(enrich.tagged_sections(C.sections(spark, sf)))


@query("snk_05_attempt_log", "SELECT CAST(user_id AS VARCHAR) AS section_code, arg_max(event_type, event_id) AS status FROM events GROUP BY user_id")
def _(spark, sf):
    from . import scrape

    fields = [x.split(" ") for x in scrape.LOG.split(", ")]
    given = {"source": F.lit("events"), "section_code": c("user_id").cast("string"), "status": c("event_type"), "attempt": c("event_id").cast("long")}
    rows = storage.stored(events(spark, sf).select(*[given.get(n, F.lit(None)).cast(k).alias(n) for n, k in fields]))
    log = storage.Parts(spark, f"{storage.scratch_folder(spark)}/log")
    first, last = rows.agg(F.min("attempt"), F.max("attempt")).first()
    cuts = [first + (last - first) * k // 3 for k in range(3)] + [last + 1]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        at = log.new_folder("log")
        rows.filter((c("attempt") >= a) & (c("attempt") < b)).write.parquet(f"{log.path}/{at}")
        log.commit({f"run={k}": at})
        if k == 1:
            scrape.compact(spark, log)
    return scrape.newest(log.read(scrape.LOG)).select("section_code", "status")


@query("src_06_index_expansion", "SELECT page_id, url AS loc, 'https://guide.example.com/map-' || (page_id % 8) || '.xml' AS sitemap FROM pages WHERE page_id % 8 NOT IN (3, 5)")
def _(spark, sf):
    """Each eighth of the pages is in a sitemap of its own; one lies on another host, one cannot be had."""
    from ..plans import discovery
    from ..sources import page_source
    from .config import Config

    own = pages(spark, sf).select("page_id", "url", (c("page_id") % 8).alias("k"))
    name = lambda k: F.concat(F.when(k == 3, F.lit("https://elsewhere.example.com")).otherwise(F.lit("https://guide.example.com")), F.lit("/map-"), k.cast("string"), F.lit(".xml"))
    escaped = F.replace(F.replace(c("url"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    entry = F.concat(F.lit("<url><loc>"), escaped, F.lit("</loc><lastmod>"), c("page_id").cast("string"), F.lit("</lastmod></url>"))
    maps = own.groupBy("k").agg(F.concat(F.lit("<urlset xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'>"), F.array_join(F.collect_list(entry), ""), F.lit("</urlset>")).alias("body"))
    index = own.select("k").distinct().agg(F.concat(F.lit("<sitemapindex>"), F.array_join(F.collect_list(F.concat(F.lit("<sitemap><loc>"), name(c("k")), F.lit("</loc></sitemap>"))), ""), F.lit("</sitemapindex>")).alias("body"))
    stored = storage.stored(maps.filter("k <> 5").select(name(c("k")).alias("url"), "body").unionByName(index.select(F.lit("https://guide.example.com/sitemap.xml").alias("url"), "body")))
    uri = stored.inputFiles()[0].rpartition("/")[0]
    found = discovery.expanded(spark, "https://guide.example.com/sitemap.xml", lambda: page_source.StoredPages(uri), Config(max_retries=0))
    return found.select(c("lastmod").cast("long").alias("page_id"), "loc", "sitemap")


@query("src_16_increment", f"SELECT section_id, source = 'freddie_mac' AS changed, 2 AS versions FROM ({guide.SECTIONS_SQL})")
def _(spark, sf):
    """All section files enriched, then those of one guide again with another line; the state has each file's last text."""
    from ..streaming import incremental

    folder = storage.scratch_folder(spark)
    rows = _files(spark, sf, "source")  # a join would send all texts through the driver: by its estimate they are small
    path = F.concat(F.lit("section-"), c("section_id").cast("string"), F.lit(".md")).alias("path")
    incremental.update(spark, storage.stored(rows.select(path, "value")), folder)
    later = F.when(c("source") == "freddie_mac", F.concat("value", F.lit("\n\nAnother line."))).otherwise(c("value"))
    incremental.update(spark, storage.stored(rows.select(path, later.alias("value"))), folder)
    found = incremental.chunks(spark, folder).groupBy("path").agg(F.max(F.contains("content", F.lit("Another line."))).alias("changed"))
    versions = F.lit(incremental.tables(spark, folder).version())
    return found.select(F.regexp_extract("path", r"(\d+)\.md", 1).cast("long").alias("section_id"), "changed", versions.alias("versions"))
