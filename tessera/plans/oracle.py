"""SQL of another engine (DuckDB) for the same results, built from the same vocabulary."""

from __future__ import annotations

from ..functions import vocabulary as V
from . import guide


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def matches(text: str, pattern: str, flags: str = "(?i)") -> str:
    """Whether ``text`` has ``pattern``; a negative lookahead is rewritten by counting."""
    if "(?!" in pattern:
        base, _, rest = pattern.partition("(?!")
        every, other = quote(flags + base), quote(flags + base + rest[:-1])
        return f"(len(regexp_extract_all({text}, {every})) > len(regexp_extract_all({text}, {other})))"
    return f"regexp_matches({text}, {quote(flags + pattern)})"


def any_match(text: str, patterns: list[str], flags: str = "(?i)") -> str:
    return "(" + " OR ".join(matches(text, p, flags) for p in patterns) + ")"


def listed(pairs: list[tuple[str, str]]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {c} THEN {quote(n)} END" for n, c in pairs) + "], lambda x: x IS NOT NULL)"


def strings(values: list[str]) -> str:
    return "[" + ", ".join(map(quote, values)) + "]"


def strip(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '^\s+', ''), '\s+$', '')"


def words(x: str) -> str:
    return rf"len(regexp_extract_all({x}, '\S+'))"


def slug(x: str, longest: int = 60) -> str:
    kept = rf"regexp_replace(lower({x}), '[^a-z0-9\s-]', '', 'g')"
    return rf"left(trim(regexp_replace({kept}, '[\s-]+', '-', 'g'), '-'), {longest})"


CHAPTER = "TRY_CAST(split_part({}, '.', 1) AS INTEGER)"


def content_type() -> str:
    low, sample = "lower(title)", "lower(left(body, 3000))"
    out = "CASE WHEN source = 'fannie_mae' AND upper(section_code) LIKE 'E-3%' THEN 'definition' WHEN source = 'fannie_mae' AND (upper(section_code) LIKE 'E-1%' OR upper(section_code) LIKE 'E-2%') THEN 'reference'"
    for kind, patterns in V.CONTENT_SIGNALS:
        out += f" WHEN {any_match(low, patterns, '')} OR {any_match(sample, patterns, '')} THEN {quote(kind)}"
    out += f" WHEN has_tables AND ({' OR '.join(f'contains({low}, {quote(w)})' for w in ('eligib', 'requirement', 'limit', 'matrix'))}) THEN 'eligibility_matrix'"
    return out + rf" WHEN len(regexp_extract_all({sample}, '(?:^|\n)\s*\d+\.\s+\w')) >= 3 THEN 'procedure' ELSE 'policy_rule' END"


def severity(text: str) -> str:
    return "CASE " + " ".join(f"WHEN {any_match(text, p)} THEN {quote(k)}" for k, p in V.SEVERITY_SIGNALS[:-1]) + " ELSE 'info_only' END"


def requirement(text: str) -> str:
    counts = [(k, "(" + " + ".join(f"CAST({matches(text, p)} AS INTEGER)" for p in ps) + ")") for k, ps in V.REQUIREMENT_SIGNALS]
    top = "greatest(" + ", ".join(c for _, c in counts) + ")"
    return f"CASE WHEN {top} = 0 THEN 'guideline' " + " ".join(f"WHEN {c} = {top} THEN {quote(k)}" for k, c in counts) + " END"


def prefix_domains(code: str) -> str:
    return "CASE " + " ".join(f"WHEN starts_with(upper({code}), {quote(p.upper())}) THEN {strings(d)}" for p, d in sorted(V.PREFIX_DOMAINS, key=lambda x: -len(x[0]))) + " END"


def range_domains(code: str) -> str:
    return "CASE " + " ".join(f"WHEN {CHAPTER.format(code)} BETWEEN {a} AND {b} THEN {strings(d)}" for a, b, d in V.RANGE_DOMAINS) + " END"


def keyword_domains(text: str) -> str:
    return listed([(d, "(" + " OR ".join(f"contains(lower({text}), {quote(w)})" for w in ws) + ")") for d, ws in V.KEYWORD_DOMAINS])


def domains() -> str:
    by_code = f"CASE WHEN source = 'fannie_mae' THEN {prefix_domains('section_code')} ELSE {range_domains('section_code')} END"
    by_word = keyword_domains("body")
    return f"list_sort(list_distinct(coalesce({by_code}, CASE WHEN len({by_word}) > 0 THEN {by_word} END, {strings([V.FALLBACK_DOMAIN])})))"


def entity_list(text: str) -> list[tuple[str, str]]:
    order = {k: i for i, k in enumerate(dict.fromkeys(k for k, *_ in V.ENTITIES))}
    return [(f"{k}.{v}", any_match(text, ps)) for k, v, ps, _ in sorted(V.ENTITIES, key=lambda e: (order[e[0]], f"{e[0]}.{e[1]}"))]


def term_list(text: str) -> list[tuple[str, str]]:
    import re

    return [(t, matches(text, r"\b" + re.escape(t) + r"\b") if len(t) <= 4 else f"contains(lower({text}), {quote(t.lower())})") for t in V.TERMS]


def metric(x: str) -> str:
    return "CASE " + " ".join(f"WHEN contains(lower({x}), {quote(w)}) THEN {quote(m)}" for w, m in V.METRIC_WORDS) + " END"


def operator(x: str, name: str) -> str:
    most, least = ("(" + " OR ".join(f"contains(lower({x}), {quote(w)})" for w in ws) + ")" for ws in (V.AT_MOST_WORDS, V.AT_LEAST_WORDS))
    return f"CASE WHEN {most} THEN '<=' WHEN {least} THEN '>=' WHEN {name} = 'credit_score' THEN '>=' ELSE '<=' END"


def unit(name: str) -> str:
    return f"CASE WHEN {name} = 'reserves_months' THEN 'months' WHEN {name} = 'credit_score' THEN '' ELSE '%' END"


_METRIC = "(?:" + "|".join(m.replace("-", r"\-").replace(" ", r"\s+") for m in V.METRICS) + ")"

WITH_SECTIONS = f"WITH sections AS ({guide.SECTIONS_SQL})"

WITH_CHUNKS = (
    WITH_SECTIONS
    + rf""", parts AS (
  SELECT *, string_split(regexp_replace(body, '(?m)^(#{{2,4}}\s+.+)$', chr(1) || '\1', 'g'), chr(1)) AS pieces FROM sections
), raw AS (
  SELECT section_id, source, section_code, title, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS k FROM parts
), headed AS (
  SELECT section_id, source, section_code, title, CASE WHEN k > 1 THEN {strip(r"regexp_extract(piece, '^#{2,4}\s+(.+)', 1)")} END AS heading, {strip('piece')} AS content,
    row_number() OVER (PARTITION BY section_id ORDER BY k) - 1 AS seq
  FROM raw WHERE k > 1 OR {strip('piece')} <> ''
), chunks AS (
  SELECT *, source || '/' || section_code || '/' || CASE WHEN coalesce(heading, '') <> '' THEN {slug('heading')} WHEN seq = 0 THEN 'intro' ELSE 'part-' || (seq + 1) END AS chunk_id FROM headed
)"""
)

WITH_ENTITIES = WITH_CHUNKS + f", tagged AS (SELECT *, {listed(entity_list('content'))} AS entities FROM chunks), found AS (SELECT section_id, seq, chunk_id, unnest(entities) AS entity FROM tagged)"

WITH_LIMITS = (
    WITH_ENTITIES
    + ", hits AS ("
    + " UNION ALL ".join(
        f"SELECT section_id, seq, chunk_id, section_code, content, entities, {k} AS pattern, unnest(regexp_extract_all(content, {quote('(?i)' + s.replace('{METRIC}', _METRIC))}, 0)) AS hit, "
        f"unnest(regexp_extract_all(content, {quote('(?i)' + s.replace('{METRIC}', _METRIC))}, 1)) AS value, generate_subscripts(regexp_extract_all(content, {quote('(?i)' + s.replace('{METRIC}', _METRIC))}, 0), 1) AS nth FROM tagged"
        for k, s in enumerate(V.CONSTRAINT_SHAPES)
    )
    + f"), named AS (SELECT *, {metric('hit')} AS metric FROM hits), full_hits AS (SELECT *, {operator('hit', 'metric')} AS operator, {unit('metric')} AS unit, {strip('hit')} AS source_text FROM named WHERE metric IS NOT NULL AND value <> '')"
    + ", limits AS (SELECT * EXCLUDE (n), row_number() OVER (PARTITION BY section_id, seq ORDER BY pattern, nth) - 1 AS k FROM (SELECT *, row_number() OVER (PARTITION BY section_id, seq, metric, operator, value ORDER BY pattern, nth) AS n FROM full_hits) WHERE n = 1)"
    + ", aliases AS (SELECT * FROM (VALUES "
    + ", ".join(f"({quote(f'{k}.{v}')}, {strings([a.lower() for a in names])})" for k, v, _, names in V.ENTITIES)
    + ") AS t(key, names)), scoped AS (SELECT l.*, a.key AS condition FROM limits l JOIN aliases a ON list_contains(l.entities, a.key) AND len(list_filter(a.names, lambda x: contains(lower(l.content), x))) > 0)"
)

WITH_REFERENCES = (
    WITH_CHUNKS
    + ", refs AS ("
    + " UNION ALL ".join(
        f"SELECT section_id, seq, chunk_id, section_code, {k} AS pattern, generate_subscripts(regexp_extract_all(content, {quote('(?i)' + s)}, 0), 1) AS nth, unnest(regexp_extract_all(content, {quote('(?i)' + s)}, {2 if k == 2 else 1})) AS phrase, unnest(regexp_extract_all(content, {quote('(?i)' + s)}, {1 if k == 2 else 2})) AS target FROM chunks"
        for k, s in enumerate(V.CONDITIONAL_SHAPES)
    )
    + rf"), tidy AS (SELECT *, rtrim({strip('phrase')}, '.,;:') AS p, rtrim({strip('target')}, '.,;:') AS t FROM refs), "
    + "once AS (SELECT *, row_number() OVER (PARTITION BY section_id, seq, p, t ORDER BY pattern, nth) AS n FROM tidy WHERE t <> section_code)"
    + ", resolved AS (SELECT *, coalesce("
    + ", ".join(f"CASE WHEN {any_match('lower(p)', ps)} THEN {quote(f'{k}.{v}')} END" for k, v, ps, _ in sorted(V.ENTITIES, key=lambda e: (list(dict.fromkeys(x[0] for x in V.ENTITIES)).index(e[0]), f'{e[0]}.{e[1]}')))
    + ", p) AS if_entity FROM once WHERE n = 1)"
)

_MAP = "alignment AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {quote(p)}, {a}, {b}, {quote(t)}, {quote(r)})" for i, (p, a, b, t, r) in enumerate(V.CROSS_SOURCE)) + ") AS m(ord, prefix, low, high, topic, relationship))"

WITH_LINKS = (
    WITH_SECTIONS
    + ", "
    + _MAP
    + f""", firsts AS (SELECT DISTINCT section_code AS code FROM sections WHERE source = 'fannie_mae'),
seconds AS (SELECT DISTINCT section_code AS code, {CHAPTER.format('section_code')} AS chapter FROM sections WHERE source = 'freddie_mac'),
to_second AS (SELECT m.*, coalesce(s.code, m.low || '-' || m.high) AS target FROM alignment m LEFT JOIN seconds s ON s.chapter BETWEEN m.low AND m.high),
to_first AS (SELECT m.*, coalesce(f.code, m.prefix) AS target FROM alignment m LEFT JOIN firsts f ON starts_with(upper(f.code), upper(m.prefix))),
first_map AS (SELECT s.source, s.section_code, m.ord FROM sections s JOIN alignment m ON s.source = 'fannie_mae' AND starts_with(upper(s.section_code), upper(m.prefix))),
second_map AS (SELECT s.source, s.section_code, m.ord FROM sections s JOIN alignment m ON s.source = 'freddie_mac' AND {CHAPTER.format('s.section_code')} BETWEEN m.low AND m.high),
links AS (
  SELECT a.source, a.section_code, a.ord, 'freddie_mac' AS link_source, b.target AS link_code, b.topic, b.relationship FROM first_map a JOIN to_second b USING (ord)
  UNION ALL SELECT a.source, a.section_code, a.ord, 'fannie_mae', b.target, b.topic, b.relationship FROM second_map a JOIN to_first b USING (ord)
)"""
)


def _adaptive(least: int = 30) -> str:
    """Chunks of the adaptive chunker on the guide's sections, whose definitions have no term lines and whose chunks are not too long: chunks by headings, of which one of fewer than ``least`` words takes in the next ones."""
    at = WITH_CHUNKS.index(", chunks AS (")
    fold = rf""", counted AS (
  SELECT *, {words('content')} AS words FROM headed
), fold AS (
  SELECT section_id, seq, 0::BIGINT AS run, words AS n FROM counted WHERE seq = 0
  UNION ALL
  SELECT c.section_id, c.seq, CASE WHEN f.n >= {least} THEN f.run + 1 ELSE f.run END, CASE WHEN f.n >= {least} THEN c.words ELSE f.n + c.words END FROM fold f JOIN counted c ON c.section_id = f.section_id AND c.seq = f.seq + 1
), merged AS (
  SELECT section_id, source, section_code, title, run AS seq, first(heading ORDER BY seq) AS heading, string_agg(content, chr(10) || chr(10) ORDER BY seq) AS content FROM counted JOIN fold USING (section_id, seq) GROUP BY section_id, source, section_code, title, run
)"""
    return WITH_CHUNKS[:at].replace("WITH ", "WITH RECURSIVE ", 1) + fold + WITH_CHUNKS[at:].replace("FROM headed", "FROM merged")


WITH_ADAPTIVE = _adaptive()
#: White space as the patterns of the rules have it, for a class of the other engine.
SPACE = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def any_words(x: str) -> str:
    """Words of any text."""
    return f"len(regexp_extract_all({x}, '[^{SPACE}]+'))"


def any_strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^[{SPACE}]+', ''), '[{SPACE}]+$', '')"


WITH_SUBSECTIONS = _adaptive(50)
#: The same with limits, references and links of these chunks.
WITH_ENRICHED = WITH_ADAPTIVE + WITH_LIMITS.removeprefix(WITH_CHUNKS) + WITH_REFERENCES.removeprefix(WITH_CHUNKS) + WITH_LINKS.removeprefix(WITH_SECTIONS)
