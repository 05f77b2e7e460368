"""Classification, tagging and extraction as column expressions built from the vocabulary.

Patterns are literals, so each is compiled once a task, and each family is one
expression over the text: no join and no Python.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from re import _parser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T
from . import vocabulary as V

#: `.` stops at line feeds only; classes, boundaries and case are Unicode.
FLAGS = "(?diuU)"
EXACT_CASE = "(?dU)"


def any_of(patterns: list[str], flags: str = FLAGS) -> str:
    return flags + "|".join(f"(?:{p})" for p in patterns)


def required_literals(pattern: str) -> list[str] | None:
    """Lower-case strings of which every match of ``pattern`` has at least one; None if there is no telling."""

    def of(items) -> list[str] | None:
        options: list[list[str]] = []
        run = ""
        for op, arg in [*items, (None, None)]:
            if op == _parser.LITERAL and arg < 128:
                run += chr(arg).lower()
                continue
            if run:
                options.append([run])
                run = ""
            inner = None
            if op == _parser.SUBPATTERN:
                inner = of(arg[3])
            elif op == _parser.BRANCH:
                each = [of(b) for b in arg[1]]
                inner = None if None in each else [x for e in each for x in e]
            elif op == _parser.MAX_REPEAT and arg[0] >= 1:
                inner = of(arg[2])
            if inner:
                options.append(inner)
        return max(options, key=lambda o: (min(map(len, o)), -len(o)), default=None)

    found = of(_parser.parse(pattern))
    return found if found and min(map(len, found)) >= 2 else None


def read(content: Column, of: Callable[[Column], Column]) -> Column:
    """``of`` over a text as (text, low, wide): it is lower-cased and measured once for all of a family's patterns."""
    wide = F.octet_length(content) != F.char_length(content)
    return T.let(F.struct(content.alias("text"), F.lower(content).alias("low"), wide.alias("wide")), of)


def near(t: Column, pattern: str) -> Column | None:
    """Whether a text (as `read` gives it) may have ``pattern``; None if there is no telling.

    A search for plain strings that every match must have; only texts of ASCII take it,
    since case folding beyond ASCII is for patterns.
    """
    needed = required_literals(pattern)
    if needed is None:
        return None
    return reduce(lambda a, b: a | b, [F.contains(t["low"], F.lit(x)) for x in dict.fromkeys(needed)]) | t["wide"]


def matched(t: Column, pattern: str, flags: str = FLAGS) -> Column:
    """Whether a text (as `read` gives it) has ``pattern``; what `near` can tell comes first."""
    maybe, hit = near(t, pattern), t["text"].rlike(flags + pattern)
    return hit if maybe is None else maybe & hit


def matches(content: Column, pattern: str, flags: str = FLAGS) -> Column:
    """Whether ``content`` has ``pattern``."""
    return read(content, lambda t: matched(t, pattern, flags))


def any_matched(t: Column, patterns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [matched(t, p) for p in patterns])


def strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def chosen(pairs: list[tuple[str, Column]]) -> Column:
    """The names whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in pairs]))


def content_type(source: Column, code: Column, title: Column, content: Column, has_tables: Column) -> Column:
    upper, low, sample = F.upper(code), F.lower(title), F.lower(F.substring(content, 1, 3000))
    first = source == "fannie_mae"

    def by_text(t: Column) -> Column:
        out = None
        for kind, patterns in V.CONTENT_SIGNALS:
            p = any_of(patterns, EXACT_CASE)  # the text is in lower case, so a pattern with capitals never matches
            hit = t["title"].rlike(p) | t["sample"].rlike(p)
            out = F.when(hit, F.lit(kind)) if out is None else out.when(hit, F.lit(kind))
        eligible = reduce(lambda a, b: a | b, [F.contains(t["title"], F.lit(w)) for w in ("eligib", "requirement", "limit", "matrix")])
        steps = F.regexp_count(t["sample"], F.lit(r"(?dU)(?:^|\n)\s*\d+\.\s+\w"))
        return out.when(has_tables & eligible, F.lit("eligibility_matrix")).when(steps >= 3, F.lit("procedure")).otherwise(F.lit("policy_rule"))

    texts = F.struct(low.alias("title"), sample.alias("sample"))
    return F.when(first & upper.startswith("E-3"), F.lit("definition")).when(first & (upper.startswith("E-1") | upper.startswith("E-2")), F.lit("reference")).otherwise(T.let(texts, by_text))


def severity(content: Column) -> Column:
    """The strongest level with a signal."""

    def of(t: Column) -> Column:
        out = None
        for level, patterns in V.SEVERITY_SIGNALS[:-1]:
            hit = any_matched(t, patterns)
            out = F.when(hit, F.lit(level)) if out is None else out.when(hit, F.lit(level))
        return out.otherwise(F.lit("info_only"))

    return read(content, of)


def severity_signals(content: Column, most: int = 10) -> Column:
    """level:pattern of the first signals found, in declared order."""
    found = read(content, lambda t: chosen([(f"{level}:{p}", matched(t, p)) for level, patterns in V.SEVERITY_SIGNALS for p in patterns]))
    return F.slice(found, 1, most)


def requirement_counts(content: Column) -> Column:
    """How many patterns of each type match, in declared order."""
    return read(content, lambda t: F.array(*[reduce(lambda a, b: a + b, [matched(t, p).cast("int") for p in patterns]) for _, patterns in V.REQUIREMENT_SIGNALS]))


def requirement_type(content: Column) -> Column:
    """The type of which most patterns match; the first of equals; guideline if none does."""

    def of(counts: Column) -> Column:
        top = F.array_max(counts)
        out = F.when(top == 0, F.lit("guideline"))
        for k, (kind, _) in enumerate(V.REQUIREMENT_SIGNALS):
            out = out.when(counts[k] == top, F.lit(kind))
        return out

    return T.let(requirement_counts(content), of)


def prefix_domains(code: Column) -> Column:
    """Domains of the longest prefix of the code; null if none fits."""
    upper, out = F.upper(code), None
    for prefix, domains in sorted(V.PREFIX_DOMAINS, key=lambda x: -len(x[0])):
        hit = upper.startswith(prefix.upper())
        out = F.when(hit, strings(domains)) if out is None else out.when(hit, strings(domains))
    return out


def range_domains(code: Column) -> Column:
    """Domains of the range that holds the chapter; null if none does."""
    chapter, out = T.chapter_number(code), None
    for low, high, domains in V.RANGE_DOMAINS:
        hit = chapter.between(low, high)
        out = F.when(hit, strings(domains)) if out is None else out.when(hit, strings(domains))
    return out


def keyword_domains(content: Column) -> Column:
    return T.let(F.lower(content), lambda low: chosen([(d, reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])) for d, words in V.KEYWORD_DOMAINS]))


def domains(source: Column, code: Column, content: Column) -> Column:
    by_code = F.when(source == "fannie_mae", prefix_domains(code)).otherwise(range_domains(code))
    by_word = T.let(keyword_domains(content), lambda found: F.when(F.size(found) > 0, found))
    found = F.coalesce(by_code, by_word, strings([V.FALLBACK_DOMAIN]))
    return F.array_sort(F.array_distinct(found))


def enumerations(content: Column) -> Column:
    """enumeration.value of all that match."""
    return read(content, lambda t: chosen([(f"{e}.{v}", matched(t, p)) for e, v, p in V.ENUMERATIONS]))


def terms(content: Column) -> Column:
    """Glossary terms found, in glossary order; up to four characters they must be whole words."""
    return read(content, lambda t: chosen([(x, matched(t, r"\b" + re.escape(x) + r"\b") if len(x) <= 4 else F.contains(t["low"], F.lit(x.lower()))) for x in V.TERMS]))


def entity_conditions(t: Column) -> list[tuple[str, Column]]:
    """type.value of each entity and whether a text (as `read` gives it) has it."""
    return [(f"{kind}.{value}", any_matched(t, patterns)) for kind, value, patterns, _ in V.ENTITIES]


def entities(content: Column) -> Column:
    """type.value of all entities found: types in declared order, values sorted within a type."""
    order = {k: i for i, k in enumerate(dict.fromkeys(k for k, *_ in V.ENTITIES))}
    return read(content, lambda t: chosen(sorted(entity_conditions(t), key=lambda x: (order[x[0].split(".")[0]], x[0]))))


def metric_pattern() -> str:
    return "(?:" + "|".join(m.replace("-", r"\-") if " " not in m else m.replace("-", r"\-").replace(" ", r"\s+") for m in V.METRICS) + ")"


def constraint_patterns() -> list[str]:
    return [FLAGS + s.replace("{METRIC}", metric_pattern()) for s in V.CONSTRAINT_SHAPES]


def metric(match: Column) -> Column:
    low, out = F.lower(match), None
    for word, name in V.METRIC_WORDS:
        hit = F.contains(low, F.lit(word))
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out


def operator(match: Column, name: Column) -> Column:
    low = F.lower(match)
    most = reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in V.AT_MOST_WORDS])
    least = reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in V.AT_LEAST_WORDS])
    return F.when(most, F.lit("<=")).when(least, F.lit(">=")).when(name == "credit_score", F.lit(">=")).otherwise(F.lit("<="))


def unit(name: Column) -> Column:
    return F.when(name == "reserves_months", F.lit("months")).when(name == "credit_score", F.lit("")).otherwise(F.lit("%"))


def first_of_equals(items: Column, key, kind: str) -> Column:
    """``items`` without those whose key came before."""
    return F.aggregate(items, F.array().cast(f"array<{kind}>"), lambda acc, x: F.when(F.exists(acc, lambda y: key(y) == key(x)), acc).otherwise(F.concat(acc, F.array(x))))


CONSTRAINT = "struct<metric:string,operator:string,value:string,unit:string,conditions:array<string>,source_text:string>"


def _named(low: str) -> str | None:
    return next((name for word, name in V.METRIC_WORDS if word in low), None)


def _compared(low: str, name: str) -> str:
    if any(w in low for w in V.AT_MOST_WORDS):
        return "<="
    return ">=" if any(w in low for w in V.AT_LEAST_WORDS) or name == "credit_score" else "<="


class Limits:
    """The shapes of limits and the aliases of entities, compiled; of a text that is ASCII only the shapes whose plain strings it has are searched."""

    def __init__(self, around: int = 300) -> None:
        shapes = [s.replace("{METRIC}", metric_pattern()) for s in V.CONSTRAINT_SHAPES]
        self.shapes = [(re.compile(s, re.IGNORECASE), required_literals(s)) for s in shapes]
        self.aliases = {f"{k}.{v}": [a.lower() for a in names] for k, v, _, names in V.ENTITIES}
        self.around = around

    def of(self, content: str, found: list[str]) -> list[dict]:
        """Numeric limits of one text in order of pattern and place, the first of equals.

        Entities of ``found`` that have an alias within ``around`` characters of the
        place are the conditions.
        """
        out: dict[tuple[str, str, str], dict] = {}
        whole = content.lower() if content.isascii() else None
        for pattern, needed in self.shapes:
            if whole is not None and needed is not None and not any(x in whole for x in needed):
                continue
            for m in pattern.finditer(content):
                low = m[0].lower()
                name = _named(low)
                if name is None or not m[1]:
                    continue
                key = (name, _compared(low, name), m[1])
                if key not in out:
                    near = content[max(0, m.start() - self.around) : m.start() + self.around].lower()
                    unit_of = {"reserves_months": "months", "credit_score": ""}.get(name, "%")
                    conditions = sorted(e for e in found if any(a in near for a in self.aliases[e]))
                    out[key] = dict(zip(("metric", "operator", "value"), key, strict=True)) | {"unit": unit_of, "conditions": conditions, "source_text": m[0].strip()}
        return list(out.values())


def constraints(content: Column, found: Column, around: int = 300) -> Column:
    """Numeric limits of a text; ``found`` are its entities.

    Places of matches are needed, which column functions do not give, so this is a
    vectorised function over Arrow batches.  It is not given texts without any plain
    string that a limit must have.
    """
    from pyspark.sql.types import DataType
    from pyspark.sql.pandas.types import to_arrow_type

    kind = f"array<{CONSTRAINT}>"
    limits, given = Limits(around), to_arrow_type(DataType.fromDDL(kind))

    @F.arrow_udf(kind)
    def of(texts: pa.Array, entities: pa.Array) -> pa.Array:
        pairs = zip(texts.to_pylist(), entities.to_pylist(), strict=True)
        return pa.array([limits.of(t, e or []) if t else [] for t, e in pairs], type=given)

    def maybe(t: Column) -> Column:
        tests = [near(t, s.replace("{METRIC}", metric_pattern())) for s in V.CONSTRAINT_SHAPES]
        return F.when(F.lit(True) if any(x is None for x in tests) else reduce(lambda a, b: a | b, tests), t["text"])

    text = read(content, maybe)
    return of(text, F.when(text.isNotNull(), found))


def resolved_entity(phrase: Column) -> Column:
    """The first entity whose pattern the phrase has, or the phrase itself."""
    return F.coalesce(read(F.lower(T.strip(phrase)), lambda t: F.coalesce(*[F.when(c, F.lit(n)) for n, c in entity_conditions(t)])), phrase)


REFERENCE = "struct<if_entity:string,then_see:string>"


def references(content: Column) -> Column:
    """If-then references of a text, the first of equals."""

    def tidy(x: Column) -> Column:
        return F.regexp_replace(T.strip(x), r"[.,;:]+\z", "")

    def of(k: int, p: str) -> Column:
        one, two = (F.regexp_extract_all(content, F.lit(FLAGS + p), F.lit(g)) for g in (1, 2))
        phrases, sections = (two, one) if k == 2 else (one, two)
        return F.transform(phrases, lambda x, i: F.struct(tidy(x).alias("if_entity"), tidy(F.get(sections, i)).alias("then_see")))

    every = F.concat(*[of(k, p) for k, p in enumerate(V.CONDITIONAL_SHAPES)]).cast(f"array<{REFERENCE}>")
    once = first_of_equals(every, lambda x: x, REFERENCE)
    return F.transform(once, lambda x: F.struct(resolved_entity(x["if_entity"]).alias("if_entity"), x["then_see"].alias("then_see")))


def to_others(found: Column, code: Column) -> Column:
    """Those of ``found`` (see `references`) that a section of this code does not make to itself."""
    return F.filter(found, lambda x: x["then_see"] != code)


def conditional_references(content: Column, code: Column) -> Column:
    """If-then references to other sections, the first of equals."""
    return to_others(references(content), code)
