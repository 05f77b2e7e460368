"""Scalar text functions as column expressions (they run in the JVM, within code generation)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as text processing of the guides sees it: Unicode, and the four information separators.
BLANK = r"(?U)[\s\x1c-\x1f]"


def let(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)`` with ``value`` worked out once, however often ``of`` uses it."""
    return F.transform(F.array(value), of)[0]


def strip(text: Column) -> Column:
    """``text`` without white space at both ends."""
    return F.regexp_replace(text, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK + "+"), "")).cast("long")


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def slugify(text: Column, longest: int = 60) -> Column:
    """Lower-case letters, digits and single hyphens; at most ``longest`` characters."""
    kept = F.regexp_replace(F.lower(text), r"(?U)[^a-z0-9\s-]", "")
    joined = F.regexp_replace(kept, r"(?U)[\s-]+", "-")
    return F.substring(F.regexp_replace(joined, r"\A-+|-+\z", ""), 1, longest)


def safe_path_component(text: Column) -> Column:
    """``text`` without path separators, parent references and NUL; `_unknown` if nothing is left."""
    bare = reduce(lambda c, s: F.replace(c, F.lit(s), F.lit("")), ["..", "/", "\\", "\0"], text)
    return F.coalesce(blank_to_null(bare), F.lit("_unknown"))


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def chapter_number(code: Column) -> Column:
    """The number before the first dot, or null."""
    return F.split_part(code, F.lit("."), F.lit(1)).try_cast("int")


def part_letter(code: Column) -> Column:
    return F.lower(F.substring(code, 1, 1))


def output_path(source: Column, code: Column, title: Column, part: Column, chapter: Column) -> Column:
    """Where a section's file goes, below the output folder."""
    slug = slugify(title)
    first = F.concat(F.lit("part_"), F.lower(safe_path_component(part)), F.lit("/"), F.lower(safe_path_component(code)), F.lit("_"), slug, F.lit(".md"))
    second = F.concat(F.lit("chapter_"), safe_path_component(chapter), F.lit("/"), safe_path_component(code), F.lit("_"), slug, F.lit(".md"))
    return F.when(source == "fannie_mae", first).otherwise(second)


def path_prefix(source: Column, code: Column) -> Column:
    """The path of a section known by its code alone, up to the title."""
    first = F.concat(F.lit("part_"), part_letter(code), F.lit("/"), F.lower(safe_path_component(code)))
    second = F.concat(F.lit("chapter_"), F.split_part(code, F.lit("."), F.lit(1)), F.lit("/"), safe_path_component(code))
    return F.when(source == "fannie_mae", first).otherwise(second)


def hierarchy_path(part_name: Column, chapter_name: Column, chapter: Column, subpart_name: Column, code: Column) -> Column:
    """Part > chapter > subpart, blanks left out; the code where nothing is known."""
    level = F.coalesce(blank_to_null(chapter_name), F.concat(F.lit("Chapter "), blank_to_null(chapter)))
    path = F.concat_ws(" > ", blank_to_null(part_name), level, blank_to_null(subpart_name))
    return F.coalesce(blank_to_null(path), code)


def semantic_path(part_name: Column, chapter_name: Column, chapter: Column, subpart_name: Column, subpart: Column, code: Column) -> Column:
    """As `hierarchy_path`, with the subpart's code for its name, and always the code at the end."""
    level = F.coalesce(blank_to_null(chapter_name), F.concat(F.lit("Chapter "), blank_to_null(chapter)))
    below = F.coalesce(blank_to_null(subpart_name), F.concat(F.lit("Section "), blank_to_null(subpart)))
    return F.concat_ws(" > ", blank_to_null(part_name), level, below, code)


def summary(code: Column, title: Column, domains: Column, terms: Column) -> Column:
    """One or two sentences from a template, at most 200 characters."""
    readable = F.transform(F.slice(domains, 1, 3), lambda d: F.replace(F.element_at(F.split(d, r"\."), -1), F.lit("_"), F.lit(" ")))
    topics = F.when(F.size(terms) > 0, F.array_join(F.slice(terms, 1, 5), ", ")).otherwise(F.lit("general guidelines"))
    text = F.concat(code, F.lit(" ("), title, F.lit(") covers "), F.array_join(readable, ", "), F.lit(". Key topics: "), topics, F.lit("."))
    return F.when(F.char_length(text) > 200, F.concat(F.substring(text, 1, 197), F.lit("..."))).otherwise(text)


def chapter_label(code: Column) -> Column:
    """The label of the chapter that a code of the second guide begins with."""
    return F.concat(F.lit("chapter_"), F.split_part(code, F.lit("."), F.lit(1)))


def context_prefix(path: Column, heading: Column) -> Column:
    """The lines that say where a chunk comes from."""
    return F.concat_ws("\n", F.concat(F.lit("*Section: "), path, F.lit("*")), F.concat(F.lit("*Subsection: "), heading, F.lit("*")), F.lit("\n"))


def chunk_name(heading: Column, index: Column) -> Column:
    """The slug of the heading; without a heading `intro` for the first chunk (index 0) and part-n for others."""
    plain = F.when(index == 0, F.lit("intro")).otherwise(F.concat(F.lit("part-"), (index + 1).cast("string")))
    return F.when(F.coalesce(heading, F.lit("")) != "", slugify(heading)).otherwise(plain)


def chunk_id(source: Column, code: Column, name: Column) -> Column:
    """source/code/name (see `chunk_name`)."""
    return F.concat(source, F.lit("/"), code, F.lit("/"), name)


def sort_key(code: Column) -> list[Column]:
    """Chapter and section as numbers; zeros unless both are numbers."""
    major, minor = (F.split_part(code, F.lit("."), F.lit(k)).try_cast("int") for k in (1, 2))
    minor = F.when(F.contains(code, F.lit(".")), minor).otherwise(F.lit(0))
    both = major.isNotNull() & minor.isNotNull()
    return [F.when(both, major).otherwise(F.lit(0)), F.when(both, minor).otherwise(F.lit(0))]
