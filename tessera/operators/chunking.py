"""Splitting sections into chunks: headings, definitions, oversize and undersize.

A section's chunks stay one array until the end (they are folded in order), so
nothing is shuffled; ``chunked`` explodes them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

MIN_WORDS, MAX_WORDS = 30, 800
CHUNK = "struct<heading:string,content:string>"
HEADING = r"(?mdU)^(#{2,4})\s+(.+)$"
TERM = r"(?mdU)^(?:\*\*(.+?)\*\*|__(.+?)__)\s*$"
_MARK = "\x01"


def chunk(heading: Column, content: Column) -> Column:
    return F.struct(heading.cast("string").alias("heading"), T.strip(content).alias("content"))


def has_table(content: Column) -> Column:
    """Three bars on one line."""
    return content.rlike(r"(?d)\|.*\|.*\|")


def _cut(markdown: Column, pattern: str) -> Column:
    """The text before the first match, and the texts from each match on."""
    return F.split(F.regexp_replace(markdown, pattern, _MARK + "$0"), _MARK)


def by_headings(markdown: Column) -> Column:
    """Chunks from each heading of level 2 to 4 on; text before the first is an intro without heading."""
    parts = _cut(markdown, HEADING)
    intro = F.when(T.strip(parts[0]) != "", F.array(chunk(F.lit(None), parts[0]))).otherwise(F.array().cast(f"array<{CHUNK}>"))
    rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1))), lambda p: chunk(T.strip(F.regexp_extract(p, r"(?dU)\A#{2,4}\s+(.+)", 1)), p))
    return F.when(F.size(parts) == 1, F.array(chunk(F.lit(None), markdown))).otherwise(F.concat(intro, rest)).cast(f"array<{CHUNK}>")


def by_terms(markdown: Column) -> Column:
    """Chunks from each bold line on; null where there are fewer than three."""
    parts = _cut(markdown, TERM)
    intro = F.when(T.word_count(T.strip(parts[0])) > 10, F.array(chunk(F.lit(None), parts[0]))).otherwise(F.array().cast(f"array<{CHUNK}>"))
    name = lambda p: F.coalesce(T.blank_to_null(F.regexp_extract(p, r"(?dU)\A\*\*(.+?)\*\*", 1)), F.regexp_extract(p, r"(?dU)\A__(.+?)__", 1))
    rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1))), lambda p: chunk(name(p), p))
    return F.when(F.size(parts) > 3, F.concat(intro, rest).cast(f"array<{CHUNK}>"))


_let = T.let


def _runs(words: Column, begins: Callable[[Column, Column], Column]) -> Column:
    """(first, length) of the runs that elements of so many ``words`` form in order.

    ``begins(n, w)``: whether an element of w words begins a run of its own after one of
    n words so far.  The fold carries a number and the places where runs begin, as text:
    nothing of it grows with the elements, so the work does not grow with their square.
    """
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("i"), F.lit("").alias("at"))

    def step(s: Column, w: Column) -> Column:
        new = (s["i"] == 0) | begins(s["n"], w)
        at = F.when(new, F.concat(s["at"], s["i"].cast("string"), F.lit(","))).otherwise(s["at"])
        return F.struct(F.when(new, w).otherwise(s["n"] + w).cast("long").alias("n"), (s["i"] + 1).alias("i"), at.alias("at"))

    def cut(s: Column) -> Column:
        firsts = F.transform(F.filter(F.split(s["at"], ","), lambda x: x != ""), lambda x: x.cast("int"))
        ends = lambda f: F.transform(f, lambda a, k: F.struct(a.alias("first"), (F.coalesce(F.get(f, k + 1), s["i"]) - a).alias("length")))
        return _let(firsts, ends)

    return _let(F.aggregate(words.cast("array<bigint>"), start, step), cut)


def pack_paragraphs(content: Column, most: int = MAX_WORDS) -> Column:
    """Paragraphs put together while they have at most ``most`` words; a longer one stays whole."""

    def packed(paragraphs: Column) -> Column:
        runs = _runs(F.transform(paragraphs, T.word_count), lambda n, w: n + w > most)
        return F.transform(runs, lambda r: F.array_join(F.slice(paragraphs, r["first"] + 1, r["length"]), "\n\n"))

    return _let(F.split(content, "\n\n+"), packed)


def split_oversize(chunks: Column, most: int = MAX_WORDS) -> Column:
    """Long chunks without a table are cut between paragraphs; the pieces keep the heading."""

    def one(c: Column) -> Column:
        whole = (T.word_count(c["content"]) <= most) | has_table(c["content"])
        pieces = F.transform(pack_paragraphs(c["content"], most), lambda p: chunk(c["heading"], p))
        return F.when(whole, F.array(c)).otherwise(pieces).cast(f"array<{CHUNK}>")

    return F.flatten(F.transform(chunks, one))


def merge_undersize(chunks: Column, least: int = MIN_WORDS) -> Column:
    """A chunk of fewer than ``least`` words takes in the next ones and keeps its heading."""

    def merged(own: Column) -> Column:
        runs = _runs(F.transform(own, lambda c: T.word_count(c["content"])), lambda n, w: n >= least)

        def glued(r: Column) -> Column:
            texts = F.transform(F.slice(own, r["first"] + 1, r["length"]), lambda c: c["content"])
            return F.when(r["length"] == 1, F.get(own, r["first"])).otherwise(chunk(F.get(own, r["first"])["heading"], F.array_join(texts, "\n\n")))

        return F.transform(runs, glued).cast(f"array<{CHUNK}>")

    return _let(chunks, merged)


def adaptive(markdown: Column, content_type: Column, least: int = MIN_WORDS, most: int = MAX_WORDS) -> Column:
    """The chunks of a section: terms for definitions, else headings and size limits."""
    headed = by_headings(markdown)
    defined = F.coalesce(by_terms(markdown), headed)
    return merge_undersize(F.when(content_type == "definition", defined).otherwise(split_oversize(headed, most)), least)


def merge_small_subsections(subsections: Column, least: int = 50) -> Column:
    """Subsections (heading, content, words, tables, lists) of fewer than ``least`` words take in the next one."""
    kind = "struct<heading:string,content:string,words:bigint,tables:boolean,lists:boolean>"

    def merged(own: Column) -> Column:
        runs = _runs(F.transform(own, lambda s: s["words"]), lambda n, w: n >= least)

        def glued(r: Column) -> Column:
            def whole(parts: Column) -> Column:
                texts = F.transform(parts, lambda s, k: F.when(k == 0, s["content"]).otherwise(F.concat(F.lit("## "), s["heading"], F.lit("\n\n"), s["content"])))
                return F.struct(
                    parts[0]["heading"].alias("heading"),
                    F.array_join(texts, "\n\n").alias("content"),
                    F.aggregate(parts, F.lit(0).cast("long"), lambda a, s: a + s["words"]).alias("words"),
                    F.exists(parts, lambda s: s["tables"]).alias("tables"),
                    F.exists(parts, lambda s: s["lists"]).alias("lists"),
                )

            return _let(F.slice(own, r["first"] + 1, r["length"]), whole)

        return F.transform(runs, glued).cast(f"array<{kind}>")

    return _let(subsections.cast(f"array<{kind}>"), merged)


def semantic(sections: DataFrame, least: int = 50, most: int = 2000) -> DataFrame:
    """A chunk for each section and, of those of more than ``most`` words and several subsections, one for each of these.

    ``sections`` have source, section_code, title, content_markdown, word_count, subsections
    (heading, content, words, tables, lists) and the names and codes of their place.  A
    subsection's text begins with where it stands.
    """
    c = F.col
    place = T.semantic_path(c("part_name"), c("chapter_name"), c("chapter_code"), c("subpart_name"), c("subpart_code"), c("section_code"))
    own = F.struct(F.lit("section").alias("chunk_type"), F.lit(None).cast("string").alias("heading"), c("content_markdown").alias("content"), c("word_count").cast("long").alias("words"))
    parts = F.transform(
        merge_small_subsections(c("subsections"), least),
        lambda s: F.struct(F.lit("subsection").alias("chunk_type"), s["heading"].alias("heading"), F.concat(T.context_prefix(F.concat(c("section_code"), F.lit(" - "), c("title")), s["heading"]), s["content"]).alias("content"), s["words"].alias("words")),
    )
    split = (c("word_count") > most) & (F.size("subsections") > 1)
    rows = sections.select("source", "section_code", "title", place.alias("place"), F.explode(F.when(split, F.concat(F.array(own), parts)).otherwise(F.array(own))).alias("k"))
    path = F.concat_ws(" > ", "place", "k.heading")
    chunk_id = F.concat_ws("/", "source", "section_code", T.slugify(c("k.heading")))
    return rows.select("source", "section_code", "k.chunk_type", chunk_id.alias("chunk_id"), F.when(c("k.heading").isNull(), c("title")).otherwise(F.concat(c("section_code"), F.lit(": "), c("k.heading"))).alias("title"), "k.heading", path.alias("hierarchy_path"), "k.content", c("k.words").alias("word_count"))


def cut(texts: DataFrame, chunks: Column) -> DataFrame:
    """A row for each chunk: the columns of ``texts``, seq, heading, content, word_count, has_table."""
    rows = texts.select("*", F.posexplode(chunks).alias("seq", "chunk")).select(*texts.columns, "seq", "chunk.heading", "chunk.content")
    return rows.select("*", T.word_count(F.col("content")).alias("word_count"), has_table(F.col("content")).alias("has_table"))


def chunked(sections: DataFrame, chunks: Column) -> DataFrame:
    """As `cut`, with chunk_id."""
    name = T.chunk_name(F.col("heading"), F.col("seq"))
    return cut(sections, chunks).withColumn("chunk_id", T.chunk_id(F.col("source"), F.col("section_code"), name))
