"""Markdown trees with front matter, manifests, state and the sinks of the engine.

Files are read by Spark's own readers, so a tree may lie in any store Spark reads.
Tables are the primary form of results; single text files are an export.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

FRONT = "struct<fields:map<string,string>,body:string,error:string>"


def scan_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """path, value of every `.md` file below ``folder``."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").text(folder, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), "value")


#: A plain YAML scalar beyond doubt: words of ASCII, of which none has a meaning of its own, with single separators.
_PLAIN = r"(?!(?:yes|no|on|off|true|false|null|y|n)(?![A-Za-z0-9 /_.-]))[A-Za-z][A-Za-z0-9]*(?:(?:[ /_.-]|://)[A-Za-z0-9]+)*"
_SIMPLE = rf"(?:{_PLAIN}|[0-9]+|'[A-Za-z0-9 ._/-]*')"
_PLAIN_ALONE, _DECIMAL = re.compile(_PLAIN, re.IGNORECASE), re.compile(r"[0-9]+\.[0-9]+")
_FIELDS = re.compile(rf"\n(?:[a-z_]+: {_SIMPLE}\n|[a-z_]+:\n(?:- {_SIMPLE}\n)+)*", re.IGNORECASE)
_FIELD = re.compile(r"^([a-z_]+):(?: (.*))?$", re.MULTILINE | re.IGNORECASE)
#: Longest plain scalar that is sure to stay on one line.
_SHORT = 40


def _simple_fields(front: str) -> dict[str, str] | None:
    """The fields of front matter that is of simple lines alone, as YAML gives them; None for any other."""
    if not _FIELDS.fullmatch(front):
        return None
    found = _FIELD.findall(front)
    if len({k for k, _ in found}) < len(found):
        return None
    return {k: v[1:-1] if v[0] == "'" else v for k, v in found if v}


def split_front_matter(text: str | None) -> dict:
    """The fields between the first two `---`, as text, and what follows; bad YAML gives an error and no fields."""
    import yaml

    text = text or ""
    if not text.startswith("---") or (end := text.find("---", 3)) < 0:
        return {"fields": {}, "body": text, "error": None}
    body = text[end + 3 :].strip()
    if (simple := _simple_fields(text[3:end])) is not None:
        return {"fields": simple, "body": body, "error": None}
    try:
        found = yaml.load(text[3:end], Loader=yaml.BaseLoader)  # every scalar stays text, as it is written
    except yaml.YAMLError as error:
        return {"fields": {}, "body": body, "error": str(error)[:200]}
    if found is None:
        return {"fields": {}, "body": body, "error": None}
    if not isinstance(found, dict):
        return {"fields": {}, "body": body, "error": "the front matter is no mapping"}
    return {"fields": {str(k): v for k, v in found.items() if isinstance(v, str)}, "body": body, "error": None}


def _front(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([split_front_matter(t) for t in texts], columns=["fields", "body", "error"])


def front_matter(value: Column) -> Column:
    """Fields, body and error of a file."""
    return F.pandas_udf(_front, FRONT)(value)


def sections(files: DataFrame) -> DataFrame:
    """path, content_hash, the known fields (absent: empty), body and error."""
    parsed = files.select("path", T.content_hash(F.col("value")).alias("content_hash"), front_matter(F.col("value")).alias("f"))
    text = lambda k: F.coalesce(F.try_element_at("f.fields", F.lit(k)), F.lit("")).alias(k)
    number = lambda k: F.coalesce(F.try_element_at("f.fields", F.lit(k)).try_cast("int"), F.lit(0)).alias(k)
    names = ["source", "section_code", "title", "url", "part", "part_name", "chapter", "chapter_name", "subpart", "subpart_name", "effective_date"]
    return parsed.select("path", "content_hash", *map(text, names), number("word_count"), number("table_count"), "f.body", "f.error")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """section_code, status, content_hash out of a manifest in JSON; a corrupt one gives no rows."""
    schema = "sections map<string,string>, content_hashes map<string,string>"
    found = spark.read.schema(schema).option("multiLine", "true").option("mode", "PERMISSIVE").json(path)
    rows = found.select(F.explode("sections").alias("section_code", "status"), "content_hashes")
    return rows.select("section_code", "status", F.try_element_at("content_hashes", F.col("section_code")).alias("content_hash"))


COUNTERS = ["total_discovered", "total_scraped", "total_failed", "total_skipped", "total_quality_warnings"]


def read_manifest_totals(spark: SparkSession, path: str) -> DataFrame:
    """source, the counters, started_at, last_updated and the errors of a manifest in JSON; a corrupt one gives no rows."""
    error = "array<struct<url:string,section_code:string,error_type:string,error_message:string,status_code:int,timestamp:string,retries_attempted:int>>"
    schema = "source string, " + ", ".join(f"{n} long" for n in COUNTERS) + f", started_at string, last_updated string, errors {error}"
    found = spark.read.schema(schema).option("multiLine", "true").option("mode", "PERMISSIVE").json(path).filter("source IS NOT NULL")
    return found.select("source", *[F.coalesce(n, F.lit(0)).alias(n) for n in COUNTERS], *[F.coalesce(n, F.lit("")).alias(n) for n in ("started_at", "last_updated")], F.coalesce("errors", F.array().cast(error)).alias("errors"))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """path, content_hash of the last run; a corrupt or absent state gives no rows."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath):
        return spark.createDataFrame([], "path string, content_hash string")
    found = spark.read.schema("file_hashes map<string,string>").option("multiLine", "true").json(path)
    return found.select(F.explode("file_hashes").alias("path", "content_hash"))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a table; the commit of the job makes it whole or absent."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def by_kind(names: str) -> Column:
    """An array of kind.value as an array of (kind, values), kinds in order of their first value."""
    kinds = F.array_distinct(F.transform(names, lambda x: F.substring_index(x, ".", 1)))
    values = lambda k: F.transform(F.filter(names, lambda x: F.substring_index(x, ".", 1) == k), lambda x: F.substr(x, F.length(k) + 2))
    return F.transform(kinds, lambda k: F.struct(k.alias("kind"), values(k).alias("values")))


#: How many of a chunk's findings its file shows.
SHOWN = {"key_terms": 15, "numeric_constraints": 5, "cross_source_links": 5}


def shown(name: str) -> Column:
    """The first of a chunk's findings, as many as its file shows."""
    return F.slice(name, 1, SHOWN[name])


def _line(label: str, value: Column) -> Column:
    return F.when(value.isNotNull() & (value != ""), F.concat(F.lit(f"{label}: "), value))


def _model_lines() -> list[Column]:
    """The lines of a model's findings, from the columns of the model pass."""
    c = F.col
    kinds = F.transform(F.map_entries("llm_entities"), lambda x: F.concat(x["key"], F.lit("="), F.array_join(x["value"], ",")))
    limits = F.transform(F.slice("llm_constraints", 1, 5), lambda x: F.concat(x["metric"], x["operator"], x["value"], x["unit"]))
    relations = F.transform(F.slice("llm_relationships", 1, 5), lambda x: F.concat(x["type"], F.lit("->"), x["target_section"]))
    # The labels and separators are the file's format.
    return [
        _line("LLM Summary", c("llm_summary")),
        _line("LLM Entities", F.array_join(kinds, "; ")),
        _line("LLM Constraints", F.array_join(limits, "; ")),
        _line("LLM Relationships", F.array_join(relations, "; ")),
        _line("LLM Model", c("llm_model")),
    ]


def model_lines() -> Column:
    """The lines of a model's findings that a chunk's file has."""
    return F.concat_ws("\n", *_model_lines())


def chunk_header(model_pass: bool = False) -> Column:
    """The text of a chunk's file: its facts line by line, a rule, and the content; absent facts but domains have no line.

    With ``model_pass`` the chunk has the columns of the model pass, which get lines of their own.
    """
    line = _line
    c = F.col
    enumerations = F.transform(by_kind("enumerations"), lambda x: F.concat(x["kind"], F.lit("("), F.array_join(x["values"], ", "), F.lit(")")))
    entities = F.transform(by_kind("entities"), lambda x: F.concat(x["kind"], F.lit("="), F.array_join(x["values"], ",")))
    limits = F.transform(shown("numeric_constraints"), lambda x: F.concat(x["metric"], x["operator"], x["value"], x["unit"]))
    linked = F.transform(shown("cross_source_links"), lambda x: F.concat(x["source"], F.lit("/"), x["section_code"]))
    # The labels and separators are the file's format.
    lines = [
        line("Source", c("source")),
        F.concat(F.lit("Section: "), c("section_code"), F.lit(" - "), c("title")),
        line("Subsection", c("heading")),
        F.concat(F.lit("Domains: "), F.coalesce(F.array_join("domains", ", "), F.lit(""))),
        line("MISMO", F.array_join(enumerations, "; ")),
        line("Key Terms", F.array_join(shown("key_terms"), ", ")),
        line("Entities", F.array_join(entities, "; ")),
        F.when(c("requirement_type") != "guideline", F.concat(F.lit("Requirement: type="), c("requirement_type"), F.lit(", severity="), c("severity"))),
        line("Constraints", F.array_join(limits, "; ")),
        line("Cross-Source", F.array_join(linked, ", ")),
        *(_model_lines() if model_pass else []),
        line("Content Type", c("content_type")),
        line("Summary", c("summary")),
        F.lit("---"),
        F.coalesce(c("content"), F.lit("")),
    ]
    return F.concat_ws("\n", *lines)


def export_texts(df: DataFrame, folder: str, name: str = "filename", text: str = "text") -> DataFrame:
    """Write one file a row to a folder that all executors share; returns name and bytes of each."""

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        fs, base = FileSystem.from_uri(folder)
        for f in frames:
            sizes = []
            for n, t in zip(f[name], f[text], strict=True):
                path = f"{base}/{n}"
                fs.create_dir(path.rpartition("/")[0], recursive=True)
                with fs.open_output_stream(f"{path}.tmp") as out:
                    out.write(data := (t or "").encode())
                fs.move(f"{path}.tmp", path)
                sizes.append(len(data))
            yield pd.DataFrame({"name": f[name], "bytes": sizes})

    return df.select(name, text).mapInPandas(write, "name string, bytes long")


def index_entries(chunks: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep``, chunk_id, and its entry of the index as JSON: without the content, absent facts left out.

    The date, address and place of a section come from columns of these names, if there are any.
    Links may be there as JSON text, so that a list that many chunks share is written once.
    """
    c = F.col
    mapped = lambda name: F.map_from_entries(by_kind(name))
    some = lambda name, value, alias=None: F.when(F.size(name) > 0, value).alias(alias or name)
    own = lambda name: (F.coalesce(c(name).cast("string"), F.lit("")) if name in chunks.columns else F.lit("")).alias(name)
    date = (c("effective_date") if "effective_date" in chunks.columns else F.lit(None)).cast("string").alias("effective_date")
    requirement = F.when(c("requirement_type") != "guideline", F.struct(c("requirement_type").alias("type"), "severity")).alias("requirement")
    limits = F.transform("numeric_constraints", lambda x: F.struct(x["metric"].alias("metric"), x["operator"].alias("operator"), x["value"].alias("value"), x["unit"].alias("unit"), x["conditions"].alias("conditions")))
    first = ["chunk_id", "source", "section_code", "title", "heading", "domains", mapped("enumerations").alias("mismo_tags"), "key_terms", "content_type", "summary", "cross_source_links", "word_count", "has_table"]
    fields = [*first, date, own("url"), own("hierarchy_path"), some("entities", mapped("entities")), requirement, some("numeric_constraints", limits), some("conditional_refs", c("conditional_refs"))]
    if "llm_model" in chunks.columns:
        found = F.transform("llm_constraints", lambda x: F.struct(*[x[n].alias(n) for n in ("metric", "operator", "value", "unit", "conditions")]))
        said = lambda name: F.when(c(name) != "", c(name)).alias(name)
        fields += [said("llm_summary"), some("llm_entities", c("llm_entities")), some("llm_constraints", found), some("llm_relationships", c("llm_relationships")), said("llm_model")]
    entry = F.to_json(F.struct(*fields))
    if dict(chunks.dtypes)["cross_source_links"] == "string":  # as JSON, which is put between the fields before and after it
        k = next(i for i, x in enumerate(first) if isinstance(x, str) and x == "cross_source_links")
        before = T.let(F.to_json(F.struct(*fields[:k])), lambda x: F.substring(x, F.lit(1), F.char_length(x) - 1))
        after = F.substring(F.to_json(F.struct(*fields[k + 1 :])), 2, 2**31 - 1)  # neither is empty: domains and the address are never null
        entry = F.concat(before, F.lit(',"cross_source_links":'), c("cross_source_links"), F.lit(","), after)
    return chunks.select(*(keep or []), "chunk_id", entry.alias("entry"))


def chunk_markers(markdown: Column, chunk_id: Column, headings: Column) -> Column:
    """``markdown`` with the section's marker on top and a marker before each heading's first line.

    ``headings`` is an array of (heading, chunk_id); a line counts if it is of level 2
    or 3 and begins with the heading.
    """

    def mark(text: str, own: str | None, parts: list) -> str:
        import re

        text = f"<!-- chunk: {own} -->\n\n{text}" if own else text
        for p in parts if parts is not None else []:
            if p["heading"]:
                found = re.compile(rf"^(?=#{{2,3}}\s+{re.escape(p['heading'])})", re.MULTILINE)
                text = found.sub(lambda _, p=p: f"<!-- chunk: {p['chunk_id']} -->\n", text, count=1)
        return text

    def of(texts: pd.Series, ids: pd.Series, lists: pd.Series) -> pd.Series:
        return pd.Series([mark(t or "", i, x) for t, i, x in zip(texts, ids, lists, strict=True)])

    return F.pandas_udf(of, "string")(markdown, chunk_id, headings)


FRONT_KEYS = ["source", "section_code", "title", "url", "part", "part_name", "chapter", "chapter_name"]
FRONT_MORE = ["subpart", "subpart_name", "effective_date"]


def render_front_matter(section: dict) -> str:
    """YAML of a section's fields; optional ones only where they are known, references in order."""
    data = {k: section.get(k) or "" for k in FRONT_KEYS} | {k: section[k] for k in FRONT_MORE if section.get(k)}
    data |= {k: int(section.get(k) or 0) for k in ("word_count", "table_count")}
    references = section.get("cross_references")
    if references is not None and len(references):
        data["cross_references"] = sorted(set(references))
    return "".join(_rendered(k, v) for k, v in data.items())


def _rendered(key: str, value: str | int | list[str]) -> str:
    """One field as YAML; what is plain beyond doubt needs no emitter."""
    import yaml

    if isinstance(value, int):
        return f"{key}: {value}\n"
    if isinstance(value, str):
        if not value or _DECIMAL.fullmatch(value):
            return f"{key}: '{value}'\n"
        if len(value) <= _SHORT and _PLAIN_ALONE.fullmatch(value):
            return f"{key}: {value}\n"
    elif all(len(x) <= _SHORT and _PLAIN_ALONE.fullmatch(x) for x in value):
        return f"{key}:\n" + "".join(f"- {x}\n" for x in value)
    return yaml.safe_dump({key: value}, default_flow_style=False, sort_keys=False, allow_unicode=True)


def section_file(section: Column) -> Column:
    """The markdown file of a section (a struct of its fields, content_markdown and announcements)."""

    def render(s: dict) -> str:
        lines = ["---", render_front_matter(s).rstrip(), "---", "", f"# {s['section_code']}: {s['title']}", "", s.get("content_markdown") or ""]
        news = s.get("announcements")
        if news is not None and len(news):
            lines += ["", "---", "", f"*Related Announcements: {', '.join(news)}*"]
        return "\n".join(lines)

    def of(frame: pd.DataFrame) -> pd.Series:
        return pd.Series([render(r) for r in frame.to_dict("records")])

    return F.pandas_udf(of, "string")(section)
