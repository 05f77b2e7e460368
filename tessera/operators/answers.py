"""A model's answers: JSON text to typed fields, each with its default where it is missing or of another type.

The text is parsed as a VARIANT, so a field of the wrong type falls to its default and
leaves the others as they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as T

LIMITS = "array<struct<metric:string,operator:string,value:string,unit:string,conditions:array<string>,source_text:string>>"
RELATIONS = "array<struct<type:string,target_section:string,condition:string,description:string>>"
ENTITIES = "map<string,array<string>>"
ANSWER = f"struct<summary:string,entities:{ENTITIES},numeric_constraints:{LIMITS},relationships:{RELATIONS}>"


def bare(answer: Column) -> Column:
    """The text between fences, if there are any: the line of an opening fence goes whole."""
    text = T.strip(F.coalesce(answer, F.lit("")))
    line_end = F.instr(text, "\n")
    opened = F.when(text.startswith("```"), F.when(line_end > 0, F.substr(text, line_end + 1)).otherwise(F.lit(""))).otherwise(text)
    return T.strip(F.when(opened.endswith("```"), F.left(opened, F.char_length(opened) - 3)).otherwise(opened))


def _object(value: Column) -> Column:
    """The fields of a JSON object; null for anything else."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def _array(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _string(value: Column) -> Column:
    """A value as text; arrays and objects as JSON, true and null with a capital letter."""
    kind = F.schema_of_variant(value)
    own = F.when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), F.to_json(value)).otherwise(F.try_variant_get(value, "$", "string"))
    return F.when(F.is_variant_null(value), F.lit("None")).when(kind == "BOOLEAN", F.initcap(own)).otherwise(own)


def _field(fields: Column, name: str, default: str = "") -> Column:
    return F.when(F.map_contains_key(fields, F.lit(name)), _string(F.element_at(fields, name))).otherwise(F.lit(default))


def _is_string(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def _listed(value: Column, keys: list[str], of, kind: str) -> Column:
    """``of`` the fields of each object in an array that has all of ``keys``; no array gives an empty one."""
    found = F.filter(F.transform(_array(value), _object), lambda x: x.isNotNull())
    has_all = F.filter(found, lambda x: F.forall(F.array(*map(F.lit, keys)), lambda k: F.array_contains(F.map_keys(x), k)))
    return F.coalesce(F.transform(has_all, of), F.array().cast(kind))


def _limit(x: Column) -> Column:
    given = F.coalesce(F.transform(F.filter(_array(F.element_at(x, "conditions")), _is_string), _string), F.array().cast("array<string>"))
    # The defaults of the answer's format.
    return F.struct(_field(x, "metric").alias("metric"), _field(x, "operator", "<=").alias("operator"), _field(x, "value").alias("value"), _field(x, "unit", "%").alias("unit"), given.alias("conditions"), _field(x, "source_text").alias("source_text"))


def _relation(x: Column) -> Column:
    return F.struct(*[_field(x, n).alias(n) for n in ("type", "target_section", "condition", "description")])


def parsed(answer: Column) -> Column:
    """The fields of an answer (``ANSWER``); what is no JSON object gives all defaults."""
    fields = _object(F.try_parse_json(bare(answer)))
    entities = F.map_filter(_object(F.element_at(fields, "entities")), lambda _, v: _array(v).isNotNull())
    entities = F.transform_values(entities, lambda _, v: F.transform(_array(v), _string))
    return F.struct(
        F.coalesce(_field(fields, "summary"), F.lit("")).alias("summary"),
        F.coalesce(entities, F.create_map().cast(ENTITIES)).alias("entities"),
        _listed(F.element_at(fields, "numeric_constraints"), ["metric", "value"], _limit, LIMITS).alias("numeric_constraints"),
        _listed(F.element_at(fields, "relationships"), ["type"], _relation, RELATIONS).alias("relationships"),
    )


def restored(result: Column) -> Column:
    """The fields (``ANSWER``) out of what ``F.to_json(parsed(...))`` gave."""
    return F.from_json(result, ANSWER)
