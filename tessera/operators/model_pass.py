"""The optional language-model pass: prompts, calls for what the cache lacks, and answers beside the rules' results."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources import files, storage
from . import answers
from .answer_cache import AnswerCache, cache_key

PROMPT_VERSION = "1.0"
PROMPT_WORDS = 3000
OUTPUT_TOKENS = 300
#: Shares of a call's tokens, in tenths, that count as input and as output.
INPUT_TENTHS, OUTPUT_TENTHS = 7, 3

SYSTEM_PROMPT = "You know mortgage underwriting guides well. Read the section you are given and state its facts as one JSON object of the form asked for, and nothing else."
#: What each prompt ends with: the form of the answer, which `answers.parsed` reads.
FORM = """

Answer with one JSON object with these fields; leave a field's array or object empty where the section has nothing for it:
"summary": one or two sentences on what the section requires, and of whom;
"entities": an object from kind (transaction_types, occupancy_types, property_types, loan_types, lien_positions, program_types, income_sources, asset_types, credit_events, project_types, valuation_types, documentation_types, aus_types) to an array of values that the section treats;
"numeric_constraints": an array of {"metric", "operator" (<= or >=), "value", "unit", "conditions" (an array of kind.value), "source_text"}, one for each limit, those in tables too;
"relationships": an array of {"type" (REQUIRES, CONDITIONAL or EXCEPTION), "target_section", "condition", "description"}."""


class Model(Protocol):
    """What a provider has to offer; prices are for 1,000 tokens."""

    name: str
    input_price: float
    output_price: float

    def complete(self, prompt: str, system: str = "") -> tuple[str, int]:
        """The answer and the tokens used."""


class StubModel:
    """A deterministic model that needs no network: its summary is the section's line of the prompt."""

    name, input_price, output_price = "stub", 0.00025, 0.00125

    def complete(self, prompt: str, system: str = "") -> tuple[str, int]:
        import json

        line = next((x for x in prompt.split("\n") if x.startswith("SECTION: ")), "")
        return json.dumps({"summary": line.removeprefix("SECTION: ")}), len(prompt.split())


def cost(input_tokens: Column, output_tokens: Column, model: Model) -> Column:
    return input_tokens / F.lit(1000) * F.lit(model.input_price) + output_tokens / F.lit(1000) * F.lit(model.output_price)


def first_rows(rows: DataFrame, order: list[str], most: int) -> DataFrame:
    """``rows`` with chosen: whether they are among the first ``most``; the head alone is ordered in one place."""
    head = rows.select(*order).orderBy(*order).limit(most).withColumn("chosen", F.lit(True))
    return rows.join(head, order, "left").withColumn("chosen", F.coalesce("chosen", F.lit(False)))


def prompt(title: Column, code: Column, source: Column, content: Column, entities: Column, limits: Column) -> Column:
    """The request for one chunk, with what the rules found in it and at most ``PROMPT_WORDS`` words of it."""
    words = F.filter(F.split(content, T.BLANK + "+"), lambda w: w != "")
    cut = F.when(F.size(words) > PROMPT_WORDS, F.concat(F.array_join(F.slice(words, 1, PROMPT_WORDS), " "), F.lit("\n\n[Content truncated]"))).otherwise(content)
    kinds = F.transform(files.by_kind(entities), lambda x: F.concat(x["kind"], F.lit(": "), F.array_join(x["values"], ", ")))
    found = F.transform(limits, lambda x: F.concat(x["metric"], x["operator"], x["value"], x["unit"]))
    some = lambda a: F.when(F.size(a) > 0, F.array_join(a, "; ")).otherwise(F.lit("None"))
    return F.concat(
        F.lit("SECTION: "), code, F.lit(" - "), title, F.lit("\nSOURCE: "), source, F.lit("\nENTITIES FOUND BY RULES: "), some(kinds), F.lit("\nLIMITS FOUND BY RULES: "), some(found), F.lit("\n\nCONTENT:\n"), cut, F.lit(FORM)
    )


def chunk_prompt() -> Column:
    """The request for a chunk of the enriched table."""
    c = F.col
    return prompt(c("title"), c("section_code"), c("source"), c("content"), c("entities"), c("numeric_constraints"))


def completed(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (any key, prompt) with answer, tokens and failed; a failed call gives an empty answer and 0 tokens."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = rows.drop("prompt").schema.add("answer", "string").add("tokens", "long").add("failed", "boolean")
    types = to_arrow_schema(schema)

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("prompt").to_pylist():
                try:
                    out.append((*model.complete(text or "", SYSTEM_PROMPT), False))
                except Exception:  # a provider may fail in any way; the row stays without an answer
                    out.append(("", 0, True))
            keys = [batch.column(n) for n in batch.schema.names if n != "prompt"]
            yield pa.RecordBatch.from_arrays([*keys, pa.array([a for a, _, _ in out], pa.string()), pa.array([n for _, n, _ in out], pa.int64()), pa.array([x for _, _, x in out], pa.bool_())], schema=types)

    return rows.mapInArrow(call, schema)


def enriched(chunks: DataFrame, model: Model, cache: AnswerCache | None, order: list[str], most: int | None = None, version: str = PROMPT_VERSION) -> DataFrame:
    """``chunks`` with llm_summary, llm_entities, llm_constraints, llm_relationships, llm_model, llm_tokens and llm_cached.

    What the rules found is left as it is.  Only the first ``most`` chunks in ``order``
    (columns that tell chunks apart) take part; the others get empty fields and no model.
    A key that the cache lacks is called for once, with the prompt of its first chunk;
    other chunks of the key count as cached.  A failed call gives empty fields with the
    model's name and is not stored.  Without a cache each chunk is called for.
    """
    spark = chunks.sparkSession
    took_part = F.lit(True)
    rows = chunks
    if most is not None:
        rows, took_part = first_rows(chunks, order, most), F.col("chosen")
    own = F.struct(*[F.col(f"`{n}`") for n in order])
    used = storage.stored(rows.filter(took_part).select(*order, cache_key(F.col("content"), model.name, version).alias("key"), chunk_prompt().alias("prompt")))
    if cache is None:
        calls = used.select(*order, "prompt")
        found = storage.stored(completed(calls.repartition(spark.sparkContext.defaultParallelism), model))
        found = found.select(*order, F.when(~F.col("failed"), F.to_json(answers.parsed(F.col("answer")))).alias("result"), F.col("tokens").alias("llm_tokens"), F.lit(False).alias("llm_cached"))
    else:
        looked = cache.get(used.groupBy("key").agg(F.min(own).alias("first"), F.min_by("prompt", own).alias("prompt")))
        looked = storage.stored(looked)
        misses = looked.filter("result IS NULL").select("key", "prompt").repartition(spark.sparkContext.defaultParallelism)
        # Written before anything reads it, so no answer is paid for twice.
        new = storage.stored(completed(misses, model).select("key", F.when(~F.col("failed"), F.to_json(answers.parsed(F.col("answer")))).alias("result"), "tokens", F.current_timestamp().alias("stored_at")))
        cache.put(new.filter("result IS NOT NULL").select("key", "result", F.lit(model.name).alias("model"), F.lit(version).alias("prompt_version"), "stored_at", F.col("tokens").alias("tokens_used")))
        by_key = looked.select("key", "first", F.col("result").alias("stored")).join(new.select("key", F.col("result").alias("fresh"), "tokens"), "key", "left")
        called = F.col("stored").isNull() & (own == F.col("first"))
        failed = F.col("stored").isNull() & F.col("fresh").isNull()
        found = used.select(*order, "key").join(by_key, "key").select(*order, F.coalesce("stored", "fresh").alias("result"), F.when(called, F.coalesce("tokens", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("llm_tokens"), (~called & ~failed).alias("llm_cached"))
    fields = answers.restored(F.coalesce("result", F.lit("{}")))
    done = chunks.join(found, order, "left").withColumn("__f", fields)
    return done.select(
        *[F.col(f"`{n}`") for n in chunks.columns],
        F.coalesce("__f.summary", F.lit("")).alias("llm_summary"),
        F.coalesce("__f.entities", F.create_map().cast(answers.ENTITIES)).alias("llm_entities"),
        F.coalesce("__f.numeric_constraints", F.array().cast(answers.LIMITS)).alias("llm_constraints"),
        F.coalesce("__f.relationships", F.array().cast(answers.RELATIONS)).alias("llm_relationships"),
        F.when(F.col("llm_cached").isNotNull(), F.lit(model.name)).otherwise(F.lit("")).alias("llm_model"),
        F.coalesce("llm_tokens", F.lit(0).cast("long")).alias("llm_tokens"),
        F.coalesce("llm_cached", F.lit(False)).alias("llm_cached"),
    )


def totals(rows: DataFrame, model: Model) -> DataFrame:
    """processed, cached, tokens and cost of an enriched table (llm_model, llm_tokens, llm_cached); a call's tokens are split before they are summed."""
    took_part, used = F.col("llm_model") != "", F.col("llm_tokens")
    part = lambda tenths: F.coalesce(F.sum(F.floor(used * tenths / 10)), F.lit(0)).cast("long")
    sums = rows.agg(F.count_if(took_part).alias("processed"), F.count_if(F.col("llm_cached")).alias("cached"), F.coalesce(F.sum(used), F.lit(0)).cast("long").alias("tokens"), part(INPUT_TENTHS).alias("input_tokens"), part(OUTPUT_TENTHS).alias("output_tokens"))
    return sums.withColumn("cost", F.round(cost(F.col("input_tokens"), F.col("output_tokens"), model), 6))


def dry_run(chunks: DataFrame, model: Model, cache: AnswerCache | None, order: list[str], most: int | None = None, version: str = PROMPT_VERSION) -> DataFrame:
    """One row: what a pass would call for and cost; nothing is called."""
    own = first_rows(chunks, order, most).filter("chosen") if most is not None else chunks
    keyed = own.select(cache_key(F.col("content"), model.name, version).alias("key"), T.word_count(chunk_prompt()).alias("words"))
    looked = cache.get(keyed) if cache is not None else keyed.withColumn("result", F.lit(None).cast("string"))
    miss = F.col("result").isNull()
    sums = looked.agg(F.count(F.lit(1)).alias("total_chunks"), F.count_if(~miss).alias("hits"), F.count_if(miss).alias("misses"), F.coalesce(F.sum(F.when(miss, F.floor(F.col("words") * 13 / 10))), F.lit(0)).cast("long").alias("input_tokens"))
    sums = sums.withColumn("output_tokens", F.col("misses") * OUTPUT_TOKENS)
    return sums.select("*", F.round(cost(F.col("input_tokens"), F.col("output_tokens"), model), 4).alias("estimated_cost"), F.lit(model.name).alias("model"))
