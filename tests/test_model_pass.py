"""The answer cache, the answers' types and the model pass, without a network."""

import json
import sys
import threading
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tessera.operators import answers, model_pass
from tessera.operators.answer_cache import AnswerCache, cache_key
from tessera.sources import files

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import the tests
CHUNK = ["section_id", "seq"]
SCHEMA = "section_id long, seq long, source string, section_code string, title string, content string, entities array<string>, numeric_constraints array<struct<metric:string,operator:string,value:string,unit:string>>"
ANSWER = {
    "summary": "At most 80%.",
    "entities": {"occupancy_types": ["Investment"]},
    "numeric_constraints": [{"metric": "LTV", "value": "80", "conditions": ["occupancy_types.Investment"], "source_text": "80% LTV"}],
    "relationships": [{"type": "REQUIRES", "target_section": "B1-1-01", "condition": "always", "description": "d"}],
}


class Counting:
    """Leaves a file for each call; fails where the prompt says so."""

    name, input_price, output_price = "counting", 1.0, 10.0

    def __init__(self, folder):
        self.folder = str(folder)

    def complete(self, prompt, system=""):
        with open(f"{self.folder}/{uuid.uuid4().hex}", "w") as out:
            out.write(prompt)
        if "fail here" in prompt:
            raise OSError("no answer")
        return "```json\n" + json.dumps(ANSWER) + "\n```", 150


@pytest.fixture()
def calls(tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()
    return folder


def chunks(spark, contents):
    return spark.createDataFrame([(k, 0, "freddie_mac", f"110{k}.1", f"T{k}", x, ["a.b", "a.c", "d.e"], [("LTV", "<=", "80", "%")]) for k, x in enumerate(contents)], SCHEMA)


def count(folder):
    return len(list(folder.iterdir()))


def test_a_second_run_calls_nothing(spark, tmp_path, calls):
    rows, model = chunks(spark, ["one", "two", "two", "fail here", None]), Counting(calls)
    cache = AnswerCache(spark, f"file://{tmp_path}/cache")
    first = model_pass.enriched(rows, model, cache, CHUNK)
    got = {r["section_id"]: r for r in first.collect()}
    assert count(calls) == 4
    assert [(got[k]["llm_cached"], got[k]["llm_tokens"], got[k]["llm_model"], got[k]["llm_summary"]) for k in range(5)] == [(False, 150, "counting", "At most 80%."), (False, 150, "counting", "At most 80%."), (True, 0, "counting", "At most 80%."), (False, 0, "counting", ""), (False, 150, "counting", "At most 80%.")]
    assert got[0]["llm_entities"] == {"occupancy_types": ["Investment"]} and got[0]["entities"] == ["a.b", "a.c", "d.e"]
    assert got[0]["llm_constraints"][0].asDict() == {"metric": "LTV", "operator": "<=", "value": "80", "unit": "%", "conditions": ["occupancy_types.Investment"], "source_text": "80% LTV"}
    assert got[0]["llm_relationships"][0].asDict() == ANSWER["relationships"][0] and got[3]["llm_entities"] == {}
    assert model_pass.totals(first, model).first().asDict() == {"processed": 5, "cached": 1, "tokens": 450, "input_tokens": 315, "output_tokens": 135, "cost": 1.665}
    second = model_pass.enriched(rows.filter("section_id <> 3"), model, cache, CHUNK).collect()
    assert count(calls) == 4 and all(r["llm_cached"] and r["llm_summary"] for r in second)
    model_pass.enriched(rows, model, cache, CHUNK)
    assert count(calls) == 5  # the failed one is asked for again
    model_pass.enriched(rows, model, cache, CHUNK, version="2.0")
    assert count(calls) == 9


def test_without_a_cache_each_chunk_is_asked_for(spark, calls):
    rows = chunks(spark, ["same", "same", "fail here"])
    got = model_pass.enriched(rows, Counting(calls), None, CHUNK).orderBy("section_id").collect()
    assert count(calls) == 3 and [(r["llm_cached"], r["llm_tokens"]) for r in got] == [(False, 150), (False, 150), (False, 0)]


def test_only_the_first_chunks_take_part(spark, tmp_path, calls):
    rows, cache = chunks(spark, list("abcde")), AnswerCache(spark, f"file://{tmp_path}/cache")
    got = model_pass.enriched(rows, Counting(calls), cache, CHUNK, most=2)
    assert count(calls) == 2
    assert [(r["llm_summary"] != "", r["llm_model"]) for r in got.orderBy("section_id").collect()] == [(True, "counting")] * 2 + [(False, "")] * 3
    dry = model_pass.dry_run(rows, Counting(calls), cache, CHUNK).first()
    assert (dry["total_chunks"], dry["hits"], dry["misses"], dry["output_tokens"], dry["model"]) == (5, 2, 3, 900, "counting") and count(calls) == 2
    assert model_pass.dry_run(rows, Counting(calls), None, CHUNK, most=3).first()["misses"] == 3
    none = model_pass.enriched(rows.limit(0), Counting(calls), cache, CHUNK)
    assert none.collect() == [] and model_pass.totals(none, Counting(calls)).first()["processed"] == 0


def entries(spark, keys, result='{"summary":"x"}', at="2024-01-01 00:00:00"):
    rows = [(k, result, "m", "1", 7) for k in keys]
    return spark.createDataFrame(rows, "key string, result string, model string, prompt_version string, tokens_used long").withColumn("stored_at", F.lit(at).cast("timestamp"))


def test_set_clear_and_statistics(spark, tmp_path):
    cache = AnswerCache(spark, f"file://{tmp_path}/deep/cache")
    keys = [f"{k:02x}" + "0" * 62 for k in (0, 1, 0x1E, 0xAB)]
    asked = spark.createDataFrame([(k,) for k in [*keys, "ff" + "0" * 62]], "key string")
    assert cache.statistics(cache.get(asked)).first().asDict() == {"hits": 0, "misses": 5, "hit_rate": 0.0, "entries": 0}
    assert cache.statistics(cache.get(asked.limit(0))).first()["hit_rate"] == 0.0
    cache.put(entries(spark, keys))
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "deep" / "cache").rglob("*.parquet") if "shard=00" not in str(p)}
    cache.put(entries(spark, keys[:1], '{"summary":"newer"}', "2025-01-01 00:00:00"))
    cache.put(entries(spark, keys[:1], '{"summary":"older"}', "2023-01-01 00:00:00"))
    assert untouched == {p: p.stat().st_mtime_ns for p in (tmp_path / "deep" / "cache").rglob("*.parquet") if "shard=00" not in str(p)}
    got = {r["key"]: r["result"] for r in cache.get(asked).collect()}
    assert got[keys[0]] == '{"summary":"newer"}' and got[keys[2]] == '{"summary":"x"}' and got["ff" + "0" * 62] is None
    assert cache.statistics(cache.get(asked)).first().asDict() == {"hits": 4, "misses": 1, "hit_rate": 0.8, "entries": 4}
    cache.put(entries(spark, keys[3:], "not json", "2026-01-01 00:00:00"))  # a corrupt entry counts as none
    assert cache.statistics(cache.get(asked)).first()["hits"] == 3
    assert cache.clear() == 3 and cache.clear() == 0 and cache.entries().count() == 0


def test_a_lookup_reads_the_shards_that_it_needs(spark, tmp_path):
    cache = AnswerCache(spark, f"file://{tmp_path}/cache")
    keys = [f"{k:02x}" + "0" * 62 for k in range(20)]
    cache.put(entries(spark, keys))
    asked = spark.createDataFrame([(keys[3],), (keys[4],)], "key string")
    assert cache.touched(asked) == ["03", "04"]
    files_read = cache.entries(cache.touched(asked)).select(F.col("_metadata.file_path")).distinct().count()
    assert files_read == 2
    plan = cache.get(asked)._jdf.queryExecution().toString()
    assert "PartitionFilters: [shard" in plan


def test_two_writers_lose_nothing_and_leave_no_double_key(spark, tmp_path):
    path = f"file://{tmp_path}/cache"
    keys = [f"{k:02x}" + f"{j}" * 62 for k in range(4) for j in range(4)]
    errors = []

    def write(own, at):
        try:
            AnswerCache(spark, path).put(entries(spark, own, json.dumps({"summary": at}), at))
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=write, args=(keys[a : a + 10], f"202{k}-01-01 00:00:00")) for k, a in enumerate((0, 3, 6))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    rows = AnswerCache(spark, path).entries().collect()
    assert sorted(r["key"] for r in rows) == sorted(keys)
    assert {r["key"]: json.loads(r["result"])["summary"][:4] for r in rows} == {k: "2022" if i >= 6 else "2021" if i >= 3 else "2020" for i, k in enumerate(keys)}


def test_a_turn_left_by_a_dead_writer_ends(spark, tmp_path):
    (tmp_path / "_turn-cache").write_text("someone")
    cache = AnswerCache(spark, f"file://{tmp_path}/cache", stale=0.0)
    cache.put(entries(spark, ["ab" * 32]))
    assert cache.entries().count() == 1 and not (tmp_path / "_turn-cache").exists()


def plain(response):
    """What an answer's text says, by the standard parser."""
    text = (response or "").strip()
    if text.startswith("```"):
        text = text.partition("\n")[2]
    text = text.removesuffix("```").strip()
    try:
        data = json.loads(text)
    except ValueError:
        data = {}
    data = data if isinstance(data, dict) else {}
    some = lambda x, kind: x if isinstance(x, kind) else kind()
    limits = [{"metric": str(c["metric"]), "operator": str(c.get("operator", "<=")), "value": str(c["value"]), "unit": str(c.get("unit", "%")), "conditions": [x for x in some(c.get("conditions"), list) if isinstance(x, str)], "source_text": str(c.get("source_text", ""))} for c in some(data.get("numeric_constraints"), list) if isinstance(c, dict) and "metric" in c and "value" in c]
    relations = [{n: str(r.get(n, "")) for n in ("type", "target_section", "condition", "description")} for r in some(data.get("relationships"), list) if isinstance(r, dict) and "type" in r]
    return {"summary": str(data.get("summary", "")), "entities": {k: [str(x) for x in v] for k, v in some(data.get("entities"), dict).items() if isinstance(v, list)}, "numeric_constraints": limits, "relationships": relations}


RESPONSES = [
    json.dumps(ANSWER), "```json\n" + json.dumps(ANSWER) + "\n```", "```\n{\"summary\": \"x\"}```", "```{\"summary\": 1}```", "not json at all", "", None, "[]", "7", "null", "{}", '{"summary": "only summary"}', '{"summary": null, "entities": null}',
    '{"entities": "not a dict"}', '{"entities": {"a": "b", "c": ["d", 1, true, null]}}', '{"summary": true}', '{"numeric_constraints": [{"metric": "LTV"}, {"value": 1}, 3, null, {"metric": 1, "value": 2, "conditions": "abc"[0:0]}]}',
    '{"numeric_constraints": [{"metric": "DTI", "operator": null, "value": 45, "unit": "", "conditions": ["a", 1, null, {"b": 2}]}]}', '{"numeric_constraints": {"metric": "a", "value": 1}, "relationships": "x", "summary": "kept"}',
    '{"relationships": [{"type": "REQUIRES"}, {"target_section": "x"}, {"type": 5, "condition": false}]}', '{"summary": "cut', ' \n{"summary": "blank around"}\n ',
]


def test_answers_of_all_types(spark):
    df = spark.createDataFrame(list(enumerate(RESPONSES)), "k int, answer string")
    rows = df.select("k", answers.parsed(F.col("answer")).alias("r")).collect()
    got = {r["k"]: r["r"].asDict(recursive=True) for r in rows}
    assert got == {k: plain(x) for k, x in enumerate(RESPONSES)}
    again = df.select("k", answers.restored(F.to_json(answers.parsed(F.col("answer")))).alias("r")).collect()
    assert {r["k"]: r["r"].asDict(recursive=True) for r in again} == got


def test_prompts_name_what_rules_found(spark):
    row = chunks(spark, ["word " * 3001, "short"]).select("content", model_pass.chunk_prompt().alias("p")).collect()
    assert "ENTITIES FOUND BY RULES: a: b, c; d: e\nLIMITS FOUND BY RULES: LTV<=80%\n" in row[1]["p"] and "SOURCE: freddie_mac" in row[1]["p"]
    assert row[0]["p"].count("word") == 3000 and "[Content truncated]" in row[0]["p"] and "[Content truncated]" not in row[1]["p"]
    assert all(n in row[1]["p"] for n in ("summary", "entities", "numeric_constraints", "relationships", "target_section", "source_text"))


def test_keys_depend_on_content_model_and_version(spark):
    df = spark.createDataFrame([("a" * 9000,), ("a" * 8000 + "b",), ("c",)], "t string")
    keys = [r[0] for r in df.select(cache_key(F.col("t"), "m", "1")).collect()]
    assert keys[0] == keys[1] != keys[2]
    assert len({df.select(cache_key(F.col("t"), m, v)).first()[0] for m in "mn" for v in "12"}) == 4


def test_files_have_the_lines_of_the_model(spark, tmp_path, calls):
    rows = chunks(spark, ["text", "fail here"])
    for name, kind in (("heading", "string"), ("content_type", "string"), ("summary", "string"), ("chunk_id", "string"), ("requirement_type", "string"), ("severity", "string"), ("word_count", "long"), ("has_table", "boolean")):
        rows = rows.withColumn(name, F.lit("x" if kind == "string" else 1).cast(kind))
    for name in ("domains", "enumerations", "key_terms", "conditional_refs"):
        rows = rows.withColumn(name, F.array().cast("array<string>"))
    rows = rows.withColumn("cross_source_links", F.array().cast("array<struct<source:string,section_code:string,topic:string,relationship:string>>"))
    rows = rows.withColumn("numeric_constraints", F.array().cast(answers.LIMITS))
    done = model_pass.enriched(rows, Counting(calls), None, CHUNK)
    text = {r["section_id"]: r["text"] for r in done.select("section_id", files.chunk_header(model_pass=True).alias("text")).collect()}
    assert "LLM Summary: At most 80%.\nLLM Entities: occupancy_types=Investment\nLLM Constraints: LTV<=80%\nLLM Relationships: REQUIRES->B1-1-01\nLLM Model: counting\nContent Type: x" in text[0]
    assert "LLM Summary" not in text[1] and "LLM Model: counting" in text[1]
    entry = json.loads(files.index_entries(done.filter("section_id = 0")).first()["entry"])
    assert entry["llm_summary"] == "At most 80%." and entry["llm_entities"] == ANSWER["entities"] and entry["llm_model"] == "counting"
    assert "LLM" not in rows.select(files.chunk_header().alias("text")).first()["text"]
