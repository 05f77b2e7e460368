"""Steps whose work must not grow faster than their input."""

import random

import yaml
from pyspark.sql import functions as F

from tessera.functions import rules as R
from tessera.operators import graph, linking
from tessera.plans import catalog, catalog_more, enrich, guide
from tessera.sources import files, pages, section_pages, storage, text_sink
from tessera.streaming import incremental

SF = "/root/testdata/sf0.001"
LINK = "array<struct<source:string,section_code:string,topic:string,relationship:string>>"


def test_texts_are_read_back_task_by_task(spark, tmp_path):
    rows = [(f"a/b+ %{k}.txt", f"text {k}\r\n") for k in range(2500)]
    text_sink.write_texts(spark.createDataFrame(rows, "name string, text string").coalesce(2), f"file://{tmp_path}/texts", layout="tasks")
    assert len(text_sink.TextReader({"path": f"file://{tmp_path}/texts"}).partitions()) == 2
    assert max(len(list(d.iterdir())) for d in tmp_path.glob("texts/*/*/a")) <= text_sink.FOLDER
    assert sorted(map(tuple, text_sink.read_texts(spark, f"file://{tmp_path}/texts").collect())) == sorted(rows)


def test_a_text_is_lower_cased_once_for_all_patterns(spark):
    df = spark.createDataFrame([("a condo with an ARM",), ("ſelf-employed",), (None,)], "t string")
    for found in (R.entities, R.severity, R.severity_signals, R.requirement_type, R.enumerations, R.terms, R.keyword_domains):
        assert df.select(found(F.col("t")).alias("x"))._jdf.queryExecution().analyzed().toString().count("lower(") == 1
    assert [r[0] for r in df.select(R.entities(F.col("t"))).collect()] == [["property_types.Condo", "loan_types.AdjustableRate"], ["income_sources.SelfEmployment"], []]


def test_limits_are_those_of_all_shapes(spark):
    texts = ["maximum LTV of 80% and DTI limited to 45 %", "at least 6 months of reserves", "no limit", "reſerves must not exceed 5%", None, "CLTV 70% or less"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(R.constraints(F.col("t"), F.array().cast("array<string>")).alias("c")).collect()
    assert [[(x["metric"], x["operator"], x["value"]) for x in r["c"]] for r in rows] == [[("LTV", "<=", "80"), ("DTI", "<=", "45")], [("reserves_months", ">=", "6")], [], [], [], [("CLTV", "<=", "70")]]


def test_pairs_come_from_the_first_chunk_of_a_section(spark):
    link = lambda s, c: (s, c, "t", "equivalent")
    lists = [("f", "A", [link("g", "1"), link("g", "2")]), ("g", "1", [link("f", "A")])]
    chunks = [(k, s, src, code) for k, (src, code) in enumerate([("g", "1"), ("f", "A"), ("f", "A"), ("x", "9")]) for s in range(3)]
    own = spark.createDataFrame(chunks, "section_id long, seq int, source string, section_code string")
    by = spark.createDataFrame(lists, f"source string, section_code string, cross_source_links {LINK}")
    one = graph.equivalent(own, by).select("source", "target").collect()
    every = graph.equivalent(own.join(by, ["source", "section_code"], "left")).select("source", "target").collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, every)) == [("f/A", "g/2"), ("g/1", "f/A")]


def test_the_model_pass_works_chunks_out_once(spark):
    plan = catalog_more.second_pass(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "EvalPython" not in plan


def test_front_matter_is_what_yaml_makes_of_it():
    pick, odd = random.Random(7), ["yes", "No", "null", "a: b", "x #y", "1.5", "12", "0x1f", "", "- a", "Yes sir", "on.off", "y", "é", "a  b", "a ", "2024-01-02", "'q'", "1e5", "A" * 90, "word " * 30, "https://h/x", "~", "a\nb", "NULL-1", "true"]
    for _ in range(1500):
        word = lambda: pick.choice(odd) if pick.random() < 0.4 else " ".join(pick.choice(["lime", "B2-1.2", "x_1", "Part"]) for _ in range(pick.randint(1, 12)))
        own = {k: word() for k in files.FRONT_KEYS + files.FRONT_MORE} | {"word_count": 5, "cross_references": [word() for _ in range(pick.randint(0, 3))]}
        data = {k: own.get(k) or "" for k in files.FRONT_KEYS} | {k: own[k] for k in files.FRONT_MORE if own.get(k)} | {"word_count": 5, "table_count": 0}
        data |= {"cross_references": sorted(set(own["cross_references"]))} if own["cross_references"] else {}
        assert files.render_front_matter(own) == (text := yaml.safe_dump(data, default_flow_style=False, sort_keys=False, allow_unicode=True))
        if (found := files._simple_fields("\n" + text)) is not None:
            assert found == {k: v for k, v in yaml.load(text, Loader=yaml.BaseLoader).items() if isinstance(v, str)}
    assert files._simple_fields("\nsource: a\ntitle: lime cyan\nword_count: 5\nl:\n- B1\n") == {"source": "a", "title": "lime cyan", "word_count": "5"}


def test_tasks_of_the_corpus_grow_in_number(spark, tmp_path):
    spark.range(guide.TASK_ROWS * 20).selectExpr("id AS p_partkey", "'n' AS p_name", "'b' AS p_brand", "1 AS p_size").write.parquet(f"{tmp_path}/part.parquet")
    assert guide.sections(spark, str(tmp_path)).rdd.getNumPartitions() == 20


def test_pages_are_walked_in_slices(spark):
    import pyarrow as pa

    html = [f"<h1>T{k}</h1><p>x</p>" for k in range(300)]
    batch = pa.RecordBatch.from_pydict({"url": html, "source": ["fannie_mae"] * 300, "section_code": ["A1"] * 300, "html": html})
    found = list(section_pages._walked(iter([batch]), section_pages._kind()))
    assert [b.num_rows for b in found] == [128, 128, 44] and found[2].column("p")[0]["title"].as_py() == "T256"
    assert pages._markdown(pa.array([*html, None])).to_pylist() == [pages._tidy("".join(pages._walk(h).out)) for h in [*html, None]]


def _guide(spark):
    """Sections of which many have the same text, by type of section and by code."""
    text = "Intro.\n\n## Limits\n\nFor a condo the maximum LTV of 80% applies.\n\nFor investment properties, refer to B2-1.2-01 and see Section B4-1.\n\n" + "\n\n".join(f"**Term {k}**\nmeaning " + "word " * 40 for k in range(3))
    codes = [("fannie_mae", "B2-1.2-01"), ("fannie_mae", "E-3-02"), ("fannie_mae", "ZZ-1"), ("freddie_mac", "4201.1"), ("freddie_mac", "4299.2"), ("freddie_mac", "x"), ("other", "4201.1")]
    rows = [(k, *codes[k % 7], f"T{k}", [text, text + " é", None, ""][k // 7 % 4], k % 2 == 0) for k in range(56)]
    return spark.createDataFrame(rows, "section_id long, source string, section_code string, title string, body string, has_tables boolean")


def test_a_repeated_text_is_worked_out_once(spark):
    df = _guide(spark)
    plan = enrich.tagged_chunks(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("ArrowEvalPython") < plan.index("Aggregate")
    one = enrich.tagged_chunks(df)
    refers = {r["section_code"]: [x["then_see"] for x in r["conditional_refs"]] for r in one.filter("size(conditional_refs) > 0").collect()}
    assert "B2-1.2-01" not in refers and refers["ZZ-1"] == ["B2-1.2-01"]


def test_sections_of_the_same_rows_of_the_map_share_a_list(spark, monkeypatch):
    df = _guide(spark)
    codes = df.select("source", "section_code").distinct()
    shared = linking.shared_lists(codes)
    assert shared.count() == shared.select("source", "ords").distinct().count() < codes.count()
    own = codes.withColumn("ords", linking.map_rows(F.col("source"), F.col("section_code"))).join(shared, ["source", "ords"]).drop("ords")
    links = lambda d: sorted(map(repr, d.select("source", "section_code", "cross_source_links").collect()))
    assert links(own) == links(linking.link_lists(codes))
    entries = lambda **k: sorted(map(repr, files.index_entries(enrich.enrich(df, **k)).collect()))
    as_text, as_lists = entries(as_json=True), entries()
    monkeypatch.setattr(linking, "LISTED", 0)
    assert linking.shared_lists(codes) is None and as_text == as_lists == entries(as_json=True)
    assert sum("4201.1" in e and "B2-1.2" in e for e in as_text) > 0


def test_files_of_a_batch_are_not_sent_through_the_driver(spark, monkeypatch):
    batches = []
    monkeypatch.setattr(storage, "stored", lambda df: df)
    monkeypatch.setattr(incremental, "update", lambda _, batch, folder: batches.append(batch))
    monkeypatch.setattr(incremental, "chunks", lambda *_: spark.createDataFrame([], "path string, content string"))
    catalog.queries()["src_16_increment"](spark, SF)
    assert ["Join" in b._jdf.queryExecution().optimizedPlan().toString() for b in batches] == [False, False]
    first, second = ({r["path"]: r["value"] for r in b.collect()} for b in batches)
    own = {f"section-{r['section_id']}.md": r["source"] for r in catalog.sections(spark, SF).collect()}
    assert first.keys() == second.keys() == own.keys()
    assert all(second[p] == first[p] + ("\n\nAnother line." if own[p] == "freddie_mac" else "") for p in own)
