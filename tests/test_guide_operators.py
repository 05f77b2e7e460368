"""Operators against plain statements of their rules, on small literals."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.functions import rules as R
from tessera.functions import text as T
from tessera.functions import vocabulary as V
from tessera.operators import answers, chunking, crawl, graph, linking, model_pass, ranking
from tessera.plans import enrich
from tessera.sources import pages, sitemaps


def one(spark, expression, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} {'int' if isinstance(v, int) else 'string'}" for n, v in values.items())) if names else spark.range(1)
    return df.select(expression.alias("x")).first()["x"]


# --- Chunks ----------------------------------------------------------------------------------------


def make(heading, text):
    text = text.strip()
    return heading, text


def headings_spec(text):
    found = list(re.finditer(r"^(#{2,4})\s+(.+)$", text, re.MULTILINE))
    if not found:
        return [make(None, text)]
    out = [make(None, text[: found[0].start()])] if text[: found[0].start()].strip() else []
    ends = [m.start() for m in found[1:]] + [len(text)]
    return out + [make(m.group(2).strip(), text[m.start() : e]) for m, e in zip(found, ends, strict=True)]


def oversize_spec(chunks, most):
    out = []
    for heading, text in chunks:
        if len(text.split()) <= most or re.search(r"\|.*\|.*\|", text):
            out.append((heading, text))
            continue
        part, n = [], 0
        for p in re.split(r"\n\n+", text):
            w = len(p.split())
            if part and n + w > most:
                out.append(make(heading, "\n\n".join(part)))
                part, n = [], 0
            part, n = [*part, p], n + w
        if part:
            out.append(make(heading, "\n\n".join(part)))
    return out


def undersize_spec(chunks, least):
    out = []
    for heading, text in chunks:
        if out and len(out[-1][1].split()) < least:
            out[-1] = make(out[-1][0], out[-1][1] + "\n\n" + text)
        else:
            out.append((heading, text))
    return out


def random_text(rng):
    bits = []
    for _ in range(rng.randrange(0, 14)):
        bits.append(rng.choice(["## Head ", "### Sub  ", "##### Deep", "#### ", "", "| a | b |\n", "text "]) + " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(0, 12))))
        bits.append(rng.choice(["\n", "\n\n", "\n\n\n"]))
    return "".join(bits)


def test_chunk_folds(spark):
    rng = random.Random(5)
    texts = [random_text(rng) for _ in range(400)] + ["", "  \n", "## a", "##\nb", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    headed = chunking.by_headings(F.coalesce("t", F.lit("")))
    cut = chunking.split_oversize(headed, 12)
    got = df.select("i", headed.alias("h"), cut.alias("o"), chunking.merge_undersize(cut, 6).alias("m")).collect()
    pairs = lambda xs: [(x["heading"], x["content"]) for x in xs]
    for r in got:
        h = headings_spec(texts[r["i"]] or "")
        o = oversize_spec(h, 12)
        assert (pairs(r["h"]), pairs(r["o"]), pairs(r["m"])) == (h, o, undersize_spec(o, 6)), repr(texts[r["i"]])


def test_definitions_are_split_at_terms(spark):
    body = "Intro of a few words.\n\n**One**\nfirst meaning\n\n**Two**\nsecond meaning\n\n__Three__\nthird meaning"
    got = one(spark, chunking.adaptive(F.col("t"), F.lit("definition"), least=0), t=body)
    assert [c["heading"] for c in got] == ["One", "Two", "Three"]
    few = one(spark, chunking.adaptive(F.col("t"), F.lit("definition"), least=0), t="**One**\nx\n## Head\ny")
    assert [c["heading"] for c in few] == [None, "Head"]


def test_small_subsections_grow(spark):
    data = [([("a", "x", 10, False, True), ("b", "y", 45, True, False), ("c", "z", 60, False, False)],)]
    df = spark.createDataFrame(data, "s array<struct<heading:string,content:string,words:bigint,tables:boolean,lists:boolean>>")
    got = df.select(chunking.merge_small_subsections(F.col("s")).alias("x")).first()["x"]
    assert [(g["heading"], g["content"], g["words"], g["tables"], g["lists"]) for g in got] == [("a", "x\n\n## b\n\ny", 55, True, True), ("c", "z", 60, False, False)]


# --- Text --------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("given", "want"), [("Hello, World!", "hello-world"), ("  --A  b--c  ", "a-b-c"), ("", ""), ("é", ""), ("x" * 80, "x" * 60)])
def test_slugs(spark, given, want):
    assert one(spark, T.slugify(F.col("t")), t=given) == want


def test_safe_paths(spark):
    assert one(spark, T.safe_path_component(F.col("t")), t="../a/b\\c") == "abc"
    assert one(spark, T.safe_path_component(F.col("t")), t="../") == "_unknown"
    assert one(spark, T.safe_path_component(F.col("t")), t=None) == "_unknown"


def test_strip_takes_separators(spark):
    assert one(spark, T.strip(F.col("t")), t="\x1c  \n a b 　\x1f") == "a b"
    assert one(spark, T.word_count(F.col("t")), t="\x1ca b　c ") == 3
    assert one(spark, T.word_count(F.col("t")), t=None) == 0


# --- Rules -------------------------------------------------------------------------------------------


def test_gates_change_nothing(spark):
    """The plain-string search before a pattern never hides a match."""
    rng = random.Random(6)
    words = ["must", "MUST not", "condo", "co-op", "CO OP", "two to four-unit", "2-unit", "refinance", "refinancing cash", "DU", "du refi", "W-2 income", "401K", "IRA", "Home  One", "HomeStyle Renovation", "HomeStyle", "ſhall", "generally we require", "Kd", "PUD", "planned unit development", "judgment lien", "judgment"]
    texts = [" ".join(rng.choices(words, k=6)) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: (r["e"], r["s"]) for r in df.select("i", R.entities(F.col("t")).alias("e"), R.severity_signals(F.col("t"), 99).alias("s")).collect()}
    order = list(dict.fromkeys(k for k, *_ in V.ENTITIES))
    for i, t in enumerate(texts):
        found = sorted((f"{k}.{v}" for k, v, ps, _ in V.ENTITIES if any(re.search(p, t, re.I) for p in ps)), key=lambda x: (order.index(x.split(".")[0]), x))
        assert got[i][0] == found, t
        assert got[i][1] == [f"{k}:{p}" for k, ps in V.SEVERITY_SIGNALS for p in ps if re.search(p, t, re.I)], t


@pytest.mark.parametrize(
    ("text", "metric", "operator", "value", "unit"),
    [
        ("the maximum LTV of 80% applies", "LTV", "<=", "80", "%"),
        ("a minimum credit score of 620", "credit_score", ">=", "620", ""),
        ("DTI must not exceed 45%", "DTI", "<=", "45", "%"),
        ("at least 6 months of reserves", "reserves_months", ">=", "6", "months"),
        ("CLTV is limited to 97.5%", "CLTV", "<=", "97.5", "%"),
        ("LTV cannot exceed 80%", None, None, None, None),
    ],
)
def test_limits(spark, text, metric, operator, value, unit):
    got = one(spark, R.constraints(F.col("t"), F.array().cast("array<string>")), t=text)
    assert [(g["metric"], g["operator"], g["value"], g["unit"]) for g in got] == ([(metric, operator, value, unit)] if metric else [])


def test_limits_know_their_conditions(spark):
    near = "For investment property loans the maximum LTV of 75% applies. " + "x " * 400 + "A condominium."
    df = spark.createDataFrame([(near,)], "t string").select("t", R.entities(F.col("t")).alias("e"))
    got = df.select(R.constraints(F.col("t"), F.col("e")).alias("x")).first()["x"]
    assert got[0]["conditions"] == ["occupancy_types.Investment"]


def test_conditional_references(spark):
    text = "If the property is a condominium, see Section B4-2.1. See 4501.2 for additional requirements on manufactured housing loans. If the property is a condominium, see B4-2.1."
    got = one(spark, R.conditional_references(F.col("t"), F.lit("4501.2")), t=text)
    assert [(g["if_entity"], g["then_see"]) for g in got] == [("property_types.Condo", "B4-2.1")]


def test_content_types(spark):
    kind = lambda **v: one(spark, R.content_type(F.col("source"), F.col("code"), F.col("title"), F.col("t"), F.lit(False)), **v)
    assert kind(source="fannie_mae", code="E-3-01", title="x", t="y") == "definition"
    assert kind(source="fannie_mae", code="e-1-01", title="x", t="y") == "reference"
    assert kind(source="freddie_mac", code="1101.1", title="How to apply", t="y") == "procedure"
    assert kind(source="freddie_mac", code="1101.1", title="x", t="Maximum LTV") == "policy_rule"
    assert kind(source="freddie_mac", code="1101.1", title="x", t="1. a\n2. b\n3. c") == "procedure"


def test_domains(spark):
    domains = lambda **v: one(spark, R.domains(F.col("source"), F.col("code"), F.col("t")), **v)
    assert domains(source="fannie_mae", code="b2-1.2-03", t="") == ["LOAN.loan_limits", "LOAN.loan_purpose"]
    assert domains(source="freddie_mac", code="abc", t="the income") == ["BORROWER.borrower_income"]
    assert domains(source="freddie_mac", code="9999.1", t="") == ["COMPLIANCE.regulatory"]


# --- Links and graph ---------------------------------------------------------------------------------


def test_links_fall_back_to_the_map(spark):
    df = spark.createDataFrame([("fannie_mae", "D1-3-01"), ("freddie_mac", "4401.5")], "source string, section_code string")
    got = sorted((r["section_code"], r["link_code"]) for r in linking.links(df).collect())
    assert got == [("4401.5", "B2-1.4"), ("D1-3-01", "6101-6199")]


def test_enriched_chunks(spark):
    body = "Intro.\n\n## Limits\n\nFor a condo the maximum LTV of 80% applies and lenders must verify. " + "word " * 40
    df = spark.createDataFrame([(1, "fannie_mae", "B2-1.2-01", "Limits", body, False), (2, "freddie_mac", "4201.1", "More", "", False)], "section_id long, source string, section_code string, title string, body string, has_tables boolean")
    rows = enrich.enrich(df).orderBy("section_id", "seq").collect()
    assert [r["section_id"] for r in rows] == [1, 2]
    first = rows[0]
    assert first["entities"] == ["property_types.Condo"] and first["severity"] == "must_comply"
    assert first["summary"].startswith("B2-1.2-01 (Limits) covers loan limits, loan purpose.")
    assert first["cross_source_links"][0]["section_code"] == "4201.1"
    kinds = {r["type"] for r in graph.edges(enrich.enrich(df)).collect()}
    assert kinds == {"APPLIES_TO", "IMPLIES", "CONSTRAINS", "EQUIVALENT"}


# --- Sources -----------------------------------------------------------------------------------------


def test_markdown(spark):
    html = '<html><head><style>p{}</style></head><body><h2>Head</h2><p>One <b>bold</b> <a href="/x">link</a>.</p><script>no()</script><p style="display: none">hidden</p><ul><li>a<li>b</ul><table><tr><th>A</th><th>B</th></tr></table></body></html>'
    got = one(spark, pages.markdown(F.col("t")), t=html)
    assert "## Head" in got and "One **bold** [link](/x)." in got and "- a\n- b" in got and "| A | B |" in got
    assert "no()" not in got and "hidden" not in got and "p{}" not in got
    assert one(spark, pages.markdown(F.col("t")), t=None) == ""
    assert [x["href"] for x in one(spark, pages.links(F.col("t")), t=html)] == ["/x"]


def test_short_links(spark):
    text = "see [a](https://h/sel/b3-1-01/title) or [b](/app/guide/section/4201.1) or [c](/other)"
    assert one(spark, pages.short_links(F.col("t")), t=text) == "see [a](B3-1-01) or [b](4201.1) or [c](/other)"


def test_sitemaps(spark, tmp_path):
    xml = "<urlset>" + "".join(f"<url><loc>{u}</loc><lastmod>2024-01-0{k + 1}</lastmod></url>" for k, u in enumerate(["https://h.example/sel/b1-1-01/x", "https://h.example/sel/", "http://h.example/sel/b2-1-01", "https://h.example/sel/z9/x"])) + "</urlset>"
    (tmp_path / "s.xml").write_text(xml)
    (tmp_path / "index.xml").write_text("<sitemapindex><sitemap><loc>https://h.example/a.xml</loc></sitemap><sitemap><loc>https://evil.example/b.xml</loc></sitemap></sitemapindex>")
    rows = sitemaps.first_guide(sitemaps.read_sitemap(spark, f"{tmp_path}/s.xml", "h.example")).collect()
    assert [(r["section_code"], r["lastmod"]) for r in rows] == [("B1-1-01", "2024-01-01")]
    assert [r["loc"] for r in sitemaps.read_sitemap_index(spark, f"{tmp_path}/index.xml", "h.example").collect()] == ["https://h.example/a.xml"]


# --- Crawl and model pass ----------------------------------------------------------------------------


def test_delays(spark):
    delay = lambda codes: spark.createDataFrame([(codes,)], "c array<int>").select(crawl.delay_after(F.col("c")).alias("x")).first()["x"]
    assert delay([]) == 1.0 and delay([429, 503]) == 4.0 and delay([429] * 9) == 30.0
    assert delay([429, 429, 200, 200, 200]) == 3.0 and delay([200] * 9) == 1.0


def test_answers(spark):
    fenced = '```json\n{"summary": "s", "entities": {"a": ["b"]}, "numeric_constraints": [{"metric": "LTV", "value": "80"}]}\n```'
    got = one(spark, answers.parsed(F.col("t")), t=fenced)
    assert got["summary"] == "s" and got["entities"] == {"a": ["b"]}
    assert got["numeric_constraints"][0].asDict() == {"metric": "LTV", "operator": "<=", "value": "80", "unit": "%", "conditions": [], "source_text": ""}
    bad = one(spark, answers.parsed(F.col("t")), t="no json")
    assert bad["summary"] == "" and bad["numeric_constraints"] == []


def test_failed_calls_leave_empty_answers(spark):
    class Broken:
        name = "broken"

        def complete(self, prompt, system=""):
            raise RuntimeError("no")

    df = spark.createDataFrame([(1, "a b"), (2, None)], "k int, prompt string")
    assert sorted(tuple(r) for r in model_pass.completed(df, Broken()).collect()) == [(1, "", 0, True), (2, "", 0, True)]
    assert sorted(r["tokens"] for r in model_pass.completed(df, model_pass.StubModel()).collect()) == [0, 2]


# --- Ranks, postings and folds -----------------------------------------------------------------------


def test_ranks_have_no_window_over_everything(spark):
    rows = spark.range(5000).selectExpr("id", "id * 7919 % 5003 AS v", "id % 3 AS k")
    got = ranking.ranked(rows, [F.col("v")])
    assert [r["rank"] for r in got.orderBy("v").collect()] == list(range(1, 5001))
    assert "SinglePartition" not in got._jdf.queryExecution().toString()
    hot = rows.withColumn("k", F.when(F.col("id") < 4000, "hot").otherwise(F.concat(F.lit("k"), F.col("k"))))
    places = {}
    for r in ranking.ranked_within(hot, ["k"], [F.col("v")]).orderBy("v").collect():
        places.setdefault(r["k"], []).append(r["rank"])
    assert all(p == list(range(1, len(p) + 1)) for p in places.values()) and len(places["hot"]) == 4000
    assert ranking.ranked(rows.limit(0), [F.col("v")]).count() == 0


def test_postings_in_blocks(spark, monkeypatch):
    rows = spark.range(1000).select(F.col("id").alias("section_id"), F.lit(0).alias("seq"), F.concat(F.lit("c"), F.col("id")).alias("chunk_id"), F.when(F.col("id") % 3 == 0, F.array(F.lit("all"), F.lit("third"))).otherwise(F.array(F.lit("all"))).alias("entities"))
    first = graph.entity_postings(rows)
    monkeypatch.setattr(graph, "BLOCK", 64)
    cut = graph.blocks(rows.select("section_id", "chunk_id", F.explode("entities").alias("entity")), ["entity"], [F.col("section_id")], "chunk_id", 64)
    got = cut.collect()
    assert max(len(r["items"]) for r in got) == 64 and len(got) == 16 + 6
    assert [x for r in sorted(got, key=lambda r: r["block"]) if r["entity"] == "all" for x in r["items"]] == [f"c{k}" for k in range(1000)]
    assert {r["chunk_id"] for r in graph.in_all(cut, ["all", "third"]).collect()} == {f"c{k}" for k in range(0, 1000, 3)}
    assert {r["entity"]: r["chunk_ids"] for r in graph.reverse_index(rows).collect()}["third"] == [f"c{k}" for k in range(0, 1000, 3)]
    more = graph.entity_postings(rows.limit(5).withColumn("chunk_id", F.concat(F.lit("new"), F.col("section_id"))))
    both = graph.with_more(first, more, ["entity"])
    assert sorted((r["entity"], r["block"]) for r in both.collect()) == [("all", 0), ("all", 1), ("third", 0), ("third", 1)]


def test_first_of_each_key(spark):
    rows = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), (None, 2, "z"), (None, 5, "w"), ("b", 4, None)], "k string, n int, v string")
    assert sorted(map(tuple, graph.first_by(rows, ["k"], ["n"]).collect()), key=repr) == sorted([("a", 1, "y"), (None, 2, "z"), ("b", 4, None)], key=repr)


def test_folds_grow_with_the_paragraphs(spark):
    """Twenty times the paragraphs take far less than four hundred times as long."""
    import time

    def seconds(n):
        text = "\n\n".join(f"word{k} of a paragraph" for k in range(n))
        df = spark.createDataFrame([(text,)], "t string").select(F.size(chunking.merge_undersize(chunking.split_oversize(chunking.by_headings(F.col("t")), 20), 30)).alias("n"))
        began = time.perf_counter()
        assert df.first()["n"] == -(-n // 10)
        return time.perf_counter() - began

    seconds(100)
    small, large = min(seconds(1000) for _ in range(3)), seconds(20_000)
    assert large < 60 * max(small, 0.1)


def test_semantic_chunks(spark):
    part = "struct<heading:string,content:string,words:bigint,tables:boolean,lists:boolean>"
    rows = [
        ("freddie_mac", "4201.1", "T", "whole", 2500, [("A", "a", 10, False, False), ("B", "b", 60, True, False), ("C", "c", 70, False, True)], "P", "", "42", "", ""),
        ("freddie_mac", "4201.2", "T", "short", 2000, [("A", "a", 10, False, False), ("B", "b", 60, False, False)], "", "", "", "", ""),
        ("freddie_mac", "4201.3", "T", "one part", 9000, [("A", "a", 9000, False, False)], "", "", "", "", ""),
    ]
    names = "source string, section_code string, title string, content_markdown string, word_count long, subsections array<" + part + ">, part_name string, chapter_name string, chapter_code string, subpart_name string, subpart_code string"
    got = [tuple(r) for r in chunking.semantic(spark.createDataFrame(rows, names)).collect()]
    assert [g[2] for g in got] == ["section", "subsection", "subsection", "section", "section"]
    assert got[0][3:] == ("freddie_mac/4201.1", "T", None, "P > Chapter 42 > 4201.1", "whole", 2500)
    assert got[1][3:] == ("freddie_mac/4201.1/a", "4201.1: A", "A", "P > Chapter 42 > 4201.1 > A", "*Section: 4201.1 - T*\n*Subsection: A*\n\na\n\n## B\n\nb", 70)


def test_links_are_kept_factorised(spark):
    rows = [("fannie_mae", f"B2-1.2-{k:02}") for k in range(30)] + [("freddie_mac", f"4201.{k}") for k in range(40)]
    df = spark.createDataFrame(rows, "source string, section_code string")
    own, of = linking.section_map(df), linking.targets(df)
    pairs = linking.expanded(own, of)
    assert pairs.count() == linking.links(df).count() > own.count() + of.count()
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, linking.links(df).collect()))
