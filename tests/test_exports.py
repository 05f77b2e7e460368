"""File sinks, documents, discovery over a page source, and pacing on a stream."""

import json
import sys

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tessera.operators import crawl, fetch
from tessera.plans import discovery, enrich
from tessera.plans.config import Config
from tessera.sources import exports, page_source, storage, text_sink
from tessera.streaming import pacing

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import the tests


@pytest.fixture(scope="module")
def chunks(spark):
    rows = [(k, "fannie_mae" if k % 2 else "freddie_mac", f"B2-1.2-{k:02}" if k % 2 else f"420{k}.1", f"T{k}", f"For a condo the maximum LTV of {70 + k % 3}% applies; lenders must verify, case {k}. " + "word " * 40, False) for k in range(8)]
    df = spark.createDataFrame(rows, "section_id long, source string, section_code string, title string, body string, has_tables boolean")
    return storage.stored(enrich.enrich(df))


@pytest.mark.parametrize("layout", ["flat", "tasks"])
def test_text_files(spark, tmp_path, layout):
    rows = spark.range(20).select(F.concat(F.lit("a/b"), F.col("id"), F.lit(".txt")).alias("name"), F.when(F.col("id") == 3, None).otherwise(F.concat(F.lit("text é "), F.col("id"))).alias("text")).repartition(4)
    text_sink.write_texts(rows, f"file://{tmp_path}/out", layout)
    found = {p.name: p.read_text() for p in (tmp_path / "out").rglob("*.txt")}
    assert found == {f"b{k}.txt": "" if k == 3 else f"text é {k}" for k in range(20)}
    assert ((tmp_path / "out" / "a" / "b0.txt").exists()) == (layout == "flat")
    assert not (tmp_path / "out" / text_sink.STAGED).exists()
    text_sink.write_texts(rows.limit(2), f"file://{tmp_path}/out", layout, mode="overwrite")
    assert len(list((tmp_path / "out").rglob("*.txt"))) == 2


def test_of_a_failed_job_no_file_appears(spark, tmp_path):
    good = spark.range(8).select(F.concat(F.lit("f"), F.col("id")).alias("name"), F.lit("x").alias("text")).repartition(4)
    for name in ("../up", "/abs", None):
        bad = good.unionByName(spark.createDataFrame([(name, "x")], "name string, text string"))
        with pytest.raises(Exception, match="no name of a file"):
            text_sink.write_texts(bad, f"file://{tmp_path}/out")
    assert [p for p in (tmp_path / "out").rglob("*") if p.is_file()] == [] and not (tmp_path / "up").exists()


def test_index_document(spark, chunks, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}"
    exports.write_index(chunks, folder)
    index = json.loads((tmp_path / "index.json").read_text())
    rows = chunks.orderBy("section_id", "seq").collect()
    assert list(index) == ["version", "total_chunks", "domain_distribution", "content_type_distribution", "chunks"]
    assert index["total_chunks"] == len(rows) and [e["chunk_id"] for e in index["chunks"]] == [r["chunk_id"] for r in rows]
    assert index["domain_distribution"] == {d: sum(d in r["domains"] for r in rows) for r in rows for d in r["domains"]}
    assert list(index["domain_distribution"].values()) == sorted(index["domain_distribution"].values(), reverse=True)
    assert sum(index["content_type_distribution"].values()) == len(rows)
    assert index["chunks"][0]["numeric_constraints"][0]["metric"] == "LTV"
    monkeypatch.setattr(exports, "INLINE", 3)
    exports.write_index(chunks, folder)
    long = json.loads((tmp_path / "index.json").read_text())
    lines = [json.loads(x) for f in long["chunks_files"] for x in (tmp_path / f).read_text().splitlines()]
    assert lines == index["chunks"] and "chunks" not in long
    exports.write_index(chunks.limit(0), folder)
    assert json.loads((tmp_path / "index.json").read_text())["total_chunks"] == 0
    (tmp_path / "bad.json").write_text("{not json")
    assert exports.read_document(spark, f"{folder}/bad.json") == {} == exports.read_document(spark, f"{folder}/none.json")


def test_ontology_document(spark, chunks, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}"
    exports.write_ontology(chunks, folder)
    found = json.loads((tmp_path / "ontology.json").read_text())
    assert list(found) == ["version", "entity_types", "edges", "sections_by_entity", "implication_rules", "numeric_constraints", "stats"]
    rows = chunks.orderBy("section_id", "seq").collect()
    assert found["sections_by_entity"]["property_types.Condo"] == [r["chunk_id"] for r in rows]
    assert found["stats"]["total_edges"] == len(found["edges"]) and found["stats"]["total_constraints"] == len(found["numeric_constraints"]) == 3
    assert [x["type"] for x in found["edges"]] == sorted((x["type"] for x in found["edges"]), key=exports._LAYERS.index)
    limit = next(x for x in found["numeric_constraints"] if x["value"] == "70")
    assert limit["source_sections"] == [r["section_code"] for r in rows if "of 70%" in r["content"]] and limit["conditions"] == ["property_types.Condo"]
    assert "metadata" not in found["edges"][0] and found["entity_types"]["property_types"]["count"] == len(found["entity_types"]["property_types"]["values"])
    monkeypatch.setattr(exports, "INLINE", 3)
    exports.write_ontology(chunks, folder)
    long = json.loads((tmp_path / "ontology.json").read_text())
    lines = [json.loads(x) for f in long["edges_files"] for x in (tmp_path / f).read_text().splitlines()]
    assert lines == found["edges"] and long["stats"] == found["stats"] and "sections_by_entity_files" in long


def test_chunk_files_of_one_id_are_numbered(spark, chunks, tmp_path):
    twice = chunks.unionByName(chunks.filter("section_id = 0").withColumn("section_id", F.lit(99).cast("long")))
    exports.write_chunks(twice, f"file://{tmp_path}")
    names = [p.name for p in (tmp_path / "chunks").iterdir()]
    assert len(names) == 9 and sum(n.endswith("_2.txt") for n in names) == 1


SITEMAP = "https://g.example/sitemap.xml"


def urlset(*urls):
    return "<urlset xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'>" + "".join(f"<url><loc> {u} </loc><lastmod>2024-01-01</lastmod></url>" for u in urls) + "</urlset>"


class Failing(fetch.TableFetcher):
    """Replays pages; some addresses fail."""

    def get(self, url):
        if url.endswith("broken.xml"):
            raise OSError("no connection")
        return self.pages.get(url)


def test_an_index_is_expanded_by_one_level(spark):
    inner = "<sitemapindex><sitemap><loc>https://g.example/deeper.xml</loc></sitemap></sitemapindex>"
    names = ["https://g.example/a.xml", "https://elsewhere.example/b.xml", "http://g.example/c.xml", "https://g.example/broken.xml", "https://g.example/inner.xml", "https://g.example/bad.xml"]
    pages = {
        SITEMAP: "<sitemapindex>" + "".join(f"<sitemap><loc>{u}</loc></sitemap>" for u in names) + "</sitemapindex>",
        names[0]: urlset("https://g.example/sel/b2-1.2-01/x", "https://g.example/sel/selling-guide", "https://g.example/svc/x", "https://g.example/sel/a1-1-01"),
        names[1]: urlset("https://elsewhere.example/sel/b9-1-01/x"),
        names[2]: urlset("https://g.example/sel/b8-1-01/x"),
        names[4]: inner,
        "https://g.example/deeper.xml": urlset("https://g.example/sel/b7-1-01/x"),
        names[5]: "<urlset><url>",
        "https://g.example/sel/selling-guide": "<html><a href='/sel/b2-1.2-01/x'>old</a><a href='/sel/c1-1-01/toc'>new</a><a href='/sel/c1-1-01/again'>again</a><a href='/other'>o</a></html>",
    }
    config = Config(max_retries=0, first_base_url="https://g.example", first_sitemap_url=SITEMAP)
    rows = discovery.expanded(spark, SITEMAP, lambda: Failing(pages), config).collect()
    assert {r["sitemap"] for r in rows} == {names[0]} and len(rows) == 4 and {r["lastmod"] for r in rows} == {"2024-01-01"}
    found = [tuple(r) for r in discovery.discover(spark, "fannie_mae", lambda: Failing(pages), config).collect()]
    assert found == [("https://g.example/sel/a1-1-01", "A1-1-01", "a1-1-01", "2024-01-01"), ("https://g.example/sel/b2-1.2-01/x", "B2-1.2-01", "x", "2024-01-01"), ("https://g.example/sel/c1-1-01/toc", "C1-1-01", "toc", None)]
    plain = {SITEMAP: urlset("https://g.example/app/guide/section/4201.1", "https://h.example/app/guide/section/4202.1")}
    second = Config(max_retries=0, second_base_url="https://g.example", second_sitemap_url=SITEMAP)
    assert [r["section_code"] for r in discovery.discover(spark, "freddie_mac", lambda: Failing(plain), second).collect()] == ["4201.1"]
    assert discovery.discover(spark, "freddie_mac", lambda: Failing({}), second).collect() == []


def test_pages_are_read_by_host(spark):
    urls = ["https://a.example/1", "https://b.example/2", "https://a.example/3", "https://a.example/broken.xml"]
    pages = dict(zip(urls, ["one", "two", None, "x"], strict=True))
    read = page_source.read_pages(spark, urls, lambda: Failing(pages), Config(max_retries=0))
    assert read.rdd.getNumPartitions() == 2
    assert sorted(map(tuple, read.collect()), key=repr) == sorted([(urls[0], "a.example", "one", None), (urls[1], "b.example", "two", None), (urls[2], "a.example", None, "no page"), (urls[3], "a.example", None, "OSError: no connection")], key=repr)


def test_stored_pages_are_replayed(spark):
    stored = storage.stored(spark.createDataFrame([("https://a.example/1", "one")], "url string, body string"))
    uri = stored.inputFiles()[0].rpartition("/")[0]
    read = page_source.read_pages(spark, ["https://a.example/1", "https://a.example/2"], lambda: page_source.StoredPages(uri), Config(max_retries=0))
    assert sorted((r["url"][-1], r["body"]) for r in read.collect()) == [("1", "one"), ("2", None)]


def test_pace_on_a_stream_is_the_batch_fold(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    status = F.when(F.col("event_type") == "error", 429).when(F.col("event_type") == "signup", 503).otherwise(200)
    rows = events.select(F.col("user_id").cast("string").alias("host"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("id"), status.alias("status"), (F.col("event_type") != "error").alias("ok"))
    ordered = sorted(rows.collect(), key=lambda r: (r["at"], r["id"]))
    folder = tmp_path / "in"
    cut = len(ordered) // 4 + 1
    for k in range(4):  # one batch a file, in the order of time
        spark.createDataFrame(ordered[k * cut : (k + 1) * cut], rows.schema).coalesce(1).write.parquet(f"{folder}/part{k}")
    stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(folder))
    pacing.written(stream, f"{tmp_path}/out", f"{tmp_path}/state", threshold=2, cooldown=30.0, late="0 seconds")
    out = spark.read.parquet(f"{tmp_path}/out")
    asked = out.filter("kind = 'request'")
    assert asked.count() == len(ordered)
    last = {r["host"]: r["x"] for r in asked.groupBy("host").agg(F.max_by("delay", F.struct("at", "id")).alias("x")).collect()}
    want = {r["host"]: r["delay"] for r in crawl.adaptive_delays(rows, "host", ["at", "id"], "status").collect()}
    assert last == want
    trips = crawl.breaker_trips(rows, "host", ["at", "id"], "ok", 2)
    assert {(r["host"], r["id"]) for r in asked.filter("opened").collect()} == {(r["host"], r["id"]) for r in trips.collect()}
    closed = out.filter("kind = 'closed'").count()
    assert 0 < closed <= trips.count()  # those whose cooldown ends after the last request stay open


def test_a_host_has_one_timer_however_often_its_breaker_opens():
    class Handle:
        def __init__(self):
            self.value, self.timers = None, []

        def getValueState(self, *_):
            return self

        def get(self):
            return self.value

        def exists(self):
            return self.value is not None

        def update(self, value):
            self.value = value

        def registerTimer(self, at):
            self.timers.append(at)

    class At:
        def __init__(self, ms):
            self.ms = ms

        def getExpiryTimeInMs(self):
            return self.ms

        def getCurrentWatermarkInMs(self):
            return 60_000

    handle, pacing_ = Handle(), pacing.Pacing(1.0, 30.0, 2, 30.0)
    pacing_.init(handle)
    asked = pd.DataFrame({"at": pd.to_datetime([k * 10_000 for k in range(8)][::-1], unit="ms"), "id": range(8), "status": 429, "ok": False})
    out = pd.concat(pacing_.handleInputRows(("h",), iter([asked[:3], asked[3:]]), None))
    assert out["opened"].tolist() == [False, True] * 4 and out["at"].is_monotonic_increasing
    assert handle.timers == [40_000]
    out = pd.concat(pacing_.handleExpiredTimer(("h",), At(60_000), At(40_000)))
    assert [x.timestamp() for x in out["at"]] == [40, 60]  # all that is due; the next is left to a new timer
    assert handle.timers == [40_000, 80_000]
    assert list(pacing_.handleExpiredTimer(("h",), At(60_000), At(40_000))) == []
