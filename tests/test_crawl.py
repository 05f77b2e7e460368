"""Settings, fetching, the scrape, the stream and the command line, without a network."""

import json
import sys

import pytest
from pyspark import cloudpickle

from tessera import cli
from tessera.operators import fetch
from tessera.plans import scrape
from tessera.plans.config import Config
from tessera.sources import storage
from tessera.streaming import incremental

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import the tests
PAGE = "<html><body><h2>Title here</h2><div class='rn_Answer'><p>" + "word " * 80 + "</p></div></body></html>"
CONFIG = Config(max_retries=2, quality_min_words=50)


@pytest.mark.parametrize("bad", [{"max_retries": 11}, {"max_retries": -1}, {"backoff_factor": 0.5}, {"timeout": 0}, {"breaker_threshold": 0}, {"max_workers": 0}, {"first_delay": -1}, {"max_delay": 0}, {"first_base_url": "http://x"}])
def test_settings_are_checked(bad):
    with pytest.raises(ValueError):
        Config(**bad)


class Flaky:
    """Fails a number of times, then answers."""

    def __init__(self, fails, pages):
        self.fails, self.pages, self.calls = fails, list(pages), 0

    def get(self, url):
        self.calls += 1
        if self.calls <= self.fails:
            raise OSError("not now")
        return self.pages.pop(0) if len(self.pages) > 1 else self.pages[0]


def words(html):
    return len(html.split())


def test_retries_and_quality():
    waits = []
    pace = fetch.Pace(CONFIG, 0.0, waits.append)
    got = fetch.fetch_one(Flaky(2, ["w " * 60]), "u", CONFIG, pace, words)
    assert got["status"] == "success" and got["attempts"] == 3 and len(waits) == 2 and 2 <= waits[1] <= 2.5
    got = fetch.fetch_one(Flaky(9, ["x"]), "u", CONFIG, pace, words)
    assert got["status"] == "failed" and got["error_type"] == "OSError" and pace.failures == 1
    got = fetch.fetch_one(Flaky(0, ["short", "w " * 55]), "u", CONFIG, pace, words)
    assert got["status"] == "success" and got["word_count"] == 55 and pace.failures == 0
    got = fetch.fetch_one(Flaky(0, ["short one"]), "u", CONFIG, pace, words)
    assert got["status"] == "quality_warning"


def test_breaker_and_delay():
    waits = []
    pace = fetch.Pace(Config(breaker_threshold=2, breaker_cooldown=60), 1.0, waits.append, lambda: 0.0)
    pace.failures = 2
    pace.wait()
    assert waits == [60, 1.0] and pace.failures == 0
    pace.saw(429)
    pace.saw(503)
    assert pace.delay == 4.0
    for _ in range(3):
        pace.saw(200)
    assert pace.delay == 3.0


def test_scrape_resumes(spark, tmp_path):
    found = spark.createDataFrame([(f"https://h/{k}", "freddie_mac", f"110{k}.1") for k in range(4)], "url string, source string, section_code string")
    pages = {"https://h/0": PAGE, "https://h/1": "<p>short</p>", "https://h/2": None}
    config = Config(max_retries=0)
    folder = f"file://{tmp_path}/out"
    first = {r["section_code"]: r["status"] for r in scrape.scrape(spark, found, folder, lambda: fetch.TableFetcher(pages), config).collect()}
    assert first == {"1100.1": "success", "1101.1": "quality_warning", "1102.1": "failed", "1103.1": "failed"}
    (tmp_path / "out" / "manifest").rename(tmp_path / "lost")  # as if the run had died before it wrote the manifest
    assert {r["section_code"]: r["status"] for r in scrape.scrape(spark, found, folder, lambda: fetch.TableFetcher(pages), config).collect()} == first
    assert spark.read.parquet(f"{folder}/sections").count() == 2
    assert [r["section_code"] for r in scrape.frontier(found, scrape.manifest(spark, f"{folder}/manifest"), config).orderBy("section_code").collect()] == ["1102.1", "1103.1"]
    second = {r["section_code"]: r["status"] for r in scrape.scrape(spark, found, folder, lambda: fetch.TableFetcher(pages | {"https://h/3": PAGE}), config).collect()}
    assert second == first | {"1103.1": "success"}
    assert spark.read.parquet(f"{folder}/sections").count() == 3
    row = scrape.status(scrape.manifest(spark, f"{folder}/manifest")).first()
    assert (row["discovered"], row["scraped"], row["warnings"], row["failed"]) == (4, 2, 1, 1)
    limited = scrape.frontier(found, spark.createDataFrame([], scrape.MANIFEST), Config(max_sections=2))
    assert limited.count() == 2


def test_waits_differ_by_a_share_of_the_delay():
    waits = []
    pace = fetch.Pace(CONFIG, 2.0, waits.append)
    for _ in range(50):
        pace.wait()
    assert all(1.7 <= w <= 2.3 for w in waits) and len(set(waits)) > 10
    pace = fetch.Pace(CONFIG, 0.01, waits.append)
    pace.wait()
    assert waits[-1] == 0.1


class Dying:
    """Serves pages and stops the job at the n-th; leaves a file for each page served."""

    def __init__(self, folder, at):
        self.folder, self.at = folder, at

    def open(self):
        pass

    def get(self, url):
        import os

        name = url.rpartition("/")[2]
        if self.at == name:
            raise KeyboardInterrupt  # no error of a connector: the worker dies
        open(os.path.join(self.folder, f"{name}-{os.urandom(4).hex()}"), "w").close()
        return PAGE

    def close(self):
        pass


def test_a_killed_run_goes_on_from_what_it_had_stored(spark, tmp_path):
    served = tmp_path / "served"
    served.mkdir()
    found = spark.createDataFrame([(f"https://h/{k:03}", "freddie_mac", f"1{k:03}.1") for k in range(23)], "url string, source string, section_code string")
    folder, config = f"file://{tmp_path}/out", Config(max_retries=0, manifest_save_interval=5)
    place = str(served)
    with pytest.raises(Exception):  # noqa: B017
        scrape.scrape(spark, found, folder, lambda: Dying(place, "012"), config)
    kept = scrape.manifest(spark, f"{folder}/manifest")
    assert sorted(r["section_code"] for r in kept.collect()) == [f"1{k:03}.1" for k in range(10)]
    for p in served.iterdir():
        p.unlink()
    done = scrape.scrape(spark, found, folder, lambda: Dying(place, ""), config)
    assert {r["status"] for r in done.collect()} == {"success"} and done.count() == 23
    assert sorted({p.name[:3] for p in served.iterdir()}) == [f"{k:03}" for k in range(10, 23)]  # nothing stored is fetched again
    assert spark.read.parquet(f"{folder}/sections").count() == 23 == scrape.sections(spark, folder).count()
    scrape.forget(spark, folder, found.filter("section_code = '1003.1'"))
    assert [r["section_code"] for r in scrape.frontier(found, scrape.manifest(spark, f"{folder}/manifest"), config).collect()] == ["1003.1"]
    scrape.scrape(spark, found, folder, lambda: Dying(place, ""), config)
    assert scrape.sections(spark, folder).count() == 23


def test_the_log_is_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scrape, "COMPACT_AT", 3)
    found = spark.createDataFrame([(f"https://h/{k}", "freddie_mac", f"110{k}.1") for k in range(5)], "url string, source string, section_code string")
    folder, config = f"file://{tmp_path}/out", Config(max_retries=0, manifest_save_interval=1)
    first = scrape.scrape(spark, found, folder, lambda: fetch.TableFetcher({f"https://h/{k}": PAGE for k in range(3)}), config)
    assert sorted(r["status"] for r in first.collect()) == ["failed"] * 2 + ["success"] * 3
    log = storage.Parts(spark, f"{folder}/manifest")
    assert len(log.current()) == 1 and len(storage.names(spark, f"{log.path}/log")) == 1
    second = scrape.scrape(spark, found, folder, lambda: fetch.TableFetcher({f"https://h/{k}": PAGE for k in range(4)}), config)
    assert {r["section_code"]: r["status"] for r in second.collect()}["1103.1"] == "success"
    assert [(r["section_code"], r["error_type"]) for r in scrape.first_errors(second).collect()] == [("1104.1", None)]


def write(tree, name, code, text):
    (tree / name).write_text(f"---\nsource: freddie_mac\nsection_code: '{code}'\ntitle: T\n---\n# {code}\n\n{text}\n")


def test_stream_enriches_what_changed(spark, tmp_path):
    tree, out = tmp_path / "tree", f"file://{tmp_path}/out"
    tree.mkdir()
    write(tree, "a.md", "4201.1", "A condo must be insured. " * 10)
    write(tree, "b.md", "4401.1", "An overview. " * 20)
    incremental.watch(spark, str(tree), out).awaitTermination()
    assert {r["section_code"] for r in spark.read.parquet(f"{out}/chunks").collect()} == {"4201.1", "4401.1"}
    write(tree, "c.md", "3301.2", "The credit score counts. " * 12)
    incremental.watch(spark, str(tree), out).awaitTermination()
    rows = spark.read.parquet(f"{out}/chunks").collect()
    assert {r["section_code"] for r in rows} == {"4201.1", "4401.1", "3301.2"} and len(rows) == 3
    assert spark.read.parquet(f"{out}/state").count() == 3


def test_new_files_are_linked_with_all_files(spark, tmp_path):
    tree, out = tmp_path / "tree", f"file://{tmp_path}/out"
    tree.mkdir()
    write(tree, "a.md", "4201.1", "A condo must be insured. " * 10)
    (tree / "b.md").write_text("---\nsource: fannie_mae\nsection_code: B2-1.3-01\ntitle: T\n---\n# B2-1.3-01\n\n" + "An overview. " * 20)
    incremental.watch(spark, str(tree), out).awaitTermination()
    whole = {r["section_code"]: {x["section_code"] for x in r["cross_source_links"]} for r in spark.read.parquet(f"{out}/chunks").collect()}
    (tree / "b.md").write_text((tree / "b.md").read_text() + "\nAnother line.\n")
    rows = spark.read.text(str(tree / "b.md"), wholetext=True).selectExpr("_metadata.file_path AS path", "value")
    incremental.update(spark, rows, out)
    assert {r["section_code"]: {x["section_code"] for x in r["cross_source_links"]} for r in spark.read.parquet(f"{out}/chunks").collect()} == whole
    assert "4201.1" in whole["B2-1.3-01"]


def batch(spark, tree):
    return spark.read.option("pathGlobFilter", "*.md").text(str(tree), wholetext=True).selectExpr("_metadata.file_path AS path", "value")


def test_an_increment_writes_what_changed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "BUCKETS", 8)
    tree, out = tmp_path / "tree", f"file://{tmp_path}/out"
    tree.mkdir()
    for k in range(12):
        write(tree, f"f{k}.md", f"42{k:02}.1", f"A condo must be insured, case {k}. " * 8)
    incremental.update(spark, batch(spark, tree), out)
    parts = incremental.tables(spark, out)
    before = parts.current()
    write(tree, "f3.md", "4203.1", "Another text of this section. " * 9)
    incremental.update(spark, batch(spark, tree), out)
    after = parts.current()
    moved = {p for p in after if after[p] != before.get(p)}
    assert len(moved) == 2 and {p.partition("/")[0] for p in moved} == {"chunks", "state"}  # one bucket of each
    rows = incremental.chunks(spark, out).collect()
    assert len(rows) == 12 and sum("Another text" in r["content"] for r in rows) == 1
    assert incremental.state(spark, out).count() == 12
    incremental.update(spark, batch(spark, tree), out)  # nothing changed, nothing is written
    assert parts.current() == after
    assert incremental.index(spark, out).count() == 12


@pytest.mark.parametrize("step", ["first write", "second write", "commit", "vacuum"])
def test_a_crash_leaves_a_readable_table(spark, tmp_path, monkeypatch, step):
    tree, out = tmp_path / "tree", f"file://{tmp_path}/out"
    tree.mkdir()
    write(tree, "a.md", "4201.1", "The first text of this section. " * 9)
    write(tree, "b.md", "4202.1", "A second section. " * 20)
    incremental.update(spark, batch(spark, tree), out)
    write(tree, "a.md", "4201.1", "The later text of this section. " * 9)

    class Died(Exception):
        pass

    def die(*_, **__):
        raise Died

    parts, seen = storage.Parts, []
    if step in ("first write", "second write"):
        folder = parts.new_folder

        def counted(self, kind):
            seen.append(kind)
            return die() if len(seen) == (1 if step == "first write" else 2) else folder(self, kind)

        monkeypatch.setattr(parts, "new_folder", counted)
    else:
        monkeypatch.setattr(parts, step, die)
    with pytest.raises(Died):
        incremental.update(spark, batch(spark, tree), out)
    monkeypatch.undo()
    text = {r["section_code"]: r["content"] for r in incremental.chunks(spark, out).collect()}
    assert len(text) == 2 and ("later" if step == "vacuum" else "first") in text["4201.1"]
    incremental.update(spark, batch(spark, tree), out)
    text = {r["section_code"]: r["content"] for r in incremental.chunks(spark, out).collect()}
    assert len(text) == 2 and "later" in text["4201.1"] and incremental.state(spark, out).count() == 2


def test_two_writers_of_one_version(spark, tmp_path):
    parts = storage.Parts(spark, f"file://{tmp_path}/t")
    spark.range(3).write.parquet(f"{parts.path}/data/a")
    spark.range(4).write.parquet(f"{parts.path}/data/b")
    version = parts.version()
    parts.commit({"x": "data/a"}, base=version)
    with pytest.raises(RuntimeError):
        parts.commit({"x": "data/b"}, base=version)
    assert parts.read("id long").count() == 3
    parts.commit({"y": "data/b"})
    assert parts.read("id long").count() == 7 and parts.read("id long", parts=["y", "z"]).count() == 4
    parts.commit({"x": None})
    assert parts.vacuum() == 1 and parts.read("id long").count() == 4 and not (tmp_path / "t" / "data" / "a").exists()


def test_a_table_moved_by_a_dead_run_is_taken_back(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.range(3).write.parquet(f"{path}-before")
    assert incremental._table(spark, path, None).count() == 3
    incremental._replace(spark, incremental._table(spark, path, None).filter("id > 0"), path)
    assert spark.read.parquet(path).count() == 2 and not (tmp_path / "t-before").exists()


def test_command_line(spark, tmp_path, capsys):
    tree = tmp_path / "tree"
    tree.mkdir()
    write(tree, "a.md", "4201.1", "A condo must be insured. " * 10)
    assert cli.main(["enrich", str(tree), f"file://{tmp_path}/out"], spark) == 0
    assert "policy_rule" in capsys.readouterr().out
    assert spark.read.parquet(f"{tmp_path}/out/edges").filter("type = 'APPLIES_TO'").count() == 1
    (tmp_path / "s.xml").write_text("<urlset><url><loc>https://h.example/app/guide/section/4201.1</loc></url></urlset>")
    assert cli.main(["discover", f"{tmp_path}/s.xml", "--source", "freddie-mac", "--host", "h.example"], spark) == 0
    assert "4201.1" in capsys.readouterr().out


def pages_for_scrape():
    return fetch.TableFetcher({f"https://h.example/app/guide/section/420{k}.1": f"<html><body><h2>Title {k}</h2><div class='rn_Answer'><p>" + "word " * 80 + "</p></div></body></html>" for k in range(2)})


def test_command_line_scrapes_and_reports(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "named", lambda path: {"pages": pages_for_scrape}[path])
    (tmp_path / "s.xml").write_text("<urlset>" + "".join(f"<url><loc>https://h.example/app/guide/section/420{k}.1</loc></url>" for k in range(3)) + "</urlset>")
    monkeypatch.setattr(cli, "discovered", lambda spark, sitemap, source, host, own=cli.discovered: own(spark, sitemap, source, "h.example"))
    out = f"file://{tmp_path}/out"
    assert cli.main(["scrape", "freddie-mac", "--output", out, "--sitemap", f"{tmp_path}/s.xml", "--fetcher", "pages", "--delay", "0"], spark) == 0
    names = sorted(p.name for p in (tmp_path / "out").rglob("*.md"))
    assert names == ["4200.1_title-0.md", "4201.1_title-1.md"]
    assert (tmp_path / "out" / "freddie_mac" / "chapter_4200" / names[0]).read_text().startswith("---\nsource: freddie_mac")
    capsys.readouterr()
    assert cli.main(["status", out], spark) == 0
    said = capsys.readouterr().out
    assert "|freddie_mac|3         |2      |0       |1     |0      |2    |" in said and "4202.1: None" in said
    assert cli.main(["scrape", "freddie-mac", "--output", out, "--sitemap", f"{tmp_path}/s.xml", "--fetcher", "pages", "--delay", "0", "--section", "4202.1"], spark) == 1
    assert cli.main(["scrape", "freddie-mac", "--output", out, "--sitemap", f"{tmp_path}/s.xml", "--fetcher", "pages", "--delay", "0", "--section", "4201.1"], spark) == 0


@pytest.mark.parametrize(("source", "workers", "given"), [("fannie-mae", 8, None), ("freddie-mac", 1, None), ("fannie-mae", 3, 3)])
def test_workers_by_source(source, workers, given):
    args = cli._parser().parse_args(["scrape", source] + (["--workers", str(given)] if given else []))
    config, delay, n = cli.settings(args, source)
    assert (n, config.max_workers) == (workers, workers) and delay == (1.0 if source == "fannie-mae" else 3.0)


def test_command_line_with_a_model(spark, tmp_path, capsys):
    tree, out = tmp_path / "tree", tmp_path / "out"
    tree.mkdir()
    write(tree, "a.md", "4201.1", "A condo must be insured. The maximum LTV of 75% applies to a condo. " * 6)
    args = ["enrich", str(tree), f"file://{out}", "--model", "tessera.operators.model_pass:StubModel"]
    assert cli.main([*args, "--model-dry-run"], spark) == 0 and "estimated_cost" in capsys.readouterr().out
    assert not (out / "model-cache").exists()
    assert cli.main([*args, "--files", "--stats"], spark) == 0
    assert "|1        |0     |" in capsys.readouterr().out
    index, ontology = (json.loads((out / f"{n}.json").read_text()) for n in ("index", "ontology"))
    assert index["total_chunks"] == 1 and index["chunks"][0]["llm_model"] == "stub" and index["chunks"][0]["section_code"] == "4201.1"
    assert ontology["sections_by_entity"]["property_types.Condo"] == [index["chunks"][0]["chunk_id"]]
    text = next((out / "chunks").glob("*.txt")).read_text()
    assert "LLM Summary: 4201.1 - T" in text and "Entities: property_types=Condo" in text
    assert cli.main([*args], spark) == 0 and "|1        |1     |" in capsys.readouterr().out  # a second run calls nothing
