"""Pages, files and sinks on small literals."""

import json

from pyspark.sql import functions as F

from tessera.plans import enrich
from tessera.sources import dom, files, section_pages

FILLER = "A sentence with enough words to count as content. " * 5
FIRST = f"""<html><head><title>B3-1-01 | Guide</title><meta name="last-modified" content="2024-05-06T00:00"></head><body>
<nav aria-label="Breadcrumb"><a>Part B, Origination</a><a>Chapter B3</a><span>Subpart B3-1</span></nav>
<h1>B3-1-01, Manual Underwriting (08/02/2023)</h1>
<div class="body-field"><p>{FILLER}</p><h2 id="one">Overview</h2><p>Some <a href="/sel/b2-1.2-01/ltv">LTV</a> text.</p>loose<ul><li>a<li>b</ul>
<h3>Table</h3><table><tr><th>A</th><td>1</td></tr></table><p>See <a href="https://h/sel/b2-1.2-01">again</a></p></div>
<h3>Related Announcements</h3><table><tr><th>x</th><th>y</th></tr><tr><td>SEL-2023-06</td><td>July 5, 2023</td><td>News</td></tr></table></body></html>"""
SECOND = f"""<html><head><title>Guide Section 4201.1 - Freddie Mac</title></head><body><h1>Seller/Servicer Guide</h1><h2>Purchase rules</h2>
<div class="rn_Answer"><p>Effective: 3/4/2024</p><p>{FILLER}</p><h4>Deep</h4><p>See <a href="/app/guide/section/4401.2">4401.2</a>.</p></div></body></html>"""


def test_tree_closes_what_pages_leave_open():
    root = dom.parse("<ul><li>a<li>b<ul><li>c</ul></ul><p>x<p>y<br>z</div>")
    assert [n.text() for n in root.find_all(dom.tagged("li"))] == ["a", "bc", "c"]
    assert [n.text() for n in root.find_all(dom.tagged("p"))] == ["x", "yz"]
    assert dom.parse('<p a="1&amp;2">x &lt; y</p>').html() == '<p a="1&amp;2">x &lt; y</p>'


def test_sections_of_both_guides(spark):
    df = spark.createDataFrame([("u1", "fannie_mae", "B3-1-01", FIRST), ("u2", "freddie_mac", "4201.1", SECOND), ("u3", "freddie_mac", "1.1", None)], "url string, source string, section_code string, html string")
    first, second, none = [r for r in section_pages.parsed(df).orderBy("url").collect()]
    assert first["title"] == "Manual Underwriting" and first["effective_date"] == "2023-08-02"
    assert (first["part_code"], first["chapter_code"], first["subpart_code"]) == ("B", "B3-1", None)
    assert (first["chapter_name"], first["subpart_name"]) == ("Chapter B3", "Subpart B3-1")
    assert [(s["heading"], s["heading_level"], s["anchor_id"], s["has_tables"], s["has_lists"]) for s in first["subsections"]] == [("Overview", 2, "one", False, True), ("Table", 3, None, True, False)]
    assert "loose" not in first["subsections"][0]["content_markdown"]
    assert [(r["target_section_code"], r["link_text"]) for r in first["cross_references"]] == [("B2-1.2-01", "LTV")]
    assert [tuple(a) for a in first["related_announcements"]] == [("SEL-2023-06", "July 5, 2023", "News")]
    assert first["has_tables"] and first["table_count"] == 1
    assert second["title"] == "Purchase rules" and second["effective_date"] == "2024-03-04"
    assert second["part_code"] == "4" and second["chapter_code"] == "4201"
    assert [r["target_section_code"] for r in second["cross_references"]] == ["4401.2"]
    assert [s["heading"] for s in second["subsections"]] == ["Deep"]
    assert none["title"] == "Section 1.1" and none["word_count"] == 0 and none["content_html"] == ""


def test_content_ladder():
    ladder = lambda body: section_pages.first_content(dom.parse(body))
    assert ladder(f'<div class="x field--name-body"><p>{FILLER}</p></div>').attrs["class"] == "x field--name-body"
    assert ladder(f'<div class="body-field">tiny</div><main><p>{FILLER}</p></main>').tag == "main"
    assert ladder("<div>short</div>") is None
    both = ladder(f'<div class="body-field"><p>{FILLER}</p></div><div class="glossary-table">more</div>')
    assert len(both.children) == 2


def test_front_matter(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    texts = {"a/one.md": "---\nsource: freddie_mac\nsection_code: 1101.10\ntable_count: x\neffective_date: 2024-01-02\n---\n# T\nbody\n", "a/b/two.md": "no front matter", "bad.md": "---\n: [\n---\nbody", "open.md": "---\nsource: x", "list.md": "---\n- a\n---\nb", "skip.txt": "---"}
    for k, v in texts.items():
        (tmp_path / k).write_text(v)
    rows = {r["path"].rpartition("/")[2]: r for r in files.sections(files.scan_markdown(spark, str(tmp_path))).collect()}
    assert set(rows) == {"one.md", "two.md", "bad.md", "open.md", "list.md"}
    one = rows["one.md"]
    assert (one["section_code"], one["table_count"], one["effective_date"], one["body"]) == ("1101.10", 0, "2024-01-02", "# T\nbody")
    assert rows["two.md"]["body"] == "no front matter" and rows["open.md"]["body"] == "---\nsource: x"
    assert rows["bad.md"]["error"] and rows["bad.md"]["body"] == "body" and rows["list.md"]["error"]


def test_manifest_and_state(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"sections": {"a": "success", "b": "failed"}, "content_hashes": {"a": "1"}, "total": 2}))
    (tmp_path / "bad.json").write_text("{not json")
    (tmp_path / "state.json").write_text(json.dumps({"file_hashes": {"x.md": "h"}}))
    assert sorted(tuple(r) for r in files.read_manifest(spark, f"{tmp_path}/m.json").collect()) == [("a", "success", "1"), ("b", "failed", None)]
    assert files.read_manifest(spark, f"{tmp_path}/bad.json").count() == 0
    assert [tuple(r) for r in files.read_state(spark, f"{tmp_path}/state.json").collect()] == [("x.md", "h")]
    assert files.read_state(spark, f"{tmp_path}/none.json").count() == 0


def test_exports(spark, tmp_path):
    body = "Intro.\n\n## Limits\n\nFor a condo the maximum LTV of 80% applies and lenders must verify. " + "word " * 40
    df = spark.createDataFrame([(1, "fannie_mae", "B2-1.2-01", "Limits", body, False)], "section_id long, source string, section_code string, title string, body string, has_tables boolean")
    chunks = enrich.enrich(df)
    text = chunks.select(F.lit("x/one.txt").alias("filename"), files.chunk_header().alias("text"))
    assert [r["name"] for r in files.export_texts(text, f"file://{tmp_path}").collect()] == ["x/one.txt"]
    lines = (tmp_path / "x" / "one.txt").read_text().split("\n")
    assert lines[:2] == ["Source: fannie_mae", "Section: B2-1.2-01 - Limits"]
    assert "Entities: property_types=Condo" in lines and "Constraints: LTV<=80%" in lines
    assert lines[lines.index("---") + 1] == "Intro." and any(x.startswith("Domains: ") for x in lines)
    entry = json.loads(files.index_entries(chunks).first()["entry"])
    assert "content" not in entry and entry["entities"] == {"property_types": ["Condo"]}
    assert [entry[k] for k in ("url", "hierarchy_path")] == ["", ""] and "conditions" in entry["numeric_constraints"][0] and "source_text" not in entry["numeric_constraints"][0]
    names = spark.createDataFrame([(["a.x", "b.y.z", "a.w"],), ([],)], "names array<string>").select(files.by_kind("names").alias("k"))
    assert [[(x["kind"], x["values"]) for x in r["k"]] for r in names.collect()] == [[("a", ["x", "w"]), ("b", ["y.z"])], []]
    files.write_table(chunks, f"{tmp_path}/chunks", ["source"])
    assert spark.read.parquet(f"{tmp_path}/chunks").count() == 1


def test_parts_of_pages(spark):
    from tessera.sources import page_parts

    html = "<h1>One <b>two</b></h1><p><a href='/x'>x  y</a><a>none</a></p><h3>Three</h3><table><tr><td>1<tr><td>2</table><a href=''>z</a>"
    rows = spark.createDataFrame([(1, html, "a"), (2, None, "b"), (3, "", "c"), (4, "<h2>broken", "d")], "k int, html string, `a.b` string")
    got = [tuple(r) for r in page_parts.parts(rows).orderBy("k", "kind", "place").collect()]
    assert got == [(1, "a", "heading", 1, 1, "One two", None), (1, "a", "heading", 2, 3, "Three", None), (1, "a", "link", 1, None, "x y", "/x"), (1, "a", "link", 2, None, "z", ""), (1, "a", "table", 1, 2, None, None), (4, "d", "heading", 1, 2, "broken", None)]


def test_second_guide_pages_have_parts_and_crumbs(spark):
    from tessera.sources import section_pages

    crumb = "Guide > Chapter 4201 > " + "x" * 120
    html = f"<div class='my-Breadcrumb'>{crumb}</div><h2>Title here</h2><div class='rn_Answer'>{'word ' * 60}</div>"
    rows = spark.createDataFrame([("u1", "freddie_mac", "4201.1", html), ("u2", "freddie_mac", "9101.2", html.replace("my-Breadcrumb", "none"))], "url string, source string, section_code string, html string")
    got = {r["url"]: r for r in section_pages.parsed(rows).collect()}
    assert (got["u1"]["part_code"], got["u1"]["part_name"], got["u1"]["chapter_code"], got["u1"]["chapter_name"]) == ("4", "Origination", "4201", crumb[:100])
    assert (got["u2"]["part_code"], got["u2"]["part_name"], got["u2"]["chapter_code"], got["u2"]["chapter_name"]) == ("", "", "9101", "")


def test_totals_and_errors_of_a_manifest(spark, tmp_path):
    import json

    from tessera.sources import files

    error = {"url": "u", "section_code": "4201.1", "error_type": "OSError", "error_message": "m", "status_code": None, "timestamp": "t", "retries_attempted": 3}
    (tmp_path / "m.json").write_text(json.dumps({"source": "freddie_mac", "total_discovered": 5, "total_scraped": 4, "sections": {"a": "success"}, "errors": [error], "started_at": "now"}, indent=1))
    row = files.read_manifest_totals(spark, f"{tmp_path}/m.json").first()
    assert (row["total_discovered"], row["total_scraped"], row["total_failed"], row["started_at"], row["last_updated"]) == (5, 4, 0, "now", "")
    assert row["errors"][0].asDict() == error
    (tmp_path / "bad.json").write_text("{not json")
    assert files.read_manifest_totals(spark, f"{tmp_path}/bad.json").collect() == []


def test_pages_by_http():
    """Absent and short pages are none, other errors are raised, and each session says what it takes."""
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    import pytest

    from tessera.operators import fetch
    from tessera.plans.config import Config

    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(dict(self.headers))
            code, body = {"/good": (200, "x" * 600), "/short": (200, "x"), "/gone": (404, "x" * 600)}.get(self.path, (503, ""))
            self.send_response(code)
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    fetcher = fetch.Http(Config(timeout=5), "an agent")()
    fetcher.open()
    try:
        assert fetcher.get(f"{base}/good") == "x" * 600
        assert fetcher.get(f"{base}/short") is None and fetcher.get(f"{base}/gone") is None
        with pytest.raises(Exception) as found:
            fetcher.get(f"{base}/busy")
        assert found.value.response.status_code == 503
    finally:
        fetcher.close()
        server.shutdown()
    assert asked[0]["User-Agent"] == "an agent" and all(asked[0][k] == v for k, v in fetch.HEADERS.items())
