"""Pages of the two guides to structured sections.

One vectorised function walks each page's tree and returns a struct; dates, code
hierarchy and counts follow as column expressions over it.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import pages
from .dom import Node, parse, tagged

SUBSECTION = "struct<heading:string,heading_level:int,anchor_id:string,content_html:string,content_markdown:string,word_count:long,has_tables:boolean,has_lists:boolean>"
REFERENCE = "struct<target_section_code:string,target_url:string,link_text:string,context:string>"
ANNOUNCEMENT = "struct<code:string,date:string,title:string>"
SECTION = f"struct<title:string,content_html:string,content_markdown:string,page_text:string,date_hint:string,part_crumb:string,chapter_crumb:string,subpart_crumb:string,table_count:long,subsections:array<{SUBSECTION}>,cross_references:array<{REFERENCE}>,related_announcements:array<{ANNOUNCEMENT}>>"

# Fixed values.  Names of the parts of the first guide by letter, and of the second by thousands.
FIRST_PARTS = {"A": "Part A: Doing Business with Fannie Mae", "B": "Part B: Origination Through Closing", "C": "Part C: Selling, Securitizing, and Delivering Loans", "D": "Part D: Ensuring Quality Control (QC)", "E": "Part E: Quick Reference Materials"}

SECOND_PARTS = {"1": "General", "2": "Requirements", "3": "Underwriting", "4": "Origination", "5": "Special Programs", "6": "Quality Control"}
#: Longest text of a breadcrumb bar that counts.
CRUMB_CHARS = 100

# Fixed values.  Where the second guide keeps its content, most specific first.
_SECOND_CONTENT = [".rn_Answer", "#rn_AnswerDetail", ".rn_AnswerDetail", "*answer", "*Answer", "*content", "main", "#content"]
_CODE_PREFIX, _DATE_SUFFIX = re.compile(r"^[A-E][\d\-\.]+\s*,?\s*"), re.compile(r"\s*\(\d{2}/\d{2}/\d{4}\)\s*$")
_BRANDING = re.compile(r"seller/servicer\s*guide|freddie\s*mac\s*guide", re.IGNORECASE)


def to_markdown(html: str) -> str:
    return pages._tidy("".join(pages._walk(html).out))


def _long(node: Node | None, least: int = 100) -> bool:
    return node is not None and len(node.text()) > least


def _largest_div(root: Node, least: int) -> Node | None:
    best, size = None, 0
    for div in root.find_all(tagged("div")):
        if (n := len(div.text())) > size:
            best, size = div, n
    return best if size > least else None


def first_content(root: Node) -> Node | None:
    """The content of a page of the first guide: named fields, then wider and wider elements."""
    parts = root.find_all(lambda n: n.tag == "div" and "body-field" in n.classes())
    glossary = root.find(lambda n: n.tag == "div" and "glossary-table" in n.classes())
    parts += [glossary] if glossary else []
    if parts and sum(len(p.text()) for p in parts) > 100:
        return parts[0] if len(parts) == 1 else Node("div", {}, list(parts))
    for test in (lambda n: n.tag == "div" and "field--name-body" in n.attrs.get("class", ""), lambda n: n.tag == "div" and "layout-content" in n.classes(), tagged("main")):
        if _long(found := root.find(test)):
            return found
    return _largest_div(root, 500)


def _selects(selector: str):
    if selector[0] == ".":
        return lambda n: selector[1:] in n.classes()
    if selector[0] == "#":
        return lambda n: n.attrs.get("id") == selector[1:]
    if selector[0] == "*":
        return lambda n: selector[1:] in n.attrs.get("class", "")
    return tagged(selector)


def second_content(root: Node) -> Node | None:
    for selector in _SECOND_CONTENT:
        if _long(found := root.find(_selects(selector))):
            return found
    return _largest_div(root, 200)


def first_title(root: Node) -> str:
    clean = lambda t: _DATE_SUFFIX.sub("", _CODE_PREFIX.sub("", t)).strip()
    if (h1 := root.find(tagged("h1"))) and (text := clean(h1.text())):
        return text
    og = root.find(lambda n: n.tag == "meta" and n.attrs.get("property") == "og:title" and bool(n.attrs.get("content")))
    if og:
        return clean(og.attrs["content"]) or og.attrs["content"]
    if title := root.find(tagged("title")):
        return title.text().split("|")[0].strip()
    return "Untitled Section"


def second_title(root: Node, code: str) -> str:
    if (h1 := root.find(tagged("h1"))) and len(t := h1.text()) > 3 and not _BRANDING.search(t):
        return t
    if (h2 := root.find(tagged("h2"))) and len(t := h2.text()) > 3:
        return t
    if title := root.find(tagged("title")):
        text = re.sub(r"^Guide Section\s*", "", re.sub(r"\s*[-|]\s*Freddie Mac.*$", "", title.text()))
        if text:
            return text
    return f"Section {code}"


def breadcrumbs(root: Node) -> list[str]:
    bar = root.find(lambda n: n.tag == "nav" and "breadcrumb" in n.attrs.get("aria-label", "").lower()) or root.find(lambda n: any("breadcrumb" in c for c in n.classes()))
    if bar is None:
        return []
    crumbs = [a.text() for a in bar.find_all(tagged("a"))]
    return crumbs + [t for s in bar.find_all(tagged("span")) if (t := s.text()) and t not in crumbs]


def subsections(content: Node, levels: tuple[str, ...]) -> list[dict]:
    """What follows each heading as sibling elements, up to the next heading; loose text is left out."""
    out = []
    for heading in content.find_all(tagged(*levels)):
        parts = []
        for x in heading.following():
            if isinstance(x, Node):
                if x.tag in levels:
                    break
                parts.append(x.html())
        html = "".join(parts)
        text = to_markdown(html)
        out.append({"heading": heading.text(), "heading_level": int(heading.tag[1]), "anchor_id": heading.attrs.get("id"), "content_html": html, "content_markdown": text, "word_count": len(text.split()), "has_tables": "<table" in html.lower(), "has_lists": bool(re.search(r"<[uo]l", html, re.IGNORECASE))})
    return out


def cross_references(content: Node, first: bool) -> list[dict]:
    """Links to other sections, the first of each code, with the text around them."""
    out: dict[str, dict] = {}
    for a in content.find_all(lambda n: n.tag == "a" and "href" in n.attrs):
        href = a.attrs["href"]
        if first:
            found = re.search(r"/sel/([a-z0-9\-\.]+)/", href, re.IGNORECASE) or re.search(r"/sel/([a-z0-9\-\.]+)$", href, re.IGNORECASE)
        else:
            found = re.search(r"/app/guide/section/([0-9]+(?:\.[0-9]+)?)", href)
        if found and (code := found[1].upper()) not in out:
            around = a.parent.text() if a.parent else a.text()
            out[code] = {"target_section_code": code, "target_url": href, "link_text": a.text(), "context": around[:200] + "..." if len(around) > 200 else around}
    return list(out.values())


def announcements(root: Node) -> list[dict]:
    """The table after a heading on related announcements (its first row is a header), else codes in the text."""
    out: list[dict] = []
    nodes = list(root.walk())
    for k, heading in enumerate(nodes):
        low = heading.text().lower() if heading.tag in ("h2", "h3", "h4", "strong") else ""
        if "related" in low and "announcement" in low:
            table = next((n for n in nodes[k + 1 :] if n.tag == "table"), None)
            for row in table.find_all(tagged("tr"))[1:] if table else []:
                cells = [x.text() for x in row.find_all(tagged("td", "th"))]
                if len(cells) >= 2 and cells[0]:
                    out.append({"code": cells[0], "date": cells[1], "title": cells[2] if len(cells) > 2 else None})
            break
    return out or [{"code": x, "date": "", "title": None} for x in dict.fromkeys(re.findall(r"SEL-\d{4}-\d+", "".join(root.strings())))]


def section_of(html: str | None, source: str, code: str) -> dict:
    root, first = parse(html), source == "fannie_mae"
    content = first_content(root) if first else second_content(root)
    crumbs = breadcrumbs(root)
    pick = lambda test: next((x for x in reversed(crumbs) if test(x)), "")
    bar = None if first else root.find(lambda n: "crumb" in n.attrs.get("class", "").lower())
    inner = content.html() if content else ""
    hint = root.find(lambda n: n.tag == "meta" and bool(re.search("date|modified", n.attrs.get("name", ""), re.IGNORECASE)))
    return {
        "title": first_title(root) if first else second_title(root, code),
        "content_html": inner,
        "content_markdown": to_markdown(inner),
        "page_text": " ".join("".join(root.strings()).split()),
        "date_hint": hint.attrs.get("content", "")[:10] if hint else None,
        "part_crumb": pick(lambda x: x.startswith("Part ")),
        "chapter_crumb": pick(lambda x: not x.startswith("Part ") and "Chapter" in x) if first else "".join(bar.strings()).strip()[:CRUMB_CHARS] if bar else "",
        "subpart_crumb": pick(lambda x: not x.startswith("Part ") and "Subpart" in x and "Chapter" not in x),
        "table_count": len(content.find_all(tagged("table"))) if content else 0,
        "subsections": subsections(content, ("h2", "h3") if first else ("h2", "h3", "h4")) if content else [],
        "cross_references": cross_references(content, first) if content else [],
        "related_announcements": announcements(root) if first else [],
    }


def _names(values: dict[str, str]) -> Column:
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(v))])


def second_hierarchy(code: Column) -> tuple[Column, Column, Column]:
    """Part (by thousands, where it has a name, else blank), part name and chapter of a code of the second guide."""
    chapter = F.split_part(code, F.lit("."), F.lit(1))
    thousand = F.floor(T.chapter_number(code) / 1000).cast("string")
    name = F.coalesce(F.try_element_at(_names(SECOND_PARTS), thousand), F.lit(""))
    return F.when(name != "", thousand).otherwise(F.lit("")), name, chapter


def _kind() -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    return to_arrow_type(StructType.fromDDL(f"p {SECTION}")["p"].dataType)


def _walked(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Batches of pages as batches of sections, ``pages.SLICE`` pages at a time: their trees and texts are not held for a whole batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, pages.SLICE):
            part = batch.slice(at, pages.SLICE)
            keys = [part.column(n) for n in ("url", "source", "section_code")]
            found = [section_of(h, s, c) for h, s, c in zip(*[part.column(n).to_pylist() for n in ("html", "source", "section_code")], strict=True)]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(found, kind)], names=["url", "source", "section_code", "p"])
            del found
            gc.collect()  # nodes of a tree refer to each other


def parsed(fetched: DataFrame) -> DataFrame:
    """Sections out of ``fetched`` (url, source, section_code, html): structure, hierarchy, dates and counts."""

    kind = _kind()
    rows = fetched.select("url", "source", "section_code", "html").mapInArrow(lambda batches: _walked(batches, kind), f"url string, source string, section_code string, p {SECTION}")
    code, first = F.col("section_code"), F.col("source") == "fannie_mae"
    part, chapter, subpart = pages.code_hierarchy(code)
    second_part, second_name, number = second_hierarchy(code)
    names = _names(FIRST_PARTS)
    date = F.when(first, F.coalesce(pages.effective_date(F.col("p.page_text"), True), F.nullif("p.date_hint", F.lit("")))).otherwise(pages.effective_date(F.col("p.page_text"), False))
    return rows.select(
        "url",
        "source",
        "section_code",
        "p.title",
        F.when(first, part).otherwise(second_part).alias("part_code"),
        F.when(first, F.coalesce(F.try_element_at(names, part), T.blank_to_null(F.col("p.part_crumb")), F.lit(""))).otherwise(second_name).alias("part_name"),
        F.when(first, chapter).otherwise(number).alias("chapter_code"),
        F.col("p.chapter_crumb").alias("chapter_name"),
        F.when(first, subpart).alias("subpart_code"),
        T.blank_to_null(F.col("p.subpart_crumb")).alias("subpart_name"),
        "p.content_html",
        "p.content_markdown",
        "p.subsections",
        date.alias("effective_date"),
        T.word_count(F.col("p.content_markdown")).alias("word_count"),
        (F.col("p.table_count") > 0).alias("has_tables"),
        F.col("p.table_count").alias("table_count"),
        "p.cross_references",
        "p.related_announcements",
    )
