"""Web pages: markdown, titles, dates, hierarchy and links.

What patterns can find is a column expression; walking HTML is a vectorised function
over the standard library's parser.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as T

_SKIP = {"script", "style", "noscript", "iframe"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCK = {"p", "div", "section", "article", "main", "header", "footer", "nav", "ul", "ol", "table", "tr", "blockquote", "pre", "title", "head", "body"}


class _Markdown(HTMLParser):
    """Markdown of a page: ATX headings, `-` bullets, links, bold; images and hidden parts left out."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.hidden: list[str] = []
        self.hrefs: list[str | None] = []
        self.lists: list[list] = []
        self.cells = 0
        self.links: list[dict] = []
        self.open_link: list[int] = []

    def handle_starttag(self, tag: str, attrs) -> None:
        a = dict(attrs)
        style = (a.get("style") or "").replace(" ", "").lower()
        if self.hidden or tag in _SKIP or a.get("aria-hidden") == "true" or "display:none" in style:
            if tag not in _VOID:
                self.hidden.append(tag)
            return
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag == "br":
            self.out.append("\n")
        elif tag in ("ul", "ol"):
            self.lists.append([tag, 0])
            self.out.append("\n\n" if len(self.lists) == 1 else "")
        elif tag == "li":
            kind = self.lists[-1] if self.lists else ["ul", 0]
            kind[1] += 1
            self.out.append("\n" + "  " * max(0, len(self.lists) - 1) + ("- " if kind[0] == "ul" else f"{kind[1]}. "))
        elif tag == "tr":
            self.cells = 0
            self.out.append("\n|")
        elif tag in ("td", "th"):
            self.cells += 1
            self.out.append(" ")
        elif tag == "a":
            self.hrefs.append(a.get("href"))
            self.links.append({"href": a.get("href") or "", "text": ""})
            self.open_link.append(len(self.links) - 1)
            self.out.append("[")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag in _BLOCK:
            self.out.append("\n\n")

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            if tag in self.hidden:
                while self.hidden.pop() != tag:
                    pass
            return
        if tag in ("td", "th"):
            self.out.append(" |")
        elif tag == "a" and self.hrefs:
            href = self.hrefs.pop()
            self.open_link.pop()
            self.out.append(f"]({href})" if href else "]")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag in ("ul", "ol") and self.lists:
            self.lists.pop()
            self.out.append("\n")
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6") or tag in _BLOCK:
            self.out.append("\n\n")

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            text = " ".join(data.replace(" ", " ").split(" ")) if data.strip() else (" " if data else "")
            text = text.replace("\n", " ")
            self.out.append(text)
            for k in self.open_link:
                self.links[k]["text"] += text


def _walk(html: str | None) -> _Markdown:
    parser = _Markdown()
    parser.feed(html or "")
    parser.close()
    return parser


def _tidy(text: str) -> str:
    return re.sub(r"\n{4,}", "\n\n\n", "\n".join(line.rstrip() for line in text.split("\n"))).strip()


#: Pages that a worker has as Python objects at a time.
SLICE = 128


def _markdown(html: pa.Array) -> pa.Array:
    done = [pa.array([_tidy("".join(_walk(h).out)) for h in html.slice(at, SLICE).to_pylist()], pa.string()) for at in range(0, len(html), SLICE)]
    return pa.concat_arrays(done) if done else pa.array([], pa.string())


def markdown(html: Column) -> Column:
    """Markdown of a page; null gives the empty text."""
    return F.arrow_udf(_markdown, "string")(html)


def _links(html: pd.Series) -> pd.Series:
    return html.map(lambda h: [{"href": x["href"], "text": " ".join(x["text"].split())} for x in _walk(h).links])


def links(html: Column) -> Column:
    """The visible links of a page in order."""
    return F.pandas_udf(_links, "array<struct<href:string,text:string>>")(html)


def short_links(text: Column) -> Column:
    """Links to other sections by their code alone; codes of the first guide in capitals."""
    second = F.regexp_replace(text, r"(?i)\[([^\]]+)\]\([^)]*/app/guide/section/([0-9]+(?:\.[0-9]+)?)[^)]*\)", "[$1]($2)")
    pieces = F.split(second, r"(?i)\([^()]*/sel/(?=[^/)]+)", -1)
    rest = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(1))), lambda p: F.concat(F.lit("("), F.upper(F.regexp_extract(p, r"\A([^/)]+)", 1)), F.regexp_replace(p, r"\A[^/)]+(?:/[^)]*)?", "")))
    return F.when(F.size(pieces) > 1, F.concat(pieces[0], F.array_join(rest, ""))).otherwise(second)


def tidy(text: Column) -> Column:
    """Lines without trailing white space, at most two empty lines in a row, stripped."""
    return T.strip(F.regexp_replace(F.regexp_replace(text, r"(?mdU)[^\S\n]+$", ""), r"\n{4,}", "\n\n\n"))


def effective_date(text: Column, anywhere: bool) -> Column:
    """yyyy-MM-dd of the labelled date; with ``anywhere`` of the first date else."""
    label = r"(?i)(?:Effective|Updated|Published)(?:\s+Date)?\s*:?\s*(\d{1,2}/\d{1,2}/\d{4})"
    found = [label, r"\b(\d{1,2}/\d{1,2}/\d{4})\b"][: 1 + anywhere]
    parsed = [F.try_to_date(F.nullif(F.regexp_extract(text, p, 1), F.lit("")), "M/d/yyyy") for p in found]
    return F.date_format(F.coalesce(*parsed), "yyyy-MM-dd")


def code_hierarchy(code: Column) -> tuple[Column, Column, Column]:
    """Part, chapter and subpart that a code of the first guide names."""
    deep, flat = r"^[A-E]\d+-\d+\.\d+-\d+$", r"^[A-E]\d*-\d+-\d+$"
    chapter = F.when(code.rlike(deep), F.regexp_extract(code, r"^([A-E]\d+-\d+)\.", 1)).when(code.rlike(flat), F.regexp_extract(code, r"^([A-E]\d*-\d+)-", 1)).otherwise(code)
    return F.substring(code, 1, 1), chapter, F.when(code.rlike(deep), F.regexp_extract(code, r"^([A-E]\d+-\d+\.\d+)-", 1))
