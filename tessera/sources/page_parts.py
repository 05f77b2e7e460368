"""Parts of pages as rows: a table function that Spark joins laterally with a table of pages."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import udtf

from .dom import parse, tagged

NAME = "page_parts"
HEADINGS = tagged("h1", "h2", "h3", "h4", "h5", "h6")


@udtf(returnType="kind string, place int, level int, text string, target string", useArrow=True)
class PageParts:
    """The headings, links and tables of a page, each kind counted from 1 in the order of the page.

    level: of a heading, or the rows of a table.  target: a link's address.  A null page has none.
    """

    def eval(self, html: str) -> Iterator[tuple]:
        if html is None:
            return
        places = {"heading": 0, "link": 0, "table": 0}
        for node in parse(html).walk():
            if HEADINGS(node):
                kind, level, target = "heading", int(node.tag[1]), None
            elif node.tag == "a" and "href" in node.attrs:
                kind, level, target = "link", None, node.attrs["href"]
            elif node.tag == "table":
                kind, level, target = "table", len(node.find_all(tagged("tr"))), None
            else:
                continue
            places[kind] += 1
            yield kind, places[kind], level, None if kind == "table" else " ".join("".join(node.strings()).split()), target


def register(spark: SparkSession) -> None:
    spark.udtf.register(NAME, PageParts)


def parts(pages: DataFrame, html: str = "html") -> DataFrame:
    """A row for each part of each of ``pages``, beside the page's other columns."""
    spark = pages.sparkSession
    register(spark)
    others = [f"p.`{c}`" for c in pages.columns if c != html]
    return spark.sql(f"SELECT {', '.join([*others, 'x.*'])} FROM {{pages}} AS p, LATERAL {NAME}(p.`{html}`) AS x", pages=pages)
