"""Discovery in one step: a guide's sitemap, the sitemaps that it names, and its table of contents.

A sitemap may be an index; it is expanded by one level.  Sitemaps of other hosts, or
not by HTTPS, are skipped, and one that cannot be had gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import fetch
from ..sources import page_source, pages, sitemaps
from .config import Config

#: Fixed value: a sitemap index names this many sitemaps at most, by its protocol.
MOST_SITEMAPS = 50_000
#: With fewer addresses than this the first guide's table of contents is read as well.
LEAST_ADDRESSES = 200
ENTRY = "array<struct<kind:string,loc:string,lastmod:string>>"
FOUND = "url string, section_code string, slug string, last_modified string"


def _entries(body: str | None) -> list[dict]:
    """The url and sitemap elements of a sitemap with their addresses; what is no XML has none."""
    import xml.etree.ElementTree as ET

    try:
        root = ET.fromstring(body or "")
    except ET.ParseError:
        return []
    bare = lambda x: x.tag.rpartition("}")[2]
    out = []
    for node in root.iter():
        if bare(node) in ("url", "sitemap"):
            fields = {bare(x): (x.text or "").strip() for x in node}
            if fields.get("loc"):
                out.append({"kind": bare(node), "loc": fields["loc"], "lastmod": fields.get("lastmod") or None})
    return out


def entries(body: Column) -> Column:
    return F.pandas_udf(lambda texts: pd.Series([_entries(t) for t in texts]), ENTRY)(body)


def expanded(spark: SparkSession, url: str, make: Callable[[], fetch.Fetcher], config: Config) -> DataFrame:
    """loc, lastmod and sitemap of the addresses in the sitemap at ``url`` and in those that it names."""
    host = urlparse(url).netloc
    rows = lambda read: read.select(F.col("url").alias("sitemap"), F.explode(entries(F.col("body"))).alias("e")).select("sitemap", "e.*")
    top = rows(page_source.read_pages(spark, [url], make, config))
    named = top.filter("kind = 'sitemap'").filter(sitemaps.valid_url(F.col("loc"), host)).select("loc").distinct().limit(MOST_SITEMAPS)
    below = rows(page_source.read_pages(spark, sorted(r["loc"] for r in named.collect()), make, config))
    return top.unionByName(below).filter("kind = 'url'").select("loc", "lastmod", "sitemap")


def coded(found: DataFrame, source: str, host: str | None) -> DataFrame:
    """url, section_code, slug and last_modified of a source's sections among ``found`` (loc, lastmod)."""
    if source == "fannie_mae":
        rows = sitemaps.first_guide(found)
    else:
        rows = sitemaps.second_guide(found.withColumnRenamed("loc", "url"), host or "").withColumnsRenamed({"url": "loc", "code": "section_code"})
    return rows.select(F.col("loc").alias("url"), "section_code", sitemaps.url_slug(F.col("loc")).alias("slug"), F.col("lastmod").alias("last_modified"))


def contents(spark: SparkSession, base: str, make: Callable[[], fetch.Fetcher], config: Config) -> DataFrame:
    """The sections that the first guide's table of contents links to, each at its first link."""
    read = page_source.read_pages(spark, [f"{base}/sel/selling-guide"], make, config)
    links = read.select(F.posexplode(pages.links(F.col("body"))).alias("place", "a")).select("place", F.col("a.href").alias("href"))
    path = F.regexp_extract("href", r"^(?:https?://[^/]+)?(/[^?#]*)", 1)
    rows = links.select("place", F.concat(F.lit(base), path).alias("url"), sitemaps.section_code(path).alias("section_code")).filter("section_code IS NOT NULL")
    first = rows.groupBy("section_code").agg(F.min_by("url", "place").alias("url"))
    return first.select("url", "section_code", sitemaps.url_slug(F.col("url")).alias("slug"), F.lit(None).cast("string").alias("last_modified"))


def discover(spark: SparkSession, source: str, make: Callable[[], fetch.Fetcher], config: Config) -> DataFrame:
    """url, section_code, slug and last_modified of a guide's sections, in the order of the codes.

    A code that several addresses have keeps each of them, as the sitemap does.
    """
    first = source == "fannie_mae"
    url = config.first_sitemap_url if first else config.second_sitemap_url
    base = config.first_base_url if first else config.second_base_url
    found = coded(expanded(spark, url, make, config), source, urlparse(base).netloc)
    if first and found.count() < LEAST_ADDRESSES:
        more = contents(spark, base, make, config).join(found.select("section_code").distinct(), "section_code", "left_anti")
        found = found.unionByName(more)
    return found.orderBy("section_code")
