"""Discovery of sections: sitemaps, addresses and the fallback to a table of contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T


def of_source(sections: DataFrame, source: str | None) -> DataFrame:
    """Sections of one source (hyphens stand for underscores) or, without a name, of all."""
    return sections if source is None else sections.filter(F.col("source") == source.replace("-", "_"))


def section_code(url: Column) -> Column:
    """The code after /sel/ in capitals, if it begins with A to E."""
    middle, last = (T.blank_to_null(F.regexp_extract(url, p, 1)) for p in (r"/sel/([^/]+)/", r"/sel/([^/]+)\z"))
    code = F.upper(F.coalesce(middle, last))
    return F.when(code.rlike("^[A-E]"), code)


def url_slug(url: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(url, r"/+\z", ""), "/"), -1)


def valid_url(url: Column, host: str) -> Column:
    return F.coalesce((F.try_parse_url(url, F.lit("PROTOCOL")) == "https") & (F.try_parse_url(url, F.lit("HOST")) == host), F.lit(False))


def second_guide(urls: DataFrame, host: str) -> DataFrame:
    """The second guide's section addresses with their code."""
    code = T.blank_to_null(F.regexp_extract("url", r"/section/([0-9]+(?:\.[0-9]+)?)", 1))
    good = F.contains("url", F.lit("/app/guide/section/")) & valid_url(F.col("url"), host)
    return urls.filter(good).withColumn("code", code).filter(F.col("code").isNotNull())


def with_fallback(site: DataFrame, toc: DataFrame, key: str, place: str) -> DataFrame:
    """Keys of the sitemap, and those of the table of contents that it lacks (each at its first place)."""
    once = toc.groupBy(key).agg(F.min(place).alias(place))
    more = once.join(site.select(key), key, "left_anti")
    return site.select(key, F.lit("sitemap").alias("origin")).unionByName(more.select(key, F.lit("toc").alias("origin")))


def read_sitemap(spark: SparkSession, path: str, host: str | None = None) -> DataFrame:
    """loc and lastmod of the <url> elements; malformed files give no rows."""
    found = spark.read.format("xml").option("rowTag", "url").option("mode", "DROPMALFORMED").schema("loc string, lastmod string").load(path)
    return found if host is None else found.filter(valid_url(F.col("loc"), host))


def read_sitemap_index(spark: SparkSession, path: str, host: str) -> DataFrame:
    """loc of the sitemaps that an index names, on the same host and by HTTPS only."""
    found = spark.read.format("xml").option("rowTag", "sitemap").option("mode", "DROPMALFORMED").schema("loc string").load(path)
    return found.filter(valid_url(F.col("loc"), host))


def first_guide(sitemap: DataFrame, toc_path: str = "/sel/") -> DataFrame:
    """Sitemap rows of the first guide with their code; the contents page is left out."""
    coded = sitemap.filter(F.contains("loc", F.lit(toc_path))).withColumn("section_code", section_code(F.col("loc")))
    return coded.filter(F.col("section_code").isNotNull())
