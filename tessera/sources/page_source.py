"""Pages as a data source: ``spark.read.format("tessera_pages")``, a partition for each host.

A host's pages are fetched one after the other at that host's pace; hosts are fetched
side by side.  A page that cannot be had is a row without a body and with the error.
Options: ``urls`` (a JSON list), ``fetcher`` (a factory, see `packed`), ``config``.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators import fetch
from ..plans.config import Config

NAME = "tessera_pages"
SCHEMA = "url string, host string, body string, error string"


def packed(value: object) -> str:
    return base64.b64encode(cloudpickle.dumps(value)).decode()


def unpacked(text: str) -> object:
    return cloudpickle.loads(base64.b64decode(text))


class Host(InputPartition):
    def __init__(self, host: str, urls: list[str]) -> None:
        self.host, self.urls = host, urls


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.urls, self.fetcher, self.config = options["urls"], options["fetcher"], options["config"]

    def partitions(self) -> list[Host]:
        by: dict[str, list[str]] = {}
        for url in dict.fromkeys(json.loads(self.urls)):
            by.setdefault(urlparse(url).netloc, []).append(url)
        return [Host(h, u) for h, u in sorted(by.items())] or [Host("", [])]

    def read(self, partition: Host) -> Iterator[tuple]:
        config: Config = unpacked(self.config)
        fetcher, pace = unpacked(self.fetcher)(), fetch.Pace(config, 0.0)
        fetcher.open()
        try:
            for url in partition.urls:
                pace.wait()
                body, _, error = fetch.with_retries(lambda url=url: fetcher.get(url), config.max_retries, config.backoff_factor, pace.sleep)
                pace.failures = 0 if body is not None else pace.failures + 1
                yield url, partition.host, body, None if body is not None else f"{type(error).__name__}: {error}"[:500] if error else "no page"
        finally:
            fetcher.close()


class Pages(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options)


def read_pages(spark: SparkSession, urls: list[str], make: Callable[[], fetch.Fetcher], config: Config) -> DataFrame:
    """url, host, body and error of each of ``urls``."""
    spark.dataSource.register(Pages)
    return spark.read.format(NAME).option("urls", json.dumps(urls)).option("fetcher", packed(make)).option("config", packed(config)).load()


class StoredPages:
    """A fetcher that replays pages stored as Parquet (url, body) at a URI that all executors reach."""

    def __init__(self, uri: str) -> None:
        self.uri = uri

    def open(self) -> None:
        import pyarrow.dataset as ds
        from pyarrow.fs import FileSystem

        fs, path = FileSystem.from_uri(self.uri)
        self.pages = ds.dataset(path, filesystem=fs, format="parquet", exclude_invalid_files=True)

    def get(self, url: str) -> str | None:
        import pyarrow.dataset as ds

        found = self.pages.to_table(columns=["body"], filter=ds.field("url") == url)
        return found.column("body")[0].as_py() if found.num_rows else None

    def close(self) -> None:
        pass
