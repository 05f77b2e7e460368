"""Fetching pages: one fetcher a partition, with retries, a breaker, adaptive delay and a quality gate.

A fetcher is made by a factory on the executor, opened before a partition's first page
and closed after its last.  Partitions are the workers; each has its own delay and
breaker.  The result has a row for every address, fetched or not.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

from ..plans.config import Config

RESULT = "url string, source string, section_code string, html string, status string, word_count long, attempts int, error_type string, error_message string"
JITTER = 0.25
#: Waits differ by so much from the delay, so that workers do not fall into step, and are so long at least.
WAIT_JITTER, LEAST_WAIT = 0.15, 0.1


class NotRetryable(Exception):
    """An error that another attempt cannot mend."""


class Fetcher(Protocol):
    """What a connector has to offer; `get` returns None for a page that is not there."""

    def open(self) -> None: ...

    def get(self, url: str) -> str | None: ...

    def close(self) -> None: ...


class HttpFetcher:
    """Plain HTTP by one session; absent pages and pages of under 500 characters are None."""

    def __init__(self, user_agent: str, timeout: int) -> None:
        self.user_agent, self.timeout, self.session = user_agent, timeout, None

    def open(self) -> None:
        import requests

        self.session = requests.Session()
        self.session.headers.update({"User-Agent": self.user_agent, **HEADERS})

    def get(self, url: str) -> str | None:
        answer = self.session.get(url, timeout=self.timeout)
        if answer.status_code == 404:
            return None
        answer.raise_for_status()
        return answer.text if len(answer.text) >= 500 else None

    def close(self) -> None:
        if self.session is not None:
            self.session.close()


#: What a session says it takes.
HEADERS = {"Accept": "text/html,application/xhtml+xml,application/xml;q=0.9", "Accept-Language": "en-US,en;q=0.9", "Accept-Encoding": "gzip, deflate"}


@dataclass(frozen=True)
class Http:
    """Makes a fetcher for each worker, with a session of its own."""

    config: Config
    user_agent: str = "tessera"

    def __call__(self) -> HttpFetcher:
        return HttpFetcher(self.user_agent, self.config.timeout)


class TableFetcher:
    """Pages out of a mapping, for tests and replays."""

    def __init__(self, pages: dict[str, str | None]) -> None:
        self.pages = pages

    def open(self) -> None:
        pass

    def get(self, url: str) -> str | None:
        return self.pages.get(url)

    def close(self) -> None:
        pass


@dataclass
class Pace:
    """The delay between pages and the breaker of one worker."""

    config: Config
    base: float
    sleep: Callable[[float], None] = time.sleep
    #: How far a wait is from the delay, as a share of it.
    spread: Callable[[], float] = field(default=lambda: random.uniform(-WAIT_JITTER, WAIT_JITTER))
    delay: float = field(init=False)
    good: int = 0
    failures: int = 0

    def __post_init__(self) -> None:
        self.delay = self.base

    def wait(self) -> None:
        if self.failures >= self.config.breaker_threshold:
            self.sleep(self.config.breaker_cooldown)
            self.failures = 0
        if self.delay:
            self.sleep(max(LEAST_WAIT, self.delay * (1 + self.spread())))

    def saw(self, code: int) -> None:
        """429 and 503 double the delay; three successes in a row take a quarter off."""
        if not self.config.adaptive_delay:
            return
        if code in (429, 503):
            self.delay, self.good = min(self.config.max_delay, max(self.delay, 0.1) * 2), 0
        elif code == 200:
            self.good += 1
            if self.good == 3:
                self.delay, self.good = max(self.base, self.delay * 0.75), 0


def with_retries(call: Callable[[], str | None], retries: int, factor: float, sleep: Callable[[float], None]) -> tuple[str | None, int, Exception | None]:
    """The page, the attempts made and the last error if none succeeded."""
    error: Exception | None = None
    for attempt in range(retries + 1):
        try:
            return call(), attempt + 1, None
        except NotRetryable as found:
            return None, attempt + 1, found
        except Exception as found:  # connectors raise what their library raises
            error = found
            if attempt < retries:
                wait = factor**attempt
                sleep(wait + random.uniform(0, wait * JITTER))
    return None, retries + 1, error


def fetch_one(fetcher: Fetcher, url: str, config: Config, pace: Pace, count_words: Callable[[str], int]) -> dict:
    """Fetch a page; a short one gets one more chance and the longer of both counts."""
    pace.wait()
    html, attempts, error = with_retries(lambda: fetcher.get(url), config.max_retries, config.backoff_factor, pace.sleep)
    if html is None:
        pace.failures += 1
        pace.saw(getattr(getattr(error, "response", None), "status_code", 0) or 0)
        return {"html": None, "status": "failed", "word_count": 0, "attempts": attempts, "error_type": type(error).__name__ if error else None, "error_message": str(error)[:500] if error else None}
    words = count_words(html)
    if words < config.quality_min_words:
        again, more, _ = with_retries(lambda: fetcher.get(url), min(1, config.max_retries), config.backoff_factor, pace.sleep)
        attempts += more
        if again is not None and (n := count_words(again)) > words:
            html, words = again, n
    pace.failures = 0
    pace.saw(200)
    status = "success" if words >= config.quality_min_words else "quality_warning"
    return {"html": html, "status": status, "word_count": words, "attempts": attempts, "error_type": None, "error_message": None}


def fetched(frontier: DataFrame, make: Callable[[], Fetcher], config: Config, base_delay: float, workers: int, count_words: Callable[[str], int], sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """A row for each of ``frontier`` (url, source, section_code) with the page and how it went."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetcher, pace = make(), Pace(config, base_delay, sleep)
        fetcher.open()
        try:
            for f in frames:
                done = [fetch_one(fetcher, u, config, pace, count_words) for u in f["url"]]
                yield pd.concat([f[["url", "source", "section_code"]].reset_index(drop=True), pd.DataFrame(done, columns=["html", "status", "word_count", "attempts", "error_type", "error_message"])], axis=1)
        finally:
            try:
                fetcher.close()
            except Exception:  # a connector that fails to close has done its work
                pass

    return frontier.select("url", "source", "section_code").repartition(workers).mapInPandas(run, RESULT)
