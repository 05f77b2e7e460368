"""Crawl analytics: what to fetch, failure runs, delays, quality and counters."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def frontier(found: DataFrame, done: DataFrame, key: str, most: int = 0) -> DataFrame:
    """The first ``most`` keys (0: all) that are not done; the limit comes before the skip."""
    head = found.orderBy(key).limit(most) if most else found
    return head.join(done, key, "left_anti")


def to_fetch(found: DataFrame, manifest: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Keys without a finished status in the manifest or without a file."""
    done = manifest.filter(F.col("status").isin("success", "quality_warning")).join(files, key, "left_semi")
    return found.join(done, key, "left_anti")


def changed(now: DataFrame, state: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key and hash the state does not have; the state grows with the files, so it is never sent whole through the driver."""
    return now.join(state.hint("merge"), on, "left_anti")


def right_biased_merge(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """All keys; a new value takes the place of an old one."""
    theirs = new.select(F.col(key).alias("__k"), F.col(value).alias("__v"))
    both = old.join(theirs, F.col(key) == F.col("__k"), "full")
    return both.select(F.coalesce("__k", key).alias(key), F.coalesce("__v", value).alias(value))


def failure_runs(attempts: DataFrame, by: str, order: list[str], ok: str) -> DataFrame:
    """run: how many failures in a row end with this attempt (0 for a success)."""
    upto = Window.partitionBy(by).orderBy(*order)
    island = attempts.withColumn("__island", F.sum(F.col(ok).cast("int")).over(upto))
    within = Window.partitionBy(by, "__island").orderBy(*order)
    run = F.sum((~F.col(ok)).cast("long")).over(within)
    return island.withColumn("run", F.when(F.col(ok), F.lit(0)).otherwise(run)).drop("__island")


def breaker_trips(attempts: DataFrame, by: str, order: list[str], ok: str, threshold: int = 5) -> DataFrame:
    """Attempts at which the circuit breaker opens; it resets each time."""
    runs = failure_runs(attempts, by, order, ok)
    return runs.filter((F.col("run") > 0) & (F.col("run") % threshold == 0))


def delay_after(codes: Column, base: float = 1.0, cap: float = 30.0) -> Column:
    """The delay after a sequence of status codes.

    429 and 503 double it up to ``cap``; three 200 in a row take a quarter off, down
    to ``base``.
    """
    start = F.struct(F.lit(base).alias("delay"), F.lit(0).alias("good"))

    def step(s: Column, code: Column) -> Column:
        bad, third = code.isin(429, 503), (code == 200) & (s["good"] == 2)
        delay = F.when(bad, F.least(F.lit(cap), s["delay"] * 2)).when(third, F.greatest(F.lit(base), s["delay"] * 0.75)).otherwise(s["delay"])
        good = F.when(bad | third, F.lit(0)).when(code == 200, s["good"] + 1).otherwise(s["good"])
        return F.struct(delay.alias("delay"), good.alias("good"))

    return F.aggregate(codes, start, step, lambda s: s["delay"])


class Delay:
    """The delay that `delay_after` gives, moved on request by request."""

    def __init__(self, base: float, cap: float, delay: float | None = None, good: int = 0) -> None:
        self.base, self.cap, self.delay, self.good = base, cap, base if delay is None else delay, good

    def saw(self, code: int) -> None:
        if code in (429, 503):
            self.delay, self.good = min(self.cap, self.delay * 2), 0
        elif code == 200:
            self.good += 1
            if self.good == 3:
                self.delay, self.good = max(self.base, self.delay * 0.75), 0


def adaptive_delays(requests: DataFrame, by: str, order: list[str], status: str, base: float = 1.0, cap: float = 30.0) -> DataFrame:
    """The delay that each ``by`` has come to.

    Requests are sorted by ``by`` and order and folded one after the other, so a task
    holds one delay, however many requests a ``by`` has.
    """
    kind = requests.schema[by].dataType.simpleString()

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, pace = None, None
        for f in frames:
            done = []
            for key, code in zip(f["by"], f["code"], strict=True):
                if pace is None or key != own:
                    if pace is not None:
                        done.append((own, pace.delay))
                    own, pace = key, Delay(base, cap)
                pace.saw(code)
            yield pd.DataFrame(done, columns=["by", "delay"])
        if pace is not None:
            yield pd.DataFrame([(own, pace.delay)], columns=["by", "delay"])

    rows = requests.select(F.col(by).alias("by"), *order, F.col(status).alias("code")).repartition("by").sortWithinPartitions("by", *order)
    return rows.select("by", "code").mapInPandas(fold, f"by {kind}, delay double").withColumnRenamed("by", by)


def quality_gate(attempts: DataFrame, by: str, attempt: str, words: str, least: float) -> DataFrame:
    """Of the attempts at each key the longest (the first of equals), and whether it is long enough."""
    best = attempts.groupBy(by).agg(F.max_by(F.struct(attempt, words), F.struct(words, -F.col(attempt))).alias("x"))
    return best.select(by, f"x.{attempt}", F.when(F.col(f"x.{words}") < least, "quality_warning").otherwise("success").alias("status"))


def counters(records: DataFrame, by: str, status: str) -> DataFrame:
    """Counts of all records and of each outcome."""
    n = {"scraped": "success", "warnings": "quality_warning", "failed": "failed", "skipped": "skipped"}
    return records.groupBy(by).agg(F.count(F.lit(1)).alias("discovered"), *[F.count_if(F.col(status) == v).alias(k) for k, v in n.items()])
