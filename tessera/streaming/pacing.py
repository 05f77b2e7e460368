"""Delay and circuit breaker of each host over a stream of requests, as state of one row a host.

Each request moves its host's delay (`crawl.Delay`) and its run of failures.  At
``threshold`` failures in a row the breaker opens and the run begins anew; a timer closes
it when the cooldown has passed in the time of the requests.  Requests of a host count in
the order of their time, then of their id.

Calls of the state server and single Arrow batches cost more than the fold itself, so the
state has the times at which a host's breakers close, and a timer only for the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.crawl import Delay

#: kind: request, or closed for a breaker that has cooled down (without id and status).
PACED = "host string, kind string, at timestamp, id long, status int, delay double, run int, opened boolean"


class Pacing(StatefulProcessor):
    def __init__(self, base: float, cap: float, threshold: int, cooldown: float) -> None:
        self.base, self.cap, self.threshold, self.cooldown = base, cap, threshold, cooldown

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("pace", "delay double, good int, run int, closings array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = self.state.get()
        pace, run, closings = Delay(self.base, self.cap, *(found[:2] if found else ())), found[2] if found else 0, set(found[3] if found else ())
        frames = list(rows)
        asked = frames[0] if len(frames) == 1 else pd.concat(frames)
        asked = asked.iloc[np.lexsort((asked["id"].to_numpy(), asked["at"].to_numpy()))]
        delays, runs, opened = [], [], []
        for status, ok in zip(asked["status"].tolist(), asked["ok"].tolist(), strict=True):
            pace.saw(status)
            run = 0 if ok else run + 1
            opened.append(run == self.threshold)
            if opened[-1]:
                run = 0
            delays.append(pace.delay)
            runs.append(run)
        if any(opened):
            first = min(closings, default=None)
            ends = asked["at"].to_numpy()[opened].astype("datetime64[ms]").astype(np.int64) + int(self.cooldown * 1000)
            closings.update(ends.tolist())
            if first is None or min(closings) < first:
                self.handle.registerTimer(min(closings))
        self.state.update((pace.delay, pace.good, run, sorted(closings)))
        yield pd.DataFrame({"host": key[0], "kind": "request", "at": asked["at"], "id": asked["id"], "status": asked["status"], "delay": delays, "run": runs, "opened": opened})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        delay, good, run, closings = self.state.get()
        due, rest = [t for t in closings if t <= now], [t for t in closings if t > now]
        if not due:
            return
        if rest:
            self.handle.registerTimer(rest[0])
        self.state.update((delay, good, run, rest))
        none = [None] * len(due)
        yield pd.DataFrame({"host": key[0], "kind": "closed", "at": pd.to_datetime(due, unit="ms"), "id": pd.array(none, "Int64"), "status": pd.array(none, "Int32"), "delay": delay, "run": run, "opened": False})

    def close(self) -> None:
        pass


def paced(requests: DataFrame, base: float = 1.0, cap: float = 30.0, threshold: int = 5, cooldown: float = 60.0, late: str = "10 minutes") -> DataFrame:
    """``PACED`` for a stream of requests (host, at, id, status, ok).

    State needs the RocksDB provider (`spark.sql.streaming.stateStore.providerClass`).
    """
    rows = requests.select("host", "at", "id", "status", "ok").withWatermark("at", late)
    return rows.groupBy("host").transformWithStateInPandas(Pacing(base, cap, threshold, cooldown), outputStructType=PACED, outputMode="Append", timeMode="EventTime")


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def written(requests: DataFrame, path: str, checkpoint: str, **settings) -> None:
    """Run ``paced`` over what there is of a stream and append its rows to ``path``."""
    spark = requests.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)
    try:
        paced(requests, **settings).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(name, before)
