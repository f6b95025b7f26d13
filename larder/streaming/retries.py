"""Retries with growing delays and dead letters, as a timed state machine on event time.

A request that fails is tried again after a delay that doubles with each failure in a row; after
``tries`` retries the next failure gives it up. A success, or giving up, starts its count anew. An event
at or before the due time of a retry takes its place. A retry comes out once the watermark, or a later
event of the request, has passed its due time.

Per request: the number of failures in a row and the due time. A batch's events of one request are held
together to order them; the size of a batch, which the source sets, bounds that. Rows of a null request
only move the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

EVENTS = "request string, ts timestamp, id long, ok boolean"
STEPS = "request string, at timestamp, kind string, attempt int"


class Attempts(StatefulProcessor):
    def __init__(self, tries: int, delay_ms: int) -> None:
        self.tries, self.delay = tries, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.now = handle.getValueState("attempts", "failures int, due long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events = sorted((int(ts.value // 1000), int(i), bool(ok)) for part in rows for ts, i, ok in zip(part["ts"], part["id"], part["ok"]))
        if key[0] is None:
            return
        failures, due = self.now.get() if self.now.exists() else (0, None)
        if due is not None:
            self.handle.deleteTimer(-(-due // 1000))
        out = []
        for ts, _, ok in events:
            if due is not None and due < ts:
                out.append((due, "retry", failures))
            failures, due = (0, None) if ok else (failures + 1, None)
            if failures > self.tries:
                out.append((ts, "failed", failures))
                failures = 0
            elif failures:
                due = ts + 1000 * self.delay * 2 ** (failures - 1)
        if failures:
            self.now.update((failures, due))
            if due is not None:
                self.handle.registerTimer(-(-due // 1000))
        else:
            self.now.clear()
        if out:
            yield self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        failures, due = self.now.get()
        self.now.update((failures, None))
        yield self._frame(key, [(due, "retry", failures)])

    @staticmethod
    def _frame(key, rows: list[tuple]) -> pd.DataFrame:
        at, kind, attempt = zip(*rows)
        return pd.DataFrame({"request": key[0], "at": pd.to_datetime(list(at), unit="us"), "kind": kind, "attempt": pd.array(attempt, "int32")})

    def close(self) -> None:
        pass


def retried(events: DataFrame, *, tries: int = 2, delay_ms: int = 60_000, late: str = "0 seconds") -> DataFrame:
    """Steps ``(request, at, kind, attempt)`` of a stream ``events(request, ts, id, ok)``: a ``retry`` with its due time, or ``failed`` for good. Events of a batch may come in any order, older ones than the watermark don't count."""
    timed = events.withWatermark("ts", late)
    return timed.groupBy("request").transformWithStateInPandas(Attempts(tries, delay_ms), STEPS, "append", "eventTime")


def dead_letters(steps: DataFrame) -> DataFrame:
    """What :func:`larder.operators.pages.failed_rows` takes, of the steps that gave a request up."""
    none = F.lit(None).cast("string")
    failed = steps.where("kind = 'failed'")
    return failed.select(F.col("request").alias("url"), F.col("at").alias("fetched_at"), F.lit("cheerio").alias("mode"), none.alias("label"), none.alias("source_domain"), F.lit(None).cast("array<string>").alias("admission_signals"), none.alias("fallback_reason"))
