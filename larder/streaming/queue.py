"""A queue that takes each URL once, in a stream's state.

URLs are dealt over a fixed number of buckets, each a key of the stream with a map of its URLs in RocksDB:
an entry is read and written by itself, so a batch costs what it holds, however long the queue is. Each
task first adds up what it has of a URL, so one that a third of all pages link to is one row a task.

In a batch, requests are compared with the state before it, then what was handled is marked. The status of
a URL is that of its first request: ``new``, ``already-present`` or ``already-handled``; what was handled
without a request counts as handled. Rows of a null URL take no part. With a time to live an entry goes
that long after it was last written, and the URL is new again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

EVENTS = "canonical_url string, seq long, handled boolean"
STATUS = "canonical_url string, seq long, status string, requests long"
_SUMS = "canonical_url string, seq long, requests long, handled boolean"


def _add(sums: dict[str, list], url: str, seq: int | None, requests: int, handled: bool) -> None:
    own = sums.setdefault(url, [None, 0, False])
    if requests and seq is not None and (own[0] is None or seq < own[0]):
        own[0] = seq
    own[1] += requests
    own[2] |= handled


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each URL of a task's input: first request, number of requests, whether it was handled."""
    sums: dict[str, list] = {}

    def out() -> pa.RecordBatch:
        rows = list(sums.values())
        return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.bool_())], ["canonical_url", "seq", "requests", "handled"])

    for batch in batches:
        for url, seq, handled in zip(*(c.to_pylist() for c in batch.columns)):
            if url is not None:
                _add(sums, url, seq, 0 if handled else 1, bool(handled))
        if len(sums) > 200_000:
            yield out()
            sums = {}
    yield out()


class Entries(StatefulProcessor):
    """The URLs of one bucket: whether each was handled."""

    def __init__(self, ttl_ms: int | None) -> None:
        self.ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entries = handle.getMapState("entries", "url string", "handled boolean", self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        sums: dict[str, list] = {}
        for part in rows:
            for url, seq, requests, handled in zip(part["canonical_url"], part["seq"], part["requests"], part["handled"]):
                _add(sums, url, None if pd.isna(seq) else int(seq), int(requests), bool(handled))
        out = []
        for url, (seq, requests, handled) in sums.items():
            known = self.entries.getValue((url,)) if self.entries.containsKey((url,)) else None
            if requests:
                out.append((url, seq, "new" if known is None else "already-handled" if known[0] else "already-present", requests))
            if known is None or (handled and not known[0]):
                self.entries.updateValue((url,), (handled,))
        if out:
            yield pd.DataFrame(out, columns=["canonical_url", "seq", "status", "requests"]).astype({"seq": "Int64"})

    def close(self) -> None:
        pass


def queued(events: DataFrame, *, buckets: int = 1024, ttl_ms: int | None = None) -> DataFrame:
    """The status of each URL in each batch of a stream ``events(canonical_url, seq, handled)``, with the seq of its first request and their number.

    With a time to live, a stream that is to end by itself must run without empty batches.
    """
    sums = events.select("canonical_url", "seq", "handled").mapInArrow(_combine, _SUMS)
    keyed = sums.withColumn("bucket", F.pmod(F.xxhash64("canonical_url"), F.lit(buckets)).cast("int"))
    return keyed.groupBy("bucket").transformWithStateInPandas(Entries(ttl_ms), STATUS, "append", "processingTime" if ttl_ms else "none")
