"""Per-domain admission counters with caps, kept in a stream's state.

Each domain has one counter. In every batch the first rows of a domain, by ``seq``, are admitted as long
as its counter is under the cap, and the counter grows by them. Only the first ``cap`` rows of a domain
in a task's input can be among them, so each task drops the others before the shuffle: a domain with a
third of all links sends its cap, not its links, to the task that has its counter.

Rows of a null domain are never admitted. Rows of one ``seq`` in a batch go by their URL.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

LINKS = "domain string, seq long, canonical_url string"
ADMITTED = "domain string, seq long, canonical_url string, rank long"


class _First:
    """The first ``most`` (seq, url) pairs of what is pushed, in memory for so many."""

    def __init__(self, most: int) -> None:
        self.most, self.heap = most, []

    def push(self, seq: int, url: str) -> None:
        item = _Last(seq, url)
        if len(self.heap) < self.most:
            heapq.heappush(self.heap, item)
        elif self.heap and self.heap[0] < item:
            heapq.heapreplace(self.heap, item)

    def ordered(self) -> list[tuple[int, str]]:
        return sorted((x.seq, x.url) for x in self.heap)


class _Last:
    """Orders pairs backwards, so that a heap has the last one on top."""

    __slots__ = ("seq", "url")

    def __init__(self, seq: int, url: str) -> None:
        self.seq, self.url = seq, url

    def __lt__(self, other: _Last) -> bool:
        return (self.seq, self.url) > (other.seq, other.url)


def _cut(cap: int):
    """Drop, within a task's input, what is beyond the first ``cap`` rows of its domain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[str, _First] = {}
        for batch in batches:
            for domain, seq, url in zip(*(c.to_pylist() for c in batch.columns)):
                if domain is not None:
                    first.setdefault(domain, _First(cap)).push(seq, url)
        for domain, kept in first.items():
            rows = kept.ordered()
            yield pa.RecordBatch.from_arrays([pa.array([domain] * len(rows), pa.string()), pa.array([s for s, _ in rows], pa.int64()), pa.array([u for _, u in rows], pa.string())], ["domain", "seq", "canonical_url"])

    return run


class Counter(StatefulProcessor):
    """One ``admitted`` counter for each domain; ``caps`` has those of domains with a cap of their own."""

    def __init__(self, cap: int, caps: dict[str, int]) -> None:
        self.cap, self.caps = cap, caps

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.admitted = handle.getValueState("admitted", "n long")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.admitted.update((int(initialState["admitted"].iloc[0]),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = self.admitted.get()[0] if self.admitted.exists() else 0
        room = max(0, self.caps.get(key[0], self.cap) - before)
        first = _First(room)
        for part in rows:
            if room:
                for seq, url in zip(part["seq"].tolist(), part["canonical_url"].tolist()):
                    first.push(seq, url)
        new = first.ordered()
        if new:
            self.admitted.update((before + len(new),))
            yield pd.DataFrame({"domain": key[0], "seq": [s for s, _ in new], "canonical_url": [u for _, u in new], "rank": range(before + 1, before + len(new) + 1)})

    def close(self) -> None:
        pass


def admitted(links: DataFrame, cap: int, caps: dict[str, int] | None = None, initial: DataFrame | None = None) -> DataFrame:
    """The rows of a stream ``links(domain, seq, canonical_url)`` that the caps admit, with their rank in the domain.

    ``caps`` has a cap for some domains (a handful of seeds), ``cap`` holds for the others. ``initial(domain,
    admitted)`` is what earlier runs have admitted of a domain; it is taken up when the stream begins.
    """
    caps = caps or {}
    narrow = links.select("domain", "seq", "canonical_url").mapInArrow(_cut(max([cap, *caps.values()])), LINKS)
    known = initial.groupBy("domain") if initial is not None else None
    return narrow.groupBy("domain").transformWithStateInPandas(Counter(cap, caps), ADMITTED, "append", "none", initialState=known)
