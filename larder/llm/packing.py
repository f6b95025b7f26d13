"""Bounded-space online packing of token sequences.

Each partition keeps a fixed number of open windows. A document's ids are cut into full windows;
the rest goes to the open window that it fits best. When none fits and no further window may open,
the fullest is topped up with the head of the rest and emitted, and what is left is placed anew.
The windows still open at the end of the partitions are merged by the same packer, some dozens of
partitions at a time, until one group is left; its last ids are laid out without a gap in full
windows and windows of a power of two, which need no padding.

Defined results: a null or empty text is its end id alone; a null doc_id stays null; repeated rows
are packed each; an empty table gives no piece. Every id lies in exactly one piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import arrow, put
from larder.llm.tokens import encoded, vocabulary

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary, part long, slot int"


@dataclass
class Window:
    pieces: list[tuple[object, int, bytes, int]] = field(default_factory=list)
    used: int = 0

    def add(self, doc: object, start: int, ids: bytes, total: int) -> None:
        self.pieces.append((doc, start, ids, total))
        self.used += len(ids) // 4


class Packer:
    """Best fit into at most ``open_windows`` windows; ``take`` gives the windows that are full."""

    def __init__(self, length: int, open_windows: int) -> None:
        self.length, self.most = length, open_windows
        self.windows: list[Window] = []

    def take(self, doc: object, start: int, ids: bytes, total: int) -> Iterator[Window]:
        full = 4 * self.length
        while ids:
            if len(ids) >= full:
                window, cut = Window(), full
            else:
                room = [(w.used, i) for i, w in enumerate(self.windows) if w.used + len(ids) // 4 <= self.length]
                if room:
                    window, cut = self.windows[max(room)[1]], len(ids)
                elif len(self.windows) < self.most:
                    window, cut = Window(), len(ids)
                    self.windows.append(window)
                else:
                    window = max(self.windows, key=lambda w: w.used)
                    cut = 4 * (self.length - window.used)
            window.add(doc, start, ids[:cut], total)
            start, ids = start + cut // 4, ids[cut:]
            if window.used == self.length:
                self.windows = [w for w in self.windows if w is not window]
                yield window

    def rest(self) -> Iterator[Window]:
        """All that is left, in full windows and windows of a power of two."""
        left = [p for w in self.windows for p in w.pieces]
        total = sum(len(p[2]) // 4 for p in left)
        sizes = [self.length] * (total // self.length) + [1 << b for b in range(self.length.bit_length(), -1, -1) if total % self.length >> b & 1]
        self.windows, window = [], Window()
        for doc, start, ids, whole in left:
            while ids:
                cut = min(len(ids), 4 * (sizes[0] - window.used))
                window.add(doc, start, ids[:cut], whole)
                start, ids = start + cut // 4, ids[cut:]
                if window.used == sizes[0]:
                    yield window
                    window = Window()
                    sizes.pop(0)


class Rows:
    """Pieces gathered for output."""

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "part", "slot"]
    types = [pa.int64()] * 7 + [pa.binary(), pa.int64(), pa.int32()]

    def __init__(self, keep_ids: bool) -> None:
        self.keep_ids, self.rows = keep_ids, []

    def add(self, window: Window, sequence: int | None, part: int, slot: int) -> None:
        at = 0
        for doc, start, ids, total in window.pieces:
            kept = ids if self.keep_ids or sequence is None else None
            self.rows.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, sequence, at, kept, part, slot))
            at += len(ids) // 4

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(self.names)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, self.types)], self.names)


def sequence_number(level: int, group: int, n: int) -> int:
    """Unique for up to 2**24 groups of a level and 2**32 sequences of a group."""
    return level << 56 | group << 32 | n


def pack(docs: DataFrame, tokenizer: str, *, length: int = 4096, open_windows: int = 16, fan_in: int = 32, end_id: int = 2, keep_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if kept)."""

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, packer, rows, n = TaskContext.get().partitionId(), Packer(length, open_windows), Rows(keep_ids), 0
        for doc, ids in encoded(batches, tokenizer, end_id):
            for window in packer.take(doc, 0, ids, len(ids) // 4):
                rows.add(window, sequence_number(0, part, n), part, 0)
                n += 1
            if len(rows.rows) >= 1000:
                yield rows.batch()
        for slot, window in enumerate(packer.windows):
            rows.add(window, None, part, slot)
        yield rows.batch()

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    table = put(arrow(narrow, partition, PIECE), "pieces")
    done = [table.where("sequence_id is not null")]
    parts = (table.agg(F.max("part")).first()[0] or 0) + 1
    left, level = table.where("sequence_id is null"), 0
    while True:
        level += 1
        parts = -(-parts // fan_in)
        merged = left.withColumn("group", F.expr(f"part div {fan_in}")).groupBy("group").applyInArrow(_merge(length, open_windows, level, parts == 1, keep_ids), PIECE)
        table = put(merged, "merged")
        done.append(table.where("sequence_id is not null"))
        if parts == 1:
            break
        left = table.where("sequence_id is null")
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out.drop("part", "slot", *([] if keep_ids else ["ids"]))


def _merge(length: int, open_windows: int, level: int, last: bool, keep_ids: bool):
    """Packs the open windows of at most ``fan_in`` partitions, which bounds what a task holds."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        group, packer, rows, n = key[0].as_py(), Packer(length, open_windows), Rows(keep_ids), 0
        pieces = table.sort_by([("part", "ascending"), ("slot", "ascending"), ("offset", "ascending")]).to_pylist()
        windows = (w for p in pieces for w in packer.take(p["doc_id"], p["start"], p["ids"], p["doc_tokens"]))
        for window in windows:
            rows.add(window, sequence_number(level, group, n), group, 0)
            n += 1
        if last:
            for window in packer.rest():
                rows.add(window, sequence_number(level, group, n), group, 0)
                n += 1
        else:
            for slot, window in enumerate(packer.windows):
                rows.add(window, None, group, slot)
        return pa.Table.from_batches([rows.batch()])

    return merge


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary("word_bpe_49k.json"))
