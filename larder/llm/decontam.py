"""Benchmark decontamination by winnowing.

Words are cut out of ASCII-lower-cased text. Word k-grams are hashed; in every run of
``window - k + 1`` consecutive k-grams the smallest hash (the rightmost of equal ones) is a fingerprint.
Two texts that share ``window`` words share such a run, so they share a fingerprint: joining the
fingerprints of documents and benchmark misses none. Every hit is extended to all windows of the
document that hold it; these are looked up in the benchmark's windows, and the bytes of their words are
compared. Equal windows of the benchmark are one entry, so repeated words don't multiply.

Items of fewer words than a window have no run; each is one whole window and is found by the hash
of its full word sequence.

Defined results: a null or empty text has no words and no hits; benchmark rows with a null id or
text take no part; repeated documents each give a row, repeated items count once; an empty
benchmark leaves every document clean; a null doc_id stays null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import Words, arrow, gram_hash, put, slices

#: Digits, lower-case letters and all bytes above ASCII.
LETTERS = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
#: Benchmark text that is broadcast at once; a larger benchmark is taken in blocks of about this size.
BLOCK_BYTES = 16 << 20
#: Windows that are compared at once.
PAIRS = 1 << 16

REPORT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def winnow(grams: np.ndarray, row: np.ndarray, run: int) -> np.ndarray:
    """Positions of the k-grams that are, in some run of ``run`` k-grams of one row, the rightmost of the smallest."""
    n = len(grams) - run + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least = grams[:n].copy()
    for i in range(1, run):
        np.minimum(least, grams[i : n + i], out=least)
    open_ = row[:n] == row[run - 1 :]
    chosen = np.zeros(len(grams), bool)
    for i in reversed(range(run)):
        here = open_ & (grams[i : n + i] == least)
        chosen[i : n + i] |= here
        open_ &= ~here
    return np.flatnonzero(chosen)


def same_words(a: Words, at: np.ndarray, b: Words, bt: np.ndarray, n: int) -> np.ndarray:
    """Whether the ``n`` words of ``a`` from each of ``at`` on are those of ``b`` from ``bt`` on, byte by byte; each pair of words is compared once."""
    out = np.ones(len(at), bool)
    for low in range(0, len(at), PAIRS):
        mine = (at[low : low + PAIRS, None] + np.arange(n)).ravel()
        theirs = (bt[low : low + PAIRS, None] + np.arange(n)).ravel()
        pairs, back = np.unique(mine << 32 | theirs, return_inverse=True)
        mine, theirs = pairs >> 32, pairs & 0xFFFFFFFF
        size = a.ends[mine] - a.starts[mine]
        same = size == b.ends[theirs] - b.starts[theirs]
        long = np.flatnonzero(same)
        ends = np.cumsum(size[long])
        step = np.arange(ends[-1] if len(ends) else 0)
        first = np.repeat(ends - size[long], size[long])
        unlike = a.data[np.repeat(a.starts[mine[long]], size[long]) + step - first] != b.data[np.repeat(b.starts[theirs[long]], size[long]) + step - first]
        same[long[np.searchsorted(ends, np.flatnonzero(unlike), side="right")]] = False
        out[low : low + PAIRS] = same[back].reshape(-1, n).all(1)
    return out


class Index:
    """Fingerprints and windows of one block of benchmark items.

    Windows of equal words are one entry with the items that have it, so a hit costs the same however
    often its words are repeated in the document or in the items.
    """

    def __init__(self, ids: list[str], texts: list[str], window: int, k: int) -> None:
        self.window, self.k, self.run = window, k, window - k + 1
        self.ids, self.words = ids, Words(pa.array(texts, pa.string()), LETTERS)
        words = self.words
        self.prints = np.unique(self.select(words)[0])
        self.grams = {}
        if len(inside := self.inside(words, window)):
            self.grams[window] = self.entries(inside, window)
        for n in sorted({int(c) for c in words.count if 0 < c < window}):
            self.grams[n] = self.entries(words.first[np.flatnonzero(words.count == n)], n)

    @staticmethod
    def inside(words: Words, n: int) -> np.ndarray:
        """Words that begin ``n`` words of one row."""
        return np.flatnonzero(words.row[: len(words.row) - n + 1] == words.row[n - 1 :]) if len(words.row) >= n else np.zeros(0, np.int64)

    def entries(self, at: np.ndarray, n: int) -> list[tuple]:
        """Tables of (hash, first position, where its items begin, items): windows of one hash but other words go to a table of their own."""
        tables = []
        hashes = gram_hash(self.words.hash, n)[at]
        while len(at):
            order = np.argsort(hashes, kind="stable")
            hashes, at = hashes[order], at[order]
            key, first, group = np.unique(hashes, return_index=True, return_inverse=True)
            same = same_words(self.words, at, self.words, at[first][group], n)
            owned = np.unique(np.stack((group[same], self.words.row[at[same]]), 1), axis=0)
            tables.append((key, at[first], np.searchsorted(owned[:, 0], np.arange(len(key) + 1)), owned[:, 1]))
            hashes, at = hashes[~same], at[~same]
        return tables

    def select(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        grams = gram_hash(words.hash, self.k)
        row = words.row[: len(grams)]
        inside = row == words.row[self.k - 1 :] if len(grams) else np.zeros(0, bool)
        marked = np.where(inside, row, -1 - np.arange(len(grams)))  # a k-gram across rows is in no run
        at = winnow(grams, marked, self.run)
        return grams[at], at

    def near(self, words: Words) -> np.ndarray:
        """Beginnings of the windows around the fingerprints that the benchmark has too."""
        hashes, at = self.select(words)
        at = at[np.isin(hashes, self.prints)]
        begins = np.zeros(len(words.row), bool)
        for i in range(self.run):
            begins[at[at >= i] - i] = True
        return self.inside(words, self.window)[begins[self.inside(words, self.window)]]

    def report(self, column: pa.Array) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[list[str]]]:
        """For each text: words, hit spans (merged, in words), sorted distinct items."""
        words = Words(column, LETTERS)
        covered = np.zeros(len(words.row) + 1, np.int64)
        owned = [np.zeros((0, 2), np.int64)]
        for n, tables in self.grams.items():
            at = self.near(words) if n == self.window else self.inside(words, n)
            hashes = gram_hash(words.hash, n)[at] if len(at) else np.zeros(0, np.uint64)
            for key, first, begin, items in tables:
                place = np.searchsorted(key, hashes)
                place[place == len(key)] = 0
                hit = np.flatnonzero(key[place] == hashes)
                hit = hit[same_words(words, at[hit], self.words, first[place[hit]], n)]
                np.add.at(covered, at[hit], 1)
                np.add.at(covered, at[hit] + n, -1)
                pairs = np.unique(np.stack((words.row[at[hit]], place[hit]), 1), axis=0)
                many = begin[pairs[:, 1] + 1] - begin[pairs[:, 1]]
                step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                owned.append(np.unique(np.stack((np.repeat(pairs[:, 0], many), items[np.repeat(begin[pairs[:, 1]], many) + step]), 1), axis=0))
        hit = np.cumsum(covered)[:-1] > 0
        edge = np.ones(len(hit), bool)
        edge[1:] = words.row[1:] != words.row[:-1]
        starts = np.flatnonzero(hit & (edge | ~np.append(False, hit[:-1])))
        edge = np.append(edge[1:], True)
        ends = np.flatnonzero(hit & (edge | ~np.append(hit[1:], False))) + 1
        spans: list[list[tuple[int, int]]] = [[] for _ in range(len(column))]
        for s, e, row in zip(starts.tolist(), ends.tolist(), words.row[starts].tolist()):
            low = int(words.first[row])
            spans[row].append((s - low, e - low))
        found: list[set[str]] = [set() for _ in range(len(column))]
        for row, item in np.concatenate(owned).tolist():
            found[row].add(self.ids[item])
        return words.count, spans, [sorted(x) for x in found]


def blocks(benchmark: DataFrame, item_id: str, text: str, window: int, k: int) -> Iterator[Index]:
    """Indexes over the benchmark, each of at most about BLOCK_BYTES of text (one longer item is a block)."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).where("i is not null and t is not null").distinct()
    ids, texts, size = [], [], 0
    for i, t in rows.toLocalIterator():
        ids.append(i)
        texts.append(t)
        size += len(t.encode())
        if size >= BLOCK_BYTES:
            yield Index(ids, texts, window, k)
            ids, texts, size = [], [], 0
    yield Index(ids, texts, window, k)


def contamination(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, k: int = 5) -> DataFrame:
    """One row per document: doc_id, n_words, spans (hit word ranges), items (ids, sorted as strings).

    With one benchmark block there is no shuffle. More blocks are scanned one after the other and
    their reports are merged by document and text, so the index in memory stays bounded.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    reports = []
    for index in blocks(benchmark, item_id, item_text, window, k):
        shared = spark.sparkContext.broadcast(index)
        # the digest tells documents apart when blocks are merged
        schema = T.StructType([T.StructField("doc_id", kind), T.StructField("text_sha", T.StringType()), *REPORT.fields])
        reports.append(arrow(narrow, lambda batches, shared=shared: _scan(batches, shared.value), schema))
    if len(reports) == 1:
        return reports[0].drop("text_sha")
    merged = reports[0]
    for r in reports[1:]:
        merged = merged.unionByName(r)
    merged = merged.groupBy("doc_id", "text_sha").agg(
        F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), (F.count("*") / len(reports)).cast("int").alias("copies")
    )
    joined = "aggregate(array_sort(array_distinct(spans)), cast(array() as array<struct<start:int,end:int>>), (a, s) -> if(size(a) > 0 and s.start <= try_element_at(a, -1).end, concat(slice(a, 1, size(a) - 1), array(struct(try_element_at(a, -1).start as start, greatest(try_element_at(a, -1).end, s.end) as end))), concat(a, array(s))))"
    return merged.withColumn("spans", F.expr(joined)).select("doc_id", "n_words", "spans", "items", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")


def _scan(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        words, spans, items = index.report(batch.column("text"))
        sha = [hashlib.sha256((t or "").encode()).hexdigest() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(sha, pa.string()),
                pa.array(words, pa.int64()),
                pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array(items, pa.list_(pa.string())),
            ],
            ["doc_id", "text_sha", "n_words", "spans", "items"],
        )


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, k: int = 5) -> DataFrame:
    """The documents, all columns kept, that hold no window of the benchmark; no shuffle for any number of blocks.

    What one block leaves is written for the next, so a task holds one index.
    """
    for i, index in enumerate(blocks(benchmark, item_id, item_text, window, k)):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        if i:
            docs = put(docs, "clean")

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, text):
                _, spans, _ = shared.value.report(batch.column(text))
                yield batch.filter(pa.array([not x for x in spans], pa.bool_()))

        docs = arrow(docs, clean, docs.schema)
    return docs


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP1_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT cast(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT doc_id, i, dw.n AS n, item FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM h)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p ON d.doc_id = p.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""
