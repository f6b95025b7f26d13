"""Exact top-k by inner product, by distributed histogram selection.

Queries are taken in blocks of bounded size; a block is broadcast and scored, a part at a time, against all rows.
Every partition adds a histogram of each query's scores over its current range of scores; the sums
locate the bin of the k-th highest score, whose range is the next pass's, until the bin is one
score wide. A last pass keeps scores above the k-th, and of those equal to it the smallest ids;
a partition never sends more than k rows of a query.

Vectors are quantised to integers, so scores are exact: they are computed in doubles while every
partial sum is below 2**53, else in Python integers. A score is a 64-bit integer: one beyond that
range counts, in its rank too, as the nearest one within it.

Defined results: a vector that is null or empty, or holds a null or non-finite component, takes no
part, nor does one with a null id; vectors of different lengths have no score with each other; a
row is no candidate for the query of its own id; a repeated query id is asked once, with the
smallest of its vectors; repeated candidates are candidates each; fewer candidates than k give all;
a component that overflows when scaled counts as the largest double.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larder.llm.common import arrow, put, scratch

#: Queries of a block, which is scored in one pass over the rows: with 64 components, 8 MB to broadcast.
BLOCK = 16384
#: Queries and rows scored at once, and bins of a histogram.
STEP, ROWS, BINS = 2048, 1024, 256
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def quantised(table: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, q): floor(scale * component) of the vectors that take part, as doubles, which hold these integers exactly."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    rows = table.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad)
    scaled = F.transform(F.col(vector), lambda x: F.lit(float(scale)) * x.cast("double"))
    top = F.lit(sys.float_info.max)
    # from 2**53 on a double is an integer, and may be none of Spark's
    q = F.transform(scaled, lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(F.greatest(-top, F.least(top, x))))
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), q.alias("q"))


class Block:
    """Queries of one length."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        self.ids, self.matrix = ids, matrix
        self.largest = float(np.abs(matrix).max()) if matrix.size else 0.0

    def scores(self, ids: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For STEP queries at a time: number of the first, integer scores (queries x rows) and which of them are of a query's own row."""
        bound = self.largest * float(np.abs(rows).max()) * rows.shape[1]
        for low in range(0, len(self.ids), STEP):
            part = self.matrix[low : low + STEP]
            if bound < 2**53:
                score = (part @ rows.T).astype(np.int64)
            elif bound < 2**62:
                score = part.astype(np.int64) @ rows.astype(np.int64).T
            else:
                whole = np.frompyfunc(int, 1, 1)
                score = np.maximum(np.minimum(whole(part) @ whole(rows).T, MOST), LEAST).astype(np.int64)
            yield low, score, self.ids[low : low + STEP, None] == ids[None, :]


def chunks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, integer matrix) of the rows with ``dim`` components, at most ROWS at once."""
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            part = batch.slice(low, ROWS)
            lists = part.column("q")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            own = np.flatnonzero(sizes == dim)
            if len(own):
                taken = lists.take(pa.array(own))
                yield part.column("vec_id").to_numpy(zero_copy_only=False)[own].astype(np.int64), taken.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _histograms(rows: DataFrame, block, low: np.ndarray, width: np.ndarray, k: int, shift: int) -> DataFrame:
    """Per query: counts of the scores in each bin of its range; the count of what lies above it under bin BINS."""
    state = rows.sparkSession.sparkContext.broadcast((low, width))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, (lo, step) = block.value, state.value
        m = BINS + 2
        total = np.zeros((len(b.ids), m), np.int64)
        for ids, matrix in chunks(batches, b.matrix.shape[1]):
            for first, score, own in b.scores(ids, matrix):
                n = len(score)
                at = np.clip(((score >> shift) - lo[first : first + n, None]) // step[first : first + n, None], -1, BINS) + 1  # 0: below the range
                at[own] = 0
                total[first : first + n] += np.bincount((np.arange(n)[:, None] * m + at).ravel(), minlength=n * m).reshape(n, m)
        # a bin below this partition's own k-th score can't hold the k-th of all
        above = np.cumsum(total[:, ::-1], 1)[:, ::-1] - total
        q, at = np.nonzero((total > 0) & (above < k))
        own = at > 0
        q, at = q[own], at[own]
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(at - 1, pa.int32()), pa.array(total[q, at], pa.int64())], ["query", "bin", "n"])

    return arrow(rows, count, "query long, bin int, n long").groupBy("query", "bin").agg(F.sum("n").alias("n"))


def _kth(rows: DataFrame, block, k: int, bound: int) -> np.ndarray:
    """For each query of the block the k-th highest score (the lowest, if there are fewer).

    Scores that may need more than 60 bits are compared without their last ones; the result is then
    a little lower, never higher.
    """
    shift = max(0, bound.bit_length() - 60)
    n, bound = len(block.value.ids), (bound >> shift) + 1
    low, width = np.full(n, -bound, np.int64), np.full(n, -(-(2 * bound + 1) // BINS), np.int64)
    # the highest bin at which k scores are reached, or else the lowest of all
    start = F.struct(F.lit(0).cast("long").alias("above"), F.lit(-1).alias("bin"))
    reached = lambda s, x: (x["bin"] < BINS) & (s["above"] + x["n"] >= k)
    step = lambda s, x: F.when(s["bin"] >= 0, s).otherwise(F.struct((s["above"] + x["n"]).alias("above"), F.when(reached(s, x), x["bin"]).otherwise(-1).alias("bin")))
    lowest = F.when(F.min("bin") < BINS, F.min("bin")).otherwise(-1)
    while True:
        counts = _histograms(rows, block, low, width, k, shift)
        bins = counts.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("bin", "n")), asc=False).alias("bins"), lowest.alias("lowest"))  # at most BINS + 1 of a query
        place = F.aggregate("bins", start, step)["bin"]
        found = np.full(n, -1)
        for q, b in bins.select("query", F.when(place >= 0, place).otherwise(F.col("lowest"))).collect():  # a row for each query of the block
            found[q] = b
        low = np.where(found >= 0, low + found * width, low)
        if (width == 1).all():
            return np.array([max(LEAST, min(MOST, int(x) << shift)) for x in low], np.int64)
        width = -(-width // BINS)


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) over quantised tables ``(vec_id, q)``."""
    spark = candidates.sparkSession
    rows = put(candidates, "vectors")
    largest = F.array_max(F.transform("q", lambda x: F.abs(x)))
    stats = rows.groupBy(F.size("q").alias("dim")).agg(F.max(largest).alias("m"), F.count("*").alias("n"))
    asked = queries.groupBy("vec_id").agg(F.min("q").alias("q"))
    out, schema = scratch(spark, "top"), "query_id long, rank int, vec_id long, score long"
    spark.createDataFrame([], schema).write.parquet(out)
    for dim, m, count in stats.collect():  # a row for each vector length
        same = asked.where(F.size("q") == dim).orderBy("vec_id")
        for ids, matrix in _blocks(same, dim):
            block = spark.sparkContext.broadcast(Block(ids, matrix))
            bound = max(1, min(MOST, int(min(m * block.value.largest * dim, 2.0**63))))
            low = _kth(rows, block, min(k, count), bound)
            kept = _kept(rows, block, low, k)
            order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
            best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            best.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)


def _blocks(queries: DataFrame, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    ids, rows = [], []
    for i, q in queries.toLocalIterator():
        ids.append(i)
        rows.append(q)
        if len(ids) == BLOCK:
            yield np.array(ids, np.int64), np.array(rows)
            ids, rows = [], []
    if ids:
        yield np.array(ids, np.int64), np.array(rows).reshape(-1, dim)


def _kept(rows: DataFrame, block, low: np.ndarray, k: int) -> DataFrame:
    """Of each partition and query at most the k best scores that reach the k-th of all."""
    least = rows.sparkSession.sparkContext.broadcast(low)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block.value
        held = [np.zeros((0, 3), np.int64)]
        for ids, matrix in chunks(batches, b.matrix.shape[1]):
            for first, score, own in b.scores(ids, matrix):
                q, at = np.nonzero((score >= least.value[first : first + len(score), None]) & ~own)
                held.append(np.stack((first + q, ids[at], score[q, at]), 1))
            if sum(map(len, held)) > 4 * k * len(b.ids):
                held = [_best(np.concatenate(held), k)]
        rest = _best(np.concatenate(held), k)
        yield pa.RecordBatch.from_arrays([pa.array(b.ids[rest[:, 0]], pa.int64()), pa.array(rest[:, 1], pa.int64()), pa.array(rest[:, 2], pa.int64())], ["query_id", "vec_id", "score"])

    return arrow(rows, best, "query_id long, vec_id long, score long")


def _best(rows: np.ndarray, k: int) -> np.ndarray:
    rows = rows[np.lexsort((rows[:, 1], -rows[:, 2], rows[:, 0]))]
    first = np.searchsorted(rows[:, 0], rows[:, 0], "left")
    return rows[np.arange(len(rows)) - first < k]


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


OP3_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, cast(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
r AS (SELECT *, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
