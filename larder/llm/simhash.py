"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments. Two fingerprints within the radius agree in some segment up to
a few bits, so the Hamming ball of that many bits round each segment value is enumerated, the
values are looked up in the table of segments, and the complete distance of each match is checked.
Only distinct fingerprints take part: copies share one. The matches are linked to components.

Defined results: a null or empty text has no words and fingerprint zero, linked like any other; a
null doc_id is no candidate for a component's id (null if a component has no other); repeated rows
each keep a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import arrow, mix, put, slices
from larder.llm.graph import components


def shingle_hashes(text: str | None, size: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of ``size`` words, space-joined; of all words where there are fewer; none without words."""
    words = text.encode().lower().split() if text else []  # bytes: ASCII case and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    flat, digest = b" ".join(words), xxhash.xxh64_digest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - size + 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    last = ends[min(size, len(words)) - 1 :].tolist()
    return np.frombuffer(b"".join([digest(flat[s:e], seed) for s, e in zip(starts, last)]), ">u8").astype(np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of the hashes; 0 for no hash."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)]
        ones += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = 4) -> DataFrame:
    """(doc_id, fp): the 64-bit fingerprint as a signed long."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            prints = [signed(fingerprint(shingle_hashes(t, size))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.int64())], ["doc_id", "fp"])

    return arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), run, schema)


def mih_plan(bits: int, segments: int, radius: int) -> list[tuple[int, int, int]]:
    """(shift, width, ball radius) of each segment, so that no pair within ``radius`` is missed.

    With radius = q * segments + a, the first a + 1 segments take q and the others q - 1: were all
    to differ by more, the whole would differ by at least (a + 1)(q + 1) + (segments - a - 1) q > radius.
    """
    q, a = divmod(radius, segments)
    widths = [bits // segments + (i < bits % segments) for i in range(segments)]
    shifts = [sum(widths[:i]) for i in range(segments)]
    return [(s, w, q if i <= a else q - 1) for i, (s, w) in enumerate(zip(shifts, widths)) if i <= a or q > 0]


def ball(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits with up to ``radius`` ones."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def segment(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))


def links(prints: DataFrame, *, radius: int = 4, segments: int = 3) -> DataFrame:
    """Distinct pairs (u < v) of the distinct fingerprints ``prints(fp)`` at most ``radius`` bits apart.

    A key is segment number and value in one long. The table has a row for each segment, the
    queries a row for each mask of the ball; the distance is part of the join condition, so only
    links leave the join.
    """
    plan = mih_plan(64, segments, radius)
    value = [F.lit(i << 56).bitwiseOR(segment(F.col("fp"), s, w)) for i, (s, w, _) in enumerate(plan)]
    table = prints.select(F.explode(F.array(*value)).alias("key"), F.col("fp").alias("v"))

    def probe(i: int, width: int, r: int) -> Column:
        return F.transform(F.array(*map(F.lit, ball(width, r))), lambda m: value[i].bitwiseXOR(m.cast("long")))

    probes = [probe(i, w, r) for i, (_, w, r) in enumerate(plan)]
    query = prints.select(F.explode(F.concat(*probes)).alias("key"), F.col("fp").alias("u"))
    near = (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)
    return query.join(table, (query["key"] == table["key"]) & near).select("u", "v").distinct()


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = 4, radius: int = 4, segments: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): one row per document."""
    prints = put(fingerprints(docs, doc_id=doc_id, text=text, size=size), "prints")
    distinct = put(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    linked = components(links(distinct.select("fp"), radius=radius, segments=segments))
    named = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = put(named, "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return prints.join(named.join(least, "component").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
