"""Shared pieces: scratch tables on storage that all executors see, and Arrow batch helpers."""

from __future__ import annotations

import atexit
import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Bytes of an Arrow batch between the JVM and Python: rows of long texts would else make batches of gigabytes.
BATCH_BYTES = 4 << 20
#: Text bytes that one vectorised step works on; a longer single text is taken alone.
SLICE_BYTES = 2 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only where that is unset, and on one machine, a folder of our own (tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = f"file://{tempfile.mkdtemp(prefix='larder-')}"
    spark.conf.set("spark.checkpoint.dir", own)
    atexit.register(_delete, spark, own)
    return own


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the JVM may be gone at exit
        pass


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver ends."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/larder-{name}-{uuid.uuid4().hex}")
    path = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target).toString()
    atexit.register(_delete, spark, path)
    return path


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI and the path in it, for files that are not Spark tables."""
    return pafs.FileSystem.from_uri(uri if uri.startswith("file:///") else uri.replace("file:/", "file:///", 1))


@contextmanager
def whole_file(uri: str, attempt: int) -> Iterator[pa.NativeFile]:
    """A new file that gets its name only once it is complete, so repeated and lost attempts do no harm."""
    fs, path = store(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(f"{path}.{attempt}.tmp") as out:
        yield out
    fs.move(f"{path}.{attempt}.tmp", path)


def map_file(uri: str, dtype: str) -> np.ndarray:
    """A flat file as an array: memory-mapped where it is a local path, else read."""
    fs, path = store(uri)
    if not fs.get_file_info(path).size:
        return np.zeros(0, dtype)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def arrow(df: DataFrame, step: Callable, schema) -> DataFrame:
    """``mapInArrow`` with batches of bounded bytes. The bound is a setting of the session; a smaller one stays."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = conf.get(key)
    plain = int(now) if re.fullmatch(r"-?\d+", now) else df.sparkSession.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now)
    if not 0 < plain <= BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        trim()

    return df.mapInArrow(tidy, schema)


def trim() -> None:
    """Give freed memory back to the system: a Python worker lives on between tasks, beside its executor's JVM."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def put(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there and any executor can go."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of results that nothing refers to any more; it does so when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def slices(batches: Iterable[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most`` bytes of text; rows are never dropped or cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, before + most, side="right")))
            yield batch.slice(start, end - start)
            start = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, one after the other, and the offsets of the rows; a null is an empty text."""
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return flat, offsets - offsets[0]


class SpanHash:
    """64-bit hashes of spans of one byte array: polynomials, so a span costs the same however long it is.

    They aren't strong: whoever takes spans of one hash for equal compares their bytes too.
    """

    _powers: tuple[np.ndarray, np.ndarray] | None = None
    _base = np.uint64(0x9E3779B97F4A7C15)
    _table = np.random.default_rng(7).integers(1, 2**64, 256, dtype=np.uint64)

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = self.powers(len(data) + 1)
        self.sum = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self._table[data] * up[: len(data)], out=self.sum[1:])

    @classmethod
    def powers(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of the base and of its inverse modulo 2**64."""
        if cls._powers is None or len(cls._powers[0]) < n:
            n = max(n, 1 << 16)
            inverse = np.uint64(pow(int(cls._base), -1, 1 << 64))
            cls._powers = tuple(np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)))) for b in (cls._base, inverse))
        return cls._powers

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of the bytes of each span, the same wherever the span stands."""
        return mix((self.sum[ends] - self.sum[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


class Words:
    """Words of a column of texts as arrays: byte start and end, 64-bit hash, owning row.

    ``letters`` marks the bytes (after ASCII lower-casing) that are part of a word.
    """

    LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

    def __init__(self, column: pa.Array, letters: np.ndarray) -> None:
        flat, self.offsets = text_bytes(column)
        self.data = self.LOWER[flat]
        inside = letters[self.data]
        full = self.offsets[:-1] < self.offsets[1:]
        before = np.zeros(len(inside), bool)
        before[1:] = inside[:-1]
        before[self.offsets[:-1][full]] = False
        after = np.zeros(len(inside), bool)
        after[:-1] = inside[1:]
        after[self.offsets[1:][full] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.row = np.searchsorted(self.offsets, self.starts, side="right") - 1
        self.count = np.bincount(self.row, minlength=len(column)).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.count)))
        self.spans = SpanHash(self.data)
        self.hash = self.span_hash(self.starts, self.ends)

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.spans.of(starts, ends)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive word hashes, one for each position that has n words left."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - n + 1 + i]
    return mix(total)


