"""Language identification by multinomial naive Bayes over hashed character n-grams.

N-grams of 1 to 3 characters of lower-cased text (every non-letter is a blank; n-grams of blanks
alone don't count) are hashed into buckets. The log-probability matrix, languages by buckets, is
broadcast; a batch of texts is scored by sparse lookups summed per text in numpy, whole texts.

The model is fitted on a bounded sample: at most ``SAMPLE`` labelled documents of each language,
chosen by hash; the priors are the shares of all of them. One group of the fit holds one language's
sample.

Defined results: a null text or one without a letter is ``und`` with score 0; without any training
row every document is ``und``; a null lang is no training row; a null doc_id is scored, and is never
a training row; repeated rows are scored, and count in training, each; of languages with equal
scores the first by name is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import arrow, mix, slices
from larder.llm.sampling import per_class

SAMPLE, BUCKETS, ORDERS = 1000, 1 << 16, (1, 2, 3)
UND = "und"
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: bucket and text of every n-gram."""
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    letter = letters()[codes]
    codes = np.where(letter, codes, 32).astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), np.fromiter(map(len, lowered), np.int64, len(texts)))
    for n in ORDERS:
        m = len(codes) - n + 1
        if m <= 0:
            continue
        h, seen = np.full(m, n, np.uint64), np.zeros(m, bool)
        for i in range(n):
            h = h * np.uint64(0x100000001B3) + codes[i : m + i]
            seen |= letter[i : m + i]
        seen &= row[:m] == row[n - 1 :]
        yield (mix(h[seen]) & np.uint64(BUCKETS - 1)).astype(np.int64), row[:m][seen]


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray  # languages x buckets
    prior: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and posterior probability of each text."""
        score = np.tile(self.prior, (len(texts), 1))
        known = np.zeros(len(texts), bool)
        for bucket, row in grams(texts):
            if not len(row):
                continue
            starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            at = row[starts]
            known[at] = True
            for i in range(len(self.langs)):
                score[at, i] += np.add.reduceat(self.logp[i][bucket], starts)
        if not self.langs:
            return [UND] * len(texts), np.zeros(len(texts))
        best = score.argmax(1)
        p = 1 / np.exp(score - score.max(1, keepdims=True)).sum(1)
        return [self.langs[b] if k else UND for b, k in zip(best, known)], np.where(known, p, 0.0)


def train(docs: DataFrame, trained_on: Column, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, smooth: float = 0.5) -> Model:
    """Fit on the rows where ``trained_on`` holds."""
    rows = docs.where(trained_on & F.col(text).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(lang).alias("lang"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def count(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in slices(batches, "text"):
            for bucket, _ in grams(batch.column("text").to_pylist()):
                total += np.bincount(bucket, minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([total.astype("<i8").tobytes()], pa.binary())], ["lang", "counts"])

    picked, rows_of = per_class(rows, "lang", sample, F.col("doc_id"), F.col("text"))
    fitted = sorted(tuple(r) for r in picked.groupBy("lang").applyInArrow(count, "lang string, counts binary").collect())  # a row for each language
    counts = np.array([np.frombuffer(c, "<i8") for _, c in fitted], np.float64).reshape(len(fitted), BUCKETS) + smooth
    n = np.array([rows_of[x] for x, _ in fitted], np.float64)
    return Model([x for x, _ in fitted], np.log(counts / counts.sum(1, keepdims=True)), np.log(n / n.sum()))


def predict(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            langs, p = shared.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(p, pa.float64())], ["doc_id", "lang_pred", "score"])

    return arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), run, schema)


def keep_known(docs: DataFrame, model: Model, *, text: str = "text", least: float = 0.5) -> DataFrame:
    """The documents, all columns kept, whose language is known with a posterior of at least ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            langs, p = shared.value.predict(batch.column(text).to_pylist())
            yield batch.filter(pa.array((np.array(langs, object) != UND) & (p >= least)))

    return arrow(docs, run, docs.schema)


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(folds))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, fold("doc_id", 3) != 1)
    return predict(docs, model).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
