"""Toxicity by a linear-chain conditional random field over words.

Labels are per document, so word labels are derived first: in the training sample, a hashed word or
prefix is toxic if it is in so many more toxic documents than its use in clean ones and their lengths
make likely that chance would give less than one such feature; its words in toxic documents are
labelled 1. A two-state chain with hashed features (word, prefixes) is fitted to these labels by its
exact likelihood. Forward and backward messages are scans over 2 x 2 matrices, restarted at every
document, so a batch of documents is one vectorised pass however long they are. A document's score
aggregates the marginals of all its words: the sum of their ``POWER``-th powers, in which many small
ones don't add up to a large one however long the text is, mapped to a probability by a logistic
curve fitted on the same sample.

The sample: at most ``POSITIVE`` toxic and ``NEGATIVE`` clean labelled documents of at most
``LONGEST`` characters, chosen by hash. Scoring takes whole texts of any length.

Defined results: a null or empty text gets the score of a text without toxic words; null labels and
ids are no training rows, repeated labels of a document count as toxic if one is; without training
rows of both kinds every score is the share of toxic ones (0 without any); repeated documents are
scored each.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import SLICE_BYTES, Words, arrow, mix, slices
from larder.llm.langid import fold
from larder.llm.sampling import per_class

POSITIVE, NEGATIVE, LONGEST = 1000, 3000, 20_000
BUCKETS = 1 << 20
#: Digits, lower-case letters and all bytes above ASCII.
LETTERS = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
PREFIXES = (4, 5, 6, 7)
# POWER, RATIO and SEVERAL were chosen by the likelihood in a three-fold cross-validation on labelled rows of sf0.1 that aren't held out.
#: Marginals are joined by the sum of these powers; LEAST, that power of a small marginal, is added to it before its logarithm is taken.
POWER = 6
LEAST = 0.075**POWER
#: A toxic feature is in at least so many times more toxic documents than its share of clean ones makes likely.
RATIO = 4.0
#: Chosen features whose documents another one must share to be added.
SEVERAL = 4
BLOCK = 128


def features(words: Words) -> np.ndarray:
    """Hashed features of each word: the word itself and its prefixes (in bytes)."""
    s, e = words.starts, words.ends
    columns = [words.hash, *(words.span_hash(s, np.minimum(s + n, e)) for n in PREFIXES)]
    return np.stack([mix(c + np.uint64(0x9E3779B97F4A7C15 * (i + 1) % 2**64)) for i, c in enumerate(columns)])


def buckets(feats: np.ndarray) -> np.ndarray:
    """Where the weights of hashed features stand."""
    return (feats & np.uint64(BUCKETS - 1)).astype(np.int32)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of 2 x 2 matrices laid out as 4 rows, scaled to a largest entry of 1."""
    out = np.stack((a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3]))
    return out / out.max(0)


def scan(m: np.ndarray) -> np.ndarray:
    """(2, n): the row vector (1, 1) times the first t of the matrices ``m`` (4, n), for each t, each scaled."""
    n = m.shape[1]
    if n <= BLOCK:
        out, a, b = np.empty((2, n)), 1.0, 1.0
        for t in range(n):
            x, y = a * m[0, t] + b * m[2, t], a * m[1, t] + b * m[3, t]
            a, b = x / (x + y), y / (x + y)
            out[0, t], out[1, t] = a, b
        return out
    blocks = -(-n // BLOCK)
    padded = np.zeros((4, blocks * BLOCK))
    padded[[0, 3], n:] = 1.0
    padded[:, :n] = m
    padded = np.ascontiguousarray(padded.reshape(4, blocks, BLOCK).transpose(0, 2, 1))  # position in the block, block
    for j in range(1, BLOCK):
        padded[:, j] = _times(padded[:, j - 1], padded[:, j])
    carry = np.ones((2, blocks))
    carry[:, 1:] = scan(np.ascontiguousarray(padded[:, -1, :-1]))
    out = np.stack((carry[0] * padded[0] + carry[1] * padded[2], carry[0] * padded[1] + carry[1] * padded[3]))
    out /= out.sum(0)
    return out.transpose(0, 2, 1).reshape(2, -1)[:, :n]


@dataclass
class Crf:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))
    bias: float = 0.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))
    slope: float = 1.0
    offset: float = 0.0
    prior: float | None = None
    power: float = POWER

    def messages(self, feats: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(alpha, beta, matrices) of the words; ``first`` marks the first word of each document."""
        emit = np.exp(np.clip(self.weights[feats].sum(0) + self.bias, -30, 30))
        t = np.exp(self.trans)
        m = np.stack([np.where(first, np.exp(self.start[j]), t[i, j]) * (emit if j else 1.0) for i in (0, 1) for j in (0, 1)])
        alpha = scan(m)
        back = np.ones_like(m)  # a restart: beta is 1 at the last word of a document
        inner = ~first[1:]
        back[:, :-1][:, inner] = m[[0, 2, 1, 3], 1:][:, inner]
        return alpha, scan(back[:, ::-1])[:, ::-1], m

    @staticmethod
    def marginal(alpha: np.ndarray, beta: np.ndarray) -> np.ndarray:
        one = alpha[1] * beta[1]
        return one / (one + alpha[0] * beta[0])

    def evidence(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(marginal of each word, joined marginals of each text)."""
        n = len(words.count)
        if not len(words.starts):
            return np.zeros(0), np.zeros(n)
        first = np.concatenate(([True], words.row[1:] != words.row[:-1]))
        alpha, beta, _ = self.messages(buckets(features(words)), first)
        p = self.marginal(alpha, beta)
        return p, np.bincount(words.row, p**self.power, minlength=n)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(evidence), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log(evidence + LEAST) + self.offset, -30, 30)))


@dataclass
class Part:
    """Some documents of the training sample, word by word."""

    feats: np.ndarray
    first: np.ndarray
    doc: np.ndarray  # number of the document in the sample
    y: np.ndarray | None = None


def parts_of(texts: list[str]) -> Iterator[Part]:
    """The sample in parts of about a slice of text, so that no array spans all of it."""
    size = np.cumsum([len(t.encode()) for t in texts])
    for part in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(size // SLICE_BYTES)) + 1):
        words = Words(pa.array([texts[i] for i in part], pa.string()), LETTERS)
        if len(words.starts):
            yield Part(features(words), np.concatenate(([True], words.row[1:] != words.row[:-1])), part[words.row])


def toxic_features(parts: list[Part], toxic: np.ndarray, ratio: float = RATIO, together: int = SEVERAL) -> np.ndarray:
    """Hashes of the words and prefixes that are toxic themselves.

    Features are chosen one by one, by the toxic documents that no feature chosen before explains:
    so what copies of one toxic document share by chance is not taken for toxic itself. Then those
    are added that stand in documents explained by several of the chosen ones.
    """
    pairs = []
    for part in parts:
        # each feature of a document once, with its number of words: sorted by document, then by hash
        flat, doc = part.feats.ravel(), np.tile(part.doc, len(part.feats))
        order = np.lexsort((flat, doc))
        flat, doc = flat[order], doc[order]
        once = np.flatnonzero(np.concatenate(([True], (flat[1:] != flat[:-1]) | (doc[1:] != doc[:-1]))))
        pairs.append((flat[once], doc[once].astype(np.int32), np.diff(np.append(once, len(flat)))))
    length = sum(np.bincount(p.doc, minlength=len(toxic)) for p in parts)
    # only what is in some toxic document can be chosen
    names = np.unique(np.concatenate([f[toxic[d]] for f, d, _ in pairs]))
    at_, docs_, uses_ = [], [], []
    while pairs:
        flat, doc, uses = pairs.pop(0)
        at = np.minimum(np.searchsorted(names, flat), len(names) - 1).astype(np.int32)
        known = names[at] == flat
        at_.append(at[known])
        docs_.append(doc[known])
        uses_.append(uses[known])
    name, doc, uses = np.concatenate(at_), np.concatenate(docs_), np.concatenate(uses_)
    mine, n = toxic[doc], len(names)
    # toxic documents that a feature of this use would be in by chance, by words and by documents
    rate = (np.bincount(name[~mine], uses[~mine], minlength=n) + 0.5) / max(1, length[~toxic].sum())
    sizes, many = np.unique(np.exp2(np.round(2 * np.log2(np.maximum(length[toxic], 1))) / 2), return_counts=True)
    by_words = sum(c * -np.expm1(-rate * x) for x, c in zip(sizes, many))
    by_docs = (np.bincount(name[~mine], minlength=n) + 0.5) * (toxic.sum() / (~toxic).sum())
    chance = np.maximum(by_words, by_docs)
    name, doc = name[mine], doc[mine]

    def more(yes: np.ndarray, chance: np.ndarray) -> np.ndarray:
        """How much more there is than chance gives to one feature of all (Chernoff's bound), or a negative number."""
        gain = yes * np.log(np.maximum(yes, 1) / chance) - (yes - chance) - np.log(n)
        return np.where((yes >= 3) & (yes >= ratio * chance), gain, -1)

    marked = more(np.bincount(name, minlength=n), chance) > 0
    some = marked[name]
    name, doc = name[some], doc[some]
    chosen, by = np.zeros(n, bool), np.full(len(toxic), -1)
    while (by[toxic] < 0).any():
        open_ = by[doc] < 0
        gain = more(np.bincount(name[open_], minlength=n), chance * (by[toxic] < 0).mean())
        best = int(gain.argmax())
        if gain[best] <= 0:
            break
        by[doc[(name == best) & open_]] = chosen.sum()
        chosen[best] = True
    k = int(chosen.sum())
    several = np.unique((name.astype(np.int64) * k + by[doc])[by[doc] >= 0]) // max(k, 1)
    chosen |= marked & (np.bincount(several, minlength=n) >= min(together, max(k, 1)))
    return names[chosen]


def gradient(model: Crf, part: Part) -> tuple[np.ndarray, float, np.ndarray]:
    """Of the log-likelihood of a part's word labels: by weight, bias and transition."""
    alpha, beta, m = model.messages(part.feats, part.first)
    error = part.y - model.marginal(alpha, beta)
    grad = np.zeros(BUCKETS)
    for f in part.feats:
        grad += np.bincount(f, error, minlength=BUCKETS)
    where = np.flatnonzero(~part.first)
    joint = np.stack([alpha[i, where - 1] * m[2 * i + j, where] * beta[j, where] for i in (0, 1) for j in (0, 1)])
    seen = np.bincount((2 * part.y[:-1] + part.y[1:])[~part.first[1:]], minlength=4)
    return grad, float(error.sum()), (seen - (joint / joint.sum(0)).sum(1)).reshape(2, 2)


def fit(texts: list[str], toxic: np.ndarray, rounds: int = 25, rate: float = 0.5, decay: float = 1e-4, *, power: float = POWER, ratio: float = RATIO, several: int = SEVERAL) -> Crf:
    """Gradient ascent (AdaGrad) on the likelihood of the word labels, then the logistic curve."""
    model = Crf()
    model.power = power
    if not len(toxic) or toxic.all() or not toxic.any():
        model.prior = float(toxic.mean()) if len(toxic) else 0.0
        return model
    unlike = sorted({t: i for i, t in enumerate(texts)}.values())  # a copy tells nothing new
    texts, toxic = [texts[i] for i in unlike], toxic[unlike]
    parts = list(parts_of(texts))
    if not parts or toxic.all() or not toxic.any():
        model.prior = float(toxic.mean())
        return model
    marks = toxic_features(parts, toxic, ratio, several)
    for part in parts:
        part.y = np.isin(part.feats, marks).any(0) & toxic[part.doc]
        part.feats = buckets(part.feats)
    n = sum(len(p.y) for p in parts)
    if not any(p.y.any() for p in parts):
        model.prior = float(toxic.mean())
        return model
    pair = sum(np.bincount((2 * p.y[:-1] + p.y[1:])[~p.first[1:]], minlength=4) for p in parts).reshape(2, 2) + 1.0
    model.trans = np.log(pair / pair.sum(1, keepdims=True))
    head = sum(np.bincount(p.y[p.first].astype(int), minlength=2) for p in parts) + 1.0
    model.start = np.log(head / head.sum())
    square, sb, st = np.full(BUCKETS, 1e-8, np.float32), 1e-8, np.full((2, 2), 1e-8)
    for _ in range(rounds):
        grad, g, gt = (sum(x) for x in zip(*(gradient(model, part) for part in parts)))
        grad -= decay * n * model.weights / BUCKETS
        square += (grad**2).astype(np.float32)
        model.weights += (rate * grad / np.sqrt(square)).astype(np.float32)
        sb += g * g
        model.bias += rate * g / np.sqrt(sb)
        st += gt**2
        model.trans += 0.1 * rate * gt / np.sqrt(st)
    evidence = np.zeros(len(toxic))
    for part in parts:
        alpha, beta, _ = model.messages(part.feats, part.first)
        evidence += np.bincount(part.doc, model.marginal(alpha, beta) ** power, minlength=len(toxic))
    model.slope, model.offset = _logistic(np.log(evidence + LEAST), toxic.astype(float))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """One-variable logistic regression by Newton steps; the slope is kept positive."""
    b, design = np.array([1.0, -x.mean()]), np.stack((x, np.ones_like(x)), 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ b, -30, 30)))
        g = design.T @ (y - p) - ridge * b
        h = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(h, g)
        b = b + step * min(1.0, 1.0 / max(1e-9, np.abs(step).max()))
    return max(float(b[0]), 1e-3), float(b[1])


def train(docs: DataFrame, labels: DataFrame, trained_on: Column, *, positive: int = POSITIVE, negative: int = NEGATIVE) -> Crf:
    """Fit on labelled documents of at most LONGEST characters where ``trained_on`` (on ``doc_id``) holds; one task holds the bounded sample."""
    short = docs.where(F.char_length("text") <= LONGEST)
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic")).where(trained_on).join(short.select("doc_id"), "doc_id", "left_semi")
    picked = per_class(rows.where("toxic"), "toxic", positive, F.col("doc_id"))[0].unionByName(per_class(rows.where("not toxic"), "toxic", negative, F.col("doc_id"))[0])
    # at most positive + negative ids are broadcast
    texts = short.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "text", "toxic").dropDuplicates(["doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["doc_id"], r["text"], r["toxic"]) for b in batches for r in b.to_pylist())
        model = fit([r[1] for r in rows], np.array([r[2] for r in rows], bool))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    fitted = arrow(texts.repartition(1), run, "model binary").first()
    return pickle.loads(fitted[0]) if fitted else fit([], np.zeros(0, bool))


def predict(docs: DataFrame, model: Crf, *, doc_id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """(doc_id, score, spans): spans are code-point ranges of words with a marginal of at least ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("score", T.DoubleType()), T.StructField("spans", span)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"), LETTERS)
            p, evidence = shared.value.evidence(words)
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            hits = np.flatnonzero(p >= least)
            if len(hits):
                points = np.concatenate(([0], np.cumsum((words.data & 0xC0) != 0x80)))  # code points before each byte
                base = points[words.offsets]
                for i in hits:
                    r = words.row[i]
                    spans[r].append({"start": int(points[words.starts[i]] - base[r]), "end": int(points[words.ends[i]] - base[r])})
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shared.value.score(evidence), pa.float64()), pa.array(spans, kind)], ["doc_id", "score", "spans"])

    return arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), run, schema)


def keep_clean(docs: DataFrame, model: Crf, *, text: str = "text", least: float = 0.5) -> DataFrame:
    """The documents, all columns kept, with a score under ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            score = shared.value.score(shared.value.evidence(Words(batch.column(text), LETTERS))[1])
            yield batch.filter(pa.array(score < least))

    return arrow(docs, run, docs.schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), fold("doc_id", 5) != 0)
    return predict(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
