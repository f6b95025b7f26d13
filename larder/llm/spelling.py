"""Spelling variants: words one edit apart, by a forward and a reversed sorted dictionary.

One inserted, deleted or replaced code point leaves a half of a word as it is. For each pair of
lengths (n, n) and (n, n + 1) the words that share their first n // 2 code points make a block of the
forward dictionary, those that share their last n - n // 2 a block of the reversed one, and any two
near words meet in one of the two. Both dictionaries are sorted by range partitions and scanned block
by block. A block of more than ``BLOCK`` words is subdivided before the scan, in rounds: what is free
between the shared front and back is halved again, one edit leaves a half of that as it is, so its words
go to two smaller blocks each. The scan itself subdivides in the same way until few words are left, and
verifies those. A pair belongs to one block only, told by how many code points its words have in common
at the front, so none is found twice.

Defined results: null texts have no runs; a null doc_id is the empty string before the colon; an empty
table gives no words; repeated rows count once each; of extra columns none is read. Ties between near
words go to the smallest in code-point order, which is that of their UTF-8 bytes.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from math import ceil, log, log2

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import arrow, put, slices

#: Words of a block that one scan takes at once; larger blocks are subdivided before.
BLOCK = 4096
#: Words that are compared with one another at once.
FEW = 24
#: Counts held in a task before they are handed on.
HELD = 200_000
#: A text's runs are counted in parts of so many characters.
PART = 1 << 20
_RUN = "A-Za-zÀ-ÿ"
_ROW = ["word", "n", "length", "front", "back", "most"]


def damaged_words(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = 7, every: int = 31) -> DataFrame:
    """(word, n): runs of Latin letters, A-Z in lower case, with how often they occur in all texts.

    A run loses one code point where ``every`` divides the crc32 of ``<doc_id>:<run>``; results of
    under ``least`` code points are left out. Counts are added up in each task first.
    """
    runs = re.compile(f"[{_RUN}]{{{least},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in slices(batches, "text"):
            for doc, content in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if not content:
                    continue
                own: Counter[str] = Counter()
                for part in parts(content):
                    own.update(runs.findall(part.encode().lower().decode()))  # bytes: A-Z only
                for run, n in own.items():
                    h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                    if h % every == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                    if len(run) >= least:
                        total[run] += n
                if len(total) > HELD:
                    yield _counts(total)
                    total = Counter()
        yield _counts(total)

    counted = arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def parts(text: str) -> Iterator[str]:
    """A long text in parts that don't cut a run."""
    low = 0
    edge = re.compile(f"[^{_RUN}]")
    while len(text) - low > PART:
        found = edge.search(text, low + PART)
        high = found.start() if found else len(text)
        yield text[low:high]
        low = high
    yield text[low:]


def _counts(total: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n) of all ordered pairs of distinct words one edit apart, of ``words(word, n)``."""
    sized = words.select("word", "n", F.char_length("word").alias("size")).where("size > 0")
    # as the shorter or equal word of a pair, and as the longer one; length is that of the shorter
    roles = sized.withColumn("length", F.explode(F.array(F.col("size"), F.col("size") - 1))).where("length > 0")
    half = F.expr("length div 2")
    whole = F.lit(1 << 30)
    sides = F.array(F.struct(half.alias("front"), F.lit(0).alias("back"), whole.alias("most")), F.struct(F.lit(0).alias("front"), (F.col("length") - half).alias("back"), half.alias("most")))
    rows = roles.withColumn("s", F.explode(sides)).withColumns({c: F.col(f"s.{c}") for c in ("front", "back", "most")}).select(_ROW)
    small, large = _sizes(put(rows, "blocks"))
    ready = small
    while not large.isEmpty():
        # halve what is free in the larger blocks, once a round
        half = F.expr("(length - front - back) div 2")
        free = F.col("length") - F.col("front") - F.col("back")
        sides = F.array(
            F.struct((F.col("front") + half).alias("front"), F.col("back").alias("back"), F.col("most").alias("most")),
            F.struct(F.col("front").alias("front"), (F.col("back") + free - half).alias("back"), (F.col("front") + half).alias("most")),
        )
        split = large.withColumn("s", F.explode(sides)).withColumns({c: F.col(f"s.{c}") for c in ("front", "back", "most")}).select(_ROW)
        small, large = _sizes(put(split, "blocks"))
        ready = ready.unionByName(small)
    key = _key()
    spread = ready.withColumns(key).repartitionByRange(*key).sortWithinPartitions(*key, "word")
    found = arrow(spread.select("word", "n", *key), _scan, "word string, n long, other string, other_n long")
    return found


def _key() -> dict:
    """What the words of a block have in common. The back stands reversed: blocks at the end lie in the order of the reversed dictionary."""
    shared_back = F.reverse(F.expr("right(word, back)"))
    return {"length": F.col("length"), "front": F.col("front"), "back": F.col("back"), "most": F.col("most"), "prefix": F.expr("left(word, front)"), "suffix": shared_back}


def _sizes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of blocks that a scan takes at once, rows of larger ones). Blocks of one word have no pairs; those without a free place to halve stay as they are."""
    key = _key()
    keyed = rows.withColumns(key)
    counts = keyed.groupBy(*key).agg(F.count("*").alias("_words"))
    large = counts.where((F.col("_words") > BLOCK) & (F.expr("length - front - back") > 1)).drop("_words")
    large = put(large, "large")
    marked = keyed.join(large.withColumn("_large", F.lit(True)), list(key), "left")
    return marked.where("_large is null").select(*rows.columns), marked.where("_large").select(*rows.columns)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of the blocks that lie one after the other in a sorted partition."""
    block, now = [], None
    out: list[tuple] = []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("length", "front", "back", "most", "prefix", "suffix")]
        for word, n, *key in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), *columns):
            if key != now:
                if len(block) > 1:
                    _near(block, *now[:4], out)
                block, now = [], key
                if len(out) > 50_000:
                    yield _pairs(out)
                    out = []
            block.append((word, n))
    if len(block) > 1:
        _near(block, *now[:4], out)
    yield _pairs(out)


def _pairs(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out)) if out else [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.int64()))], ["word", "n", "other", "other_n"])


def _near(block: list[tuple[str, int]], length: int, front: int, back: int, most: int, out: list[tuple]) -> None:
    """Pairs of the block (first ``front`` and last ``back`` code points equal) that have under ``most`` code points in common at the front."""
    free = length - front - back
    if len(block) > FEW and free > 1:
        half = free // 2
        left, right = defaultdict(list), defaultdict(list)
        for row in block:
            left[row[0][front : front + half]].append(row)
            right[row[0][len(row[0]) - back - free + half : len(row[0]) - back]].append(row)
        for part in left.values():
            if len(part) > 1:
                _near(part, length, front + half, back, most, out)
        for part in right.values():
            if len(part) > 1:
                _near(part, length, front, back + free - half, front + half, out)
        return
    short = [r for r in block if len(r[0]) == length]
    long = [r for r in block if len(r[0]) > length]
    for i, (u, n) in enumerate(short):
        for v, m in short[i + 1 :] + long:
            same = edited(u, v, front)
            if 0 <= same < most:
                out += (u, n, v, m), (v, m, u, n)


def edited(u: str, v: str, front: int = 0) -> int:
    """Code points that two distinct words have in common at the front, if one edit makes the second, of the same length or longer by one, of the first; else -1."""
    i, n = front, len(u)
    while i < n and u[i] == v[i]:
        i += 1
    return i if u[i + 1 if len(v) == n else i :] == v[i + 1 :] else -1


def variants(words: DataFrame, *, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``words(word, n)``.

    A word's form is its near word of the largest n, if that is at least ``ratio`` times its own; its
    root is where its forms lead. Counts grow by the ratio from form to form, so following them ends
    after the logarithm of the largest; each round of joins doubles the steps.
    """
    words = put(words.select("word", "n"), "words")
    best = near_pairs(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))).alias("b"))
    strong = -F.col("b.less") >= ratio * F.col("n")
    best = best.select("word", "n_near", F.when(strong, F.col("b.other")).alias("form"), F.when(strong, -F.col("b.less")).alias("form_n"))
    best = put(best, "near")
    steps = best.where("form is not null").select("word", F.col("form").alias("root"))
    largest = words.agg(F.max("n")).first()[0] or 1
    for _ in range(ceil(log2(max(2, log(largest, ratio) + 1)))):
        steps = put(steps.join(steps.select(F.col("word").alias("root"), F.col("root").alias("beyond")), "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "roots")
    out = words.join(best, "word", "left").join(steps, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = damaged_words(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return variants(words.where("n >= 2"))
