"""One document of each group of near copies: SimHash by multi-index hashing for word-shingle similarity.

Two documents whose sets of five-word shingles have a Jaccard similarity of ``similarity`` differ in
each fingerprint bit with a chance that depends on the sizes of the sets; it is computed exactly and
the worst one is planned for. The fingerprint is cut into segments; a Hamming ball of one bit round
each segment value is enumerated and looked up. The segments are as wide as the number of documents
asks for, so that look-ups stay short, and as many as it takes to miss a pair at the threshold with a
chance of at most ``miss``; documents of few shingles, whose bits differ more often, have more
segments. Matches whose distance is too large are dropped, with a chance of at most ``CUT`` to drop a
pair at the threshold in each of the two cuts, however many bits there are; the rest is verified on
the shingle sets themselves.

Verification goes in rounds. A linear one tries each document of a crowded segment value with the
one in the middle of it. Then the look-ups list the pairs of different components, once: two
documents of crowded values are listed in their first common segment only, and only if they are near
by a fingerprint of ``WIDE`` words and, where both are altered copies of one text, similar enough by
what sets each apart from that text, which the look-up carries: for any set H, the shingles that only
one of A and B has are those that only one of their differences from H has. So altered copies that
aren't similar enough to each other aren't listed in pairs, near the threshold or not.
Every document tries its smallest open partner, then its largest,
then the rest; verified pairs are joined to components, and pairs within a component need no check.
So a group of n copies costs about n checks.

Defined results: exact copies (equal words after ASCII lower-casing, null and empty texts among
them) are a group; rows with a null doc_id are kept; repeated rows of an id and text leave one;
rows of one id with different texts are linked by each of them and kept or dropped together.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import arrow, mix, put, release, slices
from larder.llm.graph import components
from larder.llm.simhash import ball, fingerprint, segment, shingle_hashes, signed

#: Ids that are broadcast at most (about 8 bytes each); beyond it the join is left to a shuffle.
BROADCAST_IDS = 1_000_000
#: A segment value is crowded if it has over so many times the mean number of documents.
CROWD = 2.5
#: Segments that are looked up in one job.
AT_ONCE = 2
#: Pairs whose smaller set has at most so many shingles are planned and cut by themselves.
SHORT = 13
#: Set sizes up to which the chance of a differing bit is counted out; beyond, it is the angle's but for what sizes just below add.
COUNTED = 64
#: Chance of a cut by distance to drop a pair at the threshold.
CUT = 1e-4
#: Words that are compared at least, those of them that look-ups carry, and words of documents of crowded values.
WORDS, CARRIED, WIDE = 4, 2, 32
#: Documents that meet at one copy of the text that their sets are compared with.
SALT = 64
#: Documents of a segment value that a width is chosen for, as a power of 2: wider segments have shorter lists, but need more of them.
SPREAD = 7


def _halves(n: int) -> np.ndarray:
    """Chances of 0 to n bits of n that are set."""
    return np.array([math.comb(n, i) / 2**n for i in range(n + 1)])


def differing(left: int, right: int, both: int) -> float:
    """Exact chance that a fingerprint bit of two sets of so many shingles, ``both`` of them in common, differs."""

    def set_(n: int) -> np.ndarray:
        # chance that the bit is set, by the number of common shingles that have it
        over = np.append(np.cumsum(_halves(n - both)[::-1])[::-1], 0)
        return over[np.clip(n // 2 + 1 - np.arange(both + 1), 0, n - both + 1)]

    a, b = set_(left), set_(right)
    return float(_halves(both) @ (a * (1 - b) + b * (1 - a)))


@cache
def bit_difference(similarity: float, least: int = 1) -> float:
    """The largest chance that a fingerprint bit differs, of pairs at the threshold whose sets have at least ``least`` shingles.

    Large sets: the angle between two sets of one size, over pi.
    """
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    for u in range(least, COUNTED + 1):
        for v in range(u, math.floor(u / similarity + 1e-9) + 1):
            # odd and even sizes differ, so the smallest intersection isn't always the worst
            both = math.ceil(similarity * (u + v) / (1 + similarity) - 1e-9)
            p = max([p, *(differing(u, v, m) for m in range(both, min(u, both + 2) + 1))])
    return p


def plan(documents: int, similarity: float, miss: float, least: int = 1, radius: int = 1) -> tuple[int, int, int]:
    """(segment width, segments, 64-bit words) for so many documents and balls of this radius, for pairs whose sets have at least ``least`` shingles."""
    width = min(30, max(10, math.ceil(math.log2(max(2, documents))) - SPREAD))
    p = bit_difference(similarity, least)
    found = sum(math.comb(width, r) * p**r * (1 - p) ** (width - r) for r in range(radius + 1))
    segments = math.ceil(math.log(miss) / math.log(1 - found))
    return width, segments, max(WORDS, math.ceil(segments / (64 // width)))


def wide_fingerprint(hashes: np.ndarray, words: int) -> list[int]:
    """Fingerprint words of a set of shingles, each from its own scrambling of the hashes."""
    hashes = np.unique(hashes)
    return [signed(fingerprint(mix(hashes ^ np.uint64(0x9E3779B97F4A7C15 * (i + 1) % 2**64)))) for i in range(words)]


def _narrow(docs: DataFrame, size: int, words: int, most_: int, shared: int) -> DataFrame:
    """(doc_id, sha, n, fp, apart): a digest of the words, the number of distinct shingles and the fingerprint, of ``words`` words up to ``most_`` shingles, else of ``shared``.

    With a column ``base``, ``apart`` has 32 bits of each shingle that only one of the text and its base
    has; null if those are over half as many as the text's.
    """
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("sha", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("fp", T.ArrayType(T.LongType())), T.StructField("apart", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, np.zeros(0, np.uint64)
        for batch in slices(batches, "text"):
            sha, n, fp, apart = [], [], [], []
            for t, base in zip(batch.column("text").to_pylist(), batch.column("base").to_pylist()):
                sha.append(hashlib.sha256(b" ".join((t or "").encode().lower().split())).hexdigest()[:32])
                hashes = np.unique(shingle_hashes(t, size))
                n.append(len(hashes))
                fp.append(wide_fingerprint(hashes, words if len(hashes) <= most_ else shared))
                if base is not None and base != last:
                    last, known = base, np.unique(shingle_hashes(base, size))
                odd = np.setxor1d(hashes, known, assume_unique=True) if base is not None else None
                apart.append(None if odd is None or 2 * len(odd) > len(hashes) else np.unique(odd.astype(np.uint32).view(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sha), pa.array(n, pa.int32()), pa.array(fp, pa.list_(pa.int64())), pa.array(apart, pa.list_(pa.int32()))], ["doc_id", "sha", "n", "fp", "apart"])

    base = F.col("base") if "base" in docs.columns else F.lit(None).cast("string").alias("base")
    return arrow(docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text", base), run, schema)


@cache
def most(bits: int, p: float) -> int:
    """The least distance that a pair whose bits differ with chance ``p`` exceeds with a chance of at most ``CUT``."""
    left = 1.0
    for k in range(bits + 1):
        left -= math.exp(math.lgamma(bits + 1) - math.lgamma(k + 1) - math.lgamma(bits - k + 1) + k * math.log(p) + (bits - k) * math.log1p(-p))
        if left <= CUT:
            return k
    return bits


def near(apart: Column, n: Column, bits: int, similarity: float) -> Column:
    """Whether a distance of so many bits is small enough for a pair whose smaller set has ``n`` shingles."""
    short, long_ = (most(bits, bit_difference(similarity, least)) for least in (1, SHORT + 1))
    return apart <= F.when(n <= SHORT, short).otherwise(long_)


def distance(left: str, right: str, words: int) -> Column:
    """Differing bits of the first words of two fingerprints."""
    return reduce(Column.__add__, (F.bit_count(F.col(left)[i].bitwiseXOR(F.col(right)[i])) for i in range(words)))


def alike(similarity: float) -> Column:
    """Whether a pair is similar enough by its differences from one text; true if they aren't known.

    A shingle that shares its 32 bits with another may be left out, so what is expected of that and more is allowed for.
    """
    both = F.size("xa") + F.size("xb")
    odd = both - 2 * F.size(F.array_intersect("xa", "xb"))
    enough = odd <= (F.col("na") + F.col("nb")) * (1 - similarity) / (1 + similarity) + both / 500 + 1e-9
    return F.when((F.col("ra") == F.col("rb")) & F.col("xa").isNotNull() & F.col("xb").isNotNull(), enough).otherwise(True)


def values(width: int, chosen: Iterable[int]) -> Column:
    """The keys of a fingerprint: number and value of each chosen segment in one long."""
    each = 64 // width
    return F.array(*(F.lit(i << 32).bitwiseOR(segment(F.col("fp")[i // each], i % each * width, width)) for i in chosen))


def first_common(left: str, right: str, width: int, segments: int, radius: int) -> Column:
    """Number of the first segment in which two fingerprints differ in ``radius`` bits at most."""
    each = 64 // width
    part = [segment(F.col(left)[i // each].bitwiseXOR(F.col(right)[i // each]), i % each * width, width) for i in range(segments)]
    return F.coalesce(*(F.when(F.bit_count(x) <= radius, F.lit(i)) for i, x in enumerate(part)))


def candidates(prints: DataFrame, width: int, segments: int, shared: int, longest: int, similarity: float, *, radius: int = 1, wide: bool = False) -> DataFrame:
    """Pairs (a < b) of ``prints(id, n, fp, group, crowded)`` that share a segment up to ``radius`` bits, whose distance is small and whose groups differ.

    Segments from ``shared`` on are those of documents of at most ``longest`` shingles. A few segments are
    looked up at a time: shuffle files of earlier ones can go before the next. ``wide`` takes crowded
    documents with their ``base`` and what sets them ``apart`` from it: all words of their fingerprints
    and these differences are compared, and a pair is listed once. Without it, pairs of two crowded
    documents are left out.
    """
    masks, found = ball(width, radius), []
    at_once = AT_ONCE * (width + 1) // len(masks)
    carried = WIDE if wide else CARRIED
    close = (F.col("a") < F.col("b")) & (F.col("ga") != F.col("gb")) & near(distance("fa", "fb", carried), F.least("na", "nb"), 64 * carried, similarity)
    close &= (F.shiftright("home", 32) == first_common("fa", "fb", width, segments, radius)) & alike(similarity) if wide else ~(F.col("ca") & F.col("cb"))
    more = [("base", "r"), ("apart", "x")] if wide else []
    chosen = [(prints, range(i, min(shared, i + at_once))) for i in range(0, shared, at_once)]
    chosen += [(prints.where(F.col("n") <= longest), range(i, min(segments, i + at_once))) for i in range(shared, segments, at_once)]
    for part, some in chosen:
        keys = values(width, some)
        side = lambda x: (F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.slice("fp", 1, max(carried, -(-segments // (64 // width)) if wide else 0)).alias(f"f{x}"), F.col("group").alias(f"g{x}"), F.col("crowded").alias(f"c{x}"), *(F.col(c).alias(k + x) for c, k in more))
        table = part.select(F.explode(keys).alias("key"), *side("b"))
        query = part.select(F.explode(keys).alias("home"), *side("a"))
        if radius:
            probes = F.transform(F.array(*map(F.lit, masks)), lambda m: F.col("home").bitwiseXOR(m.cast("long")))
            query = query.select("*", F.explode(probes).alias("key"))
        else:
            query = query.withColumn("key", F.col("home"))
        if not wide:
            query = query.drop("home")
        pairs = query.join(table, (query["key"] == table["key"]) & close).select("a", "b").distinct()
        found.append(put(pairs, "near"))
        del table, query, pairs
        release(prints.sparkSession)
    return reduce(DataFrame.unionByName, found).distinct()


def _close(pairs: DataFrame, prints: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs whose distance over ``words`` words is small."""
    left, right = (prints.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.slice("fp", 1, words).alias(f"f{x}")) for x in "ab")
    return pairs.join(left, "a").join(right, "b").where(near(distance("fa", "fb", words), F.least("na", "nb"), 64 * words, similarity)).select("a", "b")


def stars(prints: DataFrame, width: int, segments: int, words: int, similarity: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs of the documents of each crowded segment value with the one in their middle, where groups differ; the ids of all these documents; and (id, h, off), these documents with each such middle and its distance.

    Crowded: more than ``CROWD`` times the mean. The middle is the document nearest to the bitwise
    majority of the fingerprints, so of a text and its altered copies about the least altered one.
    """
    rows = prints.select(F.explode(values(width, range(segments))).alias("key"), "id", "n", F.col("fp")[0].alias("f"), "group")
    least = CROWD * max(1.0, prints.count() / (1 << width))
    crowds = put(rows.groupBy("key").count().where(F.col("count") > least).select("key"), "crowds")
    rows = put(rows.join(crowds, "key"), "rows")
    ones = [F.sum(F.shiftright("f", i).bitwiseAND(F.lit(1))).alias(f"n{i}") for i in range(64)]
    major = [F.when(2 * F.col(f"n{i}") > F.col("n"), F.shiftleft(F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")) for i in range(64)]
    middle = put(rows.groupBy("key").agg(F.count("*").alias("n"), *ones).select("key", reduce(Column.bitwiseOR, major).alias("m")), "middle")
    off = F.bit_count(F.col("f").bitwiseXOR(F.col("m")))
    hubs = rows.join(middle, "key").groupBy("key").agg(F.min(F.struct(off, F.col("id"), F.col("f").alias("fh"), F.col("n").alias("nh"), F.col("group").alias("gh"))).alias("hub"))
    hubs = put(hubs.select("key", F.col("hub.id").alias("h"), "hub.fh", "hub.nh", "hub.gh"), "hubs")
    close = (F.col("group") != F.col("gh")) & near(F.bit_count(F.col("f").bitwiseXOR(F.col("fh"))), F.least("n", "nh"), 64, similarity)
    pairs = rows.join(hubs, "key").where(close).select(F.least("id", "h").alias("a"), F.greatest("id", "h").alias("b")).distinct()
    homes = rows.join(hubs, "key").groupBy("id", "h").agg(F.min(F.bit_count(F.col("f").bitwiseXOR(F.col("fh")))).alias("off"))
    return put(_close(pairs, prints, words, similarity), "stars"), put(rows.select("id").distinct(), "crowded"), put(homes, "homes")


def small(ids: DataFrame) -> DataFrame:
    """A table of ids, broadcast if it is no longer than a counted bound."""
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids


def bases(homes: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """(id, base): the document that a crowded one is compared with. Of the middles of one component the one of most documents stands for all; of several that are near, that of most documents is taken."""
    hubs = homes.groupBy("h").count().join(found.withColumnRenamed("node", "h"), "h", "left").withColumn("family", F.coalesce("component", "h"))
    hubs = put(hubs.select("h", "family", "count"), "families")
    chosen = hubs.groupBy("family").agg(F.max(F.struct("count", "h")).alias("most"))
    chosen = put(hubs.join(chosen, "family").select("h", F.col("most.h").alias("base"), (-F.col("most.count")).alias("order")), "chosen")
    far = F.greatest(F.lit(0), F.col("off") - most(64, bit_difference(similarity)))  # 0 for those that are near
    return put(homes.join(small(chosen), "h").groupBy("id").agg(F.min(F.struct(far, "order", "base")).getField("base").alias("base")), "bases")


def with_base(docs: DataFrame, based: DataFrame) -> DataFrame:
    """(doc_id, text, base): the documents of ``bases`` with the text that each is compared with, which is there once for ``SALT`` of them."""
    each = put(based.groupBy("base").agg(F.ceil(F.count("*") / SALT).cast("int").alias("parts")), "members")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = by_ids(plain, each.select(F.col("base").alias("doc_id")), "left_semi").groupBy("doc_id").agg(F.min("text").alias("base_text"))
    texts = texts.withColumnRenamed("doc_id", "base").join(small(each), "base").select("base", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("base_text"))
    rows = plain.join(small(based.withColumnRenamed("id", "doc_id")), "doc_id").join(small(each), "base")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")).join(texts, ["base", "part"])
    return rows.select("doc_id", "text", F.col("base_text").alias("base"))


def _similar(pairs: DataFrame, docs: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs of ids whose shingle sets are similar enough."""
    ids = put(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "ids")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = put(by_ids(plain, ids, "left_semi").dropDuplicates(["doc_id", "text"]), "texts")
    left, right = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ta"):
            keep, sets = [], {}
            for x, y in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist()):
                for t in (x, y):
                    if t not in sets:
                        sets[t] = np.unique(shingle_hashes(t, size))
                u, v = sets[x], sets[y]
                both = len(np.intersect1d(u, v, assume_unique=True))
                keep.append(both >= similarity * (len(u) + len(v) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return arrow(pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb"), run, "a long, b long").distinct()


def by_ids(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on doc_id with a table of ids: broadcast only up to a counted bound."""
    return docs.join(small(ids), "doc_id", how)


def groups(docs: DataFrame, *, size: int = 5, similarity: float = 0.8, miss: float = 0.003) -> DataFrame:
    """(doc_id, group): the smallest id of each document's group, for documents with a non-null id."""
    many = docs.count()
    width, segments, words = plan(many, similarity, miss)
    _, shared, compared = plan(many, similarity, miss, SHORT + 1)
    longest = math.floor(SHORT / similarity + 1e-9)  # of the partners of short documents
    narrow = put(_narrow(docs.select("doc_id", "text"), size, words, longest, compared).drop("apart"), "narrow")
    reps = put(narrow.groupBy("sha").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("fp").alias("fp")), "reps")
    # an id has a row for each of its texts: any of them may link it
    prints = put(reps.select("id", "n", "fp"), "prints")
    # rows of one sha are linked through their representative, whatever ids they have
    links = put(narrow.join(reps.select("sha", "id"), "sha").where("doc_id <> id").select(F.col("id").alias("u"), F.col("doc_id").alias("v")).distinct(), "copies")
    found = put(components(links), "groups")

    def grow(pairs: DataFrame) -> None:
        nonlocal links, found
        good = _similar(pairs, docs, size, similarity)
        links = put(links.unionByName(good.select(F.col("a").alias("u"), F.col("b").alias("v"))), "links")
        found = put(components(links), "groups")
        release(docs.sparkSession)

    def grouped() -> DataFrame:
        return prints.join(found.withColumnRenamed("node", "id"), "id", "left").select("id", "n", "fp", F.coalesce("component", "id").alias("group"))

    # stars first: they join most of a large group, whose pairs then needn't be listed
    pairs, crowded, homes = stars(grouped(), width, shared, compared, similarity)
    grow(pairs)
    marked = put(grouped().join(crowded.withColumn("crowded", F.lit(True)), "id", "left").fillna(False, "crowded"), "grouped")
    open_ = _close(put(candidates(marked, width, segments, shared, longest, similarity), "near"), prints, compared, similarity).distinct()
    # fingerprints of so many words have segments enough to look up equal values alone, with fewer rows than balls, while segments aren't too wide
    radius = 0 if plan(many, similarity, miss, radius=0)[2] <= WIDE else 1
    _, segments, words = plan(many, similarity, miss, radius=radius)
    _, shared, _ = plan(many, similarity, miss, SHORT + 1, radius)
    based = bases(homes, found, similarity)
    wide = _narrow(with_base(docs, based), size, max(WIDE, words), 0, max(WIDE, words)).dropDuplicates(["doc_id", "sha"]).withColumnRenamed("doc_id", "id")
    wide = put(wide.join(marked.where("crowded").select("id", "group", "crowded").distinct(), "id").join(based, "id").drop("sha"), "wide")
    open_ = put(open_.unionByName(candidates(wide, width, segments, shared, longest, similarity, radius=radius, wide=True)), "pairs")
    low, high = (f("a").over(W.partitionBy("b")) for f in (F.min, F.max))
    turn = F.when(F.col("a") == low, 0).when(F.col("a") == high, 1).otherwise(2)
    turns = put(open_.withColumn("turn", turn), "turns")
    for k in range(3):
        tried = turns.where(F.col("turn") == k)
        for side in "ab":
            tried = tried.join(found.select(F.col("node").alias(side), F.col("component").alias(f"c{side}")), side, "left")
        tried = put(tried.where("ca is null or cb is null or ca <> cb").select("a", "b"), "tried")
        if not tried.isEmpty():
            grow(tried)
    named = narrow.select("doc_id").distinct().join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return named.select("doc_id", F.coalesce("component", "doc_id").alias("group"))


def keep_one(docs: DataFrame, *, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """The documents, all columns kept, without those that are near copies of one with a smaller id."""
    found = put(groups(docs, size=size, similarity=similarity), "found")
    kept = by_ids(docs, found.where("doc_id <> group").select("doc_id"), "left_anti")
    again = put(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    if again.isEmpty():
        return kept
    return by_ids(kept, again, "left_anti").unionByName(by_ids(kept, again, "left_semi").dropDuplicates(["doc_id", "text"]))
