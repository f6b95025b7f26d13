"""Merkle manifest of a dataset: a root over all rows, a subroot for each group, and a proof for each row.

Rows are sorted by group and key into range partitions, as an RDD that is checkpointed, so that its
partitions stand still. Each tells how many rows of its first and its last group it has; from these
counts, one entry for each partition, the driver works out where in its group each partition begins.
Partitions build all aligned subtrees that they hold whole. The ragged nodes at their edges, for each
level at most one run short of whole at either side, are shuffled by their coordinates (group, level,
index), and the upper levels are finished there, level by level, down again for what stands beside each
ragged node. Each partition then joins its own part of every proof to that of its ragged node.

H is the lower-case hex SHA-256 of its inputs one after the other, digests as hex text. ``FANOUT``
consecutive nodes become their H, the last run of a level may be shorter; a lone leaf is its own root.

Defined results: a null column is ``-`` in a leaf; null groups are one group, the first; rows of a null
key come first in their group; rows of equal keys are ordered by their leaf; an empty table has no
proofs and a null root; extra columns, whatever their names, take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import groupby

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import put, scratch, shared_dir, store

FANOUT = 16
#: Rows of a partition, about: its digests are held in memory.
ROWS = 100_000
_SIDES = T.ArrayType(T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))


def digest(*columns: Column) -> Column:
    """H of columns: each ``-`` if null, else its UTF-8 byte count, a colon and its value."""
    one = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*one), 256)


def h(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, side: F.sha2(F.concat(side["left"], node, side["right"]), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof, level by level, left to right, as one text."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def prove(leaves: DataFrame, *, group: str, key: str, leaf: str, more: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, str | None]:
    """Of ``leaves`` with a digest column ``leaf``: (their group, key, ``more`` and leaf, ``subroot``, ``root`` and ``proof``), (group, subroot) of each group, and the root.

    A proof lists, for each level from the leaf by the subroot to the root, what stands left and right
    of the node in its run, as hex texts. ``key``, then ``leaf``, orders the leaves of a group; the
    subroots, in the order of their groups, are the leaves of one more tree.
    """
    rows, places, above, roots = _climb(leaves, group, key, leaf, more)
    spark = leaves.sparkSession
    subroots = roots.select(F.lit(0).alias("all"), "grp", "node")
    _, _, over, root = _climb(subroots, "all", "grp", "node", (), whole=True)
    root = root.first()  # one row
    root = root and root["node"]
    # the subroots' proofs are joined to those of the ragged nodes, so no row of a hot group is shuffled
    over = over.select(F.col("key").alias("_group"), F.col("proof").alias("_over"))
    above = above.join(over, F.col("grp").eqNullSafe(F.col("_group"))).withColumn("proof", F.concat("proof", "_over")).drop("_group", "_over")
    folder = scratch(spark, "beside")
    above.repartition("part").write.partitionBy("part").parquet(folder)
    proofs = rows.mapPartitionsWithIndex(lambda part, own: _proofs(part, own, places.value, folder))
    schema = leaves.select(group, key, *more, leaf).schema.add("subroot", "string").add("proof", _SIDES)
    found = spark.createDataFrame(proofs, schema, verifySchema=False)
    return found.select(group, key, *more, leaf, "subroot", F.lit(root).cast("string").alias("root"), "proof"), roots.select(F.col("grp").alias(group), F.col("node").alias("subroot")), root


def _climb(leaves: DataFrame, group: str, key: str, leaf: str, more: tuple[str, ...], whole: bool = False) -> tuple:
    """The checkpointed rows, where their partitions begin, the proofs of ragged nodes (``whole``: of all leaves, with their key) up to their group's root, and the roots."""
    spark = leaves.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    columns = [group, key, *more, leaf]
    order = [group, key, leaf, *more]
    narrow = leaves.select(*columns)
    count = narrow.count()
    parts = max(1, -(-count // ROWS), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // 1000)))
    # equal rows can change places: a number parts them where one row is repeated very often
    spread = narrow.withColumn("_n", F.monotonically_increasing_id()).repartitionByRange(parts, *order, "_n").sortWithinPartitions(*order, "_n").drop("_n")
    rows = spread.rdd.map(tuple)
    rows.checkpoint()
    known = rows.mapPartitionsWithIndex(_edges).collect()  # an entry for each partition
    places = spark.sparkContext.broadcast(_places(known))
    ragged = rows.mapPartitionsWithIndex(lambda part, own: _build(part, own, places.value))
    kind = leaves.schema[group].dataType
    node = spark.createDataFrame(ragged, f"part int, grp {kind.simpleString()}, level int, at long, size long, node string", verifySchema=False)
    above, roots = _finish(put(node, "ragged"))
    if whole:
        folder = scratch(spark, "beside")
        above.repartition("part").write.partitionBy("part").parquet(folder)
        proofs = rows.mapPartitionsWithIndex(lambda part, own: _proofs(part, own, places.value, folder))
        above = spark.createDataFrame(proofs, narrow.select(F.col(group), F.col(key).alias("key"), leaf).schema.add("subroot", "string").add("proof", _SIDES), verifySchema=False)
    return rows, places, above, roots


def _edges(part: int, rows: Iterator[tuple]) -> Iterator[tuple]:
    """(partition, first group, its rows, last group, its rows) of a partition with rows."""
    first = last = None
    for value, own in groupby(rows, key=lambda r: r[0]):
        last = value, sum(1 for _ in own)
        first = first or last
    if first:
        yield part, *first, *last


def _places(edges: list[tuple]) -> dict[int, tuple[int, int, int]]:
    """For each partition: rows of its first group in earlier ones, and all rows of its first and of its last group (the others lie within it)."""
    edges = sorted(edges)
    runs: list[list] = []  # of a group that goes on over partitions: [group, rows]
    before, first_run, last_run = {}, {}, {}
    for part, first, n, last, m in edges:
        if not runs or runs[-1][0] != first:
            runs.append([first, 0])
        before[part], first_run[part] = runs[-1][1], len(runs) - 1
        runs[-1][1] += n
        if last != first:
            runs.append([last, m])
        last_run[part] = len(runs) - 1
    return {part: (before[part], runs[first_run[part]][1], runs[last_run[part]][1]) for part in before}


def _trees(part: int, rows: Iterator[tuple], places: dict) -> Iterator[tuple]:
    """(group, its rows here, levels, size) of each group of a partition; levels are (index of the first node, nodes), as far as whole runs go."""
    if part not in places:
        return
    before, size_first, size_last = places[part]
    groups = ((value, list(own)) for value, own in groupby(rows, key=lambda r: r[0]))
    now = next(groups, None)
    first = True
    while now:
        beyond = next(groups, None)
        value, own = now
        start = before if first else 0
        size = size_first if first else size_last if beyond is None else len(own)
        levels, width = [(start, [r[-1] for r in own])], size
        while width > 1:
            low, nodes = levels[-1]
            runs = range(-(-low // FANOUT), (low + len(nodes)) // FANOUT)
            made = [h(nodes[r * FANOUT - low : (r + 1) * FANOUT - low]) for r in runs]
            begin = runs.start
            if low + len(nodes) == width and width % FANOUT and width // FANOUT * FANOUT >= low:
                made.append(h(nodes[width // FANOUT * FANOUT - low :]))  # the last run, shorter
            width = -(-width // FANOUT)
            if not made:
                break
            levels.append((begin, made))
        yield value, own, levels, size
        now, first = beyond, False


def _inside(levels: list, level: int, at: int) -> bool:
    """Whether the run above a node was built here."""
    return level + 1 < len(levels) and levels[level + 1][0] <= at // FANOUT < levels[level + 1][0] + len(levels[level + 1][1])


def _build(part: int, rows: Iterator[tuple], places: dict) -> Iterator[tuple]:
    """(partition, group, level, index, nodes of the level, digest) of each node whose run isn't whole here, and of each root."""
    for value, _, levels, size in _trees(part, rows, places):
        width = size
        for level, (low, nodes) in enumerate(levels):
            for i, node in enumerate(nodes):
                if not _inside(levels, level, low + i):
                    yield part, value, level, low + i, width, node
            width = -(-width // FANOUT)


def _finish(ragged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(part, grp, level, at, subroot, proof) for each ragged node that a partition made, and (grp, node) for each group.

    Upwards, the nodes of a level are grouped by the run that they are in; downwards, each node is
    given the proof of the one above it.
    """
    same = ["grp", "level", "at"]
    coordinate = F.struct(*same)
    levels: list[DataFrame] = []  # nodes of runs that were finished here, by level
    highest = ragged.agg(F.max("level")).first()[0]
    roots = ragged.where("size = 1").select("grp", "level", "at", "node")
    made = None
    level = 0
    while highest is not None:
        own = ragged.where((F.col("level") == level) & (F.col("size") > 1)).select("grp", "level", "at", "size", "node")
        now = own if made is None else own.unionByName(made.where("size > 1"))
        if level > highest and now.isEmpty():
            break
        run = now.groupBy("grp", (F.expr(f"at div {FANOUT}")).alias("above")).agg(F.array_sort(F.collect_list(F.struct("at", "node"))).alias("run"), F.first("size").alias("size"))
        built = run.select("grp", "above", "run", F.sha2(F.array_join("run.node", ""), 256).alias("node"), F.ceil(F.col("size") / FANOUT).cast("long").alias("size"))
        built = put(built, f"level-{level}")
        levels.append(built)
        made = built.select("grp", F.lit(level + 1).alias("level"), F.col("above").alias("at"), "size", "node")
        roots = roots.unionByName(made.where("size = 1").select(*same, "node"))
        level += 1
    roots = put(roots, "roots")
    empty = F.array().cast(_SIDES)
    known = roots.select(*same, F.col("node").alias("subroot"), empty.alias("proof"))
    all_known = known
    for level, built in reversed(list(enumerate(levels))):
        over = known.where(F.col("level") == level + 1).select(F.col("grp").alias("_grp"), F.col("at").alias("_at"), "subroot", F.col("proof").alias("_over"))
        each = built.select("grp", "above", F.expr("transform(run, (x, i) -> struct(x.at as at, array_join(transform(slice(run, 1, i), y -> y.node), '') as left, array_join(transform(slice(run, i + 2, size(run)), y -> y.node), '') as right))").alias("run"))
        each = each.join(over, F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("above") == F.col("_at")))
        below = each.select("grp", F.explode("run").alias("x"), "subroot", "_over")
        below = below.select("grp", F.lit(level).alias("level"), F.col("x.at").alias("at"), "subroot", F.concat(F.array(F.struct("x.left", "x.right")), "_over").alias("proof"))
        below = put(below, f"beside-{level}")
        known = known.where(F.col("level") <= level).unionByName(below)
        all_known = all_known.unionByName(below)
    wanted = ragged.select("part", *(F.col(c).alias(f"_{c}") for c in same))
    found = wanted.join(all_known, F.col("_grp").eqNullSafe(F.col("grp")) & (F.col("_level") == F.col("level")) & (F.col("_at") == F.col("at")))
    return found.select("part", "grp", "level", "at", "subroot", "proof"), roots.select("grp", "node")


def _proofs(part: int, rows: Iterator[tuple], places: dict, folder: str) -> Iterator[tuple]:
    """Each row of a partition with its subroot and proof: up to a ragged node from the trees built here, from there as the upper levels gave it."""
    if part not in places:
        return
    fs, path = store(f"{folder}/part={part}")
    table = pq.read_table(path, filesystem=fs, partitioning=None, columns=["grp", "level", "at", "subroot", "proof"])
    over = {(r["grp"], r["level"], r["at"]): (r["subroot"], [(s["left"], s["right"]) for s in r["proof"]]) for r in table.to_pylist()}
    for value, own, levels, _ in _trees(part, rows, places):
        beside: list[dict[int, tuple]] = [{} for _ in levels]

        def above(level: int, at: int) -> tuple[str, list]:
            """Subroot and proof of a node: looked up if it is ragged, else worked out from the node above and its run, once for each run."""
            if not _inside(levels, level, at):
                return over[value, level, at]
            run = at // FANOUT
            if run not in beside[level]:
                low, nodes = levels[level]
                beside[level][run] = *above(level + 1, run), nodes[max(0, run * FANOUT - low) : (run + 1) * FANOUT - low]
            subroot, rest, nodes = beside[level][run]
            i = at % FANOUT
            return subroot, [("".join(nodes[:i]), "".join(nodes[i + 1 :])), *rest]

        start = levels[0][0]
        for i, row in enumerate(own):
            yield *row, *above(0, start + i)


def manifest(docs: DataFrame, *, group: str = "source", key: str = "doc_id", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """(group, key, leaf, subroot, root, proof) of each row: ``proof`` leads from the leaf by the subroot of its group to the root."""
    leaves = docs.select(F.col(group).cast("string").alias("group"), F.col(key).alias("key"), digest(*(F.col(c) for c in columns)).alias("leaf"))
    return prove(leaves, group="group", key="key", leaf="leaf")[0]


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fields = ["doc_id", "source", "lang", "n_chars"]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, digest(*map(F.col, fields), lower))
    leaves = docs.select(F.col("source").alias("group"), F.col("doc_id").alias("key"), tampered.alias("tampered"), digest(*map(F.col, fields), F.col("text")).alias("leaf"))
    proven = prove(leaves, group="group", key="key", leaf="leaf", more=("tampered",))[0].withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return proven.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
