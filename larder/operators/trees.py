"""Trees of any depth, as process lists have them: depth and root of each node by pointer doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.sources.folders import kept


def rooted(nodes: DataFrame, node: str = "pid", parent: str = "ppid") -> DataFrame:
    """``nodes`` with ``root`` and ``depth``; both null for nodes on or below a cycle.

    A node whose parent isn't among the nodes, or is null or itself, is a root of depth 0. Each round
    joins every pointer with the pointer of where it leads, so a chain of n nodes takes about log2(n)
    rounds; nodes that know their root take no part any more. Ids are unique.
    """
    ids = nodes.select(F.col(node).alias("_node"), F.col(parent).alias("_parent")).where("_node is not null")
    own = ids.alias("c").join(ids.select(F.col("_node").alias("_known")), (F.col("_parent") == F.col("_known")) & (F.col("_node") != F.col("_parent")), "left")
    first = F.col("_known").isNull()
    at = kept(own.select("_node", F.coalesce("_known", "_node").alias("_at"), F.when(first, F.lit(0)).otherwise(1).cast("long").alias("_steps"), first.alias("_done")), "pointers")
    done, open_ = at.where("_done"), at.where("not _done")
    left = open_.count()
    rounds = max(left, 1).bit_length() + 1
    while left and rounds:
        to = done.unionByName(open_).select(F.col("_node").alias("_at"), F.col("_at").alias("_to"), F.col("_steps").alias("_more"), F.col("_done").alias("_end"))
        stepped = kept(open_.join(to, "_at").select("_node", F.col("_to").alias("_at"), (F.col("_steps") + F.col("_more")).alias("_steps"), F.col("_end").alias("_done")), "pointers")
        done, open_ = done.unionByName(stepped.where("_done")), stepped.where("not _done")
        left, rounds = open_.count(), rounds - 1
    found = done.select(F.col("_node").alias(node), F.col("_at").alias("root"), F.col("_steps").alias("depth"))
    return nodes.join(found, node, "left")


def totals(nodes: DataFrame, size: str, node: str = "pid", parent: str = "ppid") -> DataFrame:
    """(root, depth, nodes, size) of each tree and level."""
    return rooted(nodes, node, parent).where("root is not null").groupBy("root", "depth").agg(F.count("*").alias("nodes"), F.sum(size).alias(size))
