"""A bounded sample of rows per class, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def per_class(rows: DataFrame, label: str, most: int, *key: Column) -> tuple[DataFrame, dict]:
    """At most ``most`` rows of each non-null label, chosen by a hash of ``key``: the same rows at every run. And the number of all rows of each.

    A threshold on the hash, from the counts, leaves about twice as many; ranking then cuts to the
    bound, so no class is gathered whole.
    """
    rows = rows.where(F.col(label).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}  # a row for each class
    if not counts:
        return rows.limit(0), counts
    share = F.create_map(*[F.lit(x) for c, n in counts.items() for x in (c, min(1.0, 2.0 * most / n))])
    h = F.xxhash64(*key)
    picked = rows.withColumn("_h", h).where(F.pmod(F.col("_h"), F.lit(1 << 20)) < share[F.col(label)] * (1 << 20))
    rank = F.row_number().over(W.partitionBy(label).orderBy("_h"))
    return picked.withColumn("_n", rank).where(F.col("_n") <= most).drop("_h", "_n"), counts
