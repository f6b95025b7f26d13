"""Stored tables that are updated in part: rows by key, in partitions by a hash of the key.

An upsert reads and rewrites the partitions that its rows fall in and leaves the files of all others as
they are. The new rows, then the merged partitions, are written beside the table first; only then does a
dynamic partition overwrite put these in place, so an upsert that was cut off is simply done again, and
doing it twice changes nothing. One writer at a time.

A key is in one row (that is what a merge is by), and its row is found in one partition.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.store import upsert
from larder.sources.folders import exists, kept


class Table:
    """Rows of ``schema`` (a DDL string) below ``path``, by ``key``, in ``parts`` partitions.

    ``order`` tells the later of two rows of a key; fields in ``keep_old`` keep their value where a later
    row has none. The number of partitions is fixed when the table is first written: choose it so that
    one is some hundred MB.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, order: str, *, parts: int = 256, keep_old: tuple[str, ...] = ()) -> None:
        self.spark, self.path, self.schema, self.key, self.order, self.parts, self.keep_old = spark, path, schema, key, order, parts, keep_old

    def _part(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.parts)).cast("int")

    def _stored(self) -> DataFrame:
        """All rows with their partition, ``part``."""
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], f"{self.schema}, part int")
        return self.spark.read.schema(f"{self.schema}, part int").parquet(self.path)

    def rows(self) -> DataFrame:
        return self._stored().drop("part")

    def row(self, value) -> DataFrame:
        """The row of one key: a read of its partition, with the key pushed down."""
        value = F.lit(value).cast(self.rows().schema[self.key].dataType)
        return self._stored().where((F.col("part") == self._part(value)) & (F.col(self.key) == value)).drop("part")

    def present(self, keys: DataFrame) -> DataFrame:
        """Those of ``keys`` (distinct, with the key column) that the table has; partitions without one of them are pruned at run time."""
        asked = keys.select(self.key).distinct().withColumn("part", self._part(F.col(self.key)))
        return asked.join(self._stored().select(self.key, "part"), [self.key, "part"], "left_semi").select(self.key)

    def upsert(self, new: DataFrame) -> list[int]:
        """Merge rows in; the numbers of the partitions that were rewritten. Rows of a null key aren't stored."""
        fields = [f.name for f in self.spark.createDataFrame([], self.schema).schema]
        fresh = kept(new.select(*fields).where(F.col(self.key).isNotNull()).withColumn("part", self._part(F.col(self.key))), "fresh")
        touched = sorted(r[0] for r in fresh.select("part").distinct().collect())  # at most as many as there are partitions
        if touched:
            old = self._stored().where(F.col("part").isin(touched))
            merged = upsert(old.drop("part"), fresh.drop("part"), self.key, self.order, self.keep_old).select(*fields)
            self._replace(kept(merged.withColumn("part", self._part(F.col(self.key))), "merged"))
        return touched

    def _replace(self, rows: DataFrame) -> None:
        """Put whole partitions in place of those of the same number."""
        rows.hint("rebalance", "part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(self.path)

    def files(self) -> dict[int, list[str]]:
        """The files of each partition."""
        found: dict[int, list[str]] = {}
        for file in self._stored().inputFiles():
            found.setdefault(int(file.rpartition("/part=")[2].partition("/")[0]), []).append(file)
        return {k: sorted(v) for k, v in found.items()}

    def compact(self, numbers: Iterable[int]) -> None:
        """Rewrite partitions with few files in place of many."""
        self._replace(kept(self._stored().where(F.col("part").isin(list(numbers))), "compacted"))
