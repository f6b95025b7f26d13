"""Streams that belong to a run: what arrives is appended in rounds, each run goes on where it stopped.

A run has a folder below ``base`` by its id. Rounds of rows are appended to ``<name>/in``; ``advance``
starts the stream over what is new, with the run's checkpoint, and waits until it is worked off. Offsets
and keyed state are in the checkpoint, so a driver that is lost goes on with the next call, and a round
that was half done is done again with the same rows. Parquet sinks show whole batches only.

Keyed state lies in RocksDB; its provider is set on the session when a run is opened.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import url as U
from larder.sources.folders import exists

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Run:
    """The folders and streams of one run id below ``base``."""

    def __init__(self, spark: SparkSession, base: str, run_id: str) -> None:
        self.spark = spark
        key = spark.range(1).select(U.storage_key(F.lit(run_id))).first()[0]
        self.folder = f"{base.rstrip('/')}/{key}"
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)

    def append(self, name: str, rows: DataFrame) -> None:
        """Add a round of rows to what the stream ``name`` reads."""
        rows.write.mode("append").parquet(f"{self.folder}/{name}/in")

    def advance(self, name: str, schema, step: Callable[[DataFrame], DataFrame], mode: str = "append", *, empty_batches: bool = True) -> list[dict]:
        """Run the stream over all rows that it has not read yet. Returns the progress of its batches with rows: number, rows and observed metrics.

        A stream on event time ends with a batch without rows, for what the watermark lets go. One with
        state that goes by the clock would ask for such batches for ever: turn ``empty_batches`` off.
        """
        key = "spark.sql.streaming.noDataMicroBatches.enabled"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, empty_batches)
        rows = self.spark.readStream.schema(schema).parquet(f"{self.folder}/{name}/in")
        out = step(rows).writeStream.format("parquet").outputMode(mode).queryName(name)
        try:
            query = out.option("path", f"{self.folder}/{name}/out").option("checkpointLocation", self.checkpoint(name)).trigger(availableNow=True).start()
        finally:
            self.spark.conf.set(key, before)
        query.awaitTermination()
        return [{"batch": p["batchId"], "rows": p["numInputRows"], **{f"{o}.{k}": v for o, m in p["observedMetrics"].items() for k, v in m.asDict().items()}} for p in query.recentProgress if p["numInputRows"]]

    def checkpoint(self, name: str) -> str:
        return f"{self.folder}/{name}/checkpoint"

    def result(self, name: str, schema) -> DataFrame:
        """All rows that the stream has put out."""
        path = f"{self.folder}/{name}/out"
        return self.spark.read.schema(schema).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def state(self, name: str, variable: str) -> DataFrame:
        """(key, value) of a state variable as of the last batch, read from the checkpoint."""
        return self.spark.read.format("statestore").option("stateVarName", variable).load(self.checkpoint(name)).select("key", "value")
