"""Incremental ingest: sitemap URLs arrive as files, are checked for freshness and queued once, in micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larder.functions import url as U
from larder.operators.store import stale
from larder.streaming.queue import queued
from larder.streaming.runs import ROCKS


def url_stream(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """A stream of ``(url, seq)`` rows from Parquet files."""
    return spark.readStream.schema("url string, seq long").option("maxFilesPerTrigger", files_per_batch).parquet(path)


def ingest(urls: DataFrame, pages: DataFrame, cutoff, frontier: str, checkpoint: str, *, buckets: int = 1024) -> StreamingQuery:
    """Append each canonical URL that isn't fresh to the ``frontier`` Parquet folder, once, with its first seq.

    The queue is the stream's state; the frontier is written only. Batches show up whole.
    """
    urls.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = urls.select(U.canonicalize(F.col("url")).alias("canonical_url"), "seq", F.lit(False).alias("handled")).where("canonical_url is not null")
    new = queued(stale(rows, pages, cutoff), buckets=buckets).where("status = 'new'").select("canonical_url", "seq")
    return new.writeStream.format("parquet").option("path", frontier).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counted(candidates: DataFrame, pages: DataFrame, cutoff, name: str = "counts") -> DataFrame:
    """A stream of candidates, distinct in each batch by their source, less the fresh ones; how many were ``enqueued`` and ``skipped_fresh`` is observed in each batch."""
    known = pages.where(F.col("fetched_at") >= cutoff).select("canonical_url").distinct().withColumn("_fresh", F.lit(True))
    marked = candidates.join(known, "canonical_url", "left")
    seen = marked.observe(name, F.count_if(F.col("_fresh").isNull()).alias("enqueued"), F.count_if("_fresh").alias("skipped_fresh"))
    return seen.where("_fresh is null").drop("_fresh")


def admitted_per_domain(urls: DataFrame) -> DataFrame:
    """Running number of URLs per domain: state in the stream's store, in update or complete mode."""
    return urls.withColumn("domain", U.domain(F.col("url"))).groupBy("domain").agg(F.count("*").alias("admitted"))
