"""The crawl as a fixpoint over a table of fetched pages: frontier, extract, admit, next frontier."""

from __future__ import annotations

import uuid
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder import constants as C
from larder.functions import url as U
from larder.operators import links as L


def crawl(fetches: DataFrame, roots: DataFrame, trusted: DataFrame, work: str, limits: C.Limits = C.DEFAULT) -> DataFrame:
    """Visited URLs ``(canonical_url, depth)`` starting from ``roots(url)``.

    ``fetches(page_id, url, html)`` stands for the network. Pages are parsed once, to a table of links
    below ``work`` (a folder that all executors share); each round's frontier is written there too, so
    a lost executor costs at most one round. The caps count what earlier rounds have queued, the roots
    among them. It ends when a frontier is empty: no URL is visited twice.
    """
    spark = fetches.sparkSession
    run = f"{work}/crawl-{uuid.uuid4().hex}"
    L.candidates(L.explode_links(fetches.withColumn("page_url", U.canonicalize(F.col("url"))), "page_url")).write.parquet(f"{run}/links")
    edges = spark.read.parquet(f"{run}/links")
    start = roots.select(U.canonicalize(F.col("url")).alias("canonical_url")).where("canonical_url is not null").distinct()
    frontier = start.select("canonical_url", U.domain(F.col("canonical_url")).alias("domain"), F.lit(0).alias("depth"), F.lit(0).alias("hops"))
    schema = frontier.schema
    for depth in count():
        frontier.write.parquet(f"{run}/round={depth}")
        frontier = spark.read.schema(schema).parquet(f"{run}/round={depth}")
        # one scan of all rounds: the plan doesn't grow with them
        visited = spark.read.schema(schema).parquet(f"{run}/round=*")
        if frontier.isEmpty():
            break
        own = frontier.select(F.col("canonical_url").alias("page_url"), F.col("hops").alias("parent_hops"))
        decided = _admit(edges.join(own, "page_url"), trusted, limits)
        hops = F.when(U.is_recipe_like(F.col("absolute_url")), 0).otherwise(F.col("parent_hops") + 1)
        new = decided.select("canonical_url", "domain", "page_id", "pos", hops.alias("hops"))
        new = L.first_seen(new, "page_id", "pos").join(visited.select("canonical_url"), "canonical_url", "left_anti")
        queued = visited.groupBy("domain").agg(F.count("*").alias("queued"))
        total = visited.count()
        new = L.cap(new, limits.pages_per_domain, max(0, limits.global_queue - total), "page_id", "pos", queued=queued)
        frontier = new.select("canonical_url", "domain", F.lit(depth + 1).alias("depth"), "hops")
    return visited.select("canonical_url", "depth")


def _admit(links: DataFrame, trusted: DataFrame, limits: C.Limits) -> DataFrame:
    source = U.domain(F.col("url"))
    known = trusted.select(F.col("domain").alias("domain"), F.lit(True).alias("domain_trusted"))
    rows = links.withColumn("source_domain", source).join(known, "domain", "left").withColumn("domain_trusted", F.coalesce("domain_trusted", F.lit(False)))
    rows = rows.withColumns({"source_trusted": F.lit(True), "from_sitemap": F.lit(False), "source_is_recipe": U.is_recipe_like(F.col("url"))})
    rows = rows.withColumn("eligible", L.eligibility(F.col("absolute_url"), F.col("source_trusted"), F.lit(0), F.lit(0), F.lit(limits.pages_per_domain), limits))
    rows = L.admission(rows, limits)
    return rows.where(L.follow(F.col("allowed"), U.is_recipe_like(F.col("absolute_url")), F.col("cross_domain"), F.col("source_trusted"), F.col("parent_hops"), limits))
