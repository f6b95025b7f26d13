"""Stored state as tables: freshness joins, keyed upserts, keep-best, retention."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(candidates: DataFrame, pages: DataFrame, cutoff: Column, key: str = "canonical_url") -> DataFrame:
    """Candidates fetched at or after the cutoff (semi join; the cutoff filter reaches the scan)."""
    return candidates.join(pages.where(F.col("fetched_at") >= cutoff).select(key), key, "left_semi")


def stale(candidates: DataFrame, pages: DataFrame, cutoff: Column, key: str = "canonical_url") -> DataFrame:
    """Candidates to fetch: not fetched since the cutoff (anti join)."""
    return candidates.join(pages.where(F.col("fetched_at") >= cutoff).select(key), key, "left_anti")


def upsert(old: DataFrame, new: DataFrame, key: str, order: str, keep_old: tuple[str, ...] = ()) -> DataFrame:
    """Last write per key wins; fields in ``keep_old`` keep their value where no later write has one.

    Aggregates, not windows: a hot key is combined in each task first. Of writes of one time, the same
    one wins in every run.
    """
    rows = old.unionByName(new, allowMissingColumns=True)
    fields = [c for c in rows.columns if c != key]
    time = F.struct(F.col(order), _tie(rows, fields))
    last = F.max_by(F.struct(*fields), time).alias("r")
    kept = [F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), time)).alias(f"kept_{c}") for c in keep_old]
    merged = rows.groupBy(key).agg(last, *kept)
    return merged.select(key, *[F.col(f"kept_{c}").alias(c) if c in keep_old else F.col(f"r.{c}").alias(c) for c in fields])


def _tie(rows: DataFrame, fields: list[str]) -> Column:
    """A number by which equal rows are equal, for an order between rows of one time; fields without a hash don't count."""
    plain = [c for c in fields if not re.search("map<|variant", rows.schema[c].dataType.simpleString())]
    return F.xxhash64(*plain) if plain else F.lit(0)


def keep_best(rows: DataFrame, key: str, confidence: str, arrival: str) -> DataFrame:
    """One row per key: the highest confidence, the earliest arrival among equals, the same one among equals in both."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(F.col(confidence), -F.col(arrival), _tie(rows, rest))).alias("r")).select(key, "r.*")


def retained(runs: DataFrame, now: Column, days: int) -> DataFrame:
    """Runs that finished within the retention time."""
    return runs.where(F.col("finished_at") > now - F.make_interval(days=F.lit(days)))


def recrawl_cutoff(now: Column, days: int) -> Column:
    return now - F.make_interval(days=F.lit(days))


def page_at(pages: DataFrame, url: Column, key: str = "canonical_url") -> DataFrame:
    """The row of one URL: an equality that reaches the scan."""
    return pages.where(F.col(key) == url)


def fetched_since(pages: DataFrame, url: Column, cutoff: Column, key: str = "canonical_url") -> bool:
    """Whether one URL was fetched at or after the cutoff."""
    return not page_at(pages, url, key).where(F.col("fetched_at") >= cutoff).isEmpty()


def append_runs(runs: DataFrame, path: str) -> None:
    """Add finished runs to the table of runs."""
    runs.write.mode("append").parquet(path)


def without(rows: DataFrame, known: DataFrame, key: str = "domain") -> DataFrame:
    """Rows whose key isn't among the known ones, nulls among them."""
    return rows.join(known.select(key).distinct(), key, "left_anti")


def common(left: Column, right: Column) -> Column:
    """What two lists have in common, in the order of the first; a null list is empty."""
    empty = F.array().cast("array<string>")
    return F.array_intersect(F.coalesce(left, empty), F.coalesce(right, empty))


def skips(candidates: DataFrame, pages: DataFrame, cutoff: Column, key: str = "canonical_url") -> DataFrame:
    """How many of ``candidates(canonical_url, domain, mode)``, each URL of a mode once, are skipped as fresh, by domain and mode."""
    asked = candidates.dropDuplicates([key, "mode"])
    return fresh(asked, pages, cutoff, key).groupBy("domain", "mode").agg(F.count("*").alias("skipped"))


def recipes_by_page(pages: DataFrame, recipes: DataFrame) -> DataFrame:
    """Pages with their recipes, ``recipes(page_url, ...)``; of a page without one the recipe's columns are null."""
    return pages.join(recipes, pages["canonical_url"] == recipes["page_url"], "left")
