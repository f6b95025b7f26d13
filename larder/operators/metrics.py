"""Crawl metrics: totals with domains, histograms, run reports, diagnostics."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larder.functions.text import percent
from larder.functions.url import path


def domain_metrics(events: DataFrame) -> DataFrame:
    """Counters per domain and in total (domain ``all``) of ``events(kind, domain, mode, recipes)``."""
    is_ = lambda k: F.col("kind") == k
    counted = events.rollup("domain").agg(
        F.count_if(is_("page")).alias("processed"),
        F.count_if(is_("page") & (F.col("mode") == "cheerio")).alias("cheerio"),
        F.count_if(is_("page") & (F.col("recipes") > 0)).alias("recipe_pages"),
        F.coalesce(F.sum(F.when(is_("page"), F.col("recipes"))), F.lit(0)).alias("extracted"),
        F.count_if(is_("fallback")).alias("fallbacks"),
        F.count_if(is_("skip")).alias("skips"),
        F.grouping("domain").alias("g"),
    )
    return counted.select(
        F.when(F.col("g") == 1, "all").otherwise(F.col("domain")).alias("domain"),
        "processed",
        "cheerio",
        "recipe_pages",
        "extracted",
        "fallbacks",
        "skips",
        F.coalesce(F.try_divide("recipe_pages", "processed"), F.lit(0.0)).alias("recipe_page_yield"),
        F.coalesce(F.try_divide("fallbacks", "cheerio"), F.lit(0.0)).alias("fallback_rate"),
    )


def reason_counts(rows: DataFrame, *keys: str) -> DataFrame:
    """One count per reason of each row's list; an empty list counts as unspecified."""
    listed = F.when(F.size("reasons") > 0, F.col("reasons")).otherwise(F.array(F.lit("unspecified")))
    return rows.select(*keys, F.explode(listed).alias("reason")).groupBy(*keys, "reason").agg(F.count("*").alias("n"))


def run_report(runs: DataFrame, latest: int = 10) -> DataFrame:
    """The latest runs, formatted, newest first."""
    top = runs.orderBy(F.desc("finished_at")).limit(latest)
    return top.select("run", "pages", "recipes", percent(F.coalesce(F.try_divide("recipes", "pages"), F.lit(0.0))).alias("yield"))


def run_deltas(runs: DataFrame, *metrics: str) -> DataFrame:
    """The change of each metric against the run before. Runs are few: one row a crawl."""
    w = W.orderBy("finished_at")
    return runs.select("run", *[(F.col(m) - F.lag(m).over(w)).alias(f"delta_{m}") for m in metrics])


def start_gaps(requests: DataFrame) -> DataFrame:
    """Per domain: requests, and number, sum, maximum and mean of the gaps between their starts in microseconds."""
    gap = F.unix_micros("ts") - F.unix_micros(F.lag("ts").over(W.partitionBy("domain").orderBy("ts", "id")))
    rows = requests.withColumn("gap", gap)
    return rows.groupBy("domain").agg(F.count("*").alias("started"), F.count("gap").alias("gaps"), F.coalesce(F.sum("gap"), F.lit(0)).alias("gap_sum"), F.coalesce(F.max("gap"), F.lit(0)).alias("gap_max"), F.max_by("id", F.struct("ts", "id")).alias("latest_id"))


def every_nth(requests: DataFrame, n: int = 25) -> DataFrame:
    """The first request of each domain and every n-th."""
    rn = F.row_number().over(W.partitionBy("domain").orderBy("ts", "id"))
    return requests.withColumn("rn", rn).where((F.col("rn") == 1) | (F.col("rn") % n == 0))


def latest_k(given: str | None, default: int = 10) -> int:
    """How many runs a report shows: the whole number a text begins with; the default for none, or one under 1."""
    found = re.match(r"\s*[+-]?\d+", given or "")
    return int(found[0]) if found and int(found[0]) > 0 else default


def top(rows: DataFrame, by: str, key: str, n: int) -> DataFrame:
    """The n rows with the highest value, ties by key: taken in each task before they meet."""
    return rows.orderBy(F.desc(by), key).limit(n)


def map_total(counts: Column) -> Column:
    """Sum of the values of a map."""
    return F.aggregate(F.coalesce(F.map_values(counts), F.array().cast("array<bigint>")), F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint"))


def hits_by_path(requests: DataFrame, url: str = "url") -> DataFrame:
    """Requests of each path."""
    return requests.groupBy(path(F.col(url)).alias("path")).agg(F.count("*").alias("hits"))


def _histogram(rows: DataFrame, value: str, name: str) -> DataFrame:
    """(domain, g, map) counts of a value by domain and in total, keys in the order of the locale."""
    counted = rows.where(F.col(value).isNotNull()).groupBy("domain", value).agg(F.count("*").alias("n"))
    totals = counted.groupBy(value).agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("domain"), value, "n", F.lit(1).alias("g"))
    both = counted.select("domain", value, "n", F.lit(0).alias("g")).unionByName(totals)
    entries = F.transform(F.array_sort(F.collect_list(F.struct(located(F.col(value)).alias("l"), F.col(value).alias("k"), "n"))), lambda e: F.struct(e["k"].alias("key"), e["n"].alias("value")))
    return both.groupBy("domain", "g").agg(entries.alias(name))


def located(text: Column, locale: str = "UNICODE") -> Column:
    """A text that sorts as people of the locale sort it: letters before case and accents, not by code points."""
    return F.collate(text, locale)


def summary(events: DataFrame) -> DataFrame:
    """One row: the totals of a crawl and an array of its domains, in the order of the locale, of ``events(kind, domain, mode, recipes, language, reason, target)``.

    Kinds: page (once for each recipe's language at least), fallback, skip, blocked and off-domain. Histograms are arrays of key and
    value in the order of the locale. A domain is held whole, its events aren't.
    """
    is_ = lambda k, mode=None: (F.col("kind") == k) if mode is None else (F.col("kind") == k) & (F.col("mode") == mode)
    counters = {
        "processed": is_("page"), "processed_cheerio": is_("page", "cheerio"), "processed_playwright": is_("page", "playwright"), "recipe_pages": is_("page") & (F.col("recipes") > 0), "fallbacks": is_("fallback"),
        "skips": is_("skip"), "skips_cheerio": is_("skip", "cheerio"), "skips_playwright": is_("skip", "playwright"), "off_domain": is_("off-domain"),
    }
    base = events.rollup("domain").agg(*(F.count_if(c).alias(n) for n, c in counters.items()), F.coalesce(F.sum(F.when(is_("page"), F.col("recipes"))), F.lit(0)).alias("recipes"), F.grouping("domain").cast("int").alias("g"))
    rows = base.withColumn("recipe_page_yield", F.coalesce(F.try_divide("recipe_pages", "processed"), F.lit(0.0))).withColumn("fallback_rate", F.coalesce(F.try_divide("fallbacks", "processed_cheerio"), F.lit(0.0)))
    reason = F.when(is_("fallback") | is_("blocked"), F.coalesce("reason", F.lit("unspecified")))
    for value, name, own in (("language", "languages", events.where(is_("page") & (F.col("recipes") > 0))), ("_fallback", "fallback_reasons", events.withColumn("_fallback", F.when(is_("fallback"), reason))), ("_blocked", "blocked_reasons", events.withColumn("_blocked", F.when(is_("blocked"), reason))), ("_target", "new_domains", events.withColumn("_target", F.when(is_("off-domain"), F.col("target"))))):
        made = _histogram(own, value, name).select(F.col("domain").alias("_d"), F.col("g").alias("_g"), name)
        rows = rows.join(made, rows["domain"].eqNullSafe(made["_d"]) & (rows["g"] == made["_g"]), "left").drop("_d", "_g")
        rows = rows.withColumn(name, F.coalesce(name, F.array().cast("array<struct<key:string,value:bigint>>")))
    fields = [c for c in rows.columns if c not in ("domain", "g")]
    own = F.when(F.col("g") == 0, F.struct(located(F.col("domain")).alias("_l"), "domain", *fields))
    return rows.agg(F.max(F.when(F.col("g") == 1, F.struct(*fields))).alias("totals"), F.transform(F.array_sort(F.collect_list(own)), lambda d: d.dropFields("_l")).alias("domains"))
