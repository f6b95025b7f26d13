"""Seed dimension, sitemap scan and page scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import constants as C
from larder.functions import url as U


def seeds(spark: SparkSession, limits: C.Limits = C.DEFAULT) -> DataFrame:
    """The trusted seed domains (a fixed handful of rows)."""
    rows = [(d, s, [u], False, True, limits.pages_per_domain, "trusted") for d, s, u in C.SEEDS]
    return spark.createDataFrame(rows, "domain string, sitemap_url string, start_urls array<string>, requires_js boolean, respect_robots boolean, max_pages int, role string")


def start_urls(rows: DataFrame) -> DataFrame:
    """(domain, url): the root of each seed, then its start URLs, distinct, in order."""
    root = F.concat(F.lit("https://"), U.normalize_domain(F.col("domain")))
    urls = F.array_distinct(F.concat(F.array(root), F.transform("start_urls", lambda u: U.resolve(u, root))))
    return rows.select("domain", F.posexplode(urls).alias("pos", "url"))


def sitemap_sources(configured: Column, discovered: Column) -> Column:
    """Configured sitemaps first, then discovered ones, distinct."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.filter(F.concat(F.coalesce(configured, empty), F.coalesce(discovered, empty)), lambda x: x.isNotNull()))


def sitemap(spark: SparkSession, path: str) -> DataFrame:
    """(url) of all entries of sitemap XML files; files without entries give none."""
    return spark.read.schema("loc string, lastmod string").option("rowTag", "url").option("mode", "DROPMALFORMED").format("xml").load(path).where("loc is not null").select(F.trim("loc").alias("url"), "lastmod")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def should_respect_robots(rows: DataFrame) -> DataFrame:
    """One row: whether all seeds respect robots.txt; false without seeds. And the sum of the page caps."""
    return rows.agg(((F.count("*") > 0) & F.coalesce(F.bool_and("respect_robots"), F.lit(False))).alias("respect_robots"), F.coalesce(F.sum("max_pages"), F.lit(0)).cast("long").alias("max_requests"))


def sitemap_roots(domain: Column, configured: Column) -> Column:
    """Where sitemaps are probed for: the domain's root, then the origins of its configured sitemaps; what is no URL is left out."""
    origins = F.transform(F.coalesce(configured, F.array().cast("array<string>")), lambda u: F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)))
    return F.array_distinct(F.concat(F.array(F.concat(F.lit("https://"), U.normalize_domain(domain))), F.filter(origins, lambda u: u != "")))


def sitemap_index(spark: SparkSession, path: str) -> DataFrame:
    """(url) of the sitemaps that index files list; files may be gzipped, as Spark reads them by their ending."""
    return spark.read.schema("loc string, lastmod string").option("rowTag", "sitemap").option("mode", "DROPMALFORMED").format("xml").load(path).where("loc is not null").select(F.trim("loc").alias("url"))
