"""Page rows: which URL a page goes by, what is kept of it, where its links and requests are routed."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import constants as C
from larder.functions import url as U

_LINK_TAG = r"(?is)<link(?=[\s/])(?=[^>]*\brel\s*=\s*[\"']?canonical[\"'\s/>])[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
_SOURCES = {"seed-root": "seed-root", "sitemap": "sitemap", "playwright-fallback": "playwright-fallback"}


def canonical_tag(html: Column) -> Column:
    """The href of the first canonical link; null without one."""
    parts = [F.regexp_extract(html, _LINK_TAG, i) for i in (1, 2, 3)]
    return F.nullif(F.replace(F.concat(*parts), F.lit("&amp;"), F.lit("&")), F.lit(""))


def canonical_url(html: Column, url: Column) -> Column:
    """The canonical link resolved against the page's URL, or else that URL; both in canonical form."""
    return F.coalesce(U.canonicalize(U.resolve(canonical_tag(html), url)), U.canonicalize(url))


def redirect_chain(url: Column, loaded: Column) -> Column:
    """Both URLs where they differ, else null."""
    return F.when(loaded.isNotNull() & (loaded != url), F.array(url, loaded))


def kept_html(html: Column, method: Column, confidence: Column) -> Column:
    """Html is kept where JSON-LD didn't tell all; null otherwise."""
    return F.when((method != "json-ld") | (confidence < 0.5), html)


def zipped(rows: DataFrame, column: str = "html") -> DataFrame:
    """The column as gzip bytes, always the same for the same text; a null stays null."""
    schema = rows.drop(column).schema.add(column, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [None if x is None else gzip.compress(x.encode(), mtime=0) for x in batch.column(column).to_pylist()]
            yield batch.drop_columns([column]).append_column(column, pa.array(packed, pa.binary()))

    return rows.mapInArrow(run, schema)


def failed_rows(failures: DataFrame) -> DataFrame:
    """Page rows of ``failures(url, fetched_at, mode, label, source_domain, admission_signals, fallback_reason)``, whose retries are used up."""
    empty = F.array().cast("array<string>")
    fixed = {"language": "und", "language_confidence": 0.0, "http_status": 0, "extraction_method": "failed", "extractor_version": C.EXTRACTOR_VERSION, "extraction_confidence": 0.0, "recipe_count": 0, "page_content_hash": ""}
    return failures.select(
        U.canonicalize(F.col("url")).alias("canonical_url"),
        U.domain(F.col("url")).alias("domain"),
        "fetched_at",
        F.col("mode").alias("fetch_mode"),
        *(F.lit(v).alias(k) for k, v in fixed.items()),
        F.array(F.lit("language-undetected")).alias("language_signals"),
        empty.alias("extraction_signals"),
        discovery_source(F.col("label")).alias("discovery_source"),
        "source_domain",
        F.coalesce("admission_signals", empty).alias("admission_signals"),
        F.col("fallback_reason").alias("playwright_fallback_reason"),
        empty.alias("outbound_recipe_links"),
    )


def discovery_source(label: Column) -> Column:
    """How a request was found, by its label."""
    out = F.lit("discovered")
    for name, source in _SOURCES.items():
        out = F.when(label == name, source).otherwise(out)
    return out


def rendered_label(fallback: Column, is_root: Column, from_sitemap: Column, retry: Column) -> Column:
    """The label of a request to the rendering crawler: a page sent there by the static one is told first."""
    return F.when(fallback, "playwright-fallback").when(is_root, "seed-root").when(from_sitemap, "sitemap").when(retry, "playwright-fallback").otherwise("discovered")


def routed(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """Adds queue (``playwright`` for links to seeds that need a browser, else ``cheerio``) and role (``trusted`` where the domain is no seed). Seeds are a handful of rows."""
    known = seeds.select("domain", F.col("requires_js").alias("_js"), F.col("role").alias("_role"))
    rows = links.join(F.broadcast(known), "domain", "left")
    return rows.withColumns({"queue": F.when(F.col("_js"), "playwright").otherwise("cheerio"), "role": F.coalesce("_role", F.lit("trusted"))}).drop("_js", "_role")


def split_seeds(seeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(static, rendered) seeds."""
    return seeds.where("not requires_js"), seeds.where("requires_js")


def allowed_by_robots(links: DataFrame, rules: DataFrame) -> DataFrame:
    """Links that ``rules(domain, allow, pattern)`` of their domain let through: the longest pattern that matches decides, an allowing one of two as long.

    A pattern is the beginning of a path with its query; ``*`` stands for anything, ``$`` at its end for the
    end. Rules are found by what they have before the first of these: of a link only the prefixes of the
    lengths that its domain's rules have are looked up, not every rule compared. Empty patterns say nothing.
    Rules ``(domain, prefix)`` deny.
    """
    if "pattern" not in rules.columns:
        rules = rules.select("domain", F.lit(False).alias("allow"), F.col("prefix").alias("pattern"))
    known = rules.where("pattern <> ''").select("domain", "allow", "pattern", F.regexp_extract("pattern", r"^[^*$]*", 0).alias("head")).distinct()
    body = F.regexp_replace("pattern", r"\$$", "")
    quoted = F.array_join(F.transform(F.split(body, r"\*"), lambda x: F.concat(F.lit("\\Q"), x, F.lit("\\E"))), ".*")
    known = known.withColumn("regex", F.concat(F.lit("(?s)^"), quoted, F.when(F.col("pattern").endswith("$"), "$").otherwise("")))
    lengths = known.groupBy("domain").agg(F.collect_set(F.length("head")).alias("lengths"))
    asked = links.select("domain", _asked_path().alias("_path")).distinct()
    heads = asked.join(lengths, "domain").select("domain", "_path", F.explode(F.filter("lengths", lambda n: n <= F.length("_path"))).alias("n"))
    hits = heads.withColumn("head", F.expr("left(_path, n)")).join(known, ["domain", "head"]).where(F.rlike("_path", F.col("regex")))
    denied = hits.groupBy("domain", "_path").agg(F.max_by("allow", F.struct(F.length("pattern"), "allow")).alias("allow")).where("not allow").select("domain", "_path")
    return links.withColumn("_path", _asked_path()).join(denied, ["domain", "_path"], "left_anti").select(*links.columns)


def _asked_path() -> Column:
    return F.concat(U.path(F.col("absolute_url")), F.regexp_extract("absolute_url", r"^[^?#]*(\?[^#]*)?", 1))


def added_off_domain(requests: DataFrame, added: DataFrame) -> DataFrame:
    """Per source domain the admissions of requests that are new and lead to another domain, and the new domains in order."""
    new = requests.where("cross_domain").join(added.select("canonical_url").distinct(), "canonical_url", "left_semi")
    return new.groupBy("source_domain").agg(F.count("*").alias("admissions"), F.array_sort(F.collect_set("domain")).alias("new_domains"))


def diagnostics(events: DataFrame) -> DataFrame:
    """Per domain: started, finished, failed, retried, recipes, and sum, maximum and mean of durations, of ``events(domain, kind, recipes, millis)``."""
    is_ = lambda k: F.col("kind") == k
    took = F.when(is_("finished"), F.col("millis"))
    rows = events.groupBy("domain").agg(*(F.count_if(is_(k)).alias(k) for k in ("started", "finished", "failed", "retried")), F.coalesce(F.sum(F.when(is_("finished"), F.col("recipes"))), F.lit(0)).alias("recipes"), F.coalesce(F.sum(took), F.lit(0)).alias("millis"), F.coalesce(F.max(took), F.lit(0)).alias("max_millis"))
    return rows.withColumn("mean_millis", F.coalesce(F.try_divide("millis", "finished"), F.lit(0.0)))
