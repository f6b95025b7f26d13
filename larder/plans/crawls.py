"""Queries of robots rules, trees, sitemaps, summaries and recipes of pages, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import url as U
from larder.operators import extract as X
from larder.operators import language as LG
from larder.operators import links as L
from larder.operators import metrics as M
from larder.operators import pages as P
from larder.operators import store as S
from larder.operators import trees
from larder.plans import oracles as O
from larder.plans import queries as Q
from larder.sources import sitemaps
from larder.sources.folders import scratch

#: Rules of every domain of the pages: (allowing, pattern).
RULES = [(False, "/c"), (True, "/c/a"), (False, "/tag/*e"), (False, "/*.html$"), (True, "/tag/"), (False, "/category/*/x"), (False, "/p$"), (False, "")]
#: Mixed case and letters beyond ASCII, in the order of the root locale.
NAMES = ["aben", "Åben.dk", "ad.dk", "Ærø.dk", "apple.dk", "Apple.dk", "zebra.dk", "Zebra.dk", "øl.dk"]
_ORDERED = ["aben", "Åben.dk", "ad.dk", "Ærø.dk", "apple.dk", "Apple.dk", "øl.dk", "zebra.dk", "Zebra.dk"]
SITEMAP_URLS = 40


def robots_links(spark: SparkSession, d: str) -> DataFrame:
    """Links that the rules of their domain let through."""
    links = Q.candidates(spark, d)
    each = F.explode(F.array(*(F.struct(F.lit(a).alias("allow"), F.lit(p).alias("pattern")) for a, p in RULES)))
    rules = links.select("domain").distinct().select("domain", each.alias("r")).select("domain", "r.*")
    return P.allowed_by_robots(links, rules).select("page_id", F.col("pos").cast("long").alias("pos"), "absolute_url")


def process_chain(spark: SparkSession, d: str) -> DataFrame:
    """Depth and root of a chain of all suppliers, but for one in a hundred, where a new chain begins."""
    rows = Q.read(spark, d, "supplier").select(F.col("s_suppkey").alias("pid"), F.when(F.col("s_suppkey") % 400 > 0, F.col("s_suppkey") - 1).alias("ppid"))
    return trees.rooted(rows).select("pid", "root", "depth")


def process_tree(spark: SparkSession, d: str) -> DataFrame:
    """Resident sizes by level of the tree below 1, where the parent of n is n div 2."""
    rows = Q.read(spark, d, "supplier").where("s_suppkey > 0").select(F.col("s_suppkey").alias("pid"), F.expr("s_suppkey div 2").alias("ppid"), F.col("s_acctbal").alias("rss"))
    return trees.totals(rows, "rss").where("root = 1").select(F.col("depth").cast("int").alias("depth"), F.col("nodes").alias("processes"), F.round("rss", 2).alias("rss"))


def sitemap_follow(spark: SparkSession, d: str) -> DataFrame:
    """The pages' URLs, written as sitemaps of some tens of URLs each, some gzipped, below indexes of two levels that list one another, and read back from the first."""
    folder = scratch(spark, "sitemaps")
    pages = Q.read(spark, d, "pages").select(F.replace("url", F.lit("&"), F.lit("&amp;")).alias("url"), F.expr(f"page_id div {SITEMAP_URLS}").alias("map"))
    leaf = pages.groupBy("map").agg(F.concat(F.lit("<urlset xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'>"), F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("<url><loc> "), "url", F.lit(" </loc><lastmod>2024-01-02</lastmod></url>")))), "\n"), F.lit("</urlset>")).alias("value"))
    entry = lambda name: F.concat(F.lit("<sitemap><loc>https://maps.example/"), name, F.lit("</loc></sitemap>"))
    name = F.concat(F.lit("leaf-"), "map", F.when(F.col("map") % 2 == 0, ".xml.gz").otherwise(".xml"))
    index = leaf.groupBy(F.expr("map % 3").alias("index")).agg(F.concat(F.lit("<sitemapindex>"), F.array_join(F.array_sort(F.collect_list(entry(name))), ""), entry(F.lit("root.xml")), F.lit("</sitemapindex>")).alias("value"))
    root = index.agg(F.concat(F.lit("<sitemapindex>"), F.array_join(F.array_sort(F.collect_list(entry(F.concat(F.lit("index-"), "index", F.lit(".xml"))))), ""), entry(F.lit("gone.xml")), F.lit("</sitemapindex>")).alias("value"))
    files = leaf.select(name.alias("name"), "value").unionByName(index.select(F.concat(F.lit("index-"), "index", F.lit(".xml")).alias("name"), "value")).unionByName(root.select(F.lit("root.xml").alias("name"), "value"))
    written = sitemaps.written(files, folder)
    place = F.concat(F.lit(f"{folder}/"), F.regexp_extract("loc", r"([^/]+)$", 1))
    begin = spark.range(1).select(F.lit("https://maps.example/root.xml").alias("loc")).where(F.lit(written > 0))
    return sitemaps.followed(begin, place).select("url", "lastmod", "depth")


def _crawl_events(spark: SparkSession, d: str) -> DataFrame:
    name = F.element_at(F.array(*map(F.lit, NAMES)), (F.col("user_id") % len(NAMES) + 1).cast("int"))
    return Q.read(spark, d, "events").select(
        name.alias("domain"), F.when(F.col("event_type") == "error", F.when(F.col("event_id") % 2 == 0, "fallback").otherwise("blocked")).when(F.col("event_type") == "signup", F.when(F.col("event_id") % 3 == 0, "off-domain").otherwise("skip")).otherwise("page").alias("kind"),
        F.when(F.col("event_id") % 4 == 0, "playwright").otherwise("cheerio").alias("mode"), (F.col("event_id") % 3).alias("recipes"), F.when(F.col("event_id") % 5 > 0, F.element_at(F.array(*map(F.lit, ("da", "en", "DA", "und"))), (F.col("event_id") % 4 + 1).cast("int"))).alias("language"),
        F.when(F.col("event_id") % 7 > 2, F.concat(F.lit("reason-"), F.col("event_id") % 3)).alias("reason"), F.concat(F.lit("t"), F.col("event_id") % 6, F.lit(".dk")).alias("target"),
    )


def crawl_summary(spark: SparkSession, d: str) -> DataFrame:
    """The nested summary of a crawl, unfolded: the totals at place -1, then its domains in their order."""
    one = M.summary(_crawl_events(spark, d))
    names = lambda c: F.array_join(F.transform(c, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ", ")
    rows = one.select(F.lit(-1).alias("place"), F.lit("all").alias("domain"), "totals.*").unionByName(one.select(F.posexplode("domains").alias("place", "x")).select("place", "x.*"))
    histograms = ["languages", "fallback_reasons", "blocked_reasons", "new_domains"]
    plain = ["processed", "processed_cheerio", "processed_playwright", "recipe_pages", "recipes", "fallbacks", "skips", "skips_cheerio", "skips_playwright", "off_domain"]
    return rows.select("place", "domain", *plain, *(F.round(c, 6).alias(c) for c in ("recipe_page_yield", "fallback_rate")), *(names(F.col(c)).alias(c) for c in histograms)).where("domain <> 'all' OR processed > 0")


def fresh_skips(spark: SparkSession, d: str) -> DataFrame:
    asked = Q.read(spark, d, "pages").select(U.canonicalize(F.col("url")).alias("canonical_url"), U.domain(F.col("url")).alias("domain"), F.explode(F.when(F.col("page_id") % 2 == 0, F.array(F.lit("cheerio"), F.lit("playwright"), F.lit("cheerio"))).otherwise(F.array(F.lit("cheerio")))).alias("mode"))
    return S.skips(asked, Q._fetched(spark, d), Q._cutoff())


def pages_to_recipes(spark: SparkSession, d: str) -> DataFrame:
    """Stored pages (one a canonical URL) and their recipes by domain and by the recipe's language, where the recipe or the page states it."""
    pages = L.first_seen(Q.read(spark, d, "pages").select("page_id", U.canonicalize(F.col("url")).alias("canonical_url"), U.domain(F.col("url")).alias("domain"), "html"), "page_id")
    found = X.explode_recipes(X.extract_pages(pages)).join(pages.select("page_id", F.col("canonical_url").alias("page_url"), "domain", "html"), "page_id")
    recipes = LG.detected(found).select("page_url", F.when(F.col("language_confidence") > 0.85, F.col("language")).otherwise("unsure").alias("language"), "content_hash")
    joined = S.recipes_by_page(pages, recipes)
    return joined.groupBy("domain", "language").agg(F.count_distinct("page_id").alias("pages"), F.count("content_hash").alias("recipes"))


def _summary_sql() -> str:
    names, order = ", ".join(f"'{n}'" for n in NAMES), ", ".join(f"'{n}'" for n in _ORDERED)
    histogram = lambda v, where, name: f"{name} AS (SELECT coalesce(domain, '') AS domain, string_agg({v} || '=' || n, ', ' ORDER BY lower({v}), {v} DESC) AS m FROM (SELECT domain, {v}, count(*) AS n FROM e WHERE {where} AND {v} IS NOT NULL GROUP BY GROUPING SETS ((domain, {v}), ({v}))) GROUP BY domain)"
    return f"""WITH e AS (SELECT [{names}][user_id % {len(NAMES)} + 1] AS domain, CASE event_type WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'fallback' ELSE 'blocked' END WHEN 'signup' THEN CASE WHEN event_id % 3 = 0 THEN 'off-domain' ELSE 'skip' END ELSE 'page' END AS kind,
        CASE WHEN event_id % 4 = 0 THEN 'playwright' ELSE 'cheerio' END AS mode, event_id % 3 AS recipes, CASE WHEN event_id % 5 > 0 THEN ['da', 'en', 'DA', 'und'][event_id % 4 + 1] END AS language, CASE WHEN event_id % 7 > 2 THEN 'reason-' || event_id % 3 ELSE 'unspecified' END AS reason, 't' || event_id % 6 || '.dk' AS target FROM events),
      {histogram('language', "kind = 'page' AND recipes > 0", 'lg')}, {histogram('reason', "kind = 'fallback'", 'fr')}, {histogram('reason', "kind = 'blocked'", 'br')}, {histogram('target', "kind = 'off-domain'", 'nd')},
      c AS (SELECT domain, count(*) FILTER (kind = 'page') AS processed, count(*) FILTER (kind = 'page' AND mode = 'cheerio') AS processed_cheerio, count(*) FILTER (kind = 'page' AND mode = 'playwright') AS processed_playwright, count(*) FILTER (kind = 'page' AND recipes > 0) AS recipe_pages,
        cast(coalesce(sum(recipes) FILTER (kind = 'page'), 0) AS BIGINT) AS recipes, count(*) FILTER (kind = 'fallback') AS fallbacks, count(*) FILTER (kind = 'skip') AS skips, count(*) FILTER (kind = 'skip' AND mode = 'cheerio') AS skips_cheerio, count(*) FILTER (kind = 'skip' AND mode = 'playwright') AS skips_playwright, count(*) FILTER (kind = 'off-domain') AS off_domain FROM e GROUP BY GROUPING SETS ((domain), ())),
      p AS (SELECT *, row_number() OVER (ORDER BY list_position([{order}], domain)) - 1 AS r FROM c WHERE domain IS NOT NULL)
      SELECT cast(coalesce(p.r, -1) AS INTEGER) AS place, coalesce(c.domain, 'all') AS domain, c.processed, c.processed_cheerio, c.processed_playwright, c.recipe_pages, c.recipes, c.fallbacks, c.skips, c.skips_cheerio, c.skips_playwright, c.off_domain,
        round(CASE WHEN c.processed = 0 THEN 0 ELSE c.recipe_pages::DOUBLE / c.processed END, 6) AS recipe_page_yield, round(CASE WHEN c.processed_cheerio = 0 THEN 0 ELSE c.fallbacks::DOUBLE / c.processed_cheerio END, 6) AS fallback_rate,
        coalesce(lg.m, '') AS languages, coalesce(fr.m, '') AS fallback_reasons, coalesce(br.m, '') AS blocked_reasons, coalesce(nd.m, '') AS new_domains
      FROM c LEFT JOIN p ON p.domain = c.domain {' '.join(f"LEFT JOIN {t} ON {t}.domain = coalesce(c.domain, '')" for t in ('lg', 'fr', 'br', 'nd'))}"""


def _robots_sql() -> str:
    pattern = lambda p: "^" + p.rstrip("$").replace(".", "\\.").replace("*", ".*") + ("$" if p.endswith("$") else "")
    rules = ", ".join(f"({str(a).lower()}, '{pattern(p)}', {len(p)})" for a, p in RULES if p)
    return f"""WITH {O.LINKS}, rules(allow, pattern, size) AS (VALUES {rules}), q AS (SELECT page_id, pos, absolute_url, {O.path('absolute_url')} || regexp_extract(absolute_url, '^[^?#]*(\\?[^#]*)?', 1) AS p FROM c),
      v AS (SELECT page_id, pos, arg_max(allow, size * 2 + allow::INT) AS allow FROM q JOIN rules ON regexp_matches(p, pattern) GROUP BY page_id, pos)
      SELECT q.page_id, q.pos, q.absolute_url FROM q LEFT JOIN v USING (page_id, pos) WHERE coalesce(v.allow, true)"""


QUERIES = {f.__name__: f for f in (robots_links, process_chain, process_tree, sitemap_follow, crawl_summary, fresh_skips, pages_to_recipes)}

_H1 = "regexp_matches(html, '(?is)<h1[^>]*>[^<]*[^<[:space:]]')"
ORACLES = {
    "robots_links": _robots_sql(),
    "process_chain": "SELECT s_suppkey AS pid, s_suppkey // 400 * 400 AS root, s_suppkey % 400 AS depth FROM supplier",
    "process_tree": "WITH RECURSIVE tree AS (SELECT s_suppkey AS pid, 0 AS depth, s_acctbal AS rss FROM supplier WHERE s_suppkey = 1 UNION ALL SELECT s.s_suppkey, t.depth + 1, s.s_acctbal FROM supplier s JOIN tree t ON s.s_suppkey // 2 = t.pid WHERE s.s_suppkey > 1) SELECT depth, count(*) AS processes, round(sum(rss), 2) AS rss FROM tree GROUP BY depth",
    "sitemap_follow": "SELECT DISTINCT url, '2024-01-02' AS lastmod, 2 AS depth FROM pages",
    "crawl_summary": _summary_sql(),
    "fresh_skips": f"WITH {O._ASKED}, m AS (SELECT DISTINCT {O.canon('url')} AS canonical_url, {O.domain('url')} AS domain, unnest(CASE WHEN page_id % 2 = 0 THEN ['cheerio', 'playwright'] ELSE ['cheerio'] END) AS mode FROM pages) SELECT domain, mode, count(*) AS skipped FROM m WHERE canonical_url IN (SELECT canonical_url FROM fresh) GROUP BY ALL",
    "pages_to_recipes": f"WITH p AS (SELECT {O.domain('url')} AS domain, CASE WHEN {_H1} THEN coalesce({O.language_code(O._H)}, 'unsure') END AS language, row_number() OVER (PARTITION BY {O.canon('url')} ORDER BY page_id) AS rn FROM pages) SELECT domain, language, count(*) AS pages, count(language) AS recipes FROM p WHERE rn = 1 GROUP BY ALL",
}
