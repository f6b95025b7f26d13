"""Queries over inputs that are made of the driver's tables by plain expressions, so that SQL can say what must come out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import constants as C
from larder.functions import text as T
from larder.functions import url as U
from larder.operators import extract as X
from larder.operators import language as LG
from larder.operators import links as L
from larder.operators import metrics as M
from larder.operators import pages as P
from larder.operators import store as S
from larder.sources import seeds as SD

#: Pages of parts as dishes, one layout for each remainder of p_partkey by 7: (domain, html) as Spark SQL.
LAYOUTS = [
    ("www.arla.dk", "concat('<body><p>Ret nr ', k, '.</p><h1>', n, '</h1><p>', t, '</p>\n', s, ' minutter\n<h2>Ingredienser</h2><ul><li>▢ ', b, '</li><li>', n, '</li></ul><h3>Sådan gør du</h3><p>Rør ', t, '. Bag ', b, '.</p></body>')"),
    ("madensverden.dk", "concat('<body><p>Køkken: ', t, '</p><h1>', n, '</h1><p>Forberedelsestid:</p><p>', k, ' min</p><h3>Fremgangsmåde</h3><ol><li>Rør ', b, '.</li></ol><p>Antal: ', s, '</p><h3>Ingredienser</h3><ol><li>▢ ', b, '</li></ol></body>')"),
    ("x.spisbedre.dk", "concat('<main id=\"app\" data-page=\"', replace(to_json(named_struct('props', named_struct('recipe', named_struct('serving_size', s % 3 + 1, 'serving_size_type', named_struct('name_singular', 'bid', 'name_plural', 'bidder'), 'tip_message', t, 'title', n, 'preparation_time', s, 'grouped_instructions', array(named_struct('instructions', array(named_struct('instruction', concat('Steg ', b, '.'))))), 'grouped_ingredients', array(named_struct('ingredients', array(named_struct('amount', 0.5D, 'ingredient_inflection', 'default', 'ingredient', named_struct('name_singular', b), 'unit', named_struct('abbreviation', 'kg'))))))), 'component', 'app/pages/Recipes/Details')), '\"', '&quot;'), '\"></main>')"),
    ("dk-kogebogen.dk", "concat('<body><p>Oprindelsesland : ', t, '</p><h1>', n, '</h1><p>Antal : ', s, '</p><p>Tips:<br>Gem ', n, '.</p><p>karakterer: 5</p><p>Ingredienser:<br>', b, '<br>', n, '</p><p>Opskrift:<br>Pisk ', b, '.<br>Server ', t, '.</p><p>karakterer: 5</p></body>')"),
    ("example.org", "concat('<script type=\"application/ld+json\">{\"@type\":\"Recipe\",\"name\":\"', n, '\",\"recipeYield\":\"', s, '\",\"recipeIngredient\":[\"', b, '\",\"', t, '\"],\"recipeInstructions\":[\"Cut ', b, '.\"]}</script>')"),
    ("example.org", "concat('<article itemscope itemtype=\"http://schema.org/Recipe\"><h1 itemprop=\"name\">', n, '</h1><i itemprop=\"recipeIngredient\">', b, '</i><time itemprop=\"prepTime\" datetime=\"PT', s, 'M\">x</time><ol itemprop=\"recipeInstructions\"><li>Cut ', b, '.</li><li>Eat ', t, '.</li></ol></article>')"),
    ("example.org", "concat('<body><dl><dt>Prep time</dt><dd>', s, ' min</dd></dl><h1>', n, '</h1><h2>Ingredients</h2><ol><li>', b, '</li></ol></body>')"),
]
FIELDS = ["name", "description", "prepTime", "totalTime", "recipeYield", "recipeCuisine", "recipeIngredient", "recipeInstructions"]
#: What comes out, in the order of LAYOUTS: confidence, signals and the fields, as DuckDB SQL.
FOUND = [
    ("1.0", "site-specific-arla", "n", "'Ret nr ' || k || '. ' || t", "NULL", "s || ' minutter'", "NULL", "NULL", "'[\"' || b || '\",\"' || n || '\"]'", "'[\"Rør ' || t || '.\",\"Bag ' || b || '.\"]'"),
    ("1.0", "site-specific-madensverden", "n", "NULL", "k || ' min'", "NULL", "'' || s", "t", "'[\"' || b || '\"]'", "'[\"Rør ' || b || '.\"]'"),
    ("1.0", "site-specific-spisbedre,spisbedre-page-data", "n", "t", "s || ' min'", "NULL", "CASE s % 3 WHEN 0 THEN '1 bid' ELSE (s % 3 + 1) || ' bidder' END", "NULL", "'[\"0.5 kg ' || b || '\"]'", "'[\"Steg ' || b || '.\"]'"),
    ("1.0", "site-specific-dk-kogebogen", "n", "'Gem ' || n || '.'", "NULL", "NULL", "'' || s", "t", "'[\"' || b || '\",\"' || n || '\"]'", "'[\"Pisk ' || b || '.\",\"Server ' || t || '.\"]'"),
    ("1.0", "json-ld-normalized-fields,json-ld-found", "n", "NULL", "NULL", "NULL", "'' || s", "NULL", "'[\"' || b || '\",\"' || t || '\"]'", "'[\"Cut ' || b || '.\"]'"),
    ("1.0", "microdata-found", "n", "NULL", "'PT' || s || 'M'", "NULL", "NULL", "NULL", "'[\"' || b || '\"]'", "'[\"Cut ' || b || '.\",\"Eat ' || t || '.\"]'"),
    ("0.666667", "heuristic-title-from-h1,heuristic-ingredients-from-nearby-content,missing-instructions,heuristic-prep-time", "n", "NULL", "s || ' min'", "NULL", "NULL", "NULL", "'[\"' || b || '\"]'", "NULL"),
]


def fixture_extract(spark: SparkSession, d: str) -> DataFrame:
    """Method, confidence, signals and fields of the recipes of pages that are made of the parts."""
    parts = spark.read.parquet(f"{d}/part.parquet").selectExpr("p_partkey AS page_id", "p_partkey AS k", "p_name AS n", "p_brand AS b", "p_type AS t", "p_size AS s")
    kind = F.pmod("page_id", F.lit(len(LAYOUTS)))
    pick = lambda i, c: F.expr("CASE " + " ".join(f"WHEN pmod(page_id, {len(LAYOUTS)}) = {j} THEN {c(x[i])}" for j, x in enumerate(LAYOUTS)) + " END")
    pages = parts.select("page_id", pick(0, "'{}'".format).alias("domain"), pick(1, str).alias("html"), kind.alias("kind"))
    recipe = F.from_json(F.get("recipes", F.lit(0)), "map<string,string>")
    rows = X.extract_pages(pages).select("page_id", "method", F.round("confidence", 6).alias("confidence"), F.array_join("signals", ",").alias("signals"), recipe.alias("r"), F.explode(F.array(*map(F.lit, FIELDS))).alias("field"))
    return rows.select("page_id", "method", "confidence", "signals", "field", F.col("r")[F.col("field")].alias("value"))


def fixture_language(spark: SparkSession, d: str) -> DataFrame:
    """The language of documents as recipes: some state theirs, some come with html or a domain that tells it."""
    rows = spark.read.parquet(f"{d}/documents.parquet").selectExpr(
        "doc_id AS id", "text AS recipe_text", "CASE WHEN doc_id % 6 = 0 THEN upper(lang) END AS recipe_language",
        "CASE doc_id % 6 WHEN 1 THEN concat('<html lang=\"', lang, '_XX\">') WHEN 2 THEN concat('<meta property=\"og:locale\" content=\"', lang, '\">') WHEN 3 THEN concat('<meta name=\"language\" content=\"', lang, '\">') END AS html",
        "CASE doc_id % 5 WHEN 0 THEN 'e.dk' WHEN 1 THEN 'e.co.uk' WHEN 2 THEN 'e.se' WHEN 3 THEN 'e.com' END AS domain",
    )
    return LG.detected(rows).select("id", "language", F.round("language_confidence", 4).alias("confidence"), F.array_join("language_signals", ",").alias("signals"))


def fixture_links(spark: SparkSession, d: str) -> DataFrame:
    """Relative, protocol-relative and dotted links, and canonical links, on the pages' URLs."""
    html = F.concat(F.lit("<!-- <a href='/no'>no</a> --><link rel='canonical' href='/c/"), "page_id", F.lit("/?utm_source=y'><a href='opskrift/kage"), "page_id", F.lit("'>K</a><a href=../recipes/pie>P</a><a class=x href=\"?p=2&amp;q=&#49;\">2</a><a href='//f.dk/mad/x'>x</a><a href='#top'>T</a><a href='mailto:a@b'>m</a>"))
    pages = spark.read.parquet(f"{d}/pages.parquet").select("page_id", "url", html.alias("html"))
    links = L.candidates(L.explode_links(pages)).select("page_id", F.col("pos").cast("long").alias("pos"), "absolute_url", U.is_recipe_like(F.col("absolute_url")).alias("recipe_like"))
    return links.join(pages.select("page_id", P.canonical_url(F.col("html"), F.col("url")).alias("canonical_url")), "page_id")


def fixture_eligibility(spark: SparkSession, d: str) -> DataFrame:
    """Eligibility of URLs of every kind made of the pages' domains, with counters at and under their caps."""
    tail = F.element_at(F.array(*map(F.lit, ["/recipe/kage", "/login", "/category/x", "/x.WEBP", "/2024/05/"])), (F.col("page_id") % 5 + 1).cast("int"))
    domain = U.domain(F.col("url"))
    made = F.when(F.col("page_id") % 7 == 0, F.concat(F.lit("ftp://"), domain, tail)).when(F.col("page_id") % 11 == 0, domain).otherwise(F.concat(F.lit("https://"), domain, tail))
    counters = (F.when(F.col("page_id") % 13 == 0, C.DEFAULT.global_queue).otherwise(0), F.when(F.col("page_id") % 3 == 0, C.DEFAULT.pages_per_domain).otherwise(C.DEFAULT.pages_per_domain - 1))
    found = L.eligibility(made, F.col("page_id") % 2 == 0, *counters, F.lit(C.DEFAULT.pages_per_domain))
    return spark.read.parquet(f"{d}/pages.parquet").select("page_id", found.alias("e")).select("page_id", "e.allowed", F.array_join("e.reasons", ",").alias("reasons"))


def fixture_formats(spark: SparkSession, d: str) -> DataFrame:
    """Report formats, names of a run and lines of a process list, made of the events."""
    rows = spark.read.parquet(f"{d}/events.parquet").selectExpr(
        "event_id AS id", "event_id % 9 - 4 AS n", "(event_id % 2000 - 1000) / 1000D AS x", "CASE WHEN event_id % 5 = 0 THEN event_type ELSE concat_ws(' ', user_id, event_id, event_id % 100, event_type, '--x') END AS line",
        "transform(sequence(0, event_id % 12), i -> concat(event_type, i)) AS signals", "CASE WHEN event_id % 3 > 0 THEN concat(' run/', event_id, ' ') END AS run", "concat(event_type, '\n \t', repeat('z', cast(event_id % 400 AS int))) AS error", "CAST(ts AS timestamp) AS started",
    )
    p = T.process_row(F.col("line"))
    return rows.select(
        "id", T.delta(F.col("n")).alias("delta"), T.percent(F.col("x")).alias("percent"), T.percent_delta(F.col("x")).alias("points"), T.pad_left(F.col("n"), 4).alias("padded"), T.map_entries(F.create_map(F.lit("b"), "n", F.lit("a"), F.col("id"))).alias("entries"),
        T.mib(F.col("id") * 1572864).alias("mib"), T.first_signals(F.col("signals")).alias("signals"), T.squashed(F.col("error")).alias("error"), p["ppid"].alias("ppid"), p["pid"].alias("pid"), p["rss_bytes"].alias("rss_bytes"), p["command"].alias("command"),
        F.array_join(U.run_names(U.run_id(F.col("run"), F.col("started"))), " ").alias("names"),
    )


def page_rows(spark: SparkSession, d: str) -> DataFrame:
    """What is kept of each page: its URL, redirect, text length and html."""
    pages = spark.read.parquet(f"{d}/pages.parquet")
    loaded = F.when(F.length("html") > 1000, F.concat("url", F.lit("?moved=1"))).otherwise(F.col("url"))
    method = F.when(F.col("html").contains("ld+json"), "json-ld").otherwise("html-parsing")
    rows = pages.select("page_id", P.canonical_url(F.col("html"), F.col("url")).alias("canonical_url"), F.array_join(P.redirect_chain(F.col("url"), loaded), " ").alias("redirects"), F.length(LG.body_text(F.col("html"))).alias("body_length"), P.kept_html(F.col("html"), method, F.lit(1.0)).alias("html"))
    packed = P.zipped(rows)
    return packed.select("page_id", "canonical_url", "redirects", "body_length", F.col("html").isNotNull().alias("kept"))


def failed_pages(spark: SparkSession, d: str) -> DataFrame:
    """Rows of pages whose fetch failed for good: the error events, each as a page of its user."""
    events = spark.read.parquet(f"{d}/events.parquet").where("event_type = 'error'")
    rows = events.select(F.concat(F.lit("https://www.d"), "user_id", F.lit(".example/p/"), "event_id").alias("url"), F.col("ts").alias("fetched_at"), F.lit("cheerio").alias("mode"), F.lit("sitemap").alias("label"), F.lit(None).cast("string").alias("source_domain"), F.lit(None).cast("array<string>").alias("admission_signals"), F.lit(None).cast("string").alias("fallback_reason"))
    found = P.failed_rows(rows)
    return found.select("canonical_url", "domain", "http_status", "extraction_method", "language", "discovery_source", F.array_join("language_signals", ",").alias("language_signals"), F.size("admission_signals").cast("long").alias("n_signals"))


def routed_links(spark: SparkSession, d: str) -> DataFrame:
    """Links of the pages by queue and role, with a seed that needs a browser; and labels of rendered requests."""
    seeds = SD.seeds(spark).select("domain", "requires_js", "role").union(spark.createDataFrame([("example.com", True, "discovery")], "domain string, requires_js boolean, role string"))
    rows = P.routed(L.candidates(L.explode_links(spark.read.parquet(f"{d}/pages.parquet"))), seeds)
    label = P.rendered_label(F.col("pos") == 0, U.path(F.col("absolute_url")) == "/", F.col("pos") == 1, F.col("pos") == 2)
    return rows.groupBy("domain", "queue", "role", P.discovery_source(label).alias("source")).agg(F.count("*").alias("n"))


def request_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    events = spark.read.parquet(f"{d}/events.parquet")
    kind = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "retried").when(F.col("event_type") == "purchase", "finished").otherwise("started")
    rows = events.select(F.concat(F.lit("d"), F.pmod("user_id", F.lit(20))).alias("domain"), kind.alias("kind"), F.lit(2).alias("recipes"), F.col("event_id").alias("millis"))
    return P.diagnostics(rows).withColumn("mean_millis", F.round("mean_millis", 4))


def seed_rows(spark: SparkSession, d: str) -> DataFrame:
    """The pages' domains as seeds: their first and last URLs are start URLs and sitemaps."""
    return spark.read.parquet(f"{d}/pages.parquet").groupBy(U.domain(F.col("url")).alias("domain")).agg(F.array(F.min(U.path(F.col("url"))), F.max("url"), F.min(U.path(F.col("url")))).alias("start_urls"), F.min("url").alias("sitemap_url"), F.max("url").alias("last_url"), (F.count("*") * 10).cast("int").alias("max_pages"), (F.min("page_id") >= 0).alias("respect_robots"))


def seed_start_urls(spark: SparkSession, d: str) -> DataFrame:
    return SD.start_urls(seed_rows(spark, d))


def seed_totals(spark: SparkSession, d: str) -> DataFrame:
    return SD.should_respect_robots(seed_rows(spark, d))


def sitemap_union(spark: SparkSession, d: str) -> DataFrame:
    found = F.array(F.concat(F.lit("https://"), "domain", F.lit("/sitemap.xml")), F.col("last_url"))
    return seed_rows(spark, d).select("domain", F.explode(SD.sitemap_sources(F.array("sitemap_url"), found)).alias("url"))


def sitemap_roots(spark: SparkSession, d: str) -> DataFrame:
    roots = SD.sitemap_roots(F.concat(F.lit("www."), F.upper("domain")), F.array("sitemap_url", F.lit("nonsense"), "last_url"))
    return seed_rows(spark, d).select("domain", F.array_join(roots, " ").alias("roots"))


def page_paths(spark: SparkSession, d: str) -> DataFrame:
    """Pages by path, without those of known paths, and whether the older rule follows them."""
    hits = M.hits_by_path(spark.read.parquet(f"{d}/pages.parquet"))
    new = S.without(hits, spark.createDataFrame([("/",)], "path string"), "path")
    older = L.follow_legacy(F.col("path").contains("1"), F.col("hits") > 1, F.pmod("hits", F.lit(3)))
    return new.select("path", "hits", older.alias("older"))


def top_suppliers(spark: SparkSession, d: str) -> DataFrame:
    """The three largest of a list of processes, as suppliers with their balance for the size."""
    rows = spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").alias("pid"), F.col("s_acctbal").alias("rss"))
    return M.top(rows, "rss", "pid", 3)


def role_totals(spark: SparkSession, d: str) -> DataFrame:
    """Characters by conversation from a map by role, and the roles that are of the usual ones."""
    said = spark.read.parquet(f"{d}/conversations.parquet").where("role is not null").groupBy("conv_id", "role").agg(F.sum(F.length(F.coalesce("text", F.lit("")))).alias("n"))
    maps = said.groupBy("conv_id").agg(F.map_from_entries(F.collect_list(F.struct("role", "n"))).alias("m"))
    usual = F.array(F.lit("assistant"), F.lit("user"))
    return maps.select("conv_id", M.map_total(F.col("m")).alias("total"), F.array_join(S.common(usual, F.map_keys("m")), ",").alias("usual"))


def _case(i: int, quoted: bool = False) -> str:
    """Column ``i`` of FOUND, by layout."""
    return f"CASE page_id % {len(LAYOUTS)} " + " ".join(f"WHEN {j} THEN '{x[i]}'" if quoted else f"WHEN {j} THEN {x[i]}" for j, x in enumerate(FOUND)) + " END"


def oracles(canon, domain, links: str, path, clean, code, keywords: str) -> dict[str, str]:
    """SQL of these queries; the pieces are those of the other queries' SQL."""
    body = "regexp_replace(CASE WHEN regexp_matches(html, '(?is)<body[^>]*>.') THEN regexp_extract(html, '(?is)<body[^>]*>(.*?)(?:</body\\s*>|\\z)', 1) ELSE regexp_replace(html, '(?is)<head[\\s>].*?</head\\s*>', '', 'g') END, '(?s)<!--.*?-->|<[^>]+>', '', 'g')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        body = f"replace({body}, '{entity}', '{char}')"
    seeds = f"s AS (SELECT {domain('url')} AS domain, min({path('url')}) AS first_path, min(url) AS first_url, max(url) AS last_url, count(*) AS n FROM pages GROUP BY 1)"
    return {
        "fixture_extract": f"""WITH p AS (SELECT p_partkey AS page_id, p_partkey AS k, p_name AS n, p_brand AS b, p_type AS t, p_size AS s FROM part)
          SELECT page_id, CASE WHEN page_id % {len(LAYOUTS)} = 4 THEN 'json-ld' ELSE 'html-parsing' END AS method, {_case(0)}::DOUBLE AS confidence, {_case(1, True)} AS signals, unnest({FIELDS}) AS field, unnest([{", ".join(_case(i + 2) for i in range(len(FIELDS)))}]) AS value FROM p""",
        "fixture_language": f"""WITH i AS (SELECT doc_id AS id, lang, text, doc_id % 6 AS kind, CASE doc_id % 5 WHEN 0 THEN 'da' WHEN 1 THEN 'en' WHEN 2 THEN 'sv' END AS hint,
            CASE doc_id % 6 WHEN 1 THEN '<html lang="' || lang || '_XX">' WHEN 2 THEN '<meta property="og:locale" content="' || lang || '">' WHEN 3 THEN '<meta name="language" content="' || lang || '">' END AS html, {code('lang')} AS code FROM documents),
          t AS (SELECT *, lower({clean("concat_ws(' ', nullif(text, ''), html)")}) AS t FROM i), k(l, words) AS (VALUES {keywords}),
          s AS (SELECT id, hint, kind, code, length(t) AS len, l, cast(list_sum(list_transform(words, lambda w: (length(t) - length(replace(t, w, ''))) // length(w))) AS INTEGER) AS score FROM t, k),
          r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, (l = hint) IS TRUE DESC, l) AS rn FROM s),
          o AS (SELECT *, kind < 4 AND code IS NOT NULL AS stated, len >= 20 AND score >= 2 AS told FROM r WHERE rn = 1)
          SELECT id, CASE WHEN stated THEN code WHEN told THEN l ELSE coalesce(hint, 'und') END AS language,
            round(CASE WHEN stated THEN [1.0, 0.95, 0.9, 0.85][kind + 1]::DOUBLE WHEN told THEN least(0.55::DOUBLE + 0.05::DOUBLE * score, 0.85::DOUBLE) WHEN hint IS NOT NULL THEN 0.45 ELSE 0 END, 4)::DOUBLE AS confidence,
            CASE WHEN stated THEN ['recipe-inLanguage', 'html-lang', 'og-locale', 'meta-language'][kind + 1] WHEN told THEN 'text-keywords:' || l || ':' || score || CASE WHEN l = hint THEN ',domain-hint:' || hint ELSE '' END WHEN hint IS NOT NULL THEN 'domain-hint:' || hint ELSE 'language-undetected' END AS signals FROM o""",
        "fixture_links": f"""WITH u AS (SELECT page_id, url, regexp_extract(url, '^([^:]+)', 1) AS scheme, regexp_extract(url, '^([^:]+://[^/?#]*)', 1) AS origin, regexp_extract({path('url')}, '^(.*/)', 1) AS folder, regexp_extract(url, '^([^?#]*)', 1) AS bare, regexp_extract(url, '^([^#]*)', 1) AS whole, {domain('url')} AS dom FROM pages)
          SELECT page_id, unnest([0, 1, 2, 3, 4])::BIGINT AS pos, unnest([origin || folder || 'opskrift/kage' || page_id, origin || regexp_replace(folder, '[^/]+/$', '') || 'recipes/pie', bare || '?p=2&q=1', scheme || '://f.dk/mad/x', whole || '#top']) AS absolute_url,
            unnest([true, true, false, true, false]) AS recipe_like, scheme || '://' || dom || '/c/' || page_id AS canonical_url FROM u""",
        "fixture_eligibility": f"""WITH u AS (SELECT page_id, page_id % 5 AS kind, CASE WHEN page_id % 13 = 0 THEN 'global-queue-cap' WHEN page_id % 7 = 0 THEN 'unsupported-protocol' WHEN page_id % 11 = 0 THEN 'invalid-url' WHEN page_id % 5 = 3 THEN 'skip-extension' WHEN page_id % 5 = 1 THEN 'hard-denylist-pattern'
            WHEN page_id % 5 IN (2, 4) AND page_id % 2 = 1 THEN 'soft-discovery-pattern' WHEN page_id % 3 = 0 THEN 'domain-page-cap' WHEN page_id % 5 IN (2, 4) THEN 'queue-eligible,trusted-soft-discovery' ELSE 'queue-eligible' END AS reasons FROM pages)
          SELECT page_id, starts_with(reasons, 'queue-eligible') AS allowed, reasons FROM u""",
        "fixture_formats": f"""WITH e AS (SELECT *, event_id % 9 - 4 AS n, (event_id % 2000 - 1000) / 1000::DOUBLE AS x, event_id % 5 > 0 AS line, CASE WHEN event_id % 3 > 0 THEN 'run-' || event_id ELSE strftime(ts, '%Y-%m-%dT%H-%M-%S.%g') || 'Z' END AS run FROM events)
          SELECT event_id AS id, CASE WHEN n > 0 THEN '+' ELSE '' END || n AS delta, printf('%.1f%%', x * 100) AS percent, CASE WHEN x > 0 THEN '+' ELSE '' END || printf('%.1fpp', x * 100) AS points, CASE WHEN n < 0 THEN '  ' ELSE '   ' END || n AS padded,
            'a=' || event_id || ', b=' || n AS entries, round(event_id * 1.5::DOUBLE, 1) AS mib, array_to_string(list_transform(range(0, least(event_id % 12 + 1, 8)), lambda i: event_type || i), '|') || CASE WHEN event_id % 12 + 1 > 8 THEN '|+' || (event_id % 12 - 7) ELSE '' END AS signals,
            left(event_type || ' ' || repeat('z', event_id % 400), 300) AS error, CASE WHEN line THEN user_id END AS ppid, CASE WHEN line THEN event_id END AS pid, CASE WHEN line THEN event_id % 100 * 1024 END AS rss_bytes, CASE WHEN line THEN event_type || ' --x' END AS command,
            {" || ' ' || ".join(f"'{n}-' || run" for n in U.RUN_NAMES)} AS names FROM e""",
        "seed_start_urls": f"""WITH {seeds}, l AS (SELECT domain, ['https://' || domain, 'https://' || domain || first_path, last_url] AS u FROM s), v AS (SELECT domain, list_filter(u, lambda x, i: list_position(u, x) = i) AS u FROM l)
          SELECT domain, cast(unnest(range(0, len(u))) AS INTEGER) AS pos, unnest(u) AS url FROM v""",
        "seed_totals": f"WITH {seeds} SELECT count(*) > 0 AS respect_robots, cast(sum(n * 10) AS BIGINT) AS max_requests FROM s",
        "sitemap_union": f"WITH {seeds} SELECT domain, url FROM (SELECT domain, first_url AS url FROM s UNION SELECT domain, 'https://' || domain || '/sitemap.xml' FROM s UNION SELECT domain, last_url FROM s)",
        "sitemap_roots": f"""WITH {seeds}, l AS (SELECT domain, ['https://' || domain, lower(regexp_extract(first_url, '^([^:]+://[^/?#]+)', 1)), lower(regexp_extract(last_url, '^([^:]+://[^/?#]+)', 1))] AS u FROM s)
          SELECT domain, array_to_string(list_filter(u, lambda x, i: list_position(u, x) = i), ' ') AS roots FROM l""",
        "page_rows": f"SELECT page_id, {canon('url')} AS canonical_url, CASE WHEN length(html) > 1000 THEN url || ' ' || url || '?moved=1' END AS redirects, cast(length({body}) AS INTEGER) AS body_length, NOT contains(html, 'ld+json') AS kept FROM pages",
        "failed_pages": "SELECT 'https://d' || user_id || '.example/p/' || event_id AS canonical_url, 'd' || user_id || '.example' AS domain, 0 AS http_status, 'failed' AS extraction_method, 'und' AS language, 'sitemap' AS discovery_source, 'language-undetected' AS language_signals, 0::BIGINT AS n_signals FROM events WHERE event_type = 'error'",
        "routed_links": f"WITH {links}, s AS (SELECT *, CASE WHEN pos = 0 THEN 'playwright-fallback' WHEN {path('absolute_url')} = '/' THEN 'seed-root' WHEN pos = 1 THEN 'sitemap' WHEN pos = 2 THEN 'playwright-fallback' ELSE 'discovered' END AS source FROM c) SELECT domain, CASE WHEN domain = 'example.com' THEN 'playwright' ELSE 'cheerio' END AS queue, CASE WHEN domain = 'example.com' THEN 'discovery' ELSE 'trusted' END AS role, source, count(*) AS n FROM s GROUP BY ALL",
        "page_paths": f"SELECT path, hits, contains(path, '1') OR (hits > 1 AND hits % 3 < {C.DEFAULT.off_domain_hops}) AS older FROM (SELECT {path('url')} AS path, count(*) AS hits FROM pages GROUP BY 1) WHERE path <> '/'",
        "top_suppliers": "SELECT s_suppkey AS pid, s_acctbal AS rss FROM supplier ORDER BY rss DESC, pid LIMIT 3",
        "role_totals": "SELECT conv_id, cast(sum(length(coalesce(text, ''))) AS BIGINT) AS total, CASE WHEN bool_or(role = 'assistant') AND bool_or(role = 'user') THEN 'assistant,user' WHEN bool_or(role = 'assistant') THEN 'assistant' WHEN bool_or(role = 'user') THEN 'user' ELSE '' END AS usual FROM conversations WHERE role IS NOT NULL GROUP BY conv_id",
        "request_diagnostics": "WITH e AS (SELECT 'd' || (user_id % 20) AS domain, CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'retried' WHEN 'purchase' THEN 'finished' ELSE 'started' END AS kind, event_id FROM events) SELECT domain, count(*) FILTER (kind = 'started') AS started, count(*) FILTER (kind = 'finished') AS finished, count(*) FILTER (kind = 'failed') AS failed, count(*) FILTER (kind = 'retried') AS retried, 2 * count(*) FILTER (kind = 'finished') AS recipes, cast(coalesce(sum(event_id) FILTER (kind = 'finished'), 0) AS BIGINT) AS millis, coalesce(max(event_id) FILTER (kind = 'finished'), 0) AS max_millis, round(coalesce(avg(event_id) FILTER (kind = 'finished'), 0), 4) AS mean_millis FROM e GROUP BY domain",
    }


QUERIES = {f.__name__: f for f in (seed_start_urls, seed_totals, sitemap_union, fixture_extract, fixture_language, fixture_links, fixture_eligibility, fixture_formats, page_rows, failed_pages, routed_links, request_diagnostics, sitemap_roots, page_paths, top_suppliers, role_totals)}
