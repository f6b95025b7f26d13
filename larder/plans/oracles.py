"""DuckDB SQL for the queries: written on its own, from what the operators mean."""

from __future__ import annotations

from larder import constants as C
from larder.plans.queries import TRUSTED

_ANCHOR = r"""(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>"""
_WHITE = "[" + "".join(f"\\x{{{c:X}}}" for c in C.WHITE_CODES) + "]+"
_SCHEME = "^([A-Za-z][A-Za-z0-9+.-]*)://"


def clean(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{_WHITE}', ' ', 'g'))"


def domain(u: str) -> str:
    return f"nullif(regexp_replace(lower(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)), '^www\\.', ''), '')"


def path(u: str) -> str:
    return f"coalesce(nullif(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), ''), '/')"


def canon(u: str) -> str:
    p = f"regexp_replace(array_to_string(list_transform(string_split({path(u)}, ''), lambda ch: CASE WHEN regexp_matches(ch, '[^!-~]') THEN url_encode(ch) ELSE ch END), ''), '^/(?:amp|m)/', '/')"
    params = f"list_sort(list_transform(list_filter(string_split(regexp_extract({u}, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '(?i)^({'|'.join(C.STRIP_PARAMS)})(=|$)')), lambda p: CASE WHEN contains(p, '=') THEN p ELSE p || '=' END))"
    query = f"array_to_string({params}, '&')"
    return f"(lower(regexp_extract({u}, '{_SCHEME}', 1)) || '://' || regexp_replace(lower(regexp_extract({u}, '^[^:]+://([^/?#]+)', 1)), '^www\\.', '') || CASE WHEN {p} = '/' THEN '/' ELSE regexp_replace({p}, '/$', '') END || CASE WHEN {query} = '' THEN '' ELSE '?' || {query} END)"


def any_of(patterns: list[str]) -> str:
    return "(?i)(?:" + "|".join(patterns) + ")"


def language_code(x: str) -> str:
    s = f"replace(lower(trim({x})), '_', '-')"
    return f"CASE WHEN {s} = 'dk' OR starts_with({s}, 'da') THEN 'da' WHEN starts_with({s}, 'en') THEN 'en' WHEN starts_with({s}, 'sv') OR starts_with({s}, 'se') THEN 'sv' WHEN starts_with({s}, 'no') OR starts_with({s}, 'nb') OR starts_with({s}, 'nn') THEN 'no' WHEN starts_with({s}, 'de') THEN 'de' END"


LINKS = f"""l AS (SELECT page_id, url, unnest(range(0, len(h))) AS pos, unnest(h) AS href, unnest(t) AS raw FROM
  (SELECT page_id, url, regexp_extract_all(html, '{_ANCHOR}', 1) AS h, regexp_extract_all(html, '{_ANCHOR}', 2) AS t FROM pages)),
links AS (SELECT page_id, url, pos, href, {clean("regexp_replace(raw, '<[^>]+>', '', 'g')")} AS anchor_text FROM l),
a AS (SELECT *, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href WHEN starts_with(href, '//') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) || ':' || href
  WHEN starts_with(href, '/') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || href END AS absolute_url FROM links),
c AS (SELECT *, {canon("absolute_url")} AS canonical_url, {domain("absolute_url")} AS domain FROM a WHERE regexp_matches(lower(absolute_url), '^https?:'))"""

_PATH = path("absolute_url")
_SOFT = f"(regexp_matches({_PATH}, '{any_of(C.SOFT_PATHS)}') OR regexp_matches({_PATH}, '{C.DATE_PATH}'))"
_RECIPE = f"regexp_matches({_PATH}, '{any_of(C.RECIPE_PATHS)}')"
_ANCHORED = "(" + " OR ".join(f"contains(lower(anchor_text), '{k}')" for k in C.ANCHOR_KEYWORDS) + ")"


def eligible(soft: str) -> str:
    return f"""CASE WHEN regexp_matches({_PATH}, '(?i){C.SKIP_EXTENSIONS}') THEN 'skip-extension' WHEN regexp_matches({_PATH}, '{any_of(C.HARD_DENY_PATHS)}') THEN 'hard-denylist-pattern'
  WHEN {_SOFT} AND NOT ({soft}) THEN 'soft-discovery-pattern' WHEN {_SOFT} THEN 'queue-eligible,trusted-soft-discovery' ELSE 'queue-eligible' END"""


ADMITTED = f"""{LINKS},
b AS (SELECT * REPLACE (CASE WHEN pos % 3 = 2 THEN 'other.example.org' ELSE domain END AS domain), {domain("url")} AS source_domain, page_id % 3 = 0 AS sitemap, page_id % 5 = 0 AS rec FROM c),
e AS (SELECT *, ends_with(source_domain, '{TRUSTED}') AS tr, ends_with(domain, '{TRUSTED}') AS dt, domain <> source_domain AS cross_domain, {_RECIPE} AS rl, {_ANCHORED} AS ra FROM b),
f AS (SELECT *, {eligible("tr")} AS el, rl::INT + ra::INT + sitemap::INT + 2 * rec::INT AS s FROM e),
g AS (SELECT *, CASE WHEN NOT cross_domain AND tr AND dt THEN 'same-domain-trusted-seed' WHEN NOT cross_domain AND (tr OR s > 0) THEN 'same-domain-admission' WHEN NOT cross_domain THEN 'same-domain-insufficient-evidence'
  WHEN NOT tr THEN 'cross-domain-untrusted-source' WHEN s < {C.DEFAULT.min_cross_domain_score} THEN 'cross-domain-insufficient-evidence' ELSE 'trusted-cross-domain-admission' END AS v, starts_with(el, 'queue-eligible') AS ok FROM f),
adm AS (SELECT *, ok AND v IN ('same-domain-trusted-seed', 'same-domain-admission', 'trusted-cross-domain-admission') AS allowed,
  CASE WHEN NOT ok THEN 0 WHEN v = 'same-domain-trusted-seed' THEN greatest(s, 1) ELSE s END AS score,
  CASE WHEN NOT ok THEN el ELSE concat_ws(',', el, CASE WHEN rl THEN 'recipe-like-url' END, CASE WHEN ra THEN 'recipe-anchor-text' END, CASE WHEN sitemap THEN 'sitemap-source' END, CASE WHEN rec THEN 'source-recipe-page,source-recipe-signals' END, v) END AS reasons FROM g)"""

_H = "(regexp_extract(html, '(?i)<html[^>]*\\blang=[\"'']?([A-Za-z_-]+)', 1))"
_KEYWORDS = ", ".join(f"('{lang}', {words})" for lang, words in C.TEXT_KEYWORDS.items())
_EVENTS = "ev AS (SELECT 'd' || (user_id % 20) AS domain, CASE event_type WHEN 'error' THEN 'fallback' WHEN 'signup' THEN 'skip' ELSE 'page' END AS kind, CASE WHEN event_id % 4 = 0 THEN 'playwright' ELSE 'cheerio' END AS mode, event_id % 3 AS recipes FROM events)"
_RUNS = "runs AS (SELECT strftime(ts, '%Y-%m-%d') AS run, count(*) AS pages, count(*) FILTER (event_type = 'purchase') AS recipes, max(ts) AS finished_at FROM events GROUP BY 1)"
_ASKED = f"asked AS (SELECT DISTINCT {canon('url')} AS canonical_url FROM pages), fresh AS (SELECT {canon('url')} AS canonical_url FROM pages WHERE TIMESTAMP '2024-01-01' + to_days(cast(page_id % 60 AS INTEGER)) >= TIMESTAMP '2024-02-20' - INTERVAL 30 DAY)"
_BREAKS = "replace(regexp_replace(regexp_replace(regexp_replace(html, '(?i)<br\\s*/?>', chr(10), 'g'), '(?i)</(?:p|div|li|h[1-6]|tr|section|article)>', chr(10), 'g'), '<[^>]+>', '', 'g'), '&nbsp;', ' ')"
_PARTS = f"list_distinct(list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '(\\.)\\s+([A-ZÆØÅ])', '\\1' || chr(10) || '\\2', 'g'), '\\n+|•'), lambda x: {clean('x')}), lambda x: x <> ''))"

ORACLES = {
    "url_canonical": f"SELECT page_id, {canon('url')} AS canonical_url, {domain('url')} AS domain, true AS is_http FROM pages",
    "storage_keys": "SELECT page_id, k AS storage_key, 'queue-' || k AS queue_key FROM (SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(url, '[^a-zA-Z0-9._-]+', '-', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g'), ''), 'run') AS k FROM pages)",
    "page_hash": "SELECT page_id, sha256(html) AS page_content_hash FROM pages",
    "page_language_meta": f"SELECT page_id, coalesce({language_code(_H)}, 'und') AS language, CASE WHEN {language_code(_H)} IS NULL THEN 0.0::DOUBLE ELSE 0.95::DOUBLE END AS confidence FROM pages",
    "text_language": f"""WITH k(lang, words) AS (VALUES {_KEYWORDS}), t AS (SELECT doc_id, lower({clean('text')}) AS t FROM documents),
      s AS (SELECT doc_id, length(t) AS n, lang, cast(list_sum(list_transform(words, lambda w: (length(t) - length(replace(t, w, ''))) / length(w))) AS INTEGER) AS score FROM t, k),
      r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) AS rn FROM s)
      SELECT doc_id, CASE WHEN n >= 20 AND score >= 2 THEN lang ELSE 'und' END AS language, round(CASE WHEN n >= 20 AND score >= 2 THEN least(0.55::DOUBLE + 0.05::DOUBLE * score, 0.85::DOUBLE) ELSE 0 END, 4) AS confidence,
        CASE WHEN n >= 20 AND score >= 2 THEN score ELSE 0 END AS score FROM r WHERE rn = 1""",
    "language_counts": "SELECT lang, count(*) AS n FROM documents GROUP BY lang",
    "clean_text": f"SELECT doc_id, sha256({clean('text')}) AS clean_sha FROM documents",
    "text_with_breaks": f"SELECT page_id, sha256({_BREAKS}) AS text_sha, list_filter(list_transform(string_split({_BREAKS}, chr(10)), lambda x: {clean('x')}), lambda x: x <> '')[1] AS heading FROM pages",
    "sentence_split": f"SELECT doc_id, cast(len({_PARTS}) AS BIGINT) AS n_parts, sha256(array_to_string(list_sort({_PARTS}), '|')) AS parts_sha FROM documents",
    "title_heuristic": f"SELECT page_id, nullif({clean('''regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]+>', '', 'g')''')}, '') AS title FROM pages",
    "links_explode": f"WITH {LINKS} SELECT page_id, pos, href, anchor_text FROM links",
    "links_absolute": f"WITH {LINKS} SELECT page_id, pos, absolute_url, canonical_url, domain FROM c",
    "links_first_seen": f"WITH {LINKS} SELECT canonical_url, page_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY canonical_url ORDER BY page_id, pos) AS rn FROM c) WHERE rn = 1",
    "anchor_keyword": f"WITH {LINKS} SELECT page_id, pos, {_ANCHORED} AS recipe_anchor FROM links",
    "queue_eligibility": f"WITH {LINKS}, q AS (SELECT page_id, pos, {eligible('page_id % 2 = 0')} AS reasons FROM c) SELECT page_id, pos, starts_with(reasons, 'queue-eligible') AS allowed, reasons FROM q",
    "admission": f"WITH {ADMITTED} SELECT page_id, pos, allowed, score, cross_domain, reasons FROM adm",
    "follow_links": f"WITH {ADMITTED} SELECT page_id, pos, CASE WHEN NOT allowed THEN false WHEN rl THEN true WHEN cross_domain THEN page_id % 4 < {C.DEFAULT.off_domain_hops} WHEN tr THEN page_id % 4 < {C.DEFAULT.trusted_hops} ELSE false END AS follow FROM adm",
    "request_label": f"SELECT page_id, CASE WHEN {path('url')} = '/' THEN 'seed-root' WHEN page_id % 3 = 0 THEN 'sitemap' WHEN page_id % 5 = 0 THEN 'playwright-fallback' ELSE 'discovered' END AS label FROM pages",
    "blocked_reasons": f"WITH {ADMITTED} SELECT domain, reason, count(*) AS n FROM (SELECT domain, unnest(string_split(reasons, ',')) AS reason FROM adm WHERE NOT allowed) GROUP BY ALL",
    "off_domain": f"WITH {ADMITTED} SELECT source_domain, count(*) AS admissions, array_to_string(list_sort(list(DISTINCT domain)), ',') AS new_domains FROM adm WHERE allowed AND cross_domain GROUP BY source_domain",
    "domain_caps": f"WITH {LINKS}, f AS (SELECT *, row_number() OVER (PARTITION BY canonical_url ORDER BY page_id, pos) AS rn FROM c), r AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY page_id, pos) AS k FROM f WHERE rn = 1) SELECT canonical_url, domain FROM r WHERE k <= {C.DEFAULT.pages_per_domain} ORDER BY page_id, pos LIMIT {C.DEFAULT.global_queue}",
    "fallback_reason": f"SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN length(text) < {C.MIN_BODY_TEXT_LENGTH} THEN 'thin-content' WHEN {' OR '.join(f'''contains(text, '{m}')''' for m in C.JS_MARKERS)} THEN 'js-markers' WHEN doc_id % 3 = 0 THEN 'sitemap-page' WHEN doc_id % 4 >= 2 THEN 'high-value-discovery' END AS reason FROM documents",
    "fresh_semi": f"WITH {_ASKED} SELECT canonical_url FROM asked WHERE canonical_url IN (SELECT canonical_url FROM fresh)",
    "fresh_anti": f"WITH {_ASKED} SELECT canonical_url FROM asked WHERE canonical_url NOT IN (SELECT canonical_url FROM fresh)",
    "upsert_latest": "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) FILTER (event_id % 3 = 0 AND value IS NOT NULL) AS value FROM events GROUP BY user_id",
    "recipes_keep_best": "SELECT content_hash, doc_id, confidence FROM (SELECT sha256(text) AS content_hash, doc_id, (doc_id % 4) / 4.0::DOUBLE AS confidence, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id % 4 DESC, doc_id) AS rn FROM documents) WHERE rn = 1",
    "recipes_per_page": "SELECT source, count(*) AS n, count(*) FILTER (quality = 1) AS good FROM documents JOIN labels USING (doc_id) GROUP BY source",
    "domain_metrics": f"""WITH {_EVENTS}, m AS (SELECT CASE WHEN grouping(domain) = 1 THEN 'all' ELSE domain END AS domain, count(*) FILTER (kind = 'page') AS processed, count(*) FILTER (kind = 'page' AND mode = 'cheerio') AS cheerio,
      count(*) FILTER (kind = 'page' AND recipes > 0) AS recipe_pages, cast(coalesce(sum(recipes) FILTER (kind = 'page'), 0) AS BIGINT) AS extracted, count(*) FILTER (kind = 'fallback') AS fallbacks, count(*) FILTER (kind = 'skip') AS skips FROM ev GROUP BY ROLLUP (domain))
      SELECT *, round(CASE WHEN processed = 0 THEN 0 ELSE recipe_pages::DOUBLE / processed END, 6) AS recipe_page_yield, round(CASE WHEN cheerio = 0 THEN 0 ELSE fallbacks::DOUBLE / cheerio END, 6) AS fallback_rate FROM m""",
    "fallback_histogram": "SELECT CASE WHEN event_id % 2 = 0 THEN 'thin-content' ELSE 'unspecified' END AS reason, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1",
    "run_report": f"WITH {_RUNS} SELECT run, pages, recipes, printf('%.1f%%', floor(1000 * recipes::DOUBLE / pages + 0.5) / 10) AS yield FROM runs ORDER BY finished_at DESC LIMIT 10",
    "run_delta": f"WITH {_RUNS} SELECT run, pages - lag(pages) OVER (ORDER BY finished_at) AS delta_pages, recipes - lag(recipes) OVER (ORDER BY finished_at) AS delta_recipes FROM runs",
    "run_retention": f"WITH {_RUNS} SELECT run, pages FROM runs WHERE finished_at > TIMESTAMP '2024-04-09 12:00:00' - INTERVAL 90 DAY",
    "top_domains": "SELECT user_id % 20 AS domain, count(*) AS processed FROM events GROUP BY 1 ORDER BY processed DESC, domain LIMIT 5",
    "start_gaps": "WITH g AS (SELECT event_type AS domain, event_id, ts, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id)) AS gap FROM events) SELECT domain, count(*) AS started, count(gap) AS gaps, cast(coalesce(sum(gap), 0) AS BIGINT) AS gap_sum, coalesce(max(gap), 0) AS gap_max, arg_max(event_id, (ts, event_id)) AS latest_id FROM g GROUP BY domain",
    "nth_sample": "SELECT domain, id, rn FROM (SELECT event_type AS domain, event_id AS id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1 OR rn % 25 = 0",
    "props_variant": "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "domain_yield": f"""WITH p AS (SELECT {domain('url')} AS domain, {language_code(_H)} AS language, len(regexp_extract_all(html, '{_ANCHOR}', 1)) AS links FROM pages)
      SELECT CASE WHEN grouping(domain) = 1 THEN 'all' ELSE domain END AS domain, count(*) AS pages, count(DISTINCT language) AS languages, cast(sum(links) AS BIGINT) AS links FROM p GROUP BY ROLLUP (domain)""",
}
