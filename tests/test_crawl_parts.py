import gzip
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from larder.operators import metrics as M
from larder.operators import pages as P
from larder.operators import store as S
from larder.operators import trees
from larder.sources import sitemaps


@pytest.mark.parametrize(
    "rules,path,allowed",
    [
        ([], "/x", True),
        ([(False, "/")], "/x", False),
        ([(False, "/"), (True, "/x")], "/x/y", True),
        ([(False, "/x"), (True, "/x")], "/x", True),  # as long: allowed
        ([(False, "/x/y"), (True, "/x")], "/x/y", False),
        ([(False, "")], "/x", True),
        ([(False, "/*.php$")], "/a/b.php", False),
        ([(False, "/*.php$")], "/a/b.php?x=1", True),
        ([(False, "/a*c")], "/abbc/d", False),
        ([(False, "*/print")], "/a/print", False),
        ([(False, "/a$")], "/ab", True),
        ([(False, "/q?x=")], "/q?x=1", False),
        ([(False, "/a(b)+.[c]")], "/a(b)+.[c]d", False),
        ([(True, "/shop/*/open"), (False, "/shop/")], "/shop/12/open", True),
    ],
)
def test_robots(spark, rules, path, allowed):
    links = spark.createDataFrame([("e.dk", f"https://e.dk{path}", 1), ("other.dk", f"https://other.dk{path}", 2)], "domain string, absolute_url string, head int")
    table = spark.createDataFrame([("e.dk", *r) for r in rules], "domain string, allow boolean, pattern string")
    found = P.allowed_by_robots(links, table)
    assert found.columns == links.columns and sorted(r["head"] for r in found.collect()) == ([1, 2] if allowed else [2])


def test_trees(spark):
    deep = [(i, i - 1) for i in range(1, 1001)] + [(0, None)]
    odd = [(2000, 2000), (2001, 2000), (3001, 3002), (3002, 3001), (3003, 3001), (4000, 9999), (None, 1)]
    rows = spark.createDataFrame(deep + odd, "pid long, ppid long").withColumn("root", F.lit("clash")).drop("root")
    found = {r["pid"]: (r["root"], r["depth"]) for r in trees.rooted(rows).collect()}
    assert all(found[i] == (0, i) for i in range(1001))
    assert {k: found[k] for k in found if k is None or k >= 2000} == {2000: (2000, 0), 2001: (2000, 1), 3001: (None, None), 3002: (None, None), 3003: (None, None), 4000: (4000, 0), None: (None, None)}
    assert trees.rooted(rows.limit(0)).count() == 0
    sizes = trees.totals(spark.createDataFrame([(1, None, 5), (2, 1, 7), (3, 1, 8)], "pid long, ppid long, rss long"), "rss")
    assert sorted(map(tuple, sizes.collect())) == [(1, 0, 1, 5), (1, 1, 2, 15)]


def test_sitemaps_of_any_depth(spark, tmp_path):
    chain = {f"i{n}.xml": f"<sitemapindex><sitemap><loc>https://m/i{n + 1}.xml</loc></sitemap><sitemap><loc>https://m/i0.xml</loc></sitemap></sitemapindex>" for n in range(4)}
    files = chain | {
        "i4.xml": "<sitemapindex xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'><sitemap><loc>https://m/a.xml.gz</loc></sitemap><sitemap><loc>https://m/broken.xml</loc></sitemap><sitemap><loc>https://m/gone.xml</loc></sitemap><sitemap><loc>https://m/empty.xml</loc></sitemap></sitemapindex>",
        "a.xml.gz": "<urlset><url><loc>\n https://e.dk/?a=1&amp;b=2 </loc><lastmod>2024-05-06</lastmod><image><loc>https://e.dk/pic</loc></image></url><url><lastmod>x</lastmod></url><url><loc>https://e.dk/b</loc></url></urlset>",
        "broken.xml": "<urlset><url><loc>https://e.dk/c</loc></url><url><loc>https://e.dk/d</lo",
        "empty.xml": "",
    }
    rows = spark.createDataFrame(list(files.items()), "name string, value string")
    assert sitemaps.written(rows, f"file://{tmp_path}") == len(files)
    assert gzip.decompress((tmp_path / "a.xml.gz").read_bytes()).decode() == files["a.xml.gz"]
    place = F.concat(F.lit(f"file://{tmp_path}/"), F.regexp_extract("loc", r"([^/]+)$", 1))
    found = sitemaps.followed(spark.createDataFrame([("https://m/i0.xml",)], "loc string"), place)
    assert sorted(map(tuple, found.collect())) == [("https://e.dk/?a=1&b=2", "2024-05-06", 5), ("https://e.dk/b", None, 5), ("https://e.dk/c", None, 5)]
    assert sitemaps.followed(spark.createDataFrame([(None,)], "loc string"), place).count() == 0


def test_summary_of_a_crawl(spark):
    rows = [
        ("page", "Zebra.dk", "cheerio", 2, "da", None, None), ("page", "aben.dk", "playwright", 0, None, None, None), ("page", "Zebra.dk", "cheerio", 1, "en", None, None), ("fallback", "Zebra.dk", "cheerio", None, None, None, None),
        ("skip", "aben.dk", "playwright", None, None, None, None), ("blocked", "Åben.dk", "cheerio", None, None, "soft", None), ("off-domain", "aben.dk", "cheerio", None, None, None, "new.dk"),
    ]
    one = M.summary(spark.createDataFrame(rows, "kind string, domain string, mode string, recipes int, language string, reason string, target string")).first()
    assert [d["domain"] for d in one["domains"]] == ["aben.dk", "Åben.dk", "Zebra.dk"]
    assert (one["totals"]["processed"], one["totals"]["recipes"], one["totals"]["recipe_page_yield"], one["totals"]["fallback_rate"]) == (3, 3, 2 / 3, 0.5)
    assert [tuple(e) for e in one["totals"]["languages"]] == [("da", 1), ("en", 1)] and [tuple(e) for e in one["totals"]["fallback_reasons"]] == [("unspecified", 1)]
    assert [tuple(e) for e in one["domains"][0]["new_domains"]] == [("new.dk", 1)] and one["domains"][0]["skips_playwright"] == 1
    empty = M.summary(spark.createDataFrame([], "kind string, domain string, mode string, recipes int, language string, reason string, target string")).first()
    assert empty["domains"] == []


def test_skips_and_pages_with_recipes(spark):
    at = datetime(2024, 1, 2)
    asked = spark.createDataFrame([("u1", "a.dk", "cheerio"), ("u1", "a.dk", "cheerio"), ("u1", "a.dk", "playwright"), ("u2", "a.dk", "cheerio")], "canonical_url string, domain string, mode string")
    pages = spark.createDataFrame([("u1", at), ("u3", at)], "canonical_url string, fetched_at timestamp")
    assert sorted(map(tuple, S.skips(asked, pages, F.lit(datetime(2024, 1, 1))).collect())) == [("a.dk", "cheerio", 1), ("a.dk", "playwright", 1)]
    joined = S.recipes_by_page(pages, spark.createDataFrame([("u1", "r1"), ("u1", "r2"), ("u9", "r3")], "page_url string, recipe string"))
    assert sorted((r["canonical_url"], r["recipe"]) for r in joined.collect() if r["recipe"]) == [("u1", "r1"), ("u1", "r2")] and joined.count() == 3
