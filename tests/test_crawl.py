from datetime import datetime

import pytest
from pyspark.sql import functions as F

from larder import constants as C
from larder.functions import text as T
from larder.functions import url as U
from larder.operators import crawl, extract
from larder.operators import links as L
from larder.operators import metrics as M
from larder.operators import store as S
from larder.operators.dom import parse
from larder.sources import seeds as SD
from larder.streaming import ingest


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'boolean' if isinstance(v, bool) else 'int' if isinstance(v, int) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    "raw,wanted",
    [
        ("https://example.dk/page?utm_source=google&utm_medium=cpc", "https://example.dk/page"),
        ("https://example.dk/page?fbclid=abc123&gclid=xyz", "https://example.dk/page"),
        ("https://example.dk/search?q=kage&page=2", "https://example.dk/search?page=2&q=kage"),
        ("https://example.dk/page#section", "https://example.dk/page"),
        ("https://example.dk/opskrifter/", "https://example.dk/opskrifter"),
        ("https://example.dk/", "https://example.dk/"),
        ("https://Example.DK/Page", "https://example.dk/Page"),
        ("https://example.dk/amp/opskrift/kage", "https://example.dk/opskrift/kage"),
        ("https://example.dk/m/opskrift/kage", "https://example.dk/opskrift/kage"),
        ("https://Example.DK/amp/page/?utm_source=fb#top", "https://example.dk/page"),
        ("https://www.example.dk/page", "https://example.dk/page"),
        ("https://e.dk/a?b=1&a=2&a=1", "https://e.dk/a?a=2&a=1&b=1"),
        ("https://e.dk:443/a?x", "https://e.dk/a?x="),
        ("/opskrift/kage", None),
        ("mailto:x@e.dk", None),
        (None, None),
        ("", None),
    ],
)
def test_canonical_url(spark, raw, wanted):
    assert one(spark, U.canonicalize(F.col("u")), u=raw) == wanted


@pytest.mark.parametrize(
    "url,soft,admitted,wanted",
    [
        ("notaurl", False, 0, ["invalid-url"]),
        ("mailto:test@example.dk", False, 0, ["unsupported-protocol"]),
        ("https://example.dk/category/dinner", False, 0, ["soft-discovery-pattern"]),
        ("https://example.dk/category/dinner", True, 0, ["queue-eligible", "trusted-soft-discovery"]),
        ("https://example.dk/login", False, 0, ["hard-denylist-pattern"]),
        ("https://example.dk/photo.webp", False, 0, ["skip-extension"]),
        ("https://example.dk/recipe/kage", False, 0, ["queue-eligible"]),
        ("https://example.dk/recipe/kage", False, 2, ["domain-page-cap"]),
        ("https://example.dk/2024/05/", False, 0, ["soft-discovery-pattern"]),
    ],
)
def test_eligibility(spark, url, soft, admitted, wanted):
    x = one(spark, L.eligibility(F.col("u"), F.col("s"), F.lit(0), F.col("n"), F.lit(2)), u=url, s=soft, n=admitted)
    assert x["reasons"] == wanted and x["allowed"] == (wanted[0] == "queue-eligible")


def test_global_cap_goes_first(spark):
    assert one(spark, L.eligibility(F.col("u"), F.lit(False), F.lit(C.DEFAULT.global_queue), F.lit(0), F.lit(2)), u="notaurl")["reasons"] == ["global-queue-cap"]


@pytest.mark.parametrize("allowed,recipe,cross,trusted,hops,wanted", [(False, True, False, True, 0, False), (True, True, True, True, 9, True), (True, False, True, True, 0, True), (True, False, True, True, 1, False), (True, False, False, True, 1, True), (True, False, False, True, 2, False), (True, False, False, False, 0, False)])
def test_follow(spark, allowed, recipe, cross, trusted, hops, wanted):
    assert one(spark, L.follow(*map(F.col, "arcth")), a=allowed, r=recipe, c=cross, t=trusted, h=hops) is wanted


def test_language(spark):
    assert one(spark, T.language_code(F.col("c")), c="nb_NO") == "no"
    assert one(spark, T.language_code(F.col("c")), c="fr") is None
    found = one(spark, T.text_language(T.language_scores(T.normal_text(F.col("t")))), t="Opskrift med ingredienser og fremgangsmåde: portioner")
    assert found["language"] == "da" and found["score"] >= 4
    assert one(spark, T.text_language(T.language_scores(T.normal_text(F.col("t")))), t="recipe") is None
    assert one(spark, T.domain_language(F.col("d")), d="x.co.uk") == "en"
    assert one(spark, T.html_language(F.col("h")), h='<html lang="da-DK">')["confidence"] == 0.95


def test_json_ld_cases():
    graph = '<script type="application/ld+json">{"@graph":[{"@type":["Thing","Recipe"],"headline":"Kage","ingredients":["mel","mel"],"recipeInstructions":[{"@type":"HowToSection","itemListElement":[{"text":"Rør. Bag"},{"name":"Spis"}]}],"image":[{"url":"a.jpg"}],}]}</script>'
    recipes, method, confidence, signals = extract.extract(graph, None)
    assert method == "json-ld" and confidence == 1.0 and "malformed-json-recovered" in signals
    assert recipes[0]["name"] == "Kage" and recipes[0]["recipeIngredient"] == ["mel"] and recipes[0]["image"] == "a.jpg"
    assert recipes[0]["recipeInstructions"] == ["Rør.", "Bag", "Spis"]
    assert extract.extract('<script type="application/ld+json">{"name":"a &quot;b"}</script>', None)[3][0] == "malformed-json-failed"
    nested = extract.find_recipes({"@type": "Recipe", "hasPart": [{"@type": "Recipe", "name": "inner"}]})
    assert [r["name"] for r in nested] == ["inner"]
    assert extract.normalize({"@type": "Recipe", "recipeIngredient": [], "ingredients": ["x"]}).get("recipeIngredient") == []


def test_html_cascade():
    micro = '<div itemscope itemtype="https://schema.org/Recipe"><h1 itemprop="name">Suppe</h1><li itemprop="recipeIngredient">salt<li itemprop="recipeIngredient">vand</div>'
    recipes, method, confidence, _ = extract.extract(micro, None)
    assert recipes[0]["recipeIngredient"] == ["salt", "vand"] and confidence == pytest.approx(2 / 3) and method == "html-parsing"
    page = "<h1>Pandekager</h1><h2>Ingredienser</h2><ul><li>Mel</li><li>Mælk</li></ul><h2>Sådan gør du</h2><p>Pisk det hele.</p><p>Steg.</p>"
    recipes, _, confidence, signals = extract.extract(page, "www.arla.dk")
    assert confidence == 1.0 and signals == ["site-specific-arla"] and recipes[0]["recipeInstructions"] == ["Pisk det hele.", "Steg."]
    assert extract.extract(page, "other.dk")[2] == 1.0
    assert extract.extract("<h1>Only a title</h1>", None)[2] == pytest.approx(1 / 3)
    assert extract.extract(None, None)[1:3] == ("partial", 0.0)


def test_dom_is_tolerant():
    root = parse("<ul><li>a<li>b</ul><p>x<div>y<br>z</div><b>open")
    assert [n.text() for n in root.find("li")] == ["a", "b"]
    assert root.find("p")[0].text() == "x"
    assert parse("<div>" * 3000 + "x").text() == "x"


def test_content_hash():
    assert extract.content_hash({"a": 1, "b": ["x ", "y"]}) == extract.content_hash({"b": ["x", "y"], "a": 1})
    assert extract.content_hash({"a": ["x", "y"]}) != extract.content_hash({"a": ["y", "x"]})


def test_extract_pages_with_nulls(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "e.dk", "<h1>T</h1>")], "page_id long, domain string, html string")
    rows = {r["page_id"]: r for r in extract.extract_pages(pages).collect()}
    assert rows[1]["recipes"] == [] and len(rows[None]["recipes"]) == 1
    assert extract.explode_recipes(extract.extract_pages(pages)).first()["content_hash"]


def test_store(spark):
    t = lambda d: datetime(2024, 1, d)
    old = spark.createDataFrame([("a", t(1), "chain"), ("b", t(2), None)], "canonical_url string, fetched_at timestamp, redirect_chain string")
    new = spark.createDataFrame([("a", t(3), None)], old.schema)
    out = {r[0]: r for r in S.upsert(old, new, "canonical_url", "fetched_at", ("redirect_chain",)).collect()}
    assert out["a"]["fetched_at"] == t(3) and out["a"]["redirect_chain"] == "chain" and len(out) == 2
    best = S.keep_best(spark.createDataFrame([("h", 0.5, 1), ("h", 0.9, 2), ("h", 0.9, 3)], "k string, c double, n int"), "k", "c", "n").collect()
    assert [(r["c"], r["n"]) for r in best] == [(0.9, 2)]
    cutoff = F.lit(t(2))
    assert [r[0] for r in S.fresh(old.select("canonical_url"), old, cutoff).collect()] == ["b"]
    assert [r[0] for r in S.stale(old.select("canonical_url"), old, cutoff).collect()] == ["a"]


def test_metrics_of_nothing(spark):
    none = spark.createDataFrame([], "kind string, domain string, mode string, recipes int")
    assert M.domain_metrics(none).collect() == [] or M.domain_metrics(none).first()["processed"] == 0
    rows = spark.createDataFrame([("fallback", "d", "cheerio", 0)], "kind string, domain string, mode string, recipes int")
    assert all(r["recipe_page_yield"] == 0 and r["fallback_rate"] == 0 for r in M.domain_metrics(rows).collect())


def test_seeds_and_sitemaps(spark, tmp_path):
    (tmp_path / "map.xml").write_text('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>https://a.dk/x</loc></url><url><loc> https://a.dk/y </loc></url></urlset>')
    assert sorted(r[0] for r in SD.sitemap(spark, str(tmp_path / "map.xml")).select("url").collect()) == ["https://a.dk/x", "https://a.dk/y"]
    assert SD.start_urls(SD.seeds(spark)).count() == 14
    assert SD.should_respect_robots(SD.seeds(spark).limit(0)).first()["respect_robots"] is False


def test_crawl_reaches_what_is_admitted(spark, tmp_path):
    a = lambda u, t="x": f'<a href="{u}">{t}</a>'
    pages = [
        (1, "https://s.dk/", a("/recipe/one") + a("/list") + a("/login") + a("https://far.dk/recipe/two", "recipe")),
        (2, "https://s.dk/recipe/one", a("/") + a("/recipe/three/")),
        (3, "https://s.dk/list", a("/deep")),
        (4, "https://s.dk/deep", a("/deeper")),
        (5, "https://s.dk/deeper", ""),
        (6, "https://far.dk/recipe/two", ""),
        (7, "https://s.dk/recipe/three", ""),
    ]
    fetches = spark.createDataFrame(pages, "page_id long, url string, html string")
    roots, trusted = spark.createDataFrame([("https://s.dk",)], "url string"), spark.createDataFrame([("s.dk",)], "domain string")
    found = {r[0]: r[1] for r in crawl.crawl(fetches, roots, trusted, str(tmp_path)).collect()}
    assert found == {"https://s.dk/": 0, "https://s.dk/recipe/one": 1, "https://s.dk/list": 1, "https://far.dk/recipe/two": 1, "https://s.dk/recipe/three": 2, "https://s.dk/deep": 2}


def test_stream_equals_batch(spark, tmp_path):
    urls, pages = str(tmp_path / "urls"), spark.createDataFrame([("https://a.dk/old", datetime(2024, 1, 2))], "canonical_url string, fetched_at timestamp")
    for n, part in enumerate([["https://a.dk/x", "https://a.dk/x/"], ["https://a.dk/x#1", "https://a.dk/old", "https://a.dk/z"]]):
        spark.createDataFrame([(u, 10 * n + i) for i, u in enumerate(part)], "url string, seq long").coalesce(1).write.mode("append").parquet(urls)
    query = ingest.ingest(ingest.url_stream(spark, urls), pages, F.lit(datetime(2024, 1, 1)), str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination(120)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r["canonical_url"] for r in rows) == ["https://a.dk/x", "https://a.dk/z"]
    counted = ingest.admitted_per_domain(ingest.url_stream(spark, urls)).writeStream.outputMode("complete").format("memory").queryName("counted").trigger(availableNow=True).start()
    counted.awaitTermination(120)
    assert [tuple(r) for r in spark.table("counted").collect()] == [("a.dk", 5)]


def test_anchor_forms(spark):
    html = """<a href="/a">A</a><a class='x' href='/b"q'>B</a><A HREF = /c/d>C</A><a disabled href=/e title="x > y">E</a ><a data-href="/no">no</a><a title="href=/no" href="/f">F <b>f</b></a><abbr href="/no">no</abbr><a href="/g">G<a href="/h">H"""
    rows = L.explode_links(spark.createDataFrame([(1, "https://s.dk/", html)], "page_id long, url string, html string")).orderBy("pos").collect()
    assert [(r["href"], r["anchor_text"]) for r in rows] == [("/a", "A"), ('/b"q', "B"), ("/c/d", "C"), ("/e", "E"), ("/f", "F f"), ("/g", "G"), ("/h", "H")]


def test_crawl_follows_a_long_chain(spark, tmp_path):
    pages = [(i, f"https://s.dk/recipe/{i}", f'<a href="/recipe/{i + 1}">x</a>') for i in range(24)]
    fetches = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    roots, trusted = spark.createDataFrame([("https://s.dk/recipe/0",)], "url string"), spark.createDataFrame([("s.dk",)], "domain string")
    found = {r[0]: r[1] for r in crawl.crawl(fetches, roots, trusted, str(tmp_path)).collect()}
    assert found == {f"https://s.dk/recipe/{i}": i for i in range(25)}


def test_caps_count_what_earlier_rounds_queued(spark, tmp_path):
    # a chain of recipe pages with many leaves each: the caps hold over all rounds, roots included
    rows = [(i, f"https://e.dk/recipe/{i}", "".join(f'<a href="/recipe/{i + 1}">n</a><a href="/recipe/leaf{i}-{j}">l</a>' for j in range(3))) for i in range(12)]
    rows.append((None, "https://e.dk/recipe/12", '<a href="/recipe/end">e</a>'))
    fetches = spark.createDataFrame(rows, "page_id long, url string, html string")
    roots = spark.createDataFrame([("https://e.dk/recipe/0",)], "url string")
    trusted = spark.createDataFrame([("e.dk",)], "domain string")
    visit = lambda limits, name: crawl.crawl(fetches, roots, trusted, str(tmp_path / name), limits).collect()
    assert len(visit(C.DEFAULT, "all")) == 13 + 12 * 3 + 1
    assert len(visit(C.Limits(pages_per_domain=7), "domain")) == 7
    assert len(visit(C.Limits(global_queue=9), "all-in-all")) == 9


def test_kept_html_and_gzip(spark):
    import gzip

    from larder.operators import pages as P

    rows = spark.createDataFrame([(1, "<p>é</p>", "html-parsing"), (2, "<p>x</p>", "json-ld"), (3, None, "partial")], "id long, html string, method string")
    found = {r["id"]: r["html"] for r in P.zipped(rows.withColumn("html", P.kept_html(F.col("html"), F.col("method"), F.lit(1.0)))).collect()}
    assert gzip.decompress(found[1]).decode() == "<p>é</p>" and found[2] is None and found[3] is None


def test_robots_and_new_domains(spark):
    from larder.operators import pages as P

    links = spark.createDataFrame([("a", "e.dk", "https://e.dk/private/x", "e.dk", False), ("b", "e.dk", "https://e.dk/x", "e.dk", False), ("c", "f.dk", "https://f.dk/private/x", "e.dk", True)], "canonical_url string, domain string, absolute_url string, source_domain string, cross_domain boolean")
    denied = spark.createDataFrame([("e.dk", "/private/")], "domain string, prefix string")
    assert {r["canonical_url"] for r in P.allowed_by_robots(links, denied).collect()} == {"b", "c"}
    added = spark.createDataFrame([("b",), ("c",), ("c",)], "canonical_url string")
    assert [tuple(r) for r in P.added_off_domain(links, added).collect()] == [("e.dk", 1, ["f.dk"])]


def test_a_site_can_be_registered():
    from larder.operators import sites

    site = sites.Site(("new.dk",), lambda root: {"name": sites.first_text(root, "h4")}, 0.1, ("site-specific-new",))
    sites.register(site)
    try:
        assert extract.extract("<h4>Ny</h4>", "www.new.dk")[3] == ["site-specific-new"]
    finally:
        sites.SITES.remove(site)


def test_store_lookups_and_runs(spark, tmp_path):
    pages = spark.createDataFrame([("https://e.dk/a", datetime(2026, 1, 2)), ("https://e.dk/b", datetime(2026, 1, 1))], "canonical_url string, fetched_at timestamp")
    cutoff = F.lit("2026-01-02").cast("timestamp")
    assert S.fetched_since(pages, F.lit("https://e.dk/a"), cutoff) and not S.fetched_since(pages, F.lit("https://e.dk/b"), cutoff) and not S.fetched_since(pages, F.lit("x"), cutoff)
    for run in ("r1", "r2"):
        S.append_runs(spark.createDataFrame([(run,)], "run string"), str(tmp_path / "runs"))
    assert {r["run"] for r in spark.read.parquet(str(tmp_path / "runs")).collect()} == {"r1", "r2"}
    assert [M.latest_k(x) for x in (None, "", "3", "7 runs", "0", "-2", "x")] == [10, 10, 3, 7, 10, 10, 10]


def test_sitemap_index_and_gzip(spark, tmp_path):
    import gzip

    index = "<sitemapindex><sitemap><loc> https://e.dk/1.xml </loc></sitemap><sitemap><lastmod>2026</lastmod></sitemap><sitemap><loc>https://e.dk/2.xml.gz</loc></sitemap></sitemapindex>"
    (tmp_path / "index.xml.gz").write_bytes(gzip.compress(index.encode()))
    (tmp_path / "urls.xml.gz").write_bytes(gzip.compress(b"<urlset><url><loc>https://e.dk/a</loc></url></urlset>"))
    assert {r["url"] for r in SD.sitemap_index(spark, str(tmp_path / "index.xml.gz")).collect()} == {"https://e.dk/1.xml", "https://e.dk/2.xml.gz"}
    assert [r["url"] for r in SD.sitemap(spark, str(tmp_path / "urls.xml.gz")).collect()] == ["https://e.dk/a"]
