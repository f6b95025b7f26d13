"""Cases that the driver's tables don't hold: small pages, links and texts, and what must come out of them."""

from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from larder import constants as C
from larder.functions import text as T
from larder.functions import url as U
from larder.operators import extract as X
from larder.operators import language as LG
from larder.operators import links as L
from larder.operators import pages as P
from larder.plans.registry import ORACLES, QUERIES
from larder.sources import seeds as SD

#: (id, domain of the page's URL, html) and (method, confidence, signals, some fields).
PAGES: list[tuple[int, str, str, str, float, str, dict[str, object]]] = [
    (5, "example.org", "<html><head><link rel=\"canonical\" href=\"https://arla.dk/o\"></head><body><h1>Brød</h1><h2>Ingredienser</h2><p>Mel</p></body></html>", "html-parsing", 2 / 3 + 0.15, "site-specific-arla", {"name": "Brød", "title": "Brød", "recipeIngredient": ["Mel"]}),
    (6, "example.org", "<body><h1>Cake</h1><dl><dt>Prep time</dt><dd>10 min</dd></dl><p><b>Cook time</b> 20 min</p><span class=\"meta-x\">Serves</span><span>4</span><h2>Ingredients</h2><ul><li>Flour</li></ul><h3>Method</h3><div>Mix well. Bake long.</div></body>", "html-parsing", 1.0, "heuristic-title-from-h1,heuristic-ingredients-from-nearby-content,heuristic-instructions-from-nearby-content,heuristic-prep-time,heuristic-cook-time,heuristic-yield",
     {"name": "Cake", "prepTime": "10 min", "cookTime": "20 min", "recipeYield": "4", "recipeIngredient": ["Flour"], "recipeInstructions": ["Mix well.", "Bake long."]}),
    (7, "example.org", "<head><meta property=\"og:title\" content=\"Only a title\"></head><body></body>", "html-parsing", 1 / 3, "heuristic-title-from-meta,missing-ingredients,missing-instructions", {"name": "Only a title"}),
    (8, "example.org", "<body><p>Nothing</p></body>", "partial", 0.0, "missing-title,missing-ingredients,missing-instructions", {}),
    (9, "example.org", "<script type=\"application/ld+json\">{\"@graph\":[{\"@type\":\"WebPage\",\"mainEntity\":{\"@type\":[\"Thing\",\"Recipe\"],\"headline\":\"Pie\",\"ingredients\":[\"Apples\"],\"yield\":\"6\",\"inLanguage\":\"en-US\"}},]}</script>", "json-ld", 1.0, "malformed-json-recovered,graph-wrapper,main-entity-wrapper,json-ld-normalized-fields,json-ld-found", {"name": "Pie", "recipeIngredient": ["Apples"], "recipeYield": "6"}),
    (10, "example.org", "<div itemscope itemtype=\"https://schema.org/Recipe\"><h2>Stew</h2><span itemprop=\"ingredients\">Beef</span><meta itemprop=\"cookTime\" content=\"PT1H\"><div itemprop=\"recipeInstructions\">Brown it. Stew it.</div></div>", "html-parsing", 1.0, "microdata-found", {"name": "Stew", "recipeIngredient": ["Beef"], "cookTime": "PT1H", "recipeInstructions": ["Brown it.", "Stew it."]}),
    (11, "example.org", "<script type=\"application/ld+json\">[{\"@type\":\"ItemList\",\"itemListElement\":[{\"item\":{\"@type\":\"Recipe\",\"name\":\"A\"}},{\"@type\":\"https://schema.org/Recipe\",\"name\":\"B\"}]}]</script>", "json-ld", 1.0, "item-list-wrapper,json-ld-found,multiple-recipes", {"name": "A"}),
]

_KAGE = "Opskrift på kage: ingredienser og fremgangsmåde, portioner og minutter"
#: (id, recipe language, html, domain, recipe text) and (language, confidence, signals).
LANGUAGES: list[tuple[int, str | None, str | None, str | None, str | None, str, float, str]] = [
    (1, "en-US", '<html lang="da"><body>opskrift</body></html>', "example.dk", None, "en", 1.0, "recipe-inLanguage"),
    (2, None, '<html lang="sv-SE"><body>recept</body></html>', "example.se", None, "sv", 0.95, "html-lang"),
    (3, "xx", '<html lang="fr"><head><meta property="og:locale" content="de_DE"></head><body>Rezept</body></html>', "example.com", None, "de", 0.9, "og-locale"),
    (4, None, '<html><head><meta http-equiv="content-language" content="nb"></head><body></body></html>', None, None, "no", 0.85, "meta-language"),
    (5, None, None, "example.com", "Chocolate cake 1 teaspoon salt. Bake for 30 minutes.", "en", 0.7, "text-keywords:en:3"),
    (6, None, None, "example.dk", _KAGE, "da", 0.8, "text-keywords:da:5,domain-hint:da"),
    (7, None, None, "example.no", "ingredienser og tilberedning i 20 minutter", "no", 0.7, "text-keywords:no:3,domain-hint:no"),
    (8, None, "<body>Short</body>", "shop.example.at", None, "de", 0.45, "domain-hint:de"),
    (9, None, None, None, None, "und", 0.0, "language-undetected"),
]

#: (id, page URL, html) and (canonical URL of the page, links: absolute URL, recipe-like).
LINKED: list[tuple[int, str, str, str, list[tuple[str, bool]]]] = [
    (1, "https://www.e.dk/a/b?x=1", "<link rel='canonical' href='/c/?utm_source=y'><a href='opskrift/kage'>Kage</a><a href=../recipes/pie>Pie</a><a class=x href=\"?p=2&amp;q=1\">2</a><a href='#top'>Top</a>", "https://e.dk/c", [("https://www.e.dk/a/opskrift/kage", True), ("https://www.e.dk/recipes/pie", True), ("https://www.e.dk/a/b?p=2&q=1", False), ("https://www.e.dk/a/b?x=1#top", False)]),
    (2, "https://e.dk/d/", "<link href=\"http://f.dk/g\" rel=\"canonical\"><a href='//f.dk/mad/x'>x</a><a href='./../h/./i'>y</a><a href='mailto:a@b'>z</a>", "http://f.dk/g", [("https://f.dk/mad/x", True), ("https://e.dk/h/i", False)]),
    (3, "https://e.dk", "<link rel=stylesheet href=/s.css><a href='kuchen/'>k</a><a>none</a>", "https://e.dk/", [("https://e.dk/kuchen/", True)]),
]

#: (id, URL, soft, queued in all, admitted of the domain) and the reasons.
ELIGIBLE: list[tuple[int, str | None, bool, int, int, str]] = [
    (1, "https://e.dk/recipe/kage", False, 0, 0, "queue-eligible"),
    (2, "https://e.dk/recipe/kage", False, C.DEFAULT.global_queue, 0, "global-queue-cap"),
    (3, "https://e.dk/recipe/kage", False, 0, C.DEFAULT.pages_per_domain, "domain-page-cap"),
    (4, "https://e.dk/login", False, 0, C.DEFAULT.pages_per_domain, "hard-denylist-pattern"),
    (5, "https://e.dk/category/x", True, 0, 0, "queue-eligible,trusted-soft-discovery"),
    (6, "https://e.dk/category/x", False, 0, 0, "soft-discovery-pattern"),
    (7, "https://e.dk/x.WEBP", False, 0, 0, "skip-extension"),
    (8, "ftp://e.dk/x", False, 0, 0, "unsupported-protocol"),
    (9, "notaurl", False, 0, 0, "invalid-url"),
    (10, "notaurl", False, C.DEFAULT.global_queue, 0, "global-queue-cap"),
    (11, "https://e.dk/2024/05/", False, 0, 0, "soft-discovery-pattern"),
]




@pytest.mark.parametrize("page", PAGES, ids=[str(p[0]) for p in PAGES])
def test_pages(page):
    _, domain, html, method, confidence, signals, wanted = page
    recipes, found, sure, told = X.extract(html, domain)
    assert (found, round(sure, 6), ",".join(told)) == (method, round(confidence, 6), signals)
    assert not wanted or {k: recipes[0].get(k) for k in wanted} == wanted


def test_languages(spark):
    rows = spark.createDataFrame([r[:5] for r in LANGUAGES], "id long, recipe_language string, html string, domain string, recipe_text string")
    found = {r["id"]: (r["language"], round(r["language_confidence"], 6), ",".join(r["language_signals"])) for r in LG.detected(rows).collect()}
    assert found == {r[0]: r[5:] for r in LANGUAGES}


def test_linked_pages(spark):
    pages = spark.createDataFrame([r[:3] for r in LINKED], "page_id long, url string, html string")
    links = L.candidates(L.explode_links(pages)).select("page_id", "absolute_url", U.is_recipe_like(F.col("absolute_url")).alias("like")).collect()
    assert sorted((r["page_id"], r["absolute_url"], r["like"]) for r in links) == sorted((p[0], u, like) for p in LINKED for u, like in p[4])
    assert dict(map(tuple, pages.select("page_id", P.canonical_url(F.col("html"), F.col("url"))).collect())) == {p[0]: p[3] for p in LINKED}


def test_eligible_urls(spark):
    rows = spark.createDataFrame([r[:5] for r in ELIGIBLE], "id long, url string, soft boolean, total int, admitted int")
    found = rows.select("id", L.eligibility(F.col("url"), F.col("soft"), F.col("total"), F.col("admitted"), F.lit(C.DEFAULT.pages_per_domain)).alias("e")).collect()
    assert {r["id"]: ",".join(r["e"]["reasons"]) for r in found} == {r[0]: r[5] for r in ELIGIBLE}


def test_formats_at_their_edges(spark):
    row = spark.range(1).select(
        T.first_signals(F.array(*map(F.lit, "abcdefghij"))), T.first_signals(F.array().cast("array<string>")), T.squashed(F.concat(F.lit("one\n two"), F.repeat(F.lit("z"), 400))),
        T.process_row(F.lit("odd")), T.percent_delta(F.lit(0.125)), T.delta(F.lit(-3)), F.array_join(U.run_names(U.run_id(F.lit(" r/1 "), F.lit(datetime(2026, 1, 2)))), " "), F.array_join(SD.sitemap_roots(F.lit("www.E.dk"), F.array(F.lit("https://maps.e.dk/a.xml"), F.lit("https://e.dk/b"), F.lit("nonsense"))), " "),
    ).first()
    assert tuple(row) == ("a|b|c|d|e|f|g|h|+2", "none", "one two" + "z" * 293, None, "+12.5pp", "-3", " ".join(f"{n}-r-1" for n in U.RUN_NAMES), "https://e.dk https://maps.e.dk")


@pytest.mark.parametrize(
    "raw,wanted",
    [
        ("https://e.dk/æ?q=æ", "https://e.dk/%C3%A6?q=%C3%A6"),
        ("https://e.dk/a?b=1&a=2 3&a=1", "https://e.dk/a?a=2+3&a=1&b=1"),
        ("https://e.dk/a?x=(1)~*", "https://e.dk/a?x=%281%29%7E*"),
        ("https://e.dk/a?", "https://e.dk/a"),
        ("https://e.dk/a?x", "https://e.dk/a?x="),
        ("https://e.dk/a b/c%20d/%zz", "https://e.dk/a%20b/c%20d/%zz"),
        ("https://e.dk/a\\b", "https://e.dk/a/b"),
        ("https://e.dk/a?q=%zz&p=%20", "https://e.dk/a?p=+&q=%25zz"),
        ("https://e.dk/a?utm%5Fsource=x&r%C3%A9f=y&ref=z", "https://e.dk/a?r%C3%A9f=y"),
        ("https://e.dk/{x}|y?a=b=c&d=é+f", "https://e.dk/%7Bx%7D|y?a=b%3Dc&d=%C3%A9+f"),
        ("https://e.dk/😀", "https://e.dk/%F0%9F%98%80"),
    ],
)
def test_urls_beyond_ascii(spark, raw, wanted):
    assert spark.createDataFrame([(raw,)], "u string").select(U.canonicalize(F.col("u"))).first()[0] == wanted


def test_sentences_keep_characters_that_name_their_place(spark, tmp_path):
    # the first part has the index 0, the second 1: neither may lose those digits, and blanks at the ends go
    texts = ["0 eggs 100\n11 g mix 1", " 10 g \n 21 • 0", "One.\x0bTwo.  Three.\t\x0cFour", None, ""]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    parts = {r[0]: r[1] for r in table.select("doc_id", T.split_sentences(F.col("text"))).collect()}
    assert parts == {0: ["0 eggs 100", "11 g mix 1"], 1: ["10 g", "21", "0"], 2: ["One. Two. Three.", "Four"], 3: None, 4: []}
    table.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(map(tuple, QUERIES["sentence_split"](spark, str(tmp_path)).collect())) == sorted(db.sql(ORACLES["sentence_split"]).fetchall())
