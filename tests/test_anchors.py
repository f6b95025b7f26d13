import time

import pytest
from pyspark.sql import functions as F

from larder.operators import anchors as A
from larder.operators import links as L


@pytest.mark.parametrize(
    "html,base,found",
    [
        (None, None, []),
        ("", None, []),
        ('<!-- <a href="/c">c</a> --><a href="/d">d</a><!-- never closed <a href="/e">e</a>', None, [("/d", "d")]),
        ("""<script>var x = "<a href='/s'>s</a>";</script><style><a href=/t></style><textarea><a href=/u>u</a></textarea><a href=/v>v</a>""", None, [("/v", "v")]),
        ('<SCRIPT><a href="/s">s</a></scripts></ScRiPt ><a href="/v">v</a>', None, [("/v", "v")]),
        ('<a href="/x&#38;y&#x2F;z&amp;q=1">bl&aring;b&aelig;r <b>&lt;b&gt;</b></a>', None, [("/x&y/z&q=1", "blåbær <b>")]),
        ('<a href="/1">one<a href="/2">two', None, [("/1", "one"), ("/2", "two")]),
        ('<a href="/1" title="a > b">x</a><a title=\'<a href="/no">\' href=/2>y</a>', None, [("/1", "x"), ("/2", "y")]),
        ('<a name="n">no</a><a data-href="/no">no</a><abbr href="/no">no</abbr><a href>empty</a>', None, [("", "empty")]),
        ('<a href="/1" href="/2">first</a>', None, [("/1", "first")]),
        ('<!doctype html><?xml a?><a href="/1">x</a', None, [("/1", "x")]),
        ('a < b <3 <a href="/1">1 < 2</a>', None, [("/1", "1 < 2")]),
        ('<base href="/b/"><base href="/c/"><a href="x">x<!-- no -->y</a>', "/b/", [("x", "xy")]),
        ('<a href="/1">x</a><a href="/2', None, [("/1", "x")]),
    ],
)
def test_anchors(html, base, found):
    assert A.anchors(html) == (base, found)


@pytest.mark.parametrize("piece", ["<a ", '<a href="/x" ', "<!--", '<a href="', "<", "</", "<script>", "<a href=/x>", '<a =x =">', "<!", '<a href="/x">y', "&amp;", "<a/", "<title></titl", "<a href='/x'></a", "< "])
def test_a_page_costs_its_length(piece):
    html = piece * (1_000_000 // len(piece))
    start = time.perf_counter()
    A.anchors(html)
    assert time.perf_counter() - start < 5


def test_links_in_sql_and_base_tags(spark):
    rows = [(1, "https://a.dk/x/y", '<base href="/b/"><a href="c">1</a><a href="//e.dk/f">2</a>'), (2, "https://a.dk/x/y", '<a href="c">3</a>'), (3, "https://a.dk/", None), (4, None, '<a href="c">5</a>'), (5, "https://a.dk/", '<base href="mailto:x"><a href="/g">6</a>')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("pos", F.lit(7))
    found = L.candidates(L.explode_links(pages)).select("page_id", "absolute_url", "anchor_text").collect()
    assert sorted(map(tuple, found)) == [(1, "https://a.dk/b/c", "1"), (1, "https://e.dk/f", "2"), (2, "https://a.dk/x/c", "3"), (5, "https://a.dk/g", "6")]
    A.register(spark)
    pages.createOrReplaceTempView("anchor_pages")
    sql = spark.sql("SELECT page_id, l.pos, l.href FROM anchor_pages, LATERAL extract_links(html, url) l ORDER BY page_id, l.pos").collect()
    spark.catalog.dropTempView("anchor_pages")
    assert [tuple(r) for r in sql] == [(1, 0, "c"), (1, 1, "//e.dk/f"), (2, 0, "c"), (4, 0, "c"), (5, 0, "/g")]
