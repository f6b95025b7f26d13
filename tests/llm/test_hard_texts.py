"""Texts that make careless patterns and joins overflow a stack or take quadratic time."""

import time
from collections import Counter

import pyarrow as pa
import pytest

from larder.llm import decontam, licences

from .test_operators import brute_contamination, docs, prose


@pytest.mark.parametrize("text", ["# " * 1_000_000, "* " * 1_000_000, "> ; # " * 300_000, "a" + " " * 1_000_000 + "b", "a.\n" + "\t \r" * 300_000 + "b", "\n " * 500_000, "." * 1_000_000, "a." + ")" * 1_000_000, "-" * 1_000_000, "1. " * 300_000])
def test_licence_scan_is_linear(spark, text):
    frame = docs(spark, [(1, text + "\n\nLicensed under the MIT License")])
    licences.scan(docs(spark, [(1, "x")])).collect()
    start = time.perf_counter()
    found = licences.scan(frame).collect()
    assert time.perf_counter() - start < 20
    assert [f["licence"] for f in found[0]["found"]] == ["MIT"]


def test_repeated_words_are_linear():
    start = time.perf_counter()
    index = decontam.Index(["1", "2"], ["a " * 1000, "a b " * 600], 10, 5)
    words, spans, items = index.report(pa.array(["a " * 20_000, "a b " * 20_000 + "c " * 5, "b " * 20_000]))
    assert time.perf_counter() - start < 5
    assert words.tolist() == [20_000, 40_005, 20_000]
    assert spans == [[(0, 20_000)], [(0, 40_000)], []] and items == [["1"], ["2"], []]


def test_repeats_against_brute_force(spark):
    items = [(1, "a " * 30), (2, "a b " * 12 + "c"), (3, "a a b " * 9), (4, prose(15, 2)), (5, "a"), (6, "b c")]
    rows = [(i, t) for i, t in enumerate(["a " * 50, "a b " * 30, "b a " * 20 + "c", "a a b " * 8, "b b c", "a a a a b a a b", prose(15, 2) + " a " * 12, "c " * 30])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), ",".join(r["items"])) for r in decontam.contamination(docs(spark, rows), bench).collect())
    assert got == Counter((i, n, h, ",".join(x)) for i, t in rows for n, h, x in [brute_contamination(t, items)])


def test_windows_of_one_hash_have_tables_of_their_own(monkeypatch):
    monkeypatch.setattr(decontam, "gram_hash", lambda words, n: words[: max(0, len(words) - n + 1)] * 0)
    items = [prose(14, 1), prose(12, 2), "one two", "three four"]
    index = decontam.Index(["1", "2", "3", "4"], items, 10, 5)
    texts = [prose(14, 1), f"x {prose(12, 2)} y", "one two", "one four three four", prose(30, 8)]
    _, spans, found = index.report(pa.array(texts))
    wanted = [brute_contamination(t, list(enumerate(items, 1))) for t in texts]
    assert [(sum(e - s for s, e in x), i) for x, i in zip(spans, found)] == [(h, i) for _, h, i in wanted]
