import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from larder.llm import spelling

LETTERS = "abcdeé×"


def brute_words(rows):
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def deletions(word):
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def near(u, v):
    if u == v or abs(len(u) - len(v)) > 1:
        return False
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return min(u, v, key=len) in deletions(max(u, v, key=len))


def brute_near(words):
    """Words that are one edit apart have a word or a gap in common."""
    gaps = {}
    for w in words:
        for g in deletions(w) | {w}:
            gaps.setdefault(g, []).append(w)
    found = {w: set() for w in words}
    for together in gaps.values():
        for u in together:
            found[u].update(v for v in together if near(u, v))
    return found


def brute(words):
    close = brute_near(words)
    form = {}
    for w, others in close.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 10 * words[w]:
            form[w] = best
    rows = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        rows.add((w, form.get(w), root, n, len(close[w]), words[form[w]] if w in form else None))
    return rows


def rows_of(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def test_op11_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(spelling.op11_spelling(spark, "/root/testdata/sf0.01")) == sorted(brute(brute_words(docs)), key=repr)


@pytest.mark.parametrize("block,few", [(4096, 24), (6, 2), (1, 1)])
def test_dense_words_with_subdivided_blocks(spark, monkeypatch, block, few):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "FEW", few)
    rnd = random.Random(block)
    words = {"".join(rnd.choice(LETTERS) for _ in range(rnd.randint(1, 6))): rnd.choice([2, 3, 40, 700, 9000]) for _ in range(150)}
    # one block of a third of all words: a common front, and a common back
    words |= {"commonfront" + "".join(rnd.choice(LETTERS) for _ in range(rnd.randint(2, 4))): rnd.choice([2, 50]) for _ in range(60)}
    words |= {"".join(rnd.choice(LETTERS) for _ in range(rnd.randint(2, 4))) + "commonback": rnd.choice([2, 50]) for _ in range(60)}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows_of(spelling.variants(table)) == sorted(brute(words), key=repr)


def test_words_of_nulls_repeats_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PART", 10)
    monkeypatch.setattr(spelling, "HELD", 3)
    rows = [(1, "Abcdefgh ABCDEFGH aÉbcdefg"), (1, "Abcdefgh"), (None, "abcdefgh x"), (2, None), (3, ""), (4, "short words only"), (5, "lettersletters" * 5 + " " + "overandover " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(1))
    found = {r["word"]: r["n"] for r in spelling.damaged_words(docs).collect()}
    assert {w: n for w, n in found.items() if n >= 2} == brute_words(rows)
    assert spelling.variants(spelling.damaged_words(docs.limit(0))).count() == 0


def test_roots_follow_forms(spark):
    words = {"lettere": 2, "letters": 30, "letter": 400, "lettee": 1}
    found = {r[0]: r[2] for r in rows_of(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))}
    assert found == {"lettere": "letter", "letters": "letter", "letter": "letter", "lettee": "letter"}
