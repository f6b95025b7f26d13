import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from larder.llm import bpe
from larder.llm.tokens import vocabulary

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
ODD = [
    "", " ", "aaaaaaa aaaaaaaa", "<|endoftext|>", "a<|endoftext|>b<|startoftext|>", "<|endoftext", "İΣΑΣ ΟΔΟΣ Σ", "é Å", "한",
    "日本語 テキスト 한국어", "\x1c a \x1f b\x85c d　e ", "don't I'LL we'Ve 's", "ᲊ ՘ \U0001f600\U0001f468‍\U0001f469", "\x00\x01", "z" * 5000, "ab" * 3000,
]


def texts():
    rnd = random.Random(5)
    mixed = ["".join(rnd.choice("aAbeEstT 'lr\n\t.,0123é́Σσß日\U0001f600՘<|>") for _ in range(rnd.randint(0, 60))) for _ in range(800)]
    points = lambda: chr(rnd.choice([rnd.randint(0, 0x2FFF), rnd.randint(0, 0xD7FF), rnd.randint(0xE000, 0x1FFFF)]))
    return ODD + mixed + ["".join(points() for _ in range(rnd.randint(0, 30))) for _ in range(800)]


@pytest.mark.parametrize("name", FILES)
def test_ids_and_decoded_texts_are_the_librarys(name):
    own, library = bpe.Bpe(vocabulary(name)), Tokenizer.from_file(vocabulary(name))
    given = texts()
    wanted = [e.ids for e in library.encode_batch(given, add_special_tokens=False)]
    found = own.encode(given)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == wanted
    assert [own.decode(x) for x in found] == [library.decode(x, skip_special_tokens=False) for x in wanted]


def test_full_table_and_blocks_change_nothing(monkeypatch):
    given = texts()
    whole = bpe.Bpe(vocabulary(FILES[0])).encode(given)
    monkeypatch.setattr(bpe.Bpe, "PIECES", 50)
    monkeypatch.setattr(bpe, "BLOCK", 3)
    assert bpe.Bpe(vocabulary(FILES[0])).encode(given) == whole


def test_very_long_texts():
    own, library = bpe.Bpe(vocabulary(FILES[0])), Tokenizer.from_file(vocabulary(FILES[0]))
    for text in ("x" * 1_000_000, "ab " * 400_000, "#" * 300_000):
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_op12_against_the_library(spark):
    library = Tokenizer.from_file(vocabulary(FILES[0]))
    found = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.op12_bpe(spark, "/root/testdata/sf0.001").collect()}
    wanted = {}
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        wanted[r["doc_id"]] = len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert found == wanted


def test_nulls_repeats_and_clashing_columns(spark):
    path = vocabulary(FILES[0])
    docs = spark.createDataFrame([(1, "Hello there", "x"), (1, "Hello there", "y"), (None, "a", "z"), (2, None, None), (3, "", "w")], "doc_id long, text string, ids string").withColumn("content", F.lit(1))
    out = bpe.round_trip(docs, path)
    assert out.columns == ["doc_id", "ids", "decoded"]
    assert sorted((r[0] or -1, r[2]) for r in out.collect()) == [(-1, "a</w>"), (1, "hello</w> there</w>"), (1, "hello</w> there</w>"), (2, ""), (3, "")]
    again = bpe.decode(bpe.encode(docs, path), path)
    assert sorted((r[0] or -1, r[1]) for r in again.collect()) == sorted((r[0] or -1, r[2]) for r in out.collect())
    assert bpe.round_trip(docs.limit(0), path).count() == 0
