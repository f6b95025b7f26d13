import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from larder.llm import merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """Root, and for each leaf its siblings level by level as (left, right) lists."""
    proofs, nodes, where = [[] for _ in leaves], leaves, list(range(len(leaves)))
    while len(nodes) > 1:
        for i, at in enumerate(where):
            run = at // 16 * 16
            proofs[i].append((nodes[run:at], nodes[at + 1 : run + 16]))
        nodes, where = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)], [at // 16 for at in where]
    return nodes[0], proofs


def brute(rows):
    """The contract's rows for (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r, leaf_of(*r)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[s] = tree([leaf for _, leaf in groups[s]])
    root, tops = tree([trees[s][0] for s in order]) if order else (None, [])
    out = []
    for s, top in zip(order, tops):
        for (r, leaf), proof in zip(groups[s], trees[s][1]):
            whole = proof + top
            node = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                node = leaf_of(*r[:4], None if r[4] is None else r[4].translate(LOWER))
            for left, right in whole:
                node = h(*left, node, *right)
            out.append((r[0], leaf, trees[s][0], root, h(*(x for left, right in whole for x in left + right)), node, node == root))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


def test_op13_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    found = rows_of(merkle.op13_merkle(spark, "/root/testdata/sf0.01"))
    assert found == brute(list(map(tuple, docs.collect())))
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("rows_each", [23, 100_000])
def test_groups_over_many_partitions(spark, monkeypatch, tmp_path, rows_each):
    """A hot group, groups of 1, 16, 17, 256 and 257 rows, null and empty groups, repeated rows, nulls in any column."""
    monkeypatch.setattr(merkle, "ROWS", rows_each)
    rnd = random.Random(rows_each)
    text = lambda: rnd.choice([None, "", "Some Text É", "x" * 50])
    rows = [(i, s, rnd.choice(["en", None]), rnd.choice([None, i]), text()) for s, n in (("hot", 700), ("one", 1), ("a16", 16), ("a17", 17), ("b256", 256), ("b257", 257), (None, 20), ("", 5), ("Ærø", 3)) for i in range(n)]
    rows += [(None, "hot", "en", 1, "no id"), (None, None, None, None, None)] + [(7, "twice", "en", 3, "Same Row")] * 40
    rnd.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumns({"group": F.lit(1), "key": F.lit(2), "leaf": F.lit("x"), "tampered": F.lit("y")})
    frame.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(merkle.op13_merkle(spark, str(tmp_path))) == brute(rows)


def test_many_groups_and_manifest(spark, monkeypatch):
    monkeypatch.setattr(merkle, "ROWS", 11)
    rows = [(i, f"s{i % 90}", "en", i, f"T {i}") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    found = merkle.manifest(frame)
    assert found.columns == ["group", "key", "leaf", "subroot", "root", "proof"]
    wanted = {r[0]: (r[1], r[2], r[3]) for r in brute(rows)}
    assert {r["key"]: (r["leaf"], r["subroot"], r["root"]) for r in found.collect()} == wanted
    assert found.where(merkle.folded(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0


def test_empty_and_single(spark):
    frame = spark.createDataFrame([(1, "s", "en", 2, "t")], "doc_id long, source string, lang string, n_chars long, text string")
    assert merkle.manifest(frame.limit(0)).count() == 0
    only = merkle.manifest(frame).first()
    assert only["leaf"] == only["subroot"] == only["root"] == leaf_of(1, "s", "en", 2, "t") and only["proof"] == []
