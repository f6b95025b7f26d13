"""The pipeline against brute-force versions of its deciding stages."""

from pyspark.sql import functions as F

import corpus_pipeline
from larder.llm.common import put

from .test_operators import brute_contamination, brute_kept

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns, out = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, put(stage(spark, docs, SF), name)
        out[name] = before, docs
        if name != "packing":
            assert docs.columns == columns
    rows = sorted((r["doc_id"], r["text"]) for r in out["near_duplicates"][0].collect())
    assert {r[0] for r in out["near_duplicates"][1].select("doc_id").collect()} == brute_kept(rows)
    before, after = out["decontamination"]
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect() if not brute_contamination(r["text"], bench)[1]}
    before, after = out["packing"]
    got = after.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert len(got) == before.count() and all(r["n"] == r["t"] for r in got)


def test_stages_take_empty_and_null_documents(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    for rows in ([], [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "ein Text", None, None, None)]):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = put(stage(spark, docs, SF), name)
        docs.collect()
