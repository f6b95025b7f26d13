"""The corpus pipeline: web documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run`` writes each
result as Parquet to the shared folder and rereads it. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.llm import copies, decontam, langid, packing, tokens, toxicity
from larder.llm.common import put

#: The stages train, compare and cut in ways that SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose language has a posterior under one half."""
    return langid.keep_known(docs, langid.train(docs, langid.fold("doc_id", 3) != 1))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a toxicity score of at least one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels, langid.fold("doc_id", 5) != 0))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest id, of each group of near copies."""
    return copies.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten words in a row (or a whole shorter item) of the benchmark."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the ids of all that is left into sequences of 4096."""
    return packing.pack(docs, tokens.vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = put(stage(spark, docs, sf_dir), name)
    return docs
