"""Corpus preparation in five stages, from documents to training shards.

Each stage takes the documents that its predecessor kept and gives them, with
the columns of ``documents``, to the next; the last adds ``shard`` and
``slot``.  Between stages the documents are written as Parquet in the shared
folder and read again, so that a lost executor repeats at most one stage.

Toxicity is learned and the mix is a permutation by hashes, so there is no SQL
for the rows; the tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skuflow.llm import mixing, sharding, simhash, templates, toxicity
from skuflow.session import materialize

SHARDS = 24


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    chain = toxicity.fit_chain(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean_documents(docs, chain)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_group(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return templates.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(docs, ["doc_id", "text"], SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark),
    ("mix_sources", mix_sources),
    ("sharding", to_shards),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
