"""Every document operator and stage on tables whose other columns have the
operators' inner names, and on text ids."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from skuflow.llm import mixing, secretscan, sharding, simhash, templates, toxicity
from skuflow.session import materialize

SF = "/root/testdata/sf0.001"
INNER = ("row", "key", "key0", "first", "total", "bucket", "number", "size", "at", "n", "hash", "fp", "text_key", "root",
         "component", "anchor", "lo", "hi", "blocks", "own", "w", "pos", "slots", "toxic", "p_toxic", "item_id", "copies", "k",
         "id", "block", "shards", "target", "taken", "__id", "__key", "__k", "__d", "own_id", "own_key", "values", "windows")


@pytest.fixture
def odd_docs(make_docs):
    rows = [(k, f"some text number {k % 9} of few words in {k}", f"s{k % 3}") for k in range(24)]
    docs = make_docs([*rows, (3, "", "s1"), (4, None, None), (2, "some text number 2 of few words in 2", "s2"), (None, "x y z", "s0")])
    for name in INNER:
        docs = docs.withColumn(name, F.lit("own"))
    return docs


@pytest.mark.parametrize("stage", range(5))
def test_stages_keep_columns_with_inner_names(spark, odd_docs, stage):
    name, run = P.STAGES[stage]
    out = materialize(run(spark, odd_docs, SF), name)
    assert out.columns[:len(odd_docs.columns)] == odd_docs.columns and out.count() > 0
    assert {r[0] for r in out.select("root").collect()} == {"own"}


@pytest.mark.parametrize("run", [sharding.shard_documents, simhash.simhash_groups, secretscan.scan_documents, mixing.mix,
                                 lambda d: toxicity.score_toxicity(d, None),
                                 lambda d: templates.find_items(d, d.select(F.lit(1).alias("item_id"), "text").limit(1))])
def test_operators_ignore_columns_with_inner_names(odd_docs, run):
    run(odd_docs).collect()


def test_text_ids_pass_simhash_and_shards(make_docs):
    docs = make_docs([(k, f"one text of several words {k % 4}") for k in range(20)]).withColumn(
        "doc_id", F.format_string("d%03d", "doc_id"))
    groups = simhash.simhash_groups(docs)
    assert {r["component_id"] for r in groups.collect()} <= {f"d{k:03d}" for k in range(4)}
    assert sorted(r["doc_id"] for r in simhash.one_per_group(docs).collect()) == sorted(
        {r["component_id"] for r in groups.collect()})
    assert sharding.shard_documents(docs).count() == 20
    assert secretscan.scan_documents(docs).schema["doc_id"].dataType.simpleString() == "string"
