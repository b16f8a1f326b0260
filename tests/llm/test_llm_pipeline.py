"""The pipeline against plain versions of its stages, and the registered queries."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as P
from oracle_check import compare, duck_connection
from skuflow.llm import mixing, registry, simhash, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Name -> rows before and after."""
    out, docs = {}, spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in P.STAGES:
        new = P.materialize(stage(spark, docs, SF), name)
        out[name] = docs, new
        docs = new
    return out


def test_columns_and_order_of_stages(stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "mix_sources", "sharding"]
    for n, (before, after) in stages.items():
        assert after.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
        assert len(after.columns) == (7 if n == "sharding" else 5)


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in after.collect()}
    ids = [r["doc_id"] for r in before.collect()]
    bad, good = [[i in kept for i in ids if labels.get(i) == x] for x in (1, 0)]
    # 87 labelled rows teach little; test_llm_learned has the accuracy on more
    assert bad and sum(bad) <= 0.3 * len(bad) and sum(good) >= 0.95 * len(good)


def test_one_document_of_each_group(stages):
    before, after = stages["simhash_near_dedup"]
    fps = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in before.collect()}
    group = {i: i for i in fps}
    for i in sorted(fps):
        for j in fps:
            if j < i and (fps[i] ^ fps[j]).bit_count() <= 3 and group[i] != group[j]:
                a, b = sorted((group[i], group[j]))
                group = {k: a if g == b else g for k, g in group.items()}
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(set(group.values()))


def test_benchmark_passages_go(spark, stages):
    before, after = stages["benchmark_decontamination"]
    items = [" ".join(r["text"].split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {r["doc_id"] for r in before.collect() if any(t in " ".join((r["text"] or "").split()) for t in items)}
    gone = {r["doc_id"] for r in before.collect()} - {r["doc_id"] for r in after.collect()}
    assert leaked <= gone and len(gone - leaked) <= 0.1 * len(gone)


def test_mix_and_shards(stages):
    before, after = stages["mix_sources"]
    copies = Counter({r["doc_id"]: r["copies"] for r in mixing.mix(before).collect() if r["copies"]})
    assert Counter(r["doc_id"] for r in after.collect()) == copies
    before, after = stages["sharding"]
    rows = after.collect()
    assert Counter(r[:5] for r in rows) == Counter(tuple(r) for r in before.collect())
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len({(r["shard"], r["slot"]) for r in rows}) == len(rows)


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(str, P.run(spark, SF).collect())) == sorted(map(str, stages["sharding"][1].collect()))


def test_extra_columns_with_clashing_names_pass_every_stage(spark, make_docs):
    rows = [(k, f"some text number {k} of few words", "s") for k in range(30)] + [(None, None, None), (3, "", "s")]
    docs = make_docs(rows)
    for name in ("row", "toxic", "p_toxic", "fp", "size", "item_id", "doc", "copies", "hash"):
        docs = docs.withColumn(name, F.lit(1))
    before = docs
    for name, stage in P.STAGES:
        after = P.materialize(stage(spark, before, SF), name)
        assert after.columns[:len(docs.columns)] == docs.columns
        before = after
    assert 0 < before.count() <= 2 * len(rows)


@pytest.mark.parametrize("stage", range(5))
def test_empty_tables_pass_every_stage(spark, make_docs, stage):
    name, run = P.STAGES[stage]
    assert run(spark, make_docs([]), SF).count() == 0


def test_toxicity_without_labels_keeps_all(spark, make_docs):
    docs = make_docs([(1, "a b"), (2, None)])
    assert toxicity.score_toxicity(docs, None).where("not toxic").count() == 2


def test_every_operator_has_one_query():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_queries_equal_their_sql(spark, name):
    res = compare(spark, duck_connection(SF), name, registry.QUERIES[name], registry.ORACLE[name], SF)
    assert str(res["status"]).startswith("ok"), res


@pytest.mark.parametrize("name", ["op2_feistel_sharding", "op6_url_rules", "op7_template_windows"])
def test_native_queries_plan_no_python_and_no_cross_join(spark, name):
    plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop") if x in plan]
