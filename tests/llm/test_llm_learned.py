"""Learned operators: held-out accuracy, bounds and odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skuflow.llm import learning, quality, toxicity

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_logistic_fit_finds_the_least_loss():
    rng = np.random.default_rng(0)
    x = np.hstack([rng.normal(size=(400, 3)), np.ones((400, 1))])
    y = (rng.random(400) < learning.sigmoid(x @ [2.0, -1.0, 0.0, 0.5])).astype(float)
    w = learning.logistic_fit(x, y, 1.0)
    slope = x.T @ (learning.sigmoid(x @ w) - y) + w
    assert np.abs(slope).max() < 1e-2


def test_quality_on_held_out_documents(tables):
    docs, labels = tables
    scored = quality.score_documents(docs, quality.fit_ranking(docs, labels))
    got = scored.join(labels, "doc_id").toPandas()
    assert scored.count() == docs.count()
    assert all((zlib.crc32(str(i).encode()) % 4 == 2) == h for i, h in zip(got["doc_id"], got["held_out"]))
    out = got[got["held_out"]]
    assert len(out) > 50 and (out["predicted"] == out["quality"]).mean() >= 0.95
    assert ((got["score"] >= 0.7).astype(int) == got["predicted"]).all() and got["score"].between(0, 1).all()


def test_quality_learns_nothing_from_held_out_rows(tables):
    docs, labels = tables
    turned = labels.withColumn("quality", F.when(quality.is_held_out(F.col("doc_id")), 1 - F.col("quality"))
                               .otherwise(F.col("quality")))
    one, two = (quality.score_documents(docs, quality.fit_ranking(docs, x)).orderBy("doc_id").toPandas()
                for x in (labels, turned))
    assert one.equals(two)


ODD = [(1, None), (2, ""), (3, "plain words here"), (3, "plain words here"), (None, "x"), (4, "A!! " * 50_000), (5, " \n\t")]


def test_quality_of_odd_rows(spark, make_docs, tables):
    docs, labels = tables
    model = quality.fit_ranking(docs, labels)
    got = quality.score_documents(make_docs(ODD).withColumnRenamed("lang", "score"), model).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in (1, 2, 5)}
    assert len(empty) == 1 and {r["held_out"] for r in got if r["doc_id"] is None} == {False}
    assert quality.score_documents(make_docs([]), model).collect() == []
    for rows in ([], [(3, 1, 0)], [(3, None, 0), (None, 0, 0)]):
        flat = quality.fit_ranking(make_docs(ODD), spark.createDataFrame(rows, LABELS))
        assert {r["score"] for r in quality.score_documents(make_docs(ODD), flat).collect()} == {0.5}


def test_features_of_empty_and_repeated_text():
    assert not quality.text_features(None).any() and not quality.text_features(" \n").any()
    f = quality.text_features("go go go go")
    assert f[9] == 0.75 and f[7] == 0.25 and f[8] == 1.0


def test_toxicity_on_documents_not_learned_from(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    chain = toxicity.fit_chain(docs, labels.where(~held))
    mine = docs.join(labels.where(held).select("doc_id", F.col("toxic").alias("y")), "doc_id")
    got = toxicity.score_toxicity(mine, chain, carry=("doc_id", "y")).toPandas()
    hit = got[got["y"] == 1]
    assert len(hit) >= 100 and hit["toxic"].mean() >= 0.9
    assert got[got["y"] == 0]["toxic"].mean() <= 0.005


def test_chain_feeds_earlier_probabilities_out_of_fold():
    rng = np.random.default_rng(1)
    x = (rng.random((300, 20)) < 0.3).astype(float)
    first = (x[:, 3] > 0).astype(float)
    use = np.arange(20)
    chain = toxicity.Chain.fit(("a", "b"), x, np.stack([first, first], axis=1), np.arange(300) % 3, use,
                               {f: use for f in range(3)}, list(range(20)))
    assert [len(w) for w in chain.links] == [21, 22] and chain.links[1][-2] > 0.5


def test_features_are_chosen_by_how_far_shares_lie_apart():
    hot, cold = np.array([50, 3, 50, 2, 0]), np.array([0, 0, 500, 0, 90])
    assert toxicity.choose(hot, cold, 100, 1000, features=2).tolist() == [0, 1]


def test_toxicity_of_odd_rows(spark, make_docs, tables):
    docs, labels = tables
    chain = toxicity.fit_chain(docs, labels)
    mine = make_docs(ODD).withColumnRenamed("lang", "toxic")
    got = toxicity.score_toxicity(mine, chain).collect()
    assert len(got) == len(ODD)
    assert all(r["p_toxic"] == 0 and not r["toxic"] for r in got if r["doc_id"] in (1, 2, 5))
    whole = toxicity.score_toxicity(make_docs(ODD), chain, carry=make_docs([]).columns)
    assert sorted(map(str, whole.select(*make_docs([]).columns).collect())) == sorted(map(str, make_docs(ODD).collect()))
    assert toxicity.score_toxicity(make_docs([]), chain).collect() == []
    for rows in ([], [(3, 1, 0)], [(3, 1, None), (None, 1, 1)]):
        none = toxicity.fit_chain(make_docs(ODD), spark.createDataFrame(rows, LABELS))
        assert none is None
    assert {r["p_toxic"] for r in toxicity.score_toxicity(make_docs(ODD), None).collect()} == {0.0}


def test_word_table_may_be_emptied(tables, monkeypatch):
    docs, labels = tables
    chain = toxicity.fit_chain(docs, labels)
    texts = [r["text"] for r in docs.limit(30).collect()]
    one = [chain.scorer()(t) for t in texts]
    monkeypatch.setattr(toxicity, "CACHED", 5)
    score = chain.scorer()
    assert [score(t) for t in texts] == one


def labelled_rows(spark, rng, n):
    x = rng.normal(size=(n, quality.NARROW))
    y = (x[:, 0] + 0.5 * rng.normal(size=n) > 0.3).astype(float)
    rows = spark.createDataFrame([(row.tolist(), float(v)) for row, v in zip(x, y)], "x array<double>, y double")
    return x, y, rows


def test_quality_weights_have_the_least_loss_of_all_pairs(spark):
    x, y, rows = labelled_rows(spark, np.random.default_rng(5), 120)
    model = quality.Ranking(x.mean(axis=0), x.std(axis=0), None)
    got = quality._fit_weights(rows, model, 500, 1.0)
    wide = model.wide(x)
    gap = (wide[y > 0][:, None] - wide[y <= 0][None]).reshape(-1, 2 * quality.NARROW)
    slope = -500 * (quality.sigmoid(-gap @ got)[:, None] * gap).mean(axis=0) + got
    assert np.abs(got).max() > 0.5 and np.abs(slope).max() < 0.02


def test_quality_learns_from_all_labelled_rows(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    x = F.array(*[F.col("doc_id") % 2 + F.when(F.col("doc_id") == 777, 1e6).otherwise(0) + F.lit(0.0)] * quality.NARROW)
    features = docs.select("doc_id", x.alias("x"))
    used = labels.where(~quality.is_held_out(F.col("doc_id"))).count()
    assert used > 14_000  # formerly 12,000 of them
    model = quality.fit_features(features, labels, penalty=1e5)
    want = features.join(labels, "doc_id").where(~quality.is_held_out(F.col("doc_id"))).agg(F.avg(F.col("x")[0])).first()[0]
    assert model.mean[0] == pytest.approx(want, rel=1e-9) and model.weights is not None


def test_ranked_value_is_exact(spark):
    values = np.sort(np.r_[np.random.default_rng(2).normal(size=500), [0.25] * 300, 1e9, -1e9])
    scores = spark.createDataFrame([(float(v),) for v in values], "s double")
    assert [quality.ranked_value(scores, k) for k in (0, 1, 400, 499, 800, 801)] == [values[k] for k in (0, 1, 400, 499, 800, 801)]
