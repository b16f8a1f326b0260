import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skuflow.llm import mixing as M


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def rows_of(n=400):
    rng = np.random.default_rng(3)
    out = []
    for k in range(n):
        source = ["a", "b", "c", None, "é", "d"][min(5, int(rng.exponential(1.2)))]
        out.append((k, "w " * int(rng.integers(0, 30)), source))
    return out


def plain_targets(totals):
    keys = sorted((k for k in totals if k is not None)) + [None] * (None in totals)
    weight = {k: (3, 1, 2)[n % 3] for n, k in enumerate(keys)}
    target, left, open_ = {}, 1.5 * sum(totals.values()), set(keys)
    while open_:
        unit = left / sum(weight[k] for k in open_)
        over = [k for k in open_ if unit * weight[k] > 2 * totals[k]]
        if not over:
            target |= {k: unit * weight[k] for k in open_}
            break
        for k in over:
            target[k] = 2.0 * totals[k]
            left -= target[k]
            open_.discard(k)
    return target


def test_targets_sizes_and_taken_words(make_docs):
    rows = rows_of()
    got = {r["doc_id"]: r for r in M.mix(make_docs(rows).withColumn("size", F.lit("clash"))).collect()}
    totals, taken = Counter(), Counter()
    for i, t, s in rows:
        totals[s] += size(t)
        taken[s] += got[i]["taken"]
        assert got[i]["size"] == size(t) and got[i]["taken"] in (0, size(t), 2 * size(t))
        assert len(got[i]["shards"]) == got[i]["copies"] and all(0 <= x < M.SHARDS for x in got[i]["shards"])
    target = plain_targets(totals)
    for i, t, s in rows:
        assert got[i]["source_size"] == totals[s] and got[i]["target"] == pytest.approx(target[s])
    for s in totals:
        assert abs(taken[s] - target[s]) <= 30


def test_few_blocks_cut_at_the_border(make_docs):
    rows = rows_of()
    got = M.mix(make_docs(rows), blocks=2).groupBy("source_size", "target").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(r["t"] - r["target"]) <= 60 for r in got)


def test_reruns_agree_and_order_of_input_does_not_matter(make_docs):
    rows = rows_of()
    one, two = (sorted(map(str, M.mix(d).collect())) for d in (make_docs(rows), make_docs(rows[::-1]).repartition(5)))
    assert one == two


def test_odd_rows(make_docs):
    rows = [(1, None, "a"), (1, None, "a"), (2, "", None), (None, "x y", "b"), (3, "z " * 5000, "b"), (4, "q", "")]
    got = M.mix(make_docs(rows)).collect()
    assert len(got) == 6 and sorted(r["size"] for r in got) == [0, 0, 0, 1, 2, 5000]
    assert M.mix(make_docs([])).collect() == [] and M.mixed_documents(make_docs([])).collect() == []
    none = M.mix(make_docs([(1, None, "a"), (2, "", "b")])).collect()
    assert {r["taken"] for r in none} == {0} and {r["target"] for r in none} == {0.0}


def test_documents_come_as_often_as_they_are_taken(make_docs):
    rows = rows_of()
    docs = make_docs(rows)
    copies = {r["doc_id"]: r["copies"] for r in M.mix(docs).collect()}
    mixed = M.mixed_documents(docs)
    assert mixed.columns == docs.columns
    seen = Counter(r["doc_id"] for r in mixed.collect())
    assert seen == Counter({i: n for i, n in copies.items() if n})
    whole = {r["doc_id"]: r for r in docs.collect()}
    assert all(r == whole[r["doc_id"]] for r in mixed.collect())


def test_tree_splits_quotas_exactly():
    blocks = [1000, 0, 37, 5]
    for shards in (1, 2, 7, 16):
        got = M.split_quotas(blocks, shards, 5)
        assert got.sum(axis=0).tolist() == blocks and (got >= 0).all()
        assert got.sum(axis=1).max() - got.sum(axis=1).min() <= np.ceil(np.log2(shards)) + 1
        assert (got == M.split_quotas(blocks, shards, 5)).all()
    assert (M.split_quotas(blocks, 8, 1) != M.split_quotas(blocks, 8, 2)).any()


def test_shards_of_a_source_are_disjoint_runs_of_about_equal_share(make_docs):
    docs = make_docs([(k, "w " * 10, "a") for k in range(2000)])
    per = M.mix(docs, blocks=256, shards=4).select(F.explode("shards").alias("s")).groupBy("s").count().collect()
    assert len(per) == 4 and sum(r["count"] for r in per) == 3000
    assert max(r["count"] for r in per) < 1.5 * min(r["count"] for r in per)
