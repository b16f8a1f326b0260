import numpy as np
import pytest
from pyspark.sql import functions as F

from skuflow.llm import vectors as V
from skuflow.llm.graph import linked_rows

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    ok = [k for k, (i, e) in enumerate(rows) if i is not None and e and None not in e and np.isfinite(e).all() and np.any(e)]
    x = V.unit(np.array([rows[k][1] for k in ok], dtype=np.float32).astype(float))
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    a, b = np.nonzero(near)
    root = linked_rows(a, b, len(ok))
    ids = np.array([rows[k][0] for k in ok])
    want = [(i, 0, i, True) for k, (i, _) in enumerate(rows) if k not in set(ok)]
    for k in range(len(ok)):
        c = int(ids[root == root[k]].min())
        want.append((int(ids[k]), int(near[k].sum()), c, int(ids[k]) == c))
    return sorted(want, key=str)


def clustered(n, seed, spread=0.25, groups=12, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    x = centres[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, dim))
    return [(int(k), [float(v) for v in np.float32(row)]) for k, row in enumerate(x)]


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, e, 0) for i, e in rows], SCHEMA)
    got = V.near_duplicates(df, **options)
    return sorted(map(tuple, got.drop("audit_recall").collect()), key=str), got.agg(F.min("audit_recall")).first()[0]


def test_equals_brute_force_over_many_shards(spark):
    rows = clustered(900, 1)
    got, recall = run(spark, rows, shard_rows=200)
    want = brute(rows)
    assert recall >= 0.9
    found, true = sum(r[1] for r in got), sum(r[1] for r in want)
    assert true > 500 and 0.97 * true <= found <= true
    assert all(g[1] <= w[1] for g, w in zip(sorted(got), sorted(want)))


def test_a_crowded_cluster_is_cut_into_blocks_without_loss(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=8)
    rows = [(k, [float(v) for v in np.float32(base + 0.01 * rng.normal(size=8))]) for k in range(400)]
    got, _ = run(spark, rows, shard_rows=100)
    assert got == brute(rows) and {r[1] for r in got} == {399}


def test_odd_vectors(spark):
    a, b = [1.0, 0.0, 0.5], [0.0, 1.0, 0.0]
    rows = [(3, a), (1, a), (2, a), (2, a), (9, [2.0, 0.0, 1.0]), (4, b), (5, None), (6, []), (7, [0.0, 0.0, 0.0]),
            (8, [1.0, None, 0.0]), (10, [float("nan"), 1.0, 0.0]), (11, [float("inf"), 1.0, 0.0]), (None, a)]
    got, _ = run(spark, rows)
    assert got == brute(rows)
    other, _ = run(spark, [*rows, (12, [1.0, 0.0]), (13, [1.0, 0.0])])
    assert (12, 1, 12, True) in other and (13, 1, 12, False) in other  # lengths are apart, none is set aside


def test_empty_table(spark):
    assert run(spark, [])[0] == []


@pytest.mark.parametrize("n", [1, 2, 3, 40])
def test_small_graphs(n):
    x = V.unit(np.random.default_rng(n).normal(size=(n, 4)))
    a, b = V.build_graph(x, 0)
    got = V.range_search(x, V.padded(a, b, n), 0.5)
    near = np.triu(x @ x.T >= 0.5, 1)
    assert set(zip(*map(list, got))) == set(zip(*map(list, np.nonzero(near))))


def test_pruned_lists_drop_what_a_nearer_neighbour_covers():
    x = V.unit(np.array([[1, 0], [1, 0.1], [1, 0.11], [0, 1.0]]))
    kept = V.robust_prune(x, np.array([[1, 2, 3]] + [[-1] * 3] * 3))
    assert kept[0].tolist()[:2] == [1, -1] or 2 not in kept[0]


def test_audit_sees_lost_links(spark):
    rows = clustered(300, 5)
    _, nodes = V._nodes(spark.createDataFrame([(i, e, 0) for i, e in rows], SCHEMA))
    none = nodes.select("node", F.lit(0).cast("long").alias("links"))
    assert V.audit_recall(nodes, none, 0.95, 100, 1) == 0.0


def test_vectors_of_two_lengths_equal_brute_force_each(spark):
    long, short = clustered(300, 3), [(1000 + i, e) for i, e in clustered(120, 4, dim=5, groups=4)]
    got, recall = run(spark, [*long, *short], shard_rows=100, sample=150)
    want = sorted([*brute(long), *brute(short)], key=str)
    assert recall >= 0.95 and sum(r[1] for r in got) >= 0.95 * sum(r[1] for r in want)
    alone, _ = run(spark, [*long[:40], (5000, [1.0, 2.0]), (5001, [2.0, 4.0])], sample=30)
    assert (5001, 1, 5000, False) in alone


def test_a_hot_group_does_not_hide_losses(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=12)
    hot = [(k, [float(v) for v in np.float32(base + 0.01 * rng.normal(size=12))]) for k in range(150)]
    pairs = []
    for k in range(40):
        v = rng.normal(size=12)
        pairs += [(1000 + 2 * k + j, [float(x) for x in np.float32(v + 0.01 * j)]) for j in (0, 1)]
    _, nodes = V._nodes(spark.createDataFrame([(i, e, 0) for i, e in [*hot, *pairs]], SCHEMA))
    only_hot = nodes.select("node", F.when(F.col("first_id") < 1000, F.lit(149)).otherwise(0).cast("long").alias("links"))
    assert V.audit_recall(nodes, only_hot, 0.95, 200, 1) < 0.5


def test_below_the_target_all_pairs_are_compared(spark):
    rows = clustered(260, 6)
    got, recall = run(spark, rows, shard_rows=60, target=1.1)
    assert got == brute(rows) and recall == 1.0
