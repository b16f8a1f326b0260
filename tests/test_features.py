"""Feature joins, selection and gap filling."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skuflow.operators import features as Fe


def test_fill_forward_then_backward(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([None, 1.0, None, 2.0, None])],
                               "b int, t int, x double")
    out = Fe.fill_missing(df, ["t"], ["b"], ["x"]).orderBy("t")
    assert [r.x for r in out.collect()] == [1.0, 1.0, 1.0, 2.0, 2.0]


def test_fill_stays_inside_batch(spark):
    df = spark.createDataFrame([(1, 0, 5.0), (1, 1, None), (2, 0, None), (2, 1, None)],
                               "b int, t int, x double")
    got = {(r.b, r.t): r.x for r in Fe.fill_missing(df, ["t"], ["b"], ["x"]).collect()}
    assert got == {(1, 0): 5.0, (1, 1): 5.0, (2, 0): None, (2, 1): None}


def test_global_fill_matches_single_window(spark):
    rnd = random.Random(11)
    data = [(i, rnd.choice([None, None, None, float(i)]), rnd.choice([None, float(-i)]))
            for i in range(2000)]
    data[0] = (0, None, None)
    df = spark.createDataFrame(data, "t int, x double, z double").repartition(7)
    out = Fe.fill_missing_global(df, ["t"], ["x", "z"])
    w = Window.orderBy("t")
    ahead, behind = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    ref = df.select("t", *[F.coalesce(F.last(c, True).over(ahead), F.first(c, True).over(behind)).alias(c)
                           for c in ("x", "z")])
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, ref.collect()))


def test_global_pad_is_forward_only(spark):
    df = spark.createDataFrame([(0, None), (1, 3.0), (2, None)], "t int, x double")
    out = Fe.fill_missing_global(df, ["t"], ["x"], backward=False).orderBy("t")
    assert [r.x for r in out.collect()] == [None, 3.0, 3.0]


def test_global_fill_over_a_hierarchy_of_order_columns(spark):
    """String, whole-number and NULL keys; long gaps that cross every level."""
    rnd = random.Random(2)
    data = [(s, c, t, float(n) if rnd.random() < 0.004 else None)
            for n, (s, c, t) in enumerate((s, c, t) for s in ("a", "b", None) for c in (1, 5, 3000, 70_000, None)
                                          for t in ("01", "02", "03"))]
    data += [("c", c, "01", None) for c in range(5000)] + [("d", 1, "01", 7.5)]
    df = spark.createDataFrame(data, "s string, c int, t string, x double").repartition(6)
    out = Fe.fill_missing_global(df, ["s", "c", "t"], ["x"])
    w = Window.orderBy("s", "c", "t")
    ref = df.select("s", "c", "t", F.coalesce(
        F.last("x", True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        F.first("x", True).over(w.rowsBetween(0, Window.unboundedFollowing))).alias("x"))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, ref.collect()), key=str)


def test_feature_joins_and_clash(spark):
    target = spark.createDataFrame([("m1", 1, 10.0), ("m2", 1, 20.0)], "tm_key string, c int, gmv double")
    time_f = spark.createDataFrame([("m1", 5.0)], "tm_key string, n double")
    cat_f = spark.createDataFrame([("m2", 1, 0.3)], "tm_key string, c int, d double")
    out = Fe.join_category_features(Fe.join_time_features(target, [time_f], "tm_key"), [cat_f], ["c"], ["tm_key"])
    got = {r.tm_key: (r.n, r.d) for r in out.collect()}
    assert got == {"m1": (5.0, None), "m2": (None, 0.3)}
    with pytest.raises(ValueError):
        Fe.join_time_features(target, [time_f, time_f], ["tm_key"])


def test_feature_columns_selection():
    cols = ["tm_key", "c", "gmv", "a", "b", "z"]
    assert Fe.feature_columns(cols, "tm_key", ["c"], "gmv") == ["a", "b", "z"]
    assert Fe.feature_columns(cols, ["tm_key"], ["c"], "gmv", feature_rm_columns=["b"]) == ["a", "z"]
    assert Fe.feature_columns(cols, ["tm_key"], ["c"], "gmv", feature_columns=["z"]) == ["z"]


def test_matrix_computes_the_monthly_facts_once(spark):
    from skuflow.plans import registry as R
    m, feats = R.matrix(spark, "/root/testdata/sf0.001")
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert len(feats) == 21 and "l_extendedprice" not in plan  # formerly six reads of the order lines
