"""Split, eligibility, per-batch fits, clipping and scores."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skuflow.operators import forecast as M
from skuflow.operators import metrics as Me

SCHEMA = "tm_key string, batch int, y double, x1 double, x2 double"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def line_data(batch, a, b, months=("01", "02", "03", "04", "05")):
    return [(f"2017-{m}", batch, a + b * i, float(i), float(2 * i)) for i, m in enumerate(months)]


def test_split_overlap_and_neither(spark):
    df = frame(spark, line_data(1, 1.0, 2.0))
    out = M.split_rows(df, "tm_key", "2017-03", ["2017-03", "2017-05"])
    got = sorted((r.tm_key, r.split) for r in out.collect())
    assert got == [("2017-01", "train"), ("2017-02", "train"), ("2017-03", "test"),
                   ("2017-03", "train"), ("2017-05", "test")]


def test_eligibility_needs_train_and_test(spark):
    df = frame(spark, line_data(1, 1.0, 2.0) + line_data(2, 0.0, 1.0, months=("01", "02")))
    labeled = M.split_rows(df, "tm_key", "2017-03", ["2017-04"])
    assert [r.batch for r in M.eligible_batches(labeled, ["batch"]).collect()] == [1]
    assert {r.batch for r in M.keep_eligible(labeled, ["batch"]).collect()} == {1}


def test_ols_recovers_line_with_collinear_columns(spark):
    # x2 = 2 * x1: rank deficient; predictions must still follow y = 3 + 0.5 x1
    df = frame(spark, line_data(1, 3.0, 0.5) + line_data(2, -1.0, 4.0))
    labeled = M.split_rows(df, "tm_key", "2017-04", ["2017-05"])
    out = M.linear_forecast(labeled, ["batch"], ["x1", "x2"], "y")
    for r in out.collect():
        assert r.y_ == pytest.approx(r.y, abs=1e-9)


def test_ridge_shrinks_towards_mean(spark):
    df = frame(spark, line_data(1, 3.0, 0.5))
    labeled = M.split_rows(df, "tm_key", "2017-04", ["2017-05"])
    ols = M.linear_forecast(labeled, ["batch"], ["x1"], "y").where("split = 'test'").first().y_
    ridge = M.linear_forecast(labeled, ["batch"], ["x1"], "y", alpha=10.0) \
        .where("split = 'test'").first().y_
    assert ols == pytest.approx(5.0)
    assert 3.75 < ridge < ols   # pulled towards the train mean 3.75


def test_centred_sums_match_lstsq():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 3)) + [0.0, 1e6, 0.0]   # a large mean must not cancel
    x[:, 2] = x[:, 0] + x[:, 1]
    y = x @ [1.0, -2.0, 0.5] + 4.0
    xc, yc = x - x.mean(0), y - y.mean()
    b0, beta = M.solve_centred(np.r_[x.mean(0), y.mean()], (xc.T @ xc)[np.triu_indices(3)], xc.T @ yc)
    np.testing.assert_allclose(b0 + x @ beta, y, rtol=1e-9)


def labelled(spark, data):
    return M.split_rows(frame(spark, data), "tm_key", "2017-04", ["2017-05"])


def test_a_batch_without_targets_keeps_its_rows(spark):
    data = line_data(1, 3.0, 0.5) + [(f"2017-0{i}", 2, None, 1.0, 2.0) for i in range(1, 6)]
    for out in (M.linear_forecast(labelled(spark, data), ["batch"], ["x1"], "y"),
                M.ols_one_feature(labelled(spark, data), ["batch"], "x1", "y")):
        rows = out.collect()
        assert len(rows) == 10
        assert all((r.y_ is None) == (r.batch == 2) for r in rows)
    status = {r.batch: r.fit_status for r in M.linear_forecast(labelled(spark, data), ["batch"], ["x1"], "y").collect()}
    assert status == {1: M.FITTED, 2: M.NO_TARGET}


def test_infinite_and_missing_features(spark):
    data = line_data(1, 3.0, 0.5) + [(f"2017-0{i}", 2, float(i), math.inf if i == 2 else float(i), None) for i in range(1, 6)]
    rows = M.linear_forecast(labelled(spark, data), ["batch"], ["x1", "x2"], "y").collect()
    assert all(r.y_ is not None and math.isfinite(r.y_) for r in rows)
    dropped = M.linear_forecast(labelled(spark, data), ["batch"], ["x1"], "y", missing="drop").collect()
    assert {r.tm_key for r in dropped if r.y_ is None} == {"2017-02"}
    assert all(r.y_ == pytest.approx(r.y) for r in dropped if r.y_ is not None)
    user = M.python_model_forecast(labelled(spark, data), ["batch"], ["x1"], "y").collect()
    assert len(user) == 10 and all(math.isfinite(r.y_) for r in user)


def test_large_whole_numbers_do_not_overflow(spark):
    df = spark.createDataFrame([(f"2017-0{i}", 1, 2.0 * i, 4_000_000_000 + i) for i in range(1, 6)],
                               "tm_key string, batch int, y double, x bigint")
    out = M.ols_one_feature(M.split_rows(df, "tm_key", "2017-04", ["2017-05"]), ["batch"], "x", "y")
    assert all(r.y_ == pytest.approx(r.y, abs=1e-4) for r in out.collect())


def test_gbt_takes_string_batch_keys(spark):
    rows = [(t, f"b{b}", y, x1, x2) for b in (1, 2) for t, _, y, x1, x2 in line_data(b, 10.0 * b, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA.replace("batch int", "batch string"))
    out = M.gbt_forecast(M.split_rows(df, "tm_key", "2017-04", ["2017-05"]), ["batch"], ["x1"], "y", max_iter=5)
    assert out.where("y_ is not null").count() == 10 and "_gbt_features" not in out.columns


def test_an_oversized_batch_is_named(spark):
    with pytest.raises(Exception, match="too many for one task"):
        M.python_model_forecast(labelled(spark, line_data(1, 3.0, 0.5)), ["batch"], ["x1"], "y", max_batch_rows=3).collect()


def test_one_feature_exact_and_constant_regressor(spark):
    df = frame(spark, line_data(1, 2.0, 3.0) + [(f"2017-0{i}", 2, float(i), 7.0, 0.0)
                                                for i in range(1, 6)])
    labeled = M.split_rows(df, "tm_key", "2017-04", ["2017-05"])
    out = {(r.batch, r.tm_key): r.y_ for r in M.ols_one_feature(labeled, ["batch"], "x1", "y").collect()}
    assert out[(1, "2017-05")] == pytest.approx(14.0)
    assert out[(2, "2017-05")] == pytest.approx(2.5)   # slope 0, mean of train targets


def test_python_model_per_batch(spark):
    df = frame(spark, line_data(1, 3.0, 0.5) + line_data(2, -1.0, 4.0))
    labeled = M.split_rows(df, "tm_key", "2017-04", ["2017-05"])
    out = M.python_model_forecast(labeled, ["batch"], ["x1"], "y")
    assert out.count() == 10
    for r in out.collect():
        assert r.y_ == pytest.approx(r.y, abs=1e-9)


def test_forecast_spec_validates_and_normalises():
    spec = M.ForecastSpec("y", "tm_key", "batch", "batch", "tm_key", "2017-03", "2017-04")
    assert spec.keys_time == ["tm_key"] and spec.test_values == ["2017-04"]
    with pytest.raises(ValueError):
        M.ForecastSpec("y", "t", "b", "b", "t", "x", ["y"], method="nope")


def test_no_eligible_batch_gives_empty_result(spark):
    df = frame(spark, line_data(1, 1.0, 1.0, months=("01", "02")))
    spec = M.ForecastSpec("y", "tm_key", "batch", "batch", "tm_key", "2017-03", ["2017-09"])
    out = M.forecast(df, spec, ["x1"])
    assert out.count() == 0 and "y_" in out.columns


def test_clip_and_zero_whole_row(spark):
    df = spark.createDataFrame([("a", 1, 5.0, -1.0), ("b", 2, 4.0, 2.0)],
                               "tm_key string, batch int, y double, y_ double")
    assert [r.y_ for r in Me.clip_predictions(df).orderBy("batch").collect()] == [0.0, 2.0]
    zero = Me.zero_negative_rows(df).orderBy("batch").collect()
    assert tuple(zero[0]) == ("0", 0, 0.0, 0.0) and tuple(zero[1]) == ("b", 2, 4.0, 2.0)
    kept = Me.zero_negative_rows(df.withColumn("split", F.lit("test"))).orderBy("batch").first()
    assert kept.split == "test" and kept.tm_key == "0"


def test_scores_miss_pad_and_total_error(spark):
    df = spark.createDataFrame(
        [("train", 1, "01", 10.0, 11.0),   # ape 0.1: hit
         ("train", 1, "02", 0.0, 1.0),     # undefined
         ("train", 1, "03", 10.0, 20.0),   # ape 1.0: miss
         ("train", 1, "04", -10.0, 5.0)],  # signed actual: ape -1.5 counts as a hit
        "split string, batch int, tm_key string, y double, y_ double")
    miss = Me.hit_rate(df, "y").first().hit_rate
    pad = Me.hit_rate(df, "y", undefined="pad", order_cols=["batch", "tm_key"]).first().hit_rate
    assert miss == pytest.approx(2 / 4) and pad == pytest.approx(3 / 4)
    err = Me.total_error(df, "y").first().total_error
    assert err == pytest.approx(abs(10.0 - 37.0) / 10.0)
    missing = df.unionAll(spark.createDataFrame([("train", 1, "05", 1.0, None)], df.schema))
    assert Me.total_error(missing, "y").first().total_error is None
    size = Me.hit_rate(df, "y", abs_denominator=True).first().hit_rate
    assert size == pytest.approx(1 / 4)   # -10 against 5 is a miss by its size
    zero = spark.createDataFrame([("test", 0.0, 1.0)], "split string, y double, y_ double")
    assert Me.total_error(zero, "y").first().total_error == math.inf


def test_pad_does_not_cross_split_border(spark):
    df = spark.createDataFrame(
        [("test", 1, "05", 10.0, 10.5),    # defined, hit
         ("train", 1, "01", 0.0, 1.0),     # undefined first in train: stays a miss
         ("train", 1, "02", 10.0, 10.1)],  # hit
        "split string, batch int, tm_key string, y double, y_ double")
    got = {r.split: r.hit_rate for r in
           Me.hit_rate(df, "y", undefined="pad", order_cols=["batch", "tm_key"]).collect()}
    assert got == {"test": 1.0, "train": 0.5}
