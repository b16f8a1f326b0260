"""Models fitted in parts against numpy on whole batches."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skuflow.functions.numeric import month_index
from skuflow.operators import forecast as M
from skuflow.operators import states as S
from skuflow.operators.boosting import boosted_trees
from skuflow.operators.rolling import rolling_forecast, rolling_scores


def whole_fit(x, y):
    """Minimum-norm least squares on standardised columns, by numpy."""
    xm, ym = x.mean(0), y.mean()
    scale = (x - xm).std(0)
    scale[scale <= 1e-12 * np.abs(x).max(0, initial=1e-300)] = np.inf
    z, *_ = np.linalg.lstsq((x - xm) / scale, y - ym, rcond=1e-12)
    return lambda new: ym + (new - xm) / scale @ z


def feature_table(seed=4, k=21, n=90, batches=("a", "b", "null-heavy 1", "null-heavy 2", "null-heavy 3")):
    rng = np.random.default_rng(seed)
    parts = []
    for b in batches:
        base = rng.uniform(0, 0.4, (n, 3))
        x = base[:, rng.integers(0, 3, k)] + rng.normal(size=(n, k)) * 1e-6  # discounts: nearly collinear
        x[:, 0] = rng.normal(1e6, 10, n)
        x[:, 1] = 5.0  # constant
        y = x @ rng.normal(size=k) + rng.normal(size=n)
        frame = pd.DataFrame(x, columns=[f"x{i}" for i in range(k)])
        if b.startswith("null"):
            frame[rng.random((n, k)) < 0.9] = np.nan
        frame["y"], frame["batch"], frame["t"] = y, b, np.arange(n)
        parts.append(frame)
    return pd.concat(parts, ignore_index=True), [f"x{i}" for i in range(k)]


def spark_frame(spark, pdf):
    rows = pdf.astype(object).where(pdf.notna(), None).values.tolist()
    kinds = {"f": "double", "i": "long", "O": "string"}
    return spark.createDataFrame(rows, ", ".join(f"{c} {kinds[t.kind]}" for c, t in pdf.dtypes.items()))


@pytest.mark.parametrize("held", [1, 512])
def test_21_nearly_collinear_features_equal_numpy(spark, held, monkeypatch):
    monkeypatch.setattr(S, "HELD", held)
    pdf, feats = feature_table()
    df = spark_frame(spark, pdf).repartition(7)
    labeled = M.split_rows(df, "t", 79, list(range(80, 90)))
    got = M.linear_forecast(labeled, ["batch"], feats, "y").toPandas()
    assert len(got) == len(pdf)
    for b, part in pdf.groupby("batch"):
        x, y = part[feats].fillna(0.0).to_numpy(), part["y"].to_numpy()
        want = whole_fit(x[:80], y[:80])(x)
        mine = got[got.batch == b].sort_values("t").y_.to_numpy()
        np.testing.assert_allclose(mine[:80], want[:80], rtol=1e-7, atol=1e-5)
        residual = y[:80] - mine[:80]
        size = np.linalg.norm(x[:80], axis=0) * np.linalg.norm(y[:80])
        assert (np.abs(x[:80].T @ residual) <= 1e-10 * np.maximum(size, 1)).all() and abs(residual.sum()) < 1e-6 * np.abs(y[:80]).sum()


def test_factors_keep_digits_that_products_lose():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 1)) @ np.ones((1, 2)) + rng.normal(size=(200, 2)) * 1e-7
    y = x @ [1e7, -1e7] + 1.0
    model, state = S.LeastSquares(), None
    for at in range(0, 200, 13):
        part = model.partial_fit(None, x[at:at + 13], y[at:at + 13])
        state = part if state is None else model.merge(part, state)
    np.testing.assert_allclose(model.predict(state, x), y, rtol=1e-6)


def test_ridge_equals_the_normal_equations(spark):
    pdf, feats = feature_table(k=5)
    labeled = M.split_rows(spark_frame(spark, pdf), "t", 79, [80])
    got = M.linear_forecast(labeled, ["batch"], feats, "y", alpha=1.0).toPandas()
    for b, part in pdf[pdf.t < 80].groupby("batch"):
        x, y = part[feats].fillna(0.0).to_numpy(), part["y"].to_numpy()
        xc, yc = x - x.mean(0), y - y.mean()
        beta = np.linalg.solve(xc.T @ xc + np.eye(5), xc.T @ yc)
        mine = got[(got.batch == b) & (got.split == "train")].sort_values("t").y_.to_numpy()
        np.testing.assert_allclose(mine, y.mean() + xc @ beta, rtol=1e-6, atol=1e-6)


def test_products_and_factors_agree_on_tame_data(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(60, 3)), columns=["x0", "x1", "x2"]).assign(t=range(60), batch=1)
    pdf["y"] = pdf.x0 - 2 * pdf.x1 + rng.normal(size=60)
    labeled = M.split_rows(spark.createDataFrame(pdf), "t", 49, [55])
    a, b = (M.linear_forecast(labeled, ["batch"], ["x0", "x1", "x2"], "y", summary=s).toPandas().sort_values(["t", "split"])
            for s in ("products", "factors"))
    np.testing.assert_allclose(a.y_, b.y_, rtol=1e-9)
    with pytest.raises(ValueError):
        M.fit_linear(labeled, ["batch"], ["x0"], "y", summary="other")


def running_mean():
    """A user's model without any linear algebra."""
    class RunningMean:
        def partial_fit(self, state, x, y):
            n, s = state or (0, 0.0)
            return n + len(y), s + float(y.sum())

        def merge(self, a, b):
            return a[0] + b[0], a[1] + b[1]

        def predict(self, state, x):
            return np.full(len(x), state[1] / state[0])
    return RunningMean()


def test_a_mergeable_model_takes_a_batch_of_two_million_rows(spark):
    df = spark.range(2_000_000).select(
        F.when(F.col("id") % 1000 < 999, "hot").otherwise("small").alias("batch"), (F.col("id") % 7).cast("double").alias("y"),
        F.rand(1).alias("x"), F.when(F.col("id") % 10 == 0, M.TEST).otherwise(M.TRAIN).alias("split"))
    out = M.python_model_forecast(df, ["batch"], ["x"], "y", running_mean())
    got = {r["batch"]: r for r in out.groupBy("batch").agg(
        F.count("y_").alias("n"), F.min("y_").alias("low"), F.max("y_").alias("high"), F.first("fit_status").alias("s")).collect()}
    want = {r["batch"]: r["m"] for r in df.where("split = 'train'").groupBy("batch").agg(F.avg("y").alias("m")).collect()}
    assert sum(r["n"] for r in got.values()) == 2_000_000
    for b, r in got.items():
        assert r["low"] == r["high"] == pytest.approx(want[b]) and r["s"] == S.FITTED
    with pytest.raises(Exception, match="too many for one task"):
        M.python_model_forecast(df, ["batch"], ["x"], "y").count()


def test_mergeable_models_on_odd_batches(spark):
    rows = [("a", 1.0, 2.0, "train"), ("a", None, 3.0, "train"), ("a", float("inf"), 3.0, "test"), ("b", 1.0, None, "train"),
            ("b", 1.0, 1.0, "test"), (None, 1.0, 4.0, "train")]
    df = spark.createDataFrame(rows, "batch string, x double, y double, split string").withColumn("extra", F.array(F.lit("z")))
    out = M.python_model_forecast(df, ["batch"], ["x"], "y", running_mean()).collect()
    assert sorted((r["batch"], r["y_"], r["fit_status"]) for r in out if r["batch"]) == [
        ("a", 2.5, S.FITTED)] * 3 + [("b", None, S.NO_TARGET)] * 2
    assert M.python_model_forecast(df.limit(0), ["batch"], ["x"], "y", running_mean()).count() == 0


# ---- rolling origins --------------------------------------------------------------

def test_rolling_origins_equal_a_fit_of_every_origin(spark):
    rng = np.random.default_rng(9)
    rows = [(b, f"{1999 + m // 12}-{m % 12 + 1:02d}", float(x := rng.normal(50, 9)), float(3 * x + m + rng.normal()))
            for b in (1, 2, 3) for m in range(30) if not (b == 2 and m < 14) and not (b == 3 and m % 5 == 0)]
    pdf = pd.DataFrame(rows, columns=["b", "tm", "x", "y"])
    pdf["p"] = pdf.tm.str[:4].astype(int) * 12 + pdf.tm.str[5:].astype(int)
    base = 1999 * 12 + 1
    origins, span = [base + 8, base + 15, base + 22], 4
    out = rolling_forecast(spark.createDataFrame(pdf.drop(columns="p")), ["b"], month_index("tm"), ["x"], "y", origins, span)
    got = {(r["b"], r["tm"], r["origin"]): r["y_"] for r in out.collect()}
    want = {}
    for o in origins:
        for b, part in pdf.groupby("b"):
            train = part[part.p <= o]
            if len(train):
                f = whole_fit(train[["x"]].to_numpy(), train.y.to_numpy())
                want |= {(b, r.tm, o): f(np.array([r.x]))[()] for r in part[(part.p > o) & (part.p <= o + span)].itertuples()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(float(want[k]), rel=1e-9) for k in got)
    assert not [k for k in got if k[0] == 2 and k[2] == origins[0]]  # no history yet
    scores = {r["origin"]: r for r in rolling_scores(out, "y", "b").collect()}
    assert scores[origins[0]]["n_batches"] == 2 and set(scores) == set(origins)


# ---- boosting -----------------------------------------------------------------------

def plain_booster(x, y, new, trees, depth, rate, bins, least):
    """The same booster for one batch, node by node."""
    low, high = x.min(0), x.max(0)
    width = np.where(high > low, high - low, np.inf)
    cut = lambda v: np.clip(np.floor((v - low) / width * bins), 0, bins - 1).astype(int)
    bx, bn = cut(x), cut(new)
    f, fn = np.full(len(x), y.mean()), np.full(len(new), y.mean())
    for _ in range(trees):
        node, node_new = np.ones(len(x), int), np.ones(len(new), int)
        for level in range(depth):
            for at in sorted(set(node[node >= 2 ** level])):
                own, r = node == at, (y - f)[node == at]
                best = None
                for j in range(x.shape[1]):
                    for c in sorted(set(bx[own, j])):
                        left = bx[own, j] <= c
                        if least <= left.sum() <= own.sum() - least and (r ** 2).sum() > 0:
                            gain = round((r[left].sum() ** 2 / left.sum() + r[~left].sum() ** 2 / (~left).sum()
                                          - r.sum() ** 2 / len(r)) / (r ** 2).sum(), 9)
                            if gain > 0 and (best is None or (gain, -j, -c) > best):
                                best = gain, -j, -c
                if best:
                    j, c = -best[1], -best[2]
                    new_at, go = node_new == at, lambda b: at * 2 + (b > c)
                    node[own], node_new[new_at] = go(bx[own, j]), go(bn[new_at, j])
        for at in set(node):
            value = rate * (y - f)[node == at].mean()
            fn[node_new == at] += value
            f[node == at] += value
    return fn


def test_boosted_trees_equal_a_plain_booster_per_batch(spark):
    rng = np.random.default_rng(12)
    pdf = pd.DataFrame(rng.normal(size=(240, 3)), columns=["x0", "x1", "x2"])
    pdf["batch"] = ["hot"] * 160 + ["b"] * 60 + ["tiny"] * 3 + ["none"] * 17
    pdf["x2"] = pdf.x2.round(1)
    pdf["y"] = np.where(pdf.x0 > 0.2, 5.0, pdf.x1 * 2) + rng.normal(size=240) * 0.1
    pdf["used"] = rng.random(240) < 0.8
    pdf.loc[pdf.batch == "none", "used"] = False
    pdf.loc[pdf.batch == "tiny", "used"] = True
    settings = dict(trees=4, depth=3, rate=0.5, bins=16, least=2)
    out = boosted_trees(spark.createDataFrame(pdf).repartition(3), ["batch"], [F.col(c) for c in ("x0", "x1", "x2")], F.col("y"),
                        F.col("used"), "y_", **settings).toPandas()
    assert len(out) == 240 and out[out.batch == "none"].y_.isna().all()
    merged = out.merge(pdf.reset_index(), on=["x0", "x1", "x2", "batch"])
    for b in ("hot", "b", "tiny"):
        part, mine = pdf[pdf.batch == b], merged[merged.batch == b].sort_values("index")
        x = part[["x0", "x1", "x2"]].to_numpy()
        want = plain_booster(x[part.used], part.y[part.used].to_numpy(), x, **settings)
        np.testing.assert_allclose(mine.y_.to_numpy(), want, rtol=1e-7, atol=1e-9)
    hot = merged[(merged.batch == "hot")]
    assert ((hot.y_ - hot.y_x) ** 2).mean() < 0.3 * hot.y_x.var()
