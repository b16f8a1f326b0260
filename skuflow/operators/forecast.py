"""Per-batch forecasting.

Linear models are fitted from orthogonal summaries of the rows that merge in a
tree (``states``): pieces of a batch are factored before any shuffle, so that a
batch holding a third of all rows costs no more than any other, and nearly
collinear features keep their digits.  One row per batch reaches the solver;
prediction is a column expression.

Infinite feature values are missing values.  A missing feature is 0 in fit and
prediction by default (``missing="zero"``, for parity) or keeps its row out of
the fit and its prediction NULL (``missing="drop"``).  Every eligible batch
stays in the result; ``fit_status`` says why one has no prediction.

A user model (X1, ``python_model``) that can be merged is fitted in parts, too.
One that is a plain function runs per batch with ``applyInPandas``, which needs a
batch in one task; ``max_batch_rows`` makes a larger batch an error that names it
instead of a lost executor.

Gradient-boosted trees (M3) are one model per batch (``boosting``); the pooled
``GBTRegressor`` with the batch keys as categories is kept as ``gbt_forecast``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, ByteType, DoubleType, IntegerType, LongType, ShortType,
                               StringType, StructField, StructType)

from skuflow.operators import states
from skuflow.operators.boosting import boosted_trees
from skuflow.operators.features import as_list
from skuflow.operators.states import FITTED, NO_TARGET, NOT_SOLVED
from skuflow.session import materialize

SPLIT, PRED, STATUS = "split", "y_", "fit_status"
MAX_BATCH_ROWS = 1_000_000
TRAIN, TEST = "train", "test"


@dataclass
class ForecastSpec:
    """The reference's forecast settings, as keyword arguments (Q15 validated)."""
    target_column: str
    keys_time: list[str]
    keys_group: list[str]
    keys_batch: list[str]
    split_name: str
    train_max: object
    test_values: list
    method: str = "linear_regression"
    feature_columns: list[str] = field(default_factory=list)
    feature_rm_columns: list[str] = field(default_factory=list)
    alpha: float = 1.0
    missing: str = "zero"

    def __post_init__(self):
        self.keys_time = as_list(self.keys_time)
        self.keys_group = as_list(self.keys_group)
        self.keys_batch = as_list(self.keys_batch)
        self.test_values = as_list(self.test_values)
        if not self.keys_batch:
            raise ValueError("keys_batch is required")
        if self.method not in MODELS:
            raise ValueError(f"unknown method {self.method!r}; expected one of {sorted(MODELS)}")


def split_rows(df: DataFrame, split_name: str, train_max, test_values) -> DataFrame:
    """P6+P7 (M5): label rows ``train`` (``<= train_max``) and ``test`` (in
    ``test_values``) in one pass; a row in both sets appears twice, a row in
    neither drops out."""
    s = F.col(split_name)
    labels = F.array(F.when(s <= F.lit(train_max), F.lit(TRAIN)),
                     F.when(s.isin(list(test_values)), F.lit(TEST)))
    return df.withColumn(SPLIT, F.explode(F.filter(labels, lambda x: x.isNotNull())))


def eligible_batches(split_df: DataFrame, keys_batch) -> DataFrame:
    """Batches with at least one train row and one test row.  A batch with
    a missing key is never fitted (Q8: a pandas group-by drops it)."""
    keys = as_list(keys_batch)
    known = split_df
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    return (known.groupBy(*keys)
            .agg(F.count_if(F.col(SPLIT) == TRAIN).alias("n_train"),
                 F.count_if(F.col(SPLIT) == TEST).alias("n_test"))
            .where((F.col("n_train") > 0) & (F.col("n_test") > 0)))


def keep_eligible(split_df: DataFrame, keys_batch) -> DataFrame:
    """Semi join on the eligible batches (one row per batch; adaptive
    execution broadcasts it from its measured size)."""
    keys = as_list(keys_batch)
    ok = eligible_batches(split_df, keys).select(*keys)
    return split_df.join(ok, keys, "left_semi")


# ---- linear models from centred sums ----------------------------------------

MISSING = ("zero", "drop")


def _feature_value(name: str, missing: str) -> Column:
    """A feature as a finite double or NULL; NULL is 0 with ``missing="zero"``."""
    if missing not in MISSING:
        raise ValueError(f"missing must be one of {MISSING}")
    v = F.col(name).cast("double")
    finite = F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)
    return F.coalesce(finite, F.lit(0.0)) if missing == "zero" else finite


def centred_sums(train: DataFrame, keys_batch, features: list[str], target: str,
                 missing: str = "zero") -> DataFrame:
    """Per batch: ``_n``, means ``_means`` (features, then target), and sums of
    centred products ``_xx`` (upper triangle, by rows) and ``_xy``."""
    keys, k = as_list(keys_batch), len(features)
    # One array column: the optimiser infers constraints per column, and for
    # dozens of computed ones together it does not come to an end.
    values = F.array(*[_feature_value(c, missing) for c in features], _feature_value(target, "drop"))
    rows = train.select(*keys, values.alias("_v")).where(~F.exists("_v", lambda x: x.isNull()))
    means = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.array(
        *[F.avg(F.col("_v")[i]) for i in range(k + 1)]).alias("_means"))
    centred = rows.join(means, keys).select(*keys, "_n", "_means", F.zip_with(
        "_v", "_means", lambda v, m: v - m).alias("_d"))

    def sums(pairs) -> Column:
        return F.array(*[F.expr(f"sum(_d[{i}] * _d[{j}])") for i, j in pairs])

    upper = [(i, j) for i in range(k) for j in range(i, k)]
    return centred.groupBy(*keys).agg(  # number and means are the same in every row of a batch
        F.first("_n").alias("_n"), F.first("_means").alias("_means"), sums(upper).alias("_xx"),
        sums([(i, k) for i in range(k)]).alias("_xy"))


def solve_centred(means: np.ndarray, xx: np.ndarray, xy: np.ndarray, alpha: float = 0.0) -> tuple[float, np.ndarray]:
    """Intercept and slopes of least squares (``alpha == 0``, minimum-norm
    solution on standardised features, safe for collinear or constant columns)
    or ridge (``alpha > 0``, penalty on the slopes)."""
    k = len(xy)
    full = np.zeros((k, k))
    full[np.triu_indices(k)] = xx
    full += np.triu(full, 1).T
    if alpha > 0:
        beta = np.linalg.solve(full + alpha * np.eye(k), xy)
    else:
        scale = np.sqrt(np.clip(np.diag(full), 0.0, None))
        scale[scale == 0] = 1.0
        z, *_ = np.linalg.lstsq(full / np.outer(scale, scale), xy / scale, rcond=1e-12)
        beta = z / scale
    return float(means[-1] - means[:-1] @ beta), beta


def fit_linear(train: DataFrame, keys_batch, features: list[str], target: str,
               alpha: float = 0.0, missing: str = "zero", summary: str = "factors") -> DataFrame:
    """M1/M2: ``keys..., _b0, _beta, _status`` per batch with a usable train row.

    ``summary="factors"`` merges orthogonal factors of the rows (``states``),
    which keeps the digits of nearly collinear features; ``"products"`` sums
    centred products in the JVM, which squares the condition number."""
    keys = as_list(keys_batch)
    fields = [StructField("_b0", DoubleType()), StructField("_beta", ArrayType(DoubleType())),
              StructField("_status", StringType())]

    def checked(solve: Callable) -> tuple:
        try:
            b0, beta = solve()
            if np.isfinite([b0, *beta]).all():
                return b0, beta.tolist(), FITTED
        except np.linalg.LinAlgError:
            pass
        return None, None, NOT_SOLVED

    if summary == "factors":
        model = states.LeastSquares(alpha)
        fitted = states.fit_states(train, keys, [_feature_value(c, missing) for c in features],
                                   _feature_value(target, "drop"), model)
        return states.map_states(fitted, keys, fields, lambda state: checked(lambda: model.solve(state)))
    if summary != "products":
        raise ValueError("summary must be 'factors' or 'products'")
    stats = centred_sums(train, keys, features, target, missing)
    key_fields = [f for f in stats.schema.fields if f.name in keys]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [checked(lambda v=v: solve_centred(*(np.asarray(x, dtype=float) for x in v), alpha))
                     for v in zip(pdf["_means"], pdf["_xx"], pdf["_xy"])]
            out = pdf[keys].copy()
            for i, f in enumerate(fields):
                out[f.name] = [x[i] for x in found]
            yield out

    return stats.mapInPandas(solve, StructType([*key_fields, *fields]))


def predict_linear(rows: DataFrame, coefficients: DataFrame, keys_batch, features: list[str],
                   missing: str = "zero") -> DataFrame:
    """``y_ = b0 + sum(beta_i * x_i)`` as a column expression, and ``fit_status``.
    A batch without a fit keeps its rows, with NULL predictions."""
    keys = as_list(keys_batch)
    pred = reduce(lambda a, b: a + b, [F.col("_beta")[i] * _feature_value(f, missing)
                                       for i, f in enumerate(features)], F.col("_b0"))
    return (rows.join(coefficients, keys, "left").withColumn(PRED, pred)
            .withColumn(STATUS, F.coalesce("_status", F.lit(NO_TARGET))).drop("_b0", "_beta", "_status"))


def linear_forecast(labeled: DataFrame, keys_batch, features, target, alpha=0.0,
                    missing: str = "zero", summary: str = "factors") -> DataFrame:
    coefs = fit_linear(labeled.where(F.col(SPLIT) == TRAIN), keys_batch, features, target, alpha, missing, summary)
    return predict_linear(labeled, coefs, keys_batch, features, missing)


# ---- exact one-regressor least squares ---------------------------------------

def _wide(df: DataFrame, name: str) -> Column:
    """Whole numbers as DECIMAL(19,0): their products are exact up to 38 digits
    and do not overflow."""
    whole = isinstance(df.schema[name].dataType, (ByteType, ShortType, IntegerType, LongType))
    return F.col(name).cast("decimal(19,0)") if whole else F.col(name)


def ols_one_feature(labeled: DataFrame, keys_batch, x: str, y: str,
                    alpha: float = 0.0) -> DataFrame:
    """M1 (``alpha == 0``) or M2 with one regressor, from sums of products that
    are exact for DECIMAL and whole-number inputs (up to 38 digits), finished
    in double:

        slope = (n Sxy - Sx Sy) / (n Sxx - Sx^2 + n alpha),  b0 = (Sy - slope Sx) / n

    A batch whose regressor is constant on the train rows (and ``alpha == 0``)
    gets slope 0 and the mean as intercept (the minimum-norm solution).  A batch
    without a usable train row keeps its rows, with NULL predictions."""
    keys = as_list(keys_batch)
    xw, yw = _wide(labeled, x), _wide(labeled, y)
    train = labeled.where((F.col(SPLIT) == TRAIN) & F.col(x).isNotNull() & F.col(y).isNotNull())
    s = train.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(xw).alias("_sx"), F.sum(yw).alias("_sy"),
        F.sum(xw * yw).alias("_sxy"), F.sum(xw * xw).alias("_sxx"))
    n = F.col("_n")
    num = (n * F.col("_sxy") - F.col("_sx") * F.col("_sy")).cast("double")
    den = (n * F.col("_sxx") - F.col("_sx") * F.col("_sx")).cast("double")
    if alpha:
        den = den + n.cast("double") * F.lit(float(alpha))
    slope = F.when(den != 0, num / den).otherwise(F.lit(0.0))
    coefs = s.select(*keys, slope.alias("_slope"),
                     F.col("_sx").cast("double").alias("_sxd"),
                     F.col("_sy").cast("double").alias("_syd"),
                     F.col("_n").cast("double").alias("_nd"))
    coefs = coefs.select(*keys, "_slope",
                         ((F.col("_syd") - F.col("_slope") * F.col("_sxd")) / F.col("_nd"))
                         .alias("_intercept"))
    joined = labeled.join(coefs, keys, "left")
    pred = F.col("_intercept") + F.col("_slope") * F.col(x).cast("double")
    return joined.withColumn(PRED, pred).drop("_slope", "_intercept")


# ---- gradient-boosted trees (M3): one model per batch, or one for all ---------

def boosted_forecast(labeled: DataFrame, keys_batch, features: list[str], target: str, **settings) -> DataFrame:
    """M3: boosted trees per batch (``boosting.boosted_trees``)."""
    return boosted_trees(labeled, keys_batch, [_feature_value(c, "zero") for c in features],
                         _feature_value(target, "drop"), F.col(SPLIT) == TRAIN, PRED, **settings)


def gbt_forecast(labeled: DataFrame, keys_batch, features: list[str], target: str,
                 max_iter: int = 20, max_depth: int = 4, seed: int = 42) -> DataFrame:
    """One model for all batches; batch keys of any type are indexed and enter
    as categories.  Fitting runs at once, on a written table."""
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    keys = as_list(keys_batch)
    names, codes = [f"_gbt_key_{k}" for k in keys], [f"_gbt_code_{k}" for k in keys]
    inputs = [f"_gbt_{c}" for c in features]
    data = materialize(labeled.select(
        "*", *[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(a) for k, a in zip(keys, names)],
        *[_feature_value(c, "zero").alias(a) for c, a in zip(features, inputs)]), "gbt-rows")
    train = data.where((F.col(SPLIT) == TRAIN) & F.col(target).isNotNull()) \
        .withColumn("_gbt_label", F.col(target).cast("double"))
    indexer = StringIndexer(inputCols=names, outputCols=codes, handleInvalid="keep").fit(train)
    vec = VectorAssembler(inputCols=codes + inputs, outputCol="_gbt_features")
    bins = max(32, *[len(x) + 1 for x in indexer.labelsArray])
    model = GBTRegressor(featuresCol="_gbt_features", labelCol="_gbt_label", predictionCol=PRED,
                         maxIter=max_iter, maxDepth=max_depth, maxBins=bins,
                         seed=seed).fit(vec.transform(indexer.transform(train)))
    return model.transform(vec.transform(indexer.transform(data))).drop(
        "_gbt_features", *names, *codes, *inputs)


# ---- arbitrary Python model per batch (X1) -----------------------------------

ModelFn = Callable[[pd.DataFrame, pd.Series, pd.DataFrame], tuple[np.ndarray, np.ndarray]]


def least_squares_model(x_train: pd.DataFrame, y_train: pd.Series, x_test: pd.DataFrame):
    """Example model with the reference's contract: least squares with intercept.
    Rows without a target are left out of the fit, infinite features count as 0."""
    x_train, x_test = (x.where(np.isfinite(x), 0.0) for x in (x_train, x_test))
    if not np.isfinite(y_train.to_numpy()).any():
        return np.full(len(x_train), np.nan), np.full(len(x_test), np.nan)
    a = np.column_stack([np.ones(len(x_train)), x_train.to_numpy(dtype=float)])
    y = y_train.to_numpy(dtype=float)
    known = np.isfinite(y)
    # columns of very different size are put on one scale, so that none is cut off as tiny
    scale = np.maximum(np.abs(a).max(axis=0), 1e-300)
    coef, *_ = np.linalg.lstsq(a[known] / scale, y[known], rcond=None)
    coef = coef / scale
    b = np.column_stack([np.ones(len(x_test)), x_test.to_numpy(dtype=float)])
    return a @ coef, b @ coef


def python_model_forecast(labeled: DataFrame, keys_batch, features: list[str], target: str,
                          model: ModelFn | states.Mergeable = least_squares_model,
                          max_batch_rows: int = MAX_BATCH_ROWS) -> DataFrame:
    """A user model per batch.

    A ``states.Mergeable`` one (``partial_fit``, ``merge``, ``predict``) is fitted
    in parts, for batches of any size.  A function ``model(X_train, y_train,
    X_test) -> (pred_train, pred_test)`` needs its batch in one task: a batch of
    more than ``max_batch_rows`` rows is an error; its rows are counted by an
    aggregate before any is gathered."""
    keys = as_list(keys_batch)
    if states.is_mergeable(model):
        x = [_feature_value(c, "zero") for c in features]
        fitted = states.fit_states(labeled.where(F.col(SPLIT) == TRAIN), keys, x, _feature_value(target, "drop"), model)
        return states.predict_states(labeled, keys, x, fitted, model, PRED, STATUS)
    sizes = labeled.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    too_many = F.concat(F.lit(f"a batch has more than {max_batch_rows} rows, too many for one task: "),
                        F.to_json(F.struct(*keys)))
    sizes = sizes.select(*keys, F.when(F.col("_rows") > max_batch_rows, F.raise_error(too_many).cast("long"))
                         .otherwise(F.col("_rows")).alias("_rows"))
    columns = labeled.columns
    labeled = labeled.join(sizes, keys).where("_rows >= 0").select(*columns)
    schema = StructType(labeled.schema.fields + [StructField(PRED, DoubleType())])

    def per_batch(pdf: pd.DataFrame) -> pd.DataFrame:
        train = pdf[pdf[SPLIT] == TRAIN]
        test = pdf[pdf[SPLIT] == TEST]
        x_train = train[features].astype(float).fillna(0.0)
        x_test = test[features].astype(float).fillna(0.0)
        y_train = train[target].astype(float)
        pred_train, pred_test = model(x_train, y_train, x_test)
        return pd.concat([train.assign(**{PRED: pred_train}), test.assign(**{PRED: pred_test})])

    return labeled.groupBy(*keys).applyInPandas(per_batch, schema)


MODELS = {
    "linear_regression": lambda df, keys, feats, target, spec:
        linear_forecast(df, keys, feats, target, 0.0, spec.missing),
    "ridge": lambda df, keys, feats, target, spec:
        linear_forecast(df, keys, feats, target, spec.alpha, spec.missing),
    "xgb": lambda df, keys, feats, target, spec: boosted_forecast(df, keys, feats, target),
    "xgb_pooled": lambda df, keys, feats, target, spec: gbt_forecast(df, keys, feats, target),
    "python": lambda df, keys, feats, target, spec: python_model_forecast(df, keys, feats, target),
}


def forecast(df: DataFrame, spec: ForecastSpec, features: list[str]) -> DataFrame:
    """M5 + M4: split, keep eligible batches, fit per batch and predict.

    Returns train and test rows (column ``split``) with the prediction ``y_``;
    with no eligible batch the result is empty with the same schema (Q18).
    """
    labeled = keep_eligible(split_rows(df, spec.split_name, spec.train_max, spec.test_values),
                            spec.keys_batch)
    return MODELS[spec.method](labeled, spec.keys_batch, features, spec.target_column, spec)

