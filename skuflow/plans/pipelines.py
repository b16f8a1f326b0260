"""Composed pipelines (L1-L7) as lazy DataFrame plans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.operators import discounts as D
from skuflow.operators import elasticity as E
from skuflow.operators import features as Fe
from skuflow.operators import forecast as M
from skuflow.operators import metrics as Me
from skuflow.operators import sales as S
from skuflow.operators import topsell as T
from skuflow.session import materialize
from skuflow.sources.tsv import read_feature_dir, read_tsv, write_numbered_features, write_tsv


@dataclass
class SalesFacts:
    """The reference's seven stored tables, as one lazy plan (L1)."""
    daily: DataFrame          # daily_00: SKU x day sums and unit prices
    with_price: DataFrame     # daily_01: + synthetic gross price
    with_category: DataFrame  # daily_02: + category codes of the snapshot
    measures: DataFrame       # daily_03: + calendar keys and derived measures
    weekly: DataFrame         # SKU x week rollup
    monthly: DataFrame        # SKU x month rollup


def build_sales_facts(price_source: DataFrame, sku_dim: DataFrame, dim_date: DataFrame,
                      dim_week: DataFrame, order_detail: DataFrame | None = None,
                      daily_base: DataFrame | None = None,
                      history_start: str = S.REFERENCE_HISTORY_START,
                      snapshot_dt: str = S.REFERENCE_SKU_SNAPSHOT) -> SalesFacts:
    """L1 (from order lines) or L2 (refresh from a stored ``daily_base``).

    Nothing is computed here.
    """
    if daily_base is None:
        if order_detail is None:
            raise ValueError("either order_detail or daily_base is required")
        daily = S.sales_daily(order_detail, history_start)
    else:
        daily = daily_base
    with_price = S.attach_synthetic_price(daily, S.synthetic_price(price_source))
    with_category = S.attach_category(with_price, sku_dim, snapshot_dt)
    measures = S.sales_measures(with_category, dim_date, dim_week)
    # The rollups aggregate the measures by SKU first and join the category
    # codes afterwards: the same rows, with the SKU join on far fewer rows.
    by_sku = S.sales_measures(with_price, dim_date, dim_week)
    weekly = S.rollup_then_categorise(by_sku, sku_dim, S.WEEK_KEYS, snapshot_dt)
    monthly = S.rollup_then_categorise(by_sku, sku_dim, S.MONTH_KEYS, snapshot_dt)
    return SalesFacts(daily, with_price, with_category, measures, weekly, monthly)


def refresh_sales_facts(daily_base: DataFrame, price_source: DataFrame, sku_dim: DataFrame,
                        dim_date: DataFrame, dim_week: DataFrame,
                        snapshot_dt: str = S.REFERENCE_SKU_SNAPSHOT) -> SalesFacts:
    """L2: rebuild everything downstream of a stored SKU x day base."""
    return build_sales_facts(price_source, sku_dim, dim_date, dim_week,
                             daily_base=daily_base, snapshot_dt=snapshot_dt)


@dataclass
class FeatureRun:
    """Outputs of the feature batch."""
    elasticity: DataFrame
    facts: DataFrame          # the sliced SKU x period facts
    top_selling: DataFrame
    features: DataFrame       # wide table, one column per feature (+ row counts)


def run_feature_pipeline(order_detail: DataFrame, price_source: DataFrame, sku_dim: DataFrame,
                         dim_date: DataFrame, dim_week: DataFrame, sku_elasticity: DataFrame,
                         brand_elasticity: DataFrame, cate_elasticity: DataFrame,
                         mode: str = "monthly", category_slice: dict | None = None,
                         history_start: str = S.REFERENCE_HISTORY_START,
                         snapshot_dt: str = S.REFERENCE_SKU_SNAPSHOT,
                         elasticity_dt: str = E.REFERENCE_ELASTICITY_DT,
                         output_dir: str | None = None) -> FeatureRun:
    """Elasticity (L3), sales facts (L1), category slice (P4), top selling
    (L4) and the 19 discount features (L5) as one application.

    Lazy without ``output_dir``.  With it the facts and the features are stored
    once, the reference's hand-over files are written as TSV directories and
    the features as numbered files ``f0..f18``.
    """
    pe = E.price_elasticity(sku_elasticity, brand_elasticity, cate_elasticity, elasticity_dt)
    facts = build_sales_facts(price_source, sku_dim, dim_date, dim_week, order_detail=order_detail,
                              history_start=history_start, snapshot_dt=snapshot_dt)
    periodic = facts.weekly if mode == "weekly" else facts.monthly
    if category_slice is not None:
        periodic = S.category_slice(periodic, **category_slice)
    if output_dir:  # read by four outputs
        periodic = materialize(periodic, "periodic")
    prepared = D.prepare_discount_input(periodic, pe, mode=mode)
    top = prepared.select(T.CATE3, T.SKU, F.col("tm_key").alias(T.mode_spec(mode)[0]),
                          T.MARK, T.SHARE)
    features = D.discount_features(prepared, keep_row_counts=True)
    if output_dir:
        features = materialize(features, "features")  # read once per file
        base = output_dir.rstrip("/")
        write_tsv(pe, f"{base}/price_elasticity")
        write_tsv(periodic, f"{base}/sales_{mode}")
        write_tsv(top, f"{base}/top_selling_{mode}")
        counts = {n: f"_{n}_rows" for n in D.FEATURE_NAMES if f"_{n}_rows" in features.columns}
        write_numbered_features(features, f"{base}/features_{mode}", list(D.KEYS),
                                D.FEATURE_NAMES, counts)
    return FeatureRun(pe, periodic, top, features.select(*D.KEYS, *D.FEATURE_NAMES))


def read_forecast_inputs(spark, target_path: str, target_types: dict, time_features_dir: str,
                         category_features_dir: str, keys_time, keys_group,
                         column_types: dict | None = None):
    """The forecast's file inputs: the target TSV (S1) and every feature table
    under the time and category folders (S2), keys typed like the target."""
    keys_time, keys_group = Fe.as_list(keys_time), Fe.as_list(keys_group)
    target = read_tsv(spark, target_path, target_types)
    time_keys = {k: target_types[k] for k in keys_time}
    cate_keys = {k: target_types[k] for k in keys_group + keys_time}
    time_feats = read_feature_dir(spark, time_features_dir, time_keys, column_types=column_types)
    cate_feats = read_feature_dir(spark, category_features_dir, cate_keys,
                                  column_types=column_types)
    return target, time_feats, cate_feats


def feature_matrix(target: DataFrame, time_features: list[DataFrame],
                   category_features: list[DataFrame], spec: M.ForecastSpec,
                   fill: str = "batch") -> tuple[DataFrame, list[str]]:
    """J8 + J9 + P9 + W8/W9: the target with its features, gaps filled."""
    joined = Fe.join_time_features(target, time_features, spec.keys_time)
    joined = Fe.join_category_features(joined, category_features, spec.keys_group,
                                       spec.keys_time)
    feats = Fe.feature_columns(joined.columns, spec.keys_time, spec.keys_batch,
                               spec.target_column, spec.feature_columns,
                               spec.feature_rm_columns)
    keys = list(dict.fromkeys(spec.keys_time + spec.keys_group + spec.keys_batch))
    matrix = joined.select(*keys, spec.target_column, *feats)
    if fill == "global":
        matrix = Fe.fill_missing_global(matrix, spec.keys_time + spec.keys_batch,
                                        [spec.target_column, *feats])
    elif fill == "batch":
        matrix = Fe.fill_missing(matrix, spec.keys_time, spec.keys_batch, feats)
    elif fill != "none":
        raise ValueError("fill must be 'batch', 'global' or 'none'")
    return matrix, feats


@dataclass
class ForecastRun:
    predictions: DataFrame    # train and test rows with ``split`` and ``y_``
    metrics: DataFrame        # split, hit_rate, total_error


def forecast_pipeline(target: DataFrame, time_features: list[DataFrame],
                      category_features: list[DataFrame], spec: M.ForecastSpec,
                      fill: str = "batch", undefined: str = "miss") -> ForecastRun:
    """Join features (J8, J9), select them (P9), fill gaps (W8/W9), split,
    fit per batch and predict (M1-M5), clip and score (F16, A14, A15).

    ``fill="global"`` is the reference's whole-table fill (Q5), ordered by
    time keys then batch keys; ``"batch"`` fills features per batch in time
    order.  The joined and filled matrix is stored once: it is read by the
    eligibility check, the fit and the prediction.
    """
    matrix, feats = feature_matrix(target, time_features, category_features, spec, fill)
    matrix = materialize(matrix, "forecast-matrix")
    predictions = M.forecast(matrix, spec, feats)
    order = spec.keys_batch + spec.keys_time
    metrics = Me.score(predictions, spec.target_column, undefined=undefined, order_cols=order)
    return ForecastRun(Me.clip_predictions(predictions), metrics)
