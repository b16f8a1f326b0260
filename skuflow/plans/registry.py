"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` on the test data.

Every query reads the driver's tables (through the fixture mapping) and runs
over whole tables.  Output columns are aliased exactly as in the DuckDB oracle
(``skuflow.plans.oracle``); DECIMAL results are cast to DOUBLE at the end.
"""

from __future__ import annotations

from collections.abc import Callable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.operators import discounts as D
from skuflow.operators import elasticity as E
from skuflow.operators import features as Fe
from skuflow.operators import forecast as M
from skuflow.operators import metrics as Me
from skuflow.operators import sales as S
from skuflow.functions.numeric import month_index
from skuflow.operators import topsell as T
from skuflow.operators.rolling import rolling_forecast, rolling_scores
from skuflow.operators.states import LeastSquares
from skuflow.plans.outputs import decimals_to_double, rounded
from skuflow.plans.pipelines import (SalesFacts, build_sales_facts, feature_matrix,
                                     forecast_pipeline, read_forecast_inputs,
                                     run_feature_pipeline)
from skuflow.session import materialize, scratch_path
from skuflow.sources import fixtures as fx
from skuflow.sources.tsv import (headed_lines, preview, read_feature_dir, read_tsv, read_tsv_checked,
                                 write_numbered_features, write_tsv)
from skuflow.sources.warehouse import rebuild_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# The category slice used on the test data (codes that exist there).
FIXTURE_SLICE = {"third": (7,), "first": (2,), "second": (13,)}


def query(name: str):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return register


def inputs(spark: SparkSession, sf_dir: str) -> fx.TestInputs:
    return fx.TestInputs(spark, sf_dir)


def facts(spark: SparkSession, sf_dir: str, daily_base: DataFrame | None = None) -> SalesFacts:
    i = inputs(spark, sf_dir)
    return build_sales_facts(
        i.synthetic_price_source(), i.sku_dim(), i.dim_date(), i.dim_week(),
        order_detail=i.order_detail(), daily_base=daily_base,
        history_start=fx.HISTORY_START, snapshot_dt=fx.SKU_SNAPSHOT_DT)


# ---- L1: sales facts -------------------------------------------------------

@query("sales_daily")
def q_sales_daily(spark, sf_dir):
    return decimals_to_double(facts(spark, sf_dir).daily)


@query("synthetic_price")
def q_synthetic_price(spark, sf_dir):
    return decimals_to_double(S.synthetic_price(inputs(spark, sf_dir).synthetic_price_source()))


@query("sales_with_price")
def q_sales_with_price(spark, sf_dir):
    return decimals_to_double(facts(spark, sf_dir).with_price)


@query("sales_with_category")
def q_sales_with_category(spark, sf_dir):
    return decimals_to_double(facts(spark, sf_dir).with_category)


@query("calendar_days")
def q_calendar_days(spark, sf_dir):
    return inputs(spark, sf_dir).dim_date()


@query("sales_measures")
def q_sales_measures(spark, sf_dir):
    return decimals_to_double(facts(spark, sf_dir).measures)


@query("sales_weekly")
def q_sales_weekly(spark, sf_dir):
    return decimals_to_double(facts(spark, sf_dir).weekly)


@query("sales_monthly")
def q_sales_monthly(spark, sf_dir):
    return decimals_to_double(facts(spark, sf_dir).monthly)


@query("sales_refresh_monthly")
def q_sales_refresh_monthly(spark, sf_dir):
    # L2: the SKU x day base is stored first (S5), then the rest is rebuilt from it.
    base = materialize(facts(spark, sf_dir).daily, "sales_daily_00")
    return decimals_to_double(facts(spark, sf_dir, daily_base=base).monthly)


@query("category_slice")
def q_category_slice(spark, sf_dir):
    return decimals_to_double(S.category_slice(facts(spark, sf_dir).monthly, **FIXTURE_SLICE))


# ---- L3: price elasticity ---------------------------------------------------

def elasticity(spark, sf_dir, fallback: bool = False) -> DataFrame:
    i = inputs(spark, sf_dir)
    return E.price_elasticity(i.sku_elasticity(), i.brand_elasticity(), i.cate_elasticity(),
                              dt=fx.ELASTICITY_DT, fallback=fallback)


@query("price_elasticity")
def q_price_elasticity(spark, sf_dir):
    return elasticity(spark, sf_dir)


@query("price_elasticity_fallback")
def q_price_elasticity_fallback(spark, sf_dir):
    return elasticity(spark, sf_dir, fallback=True)


# ---- L4: trailing sales and top selling ------------------------------------

def _facts_for(spark, sf_dir, mode: str) -> DataFrame:
    f = facts(spark, sf_dir)
    return f.weekly if mode == "weekly" else f.monthly


def _trailing(spark, sf_dir, mode: str) -> DataFrame:
    period, _ = T.mode_spec(mode)
    t = T.trailing_sales(_facts_for(spark, sf_dir, mode), mode)
    return decimals_to_double(t.select(T.SKU, T.CATE3, period, T.TRAILING))


@query("trailing_sales_weekly")
def q_trailing_weekly(spark, sf_dir):
    return _trailing(spark, sf_dir, "weekly")


@query("trailing_sales_monthly")
def q_trailing_monthly(spark, sf_dir):
    return _trailing(spark, sf_dir, "monthly")


@query("category_trailing_total")
def q_category_trailing_total(spark, sf_dir):
    t = T.trailing_sales(_facts_for(spark, sf_dir, "monthly"), "monthly")
    return decimals_to_double(T.category_trailing_total(t, "monthly"))


@query("top_selling_weekly")
def q_top_selling_weekly(spark, sf_dir):
    return T.top_selling(_facts_for(spark, sf_dir, "weekly"), "weekly")


@query("top_selling_monthly")
def q_top_selling_monthly(spark, sf_dir):
    return T.top_selling(_facts_for(spark, sf_dir, "monthly"), "monthly")


@query("top_selling_monthly_double")
def q_top_selling_monthly_double(spark, sf_dir):
    # Money as DOUBLE, the API's declared type: shares are rounded before the threshold.
    monthly = _facts_for(spark, sf_dir, "monthly").withColumn(T.SALES, F.col(T.SALES).cast("double"))
    return rounded(T.top_selling(monthly, "monthly"), [T.SHARE])


@query("sku_snapshot_partition")
def q_sku_snapshot_partition(spark, sf_dir):
    # The SKU dimension stored by snapshot day, one partition read.
    dim = inputs(spark, sf_dir).sku_dim()
    stored = rebuild_table(dim, path=scratch_path(spark, "sku_dim"), partition_by=["dt"])
    return S.sku_snapshot(stored, fx.SKU_SNAPSHOT_DT)


# ---- L5: discount features --------------------------------------------------

def discount_input(spark, sf_dir, monthly: DataFrame | None = None, stored: bool = False) -> DataFrame:
    monthly = facts(spark, sf_dir).monthly if monthly is None else monthly
    return D.prepare_discount_input(monthly, elasticity(spark, sf_dir), stored=stored)


def stored_monthly(spark, sf_dir) -> DataFrame:
    """The monthly facts that target and features read, computed and written once."""
    return materialize(facts(spark, sf_dir).monthly.select("month", T.SKU, T.CATE3, D.NET, D.GA, D.SG), "monthly")


def _feature_query(name: str) -> QueryFn:
    def run(spark, sf_dir):
        out = D.discount_feature(discount_input(spark, sf_dir), name)
        return rounded(out, ["overall_discount"]) if name == "overall_discount" else out
    return run


def feature_query_name(feature: str) -> str:
    for prefix, short in (("top_saling_on_sale_discount_", "band_discount_"),
                          ("top_saling_on_sale_gmv_percent_", "band_gmv_percent_")):
        if feature.startswith(prefix):
            low, _, high = feature[len(prefix):].partition("_to_")
            return f"feature_{short}{low}_{high}"
    return f"feature_{feature}"


for _feature in D.FEATURE_NAMES:
    QUERIES[feature_query_name(_feature)] = _feature_query(_feature)


@query("discount_features_wide")
def q_discount_features_wide(spark, sf_dir):
    return rounded(D.discount_features(discount_input(spark, sf_dir)), ["overall_discount"])


# ---- L7: forecast -----------------------------------------------------------

FORECAST = dict(target_column="gmv", keys_time=["tm_key"], keys_group=[T.CATE3],
                keys_batch=[T.CATE3], split_name="tm_key", train_max=fx.TRAIN_MAX,
                test_values=list(fx.TEST_VALUES))
KEYS = ["tm_key", T.CATE3]
OUT = ["tm_key", T.CATE3, "split", "gmv", "y_"]
REGRESSORS = ["n_orders", "order_value"]


def spec(method: str = "linear_regression") -> M.ForecastSpec:
    return M.ForecastSpec(method=method, **FORECAST)


def target(spark, sf_dir, monthly: DataFrame | None = None) -> DataFrame:
    return fx.monthly_target(facts(spark, sf_dir).monthly if monthly is None else monthly)


def matrix(spark, sf_dir) -> tuple[DataFrame, list[str]]:
    """J8 + J9 + P9: target with time and category features, and the feature list."""
    monthly = stored_monthly(spark, sf_dir)
    t = Fe.join_time_features(target(spark, sf_dir, monthly),
                              [inputs(spark, sf_dir).time_features()], ["tm_key"])
    wide = D.discount_features(discount_input(spark, sf_dir, monthly, stored=True))
    m = Fe.join_category_features(t, [wide], [T.CATE3], ["tm_key"])
    feats = Fe.feature_columns(m.columns, ["tm_key"], [T.CATE3], "gmv")
    return m.select(*KEYS, "gmv", *feats), feats


def filled(spark, sf_dir) -> tuple[DataFrame, list[str]]:
    """The filled feature matrix."""
    m, feats = matrix(spark, sf_dir)
    return Fe.fill_missing(m, ["tm_key"], [T.CATE3], feats), feats


def time_matrix(spark, sf_dir) -> DataFrame:
    """Target with the time features alone, filled: what the models on
    ``n_orders`` and ``order_value`` read."""
    t = Fe.join_time_features(target(spark, sf_dir), [inputs(spark, sf_dir).time_features()], ["tm_key"])
    return Fe.fill_missing(t, ["tm_key"], [T.CATE3], REGRESSORS)


def split(df: DataFrame) -> DataFrame:
    s = spec()
    return M.split_rows(df, s.split_name, s.train_max, s.test_values)


def labeled(spark, sf_dir) -> DataFrame:
    return M.keep_eligible(split(time_matrix(spark, sf_dir)), [T.CATE3])


def _out(df: DataFrame) -> DataFrame:
    return rounded(decimals_to_double(df), ["overall_discount"])


@query("join_time_features")
def q_join_time_features(spark, sf_dir):
    t = Fe.join_time_features(target(spark, sf_dir), [inputs(spark, sf_dir).time_features()],
                              ["tm_key"])
    return decimals_to_double(t)


@query("join_category_features")
def q_join_category_features(spark, sf_dir):
    monthly = stored_monthly(spark, sf_dir)
    wide = D.discount_features(discount_input(spark, sf_dir, monthly, stored=True))
    return _out(Fe.join_category_features(target(spark, sf_dir, monthly), [wide], [T.CATE3],
                                          ["tm_key"]))


@query("feature_matrix")
def q_feature_matrix(spark, sf_dir):
    return _out(matrix(spark, sf_dir)[0])


@query("fill_missing_batch")
def q_fill_missing_batch(spark, sf_dir):
    return _out(filled(spark, sf_dir)[0])


@query("fill_missing_global")
def q_fill_missing_global(spark, sf_dir):
    m, feats = matrix(spark, sf_dir)
    return _out(Fe.fill_missing_global(m, KEYS, ["gmv", *feats]))


def _split(spark, sf_dir, which: str) -> DataFrame:
    rows = split(filled(spark, sf_dir)[0])
    return _out(rows.where(rows["split"] == which))


@query("split_train")
def q_split_train(spark, sf_dir):
    return _split(spark, sf_dir, M.TRAIN)


@query("split_test")
def q_split_test(spark, sf_dir):
    return _split(spark, sf_dir, M.TEST)


@query("eligible_batches")
def q_eligible_batches(spark, sf_dir):
    return M.eligible_batches(split(target(spark, sf_dir)), [T.CATE3])


def one_feature_forecast(spark, sf_dir) -> DataFrame:
    rows = labeled(spark, sf_dir)
    return M.ols_one_feature(rows, [T.CATE3], "n_orders", "gmv")


@query("forecast_ols_one_feature")
def q_forecast_ols_one_feature(spark, sf_dir):
    return decimals_to_double(one_feature_forecast(spark, sf_dir)
                              .select(*OUT[:4], "n_orders", "y_"))


def _model_query(method: str) -> QueryFn:
    # Predictions come from double sums: one place, the same in the oracle.
    def run(spark, sf_dir):
        stored = materialize(time_matrix(spark, sf_dir), "time-matrix")
        out = M.forecast(stored, spec(method), REGRESSORS)
        return rounded(decimals_to_double(out.select(*OUT)), ["y_"], 1)
    return run


QUERIES["forecast_ols"] = _model_query("linear_regression")
QUERIES["forecast_ridge"] = _model_query("ridge")
QUERIES["forecast_python_model"] = _model_query("python")


@query("forecast_gbt")
def q_forecast_gbt(spark, sf_dir):
    # Trees have no closed form: per split the rows, the predicted rows, and
    # whether the squared error is no worse than that of the train mean.
    stored = materialize(time_matrix(spark, sf_dir), "time-matrix")
    out = materialize(M.forecast(stored, spec("xgb"), REGRESSORS).select(
        "split", F.col("gmv").cast("double").alias("gmv"), "y_"), "gbt-predictions")
    mean = out.where("split = 'train'").agg(F.avg("gmv")).first()[0]
    own = F.sum(F.pow(F.col("gmv") - F.col("y_"), 2))
    plain = F.sum(F.pow(F.col("gmv") - F.lit(mean), 2))
    return out.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("y_").alias("n_predicted"),
        F.when(F.col("split") == "train", own <= plain).alias("train_beats_mean"))


# ---- all 21 features, as the reference fits them; models fitted in parts --------

def stored_matrix(spark, sf_dir) -> tuple[DataFrame, list[str]]:
    """The filled matrix of all features, written once."""
    df, feats = filled(spark, sf_dir)
    return materialize(df, "feature-matrix"), feats


def _all_features_query(method: str) -> QueryFn:
    def run(spark, sf_dir):
        stored, feats = stored_matrix(spark, sf_dir)
        return decimals_to_double(M.forecast(stored, spec(method), feats).select(*OUT))
    return run


QUERIES["forecast_ols_all_features"] = _all_features_query("linear_regression")
QUERIES["forecast_ridge_all_features"] = _all_features_query("ridge")
QUERIES["forecast_python_model_all_features"] = _all_features_query("python")
QUERIES["forecast_gbt_all_features"] = _all_features_query("xgb")


@query("forecast_ols_normal_equations")
def q_forecast_ols_normal_equations(spark, sf_dir):
    # Least squares leaves residuals at right angles to every regressor: per
    # category and regressor the cosine between the two, which SQL knows to be 0.
    stored, feats = stored_matrix(spark, sf_dir)
    fitted = M.forecast(stored, spec(), feats).where("split = 'train'")
    xs = F.array(*[F.struct(F.lit(c).alias("regressor"), M._feature_value(c, "zero").alias("x")) for c in feats],
                 F.struct(F.lit("intercept").alias("regressor"), F.lit(1.0).alias("x")))
    y = F.col("gmv").cast("double")
    long = fitted.select(T.CATE3, y.alias("y"), (y - F.col("y_")).alias("e"), F.explode(xs).alias("v")).select(
        T.CATE3, "y", "e", "v.*")
    size = F.sqrt(F.sum(F.col("x") * F.col("x")) * F.sum(F.col("y") * F.col("y")))
    return long.groupBy(T.CATE3, "regressor").agg(
        F.count(F.lit(1)).alias("n_train"), F.count_if(F.col("x") != 0).alias("n_not_zero"),
        F.abs(F.round(F.when(size > 0, F.sum(F.col("x") * F.col("e")) / size).otherwise(0.0), 9)).alias("cosine"))


@query("forecast_mergeable_model")
def q_forecast_mergeable_model(spark, sf_dir):
    # X1 with a model that is fitted in parts and merged: least squares on two regressors.
    stored = materialize(time_matrix(spark, sf_dir), "time-matrix")
    rows = M.keep_eligible(split(stored), [T.CATE3])
    out = M.python_model_forecast(rows, [T.CATE3], REGRESSORS, "gmv", LeastSquares())
    return rounded(decimals_to_double(out.select(*OUT)), ["y_"], 1)


# Six origins and the span of the reference's weekly settings, as months.
ROLLING_ORIGINS = ("1997-06", "1998-02", "1998-10", "1999-06", "2000-02", "2000-10")
ROLLING_SPAN = 4


@query("rolling_origin_scores")
def q_rolling_origin_scores(spark, sf_dir):
    # Six origins, each scored on the four months after it.
    months = [int(o[:4]) * 12 + int(o[5:]) for o in ROLLING_ORIGINS]
    stored = materialize(time_matrix(spark, sf_dir), "time-matrix")
    out = rolling_forecast(stored, [T.CATE3], month_index("tm_key"), ["n_orders"], "gmv", months, ROLLING_SPAN)
    return rounded(rolling_scores(out, "gmv", [T.CATE3]), ["hit_rate", "total_error"], 6)


@query("clip_predictions")
def q_clip_predictions(spark, sf_dir):
    return decimals_to_double(Me.clip_predictions(one_feature_forecast(spark, sf_dir))
                              .select(*OUT[:4], "n_orders", "y_"))


@query("zero_negative_rows")
def q_zero_negative_rows(spark, sf_dir):
    out = one_feature_forecast(spark, sf_dir).select(*OUT[:4], "n_orders", "y_")
    return decimals_to_double(Me.zero_negative_rows(out))


@query("forecast_hit_rate")
def q_forecast_hit_rate(spark, sf_dir):
    clipped = Me.clip_predictions(one_feature_forecast(spark, sf_dir))
    return Me.hit_rate(clipped, "gmv")


@query("forecast_hit_rate_pad")
def q_forecast_hit_rate_pad(spark, sf_dir):
    clipped = Me.clip_predictions(one_feature_forecast(spark, sf_dir))
    return Me.hit_rate(clipped, "gmv", undefined="pad", order_cols=[T.CATE3, "tm_key"])


@query("forecast_total_error")
def q_forecast_total_error(spark, sf_dir):
    clipped = Me.clip_predictions(one_feature_forecast(spark, sf_dir))
    return rounded(Me.total_error(clipped, "gmv"), ["total_error"])


# ---- sources and sinks --------------------------------------------------------

MONTHLY_TYPES = {"item_first_cate_cd": "int", "item_second_cate_cd": "int",
                 "item_third_cate_cd": "int", "item_sku_id": "bigint", "month": "string",
                 **{m: "double" for m in S.MEASURE_COLUMNS}}
MONTHLY_KEYS = ["item_first_cate_cd", "item_second_cate_cd", "item_third_cate_cd",
                "item_sku_id", "month"]


@query("tsv_roundtrip")
def q_tsv_roundtrip(spark, sf_dir):
    # S7 then S1: facts written as a TSV directory and read back with a schema.
    path = write_tsv(facts(spark, sf_dir).monthly, scratch_path(spark, "sales_monthly_tsv"))
    return read_tsv(spark, path, MONTHLY_TYPES).select(*MONTHLY_KEYS, *S.MEASURE_COLUMNS)


@query("table_rebuild")
def q_table_rebuild(spark, sf_dir):
    # DROP + CREATE TABLE AS as an overwrite, then a scan of the new table.
    built = rebuild_table(facts(spark, sf_dir).monthly, path=scratch_path(spark, "sales_monthly"))
    return decimals_to_double(built)


@query("preview")
def q_preview(spark, sf_dir):
    # Five rows; an explicit order makes "the first five" well defined.
    return decimals_to_double(preview(facts(spark, sf_dir).monthly, 5, MONTHLY_KEYS))


@query("numbered_feature_files")
def q_numbered_feature_files(spark, sf_dir):
    # S8 then S2: f0..f18 written as separate tables, the folder read back,
    # every table turned to (tm_key, category, feature, value) rows.
    wide = D.discount_features(discount_input(spark, sf_dir), keep_row_counts=True)
    wide = materialize(wide, "features")
    folder = scratch_path(spark, "features_cg")
    counts = {n: f"_{n}_rows" for n in D.FEATURE_NAMES if f"_{n}_rows" in wide.columns}
    write_numbered_features(wide, folder, list(D.KEYS), D.FEATURE_NAMES, counts)
    key_types = {"tm_key": "string", T.CATE3: "int"}
    tables = read_feature_dir(spark, folder, key_types)
    longs = []
    for table in tables:
        name = next(c for c in table.columns if c not in key_types)
        value = F.col(name)
        if name == "overall_discount":
            value = F.round(value, 9)
        longs.append(table.select("tm_key", T.CATE3, F.lit(name).alias("feature"),
                                  value.alias("value")))
    out = longs[0]
    for part in longs[1:]:
        out = out.unionByName(part)
    return out


# Weeks of the calendar whose order lines are read.
PRUNED_WEEKS = (40, 47)


def lines_by_day(spark, sf_dir) -> DataFrame:
    """Order lines stored by day, one file a day."""
    lines = inputs(spark, sf_dir).order_detail()
    return rebuild_table(lines.repartition("dt"), path=scratch_path(spark, "order_lines"), partition_by=["dt"])


def pruned_daily(spark, sf_dir) -> DataFrame:
    days = materialize(inputs(spark, sf_dir).dim_date(), "dim_date")
    weeks = days.where(F.col("sequentialweek").between(*PRUNED_WEEKS))
    return S.sales_daily(S.lines_of_days(lines_by_day(spark, sf_dir), weeks), fx.HISTORY_START)


@query("sales_daily_of_weeks")
def q_sales_daily_of_weeks(spark, sf_dir):
    # S4 on order lines: stored by day, pruned by a filter on the calendar.
    return decimals_to_double(pruned_daily(spark, sf_dir))


@query("tsv_bad_rows")
def q_tsv_bad_rows(spark, sf_dir):
    # Facts as text lines, some cut short and some with a cell of another
    # type; good and bad rows are counted apart, by reason.
    folder = scratch_path(spark, "sales_monthly_damaged")
    cells = [*MONTHLY_KEYS, "total_net_sales", "total_gross_sales"]
    sku = F.col("item_sku_id") % 50
    line = [F.when((sku == 1) & (F.lit(c) == "total_net_sales"), F.lit("12,5")).otherwise(
        F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in cells]
    rows = facts(spark, sf_dir).monthly.select(F.when(sku == 0, F.concat_ws("\t", *line[:4])).otherwise(
        F.concat_ws("\t", *line)).alias("value"))
    rows.mapInArrow(headed_lines("\t".join(cells)), "value string").write.mode("overwrite").text(folder)
    good, bad = read_tsv_checked(spark, folder, {c: MONTHLY_TYPES[c] for c in cells})
    return (good.select(F.lit("good").alias("reason")).unionAll(bad.select("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")))


@query("forecast_metrics_while_writing")
def q_forecast_metrics_while_writing(spark, sf_dir):
    # M6 observed while the predictions are written; the same numbers as L7's metrics.
    stored = materialize(time_matrix(spark, sf_dir), "time-matrix")
    out = M.forecast(stored, spec(), REGRESSORS)
    metrics = Me.write_and_score(out, "gmv", scratch_path(spark, "predictions"))
    return rounded(metrics, ["total_error"], 6)


# ---- weekly mode, the L6 batch, more fixtures ------------------------------------

@query("discount_features_wide_weekly")
def q_discount_features_wide_weekly(spark, sf_dir):
    prepared = D.prepare_discount_input(facts(spark, sf_dir).weekly, elasticity(spark, sf_dir),
                                        mode="weekly")
    return rounded(D.discount_features(prepared), ["overall_discount"])


@query("feature_pipeline_monthly")
def q_feature_pipeline_monthly(spark, sf_dir):
    # Elasticity, facts, category slice, top selling and features in one run.
    i = inputs(spark, sf_dir)
    run = run_feature_pipeline(
        i.order_detail(), i.synthetic_price_source(), i.sku_dim(), i.dim_date(), i.dim_week(),
        i.sku_elasticity(), i.brand_elasticity(), i.cate_elasticity(), mode="monthly",
        category_slice=FIXTURE_SLICE, history_start=fx.HISTORY_START,
        snapshot_dt=fx.SKU_SNAPSHOT_DT, elasticity_dt=fx.ELASTICITY_DT)
    return rounded(run.features, ["overall_discount"])


@query("calendar_weeks")
def q_calendar_weeks(spark, sf_dir):
    return inputs(spark, sf_dir).dim_week()


@query("history_order_lines")
def q_history_order_lines(spark, sf_dir):
    # S4 + P3: the order-line scan restricted to valid history lines.
    lines = S.valid_history_lines(inputs(spark, sf_dir).order_detail(), fx.HISTORY_START)
    return decimals_to_double(lines)


@query("forecast_ridge_one_feature")
def q_forecast_ridge_one_feature(spark, sf_dir):
    rows = labeled(spark, sf_dir)
    out = M.ols_one_feature(rows, [T.CATE3], "n_orders", "gmv", alpha=1.0)
    return decimals_to_double(out.select(*OUT[:4], "n_orders", "y_"))


@query("forecast_pipeline_metrics")
def q_forecast_pipeline_metrics(spark, sf_dir):
    # L7 end to end: features joined, filled per batch, OLS on two of them per
    # category, negative predictions clipped, scored per split.
    monthly = facts(spark, sf_dir).monthly
    wide = D.discount_features(discount_input(spark, sf_dir, monthly))
    two = M.ForecastSpec(feature_columns=REGRESSORS, **FORECAST)
    run = forecast_pipeline(target(spark, sf_dir, monthly), [inputs(spark, sf_dir).time_features()], [wide], two)
    return rounded(run.metrics, ["total_error"], 6)


@query("forecast_hit_rate_parity")
def q_forecast_hit_rate_parity(spark, sf_dir):
    # The reference's literal scoring: rows with a negative prediction zeroed
    # whole (Q3), then undefined errors padded from the previous row (Q4).
    # Zeroing keeps each row in place, so the row order is taken before it.
    order = ["_order_cate", "_order_month"]
    f = one_feature_forecast(spark, sf_dir).selectExpr(
        "*", f"{T.CATE3} AS _order_cate", "tm_key AS _order_month")
    zeroed = Me.zero_negative_rows(f, keep=("split", *order))
    return Me.hit_rate(zeroed, "gmv", undefined="pad", order_cols=order)


@query("feature_matrix_from_files")
def q_feature_matrix_from_files(spark, sf_dir):
    # The forecast's file path: target, time features and the numbered
    # category features written as TSV, read back (S1, S2), joined (J8, J9),
    # selected (P9) and filled per batch.
    monthly = facts(spark, sf_dir).monthly
    folder = scratch_path(spark, "forecast_inputs")
    write_tsv(target(spark, sf_dir, monthly), f"{folder}/target")
    write_tsv(inputs(spark, sf_dir).time_features(), f"{folder}/features_tm/orders")
    wide = D.discount_features(discount_input(spark, sf_dir, monthly), keep_row_counts=True)
    wide = materialize(wide, "features")
    counts = {n: f"_{n}_rows" for n in D.FEATURE_NAMES if f"_{n}_rows" in wide.columns}
    write_numbered_features(wide, f"{folder}/features_cg", list(D.KEYS), D.FEATURE_NAMES, counts)
    t, tf, cf = read_forecast_inputs(
        spark, f"{folder}/target", {"tm_key": "string", T.CATE3: "int", "gmv": "double"},
        f"{folder}/features_tm", f"{folder}/features_cg", ["tm_key"], [T.CATE3],
        column_types={"n_orders": "bigint"})
    m, _ = feature_matrix(t, tf, cf, spec())
    return _out(m)
