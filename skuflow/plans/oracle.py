"""DuckDB oracle SQL for each registered query (same output column names)."""

from __future__ import annotations

from skuflow.plans.registry import FIXTURE_SLICE, PRUNED_WEEKS, ROLLING_ORIGINS, ROLLING_SPAN, feature_query_name
from skuflow.plans.sqlparts import (MEASURES, as_double_list, define_slice, feature_names,
                                    feature_sql, filled_sql, pdiv, with_ctes)
from skuflow.sources.fixtures import HISTORY_START, SKU_SNAPSHOT_DT

ORACLE: dict[str, str] = {}

_CATS = "item_first_cate_cd, item_second_cate_cd, item_third_cate_cd"
_M = as_double_list(MEASURES)


def _in(values) -> str:
    return "(" + ", ".join(str(v) for v in values) + ")"


ORACLE["sales_daily"] = with_ctes("""
SELECT sale_ord_dt, item_sku_id, CAST(net_sales AS DOUBLE) AS net_sales,
       CAST(gross_sales AS DOUBLE) AS gross_sales, CAST(unit_volume AS DOUBLE) AS unit_volume,
       net_price, gross_price
FROM sales_daily""", "sales_daily")

ORACLE["synthetic_price"] = with_ctes("""
SELECT date, item_sku_id, CAST(synthetic_gross_price AS DOUBLE) AS synthetic_gross_price
FROM synthetic_price""", "synthetic_price")

ORACLE["sales_with_price"] = with_ctes("""
SELECT sale_ord_dt, item_sku_id, CAST(net_sales AS DOUBLE) AS net_sales,
       CAST(gross_sales AS DOUBLE) AS gross_sales, CAST(unit_volume AS DOUBLE) AS unit_volume,
       net_price, gross_price, CAST(synthetic_gross_price AS DOUBLE) AS synthetic_gross_price
FROM sales_with_price""", "sales_with_price")

ORACLE["sales_with_category"] = with_ctes(f"""
SELECT sale_ord_dt, item_sku_id, CAST(net_sales AS DOUBLE) AS net_sales,
       CAST(gross_sales AS DOUBLE) AS gross_sales, CAST(unit_volume AS DOUBLE) AS unit_volume,
       net_price, gross_price, CAST(synthetic_gross_price AS DOUBLE) AS synthetic_gross_price, {_CATS}
FROM sales_with_category""", "sales_with_category")

ORACLE["calendar_days"] = with_ctes("SELECT date, sequentialweek FROM dim_date", "dim_date")

ORACLE["sales_measures"] = with_ctes(f"""
SELECT date, {_CATS}, item_sku_id, CAST(unit_volume AS DOUBLE) AS unit_volume,
       CAST(total_net_sales AS DOUBLE) AS total_net_sales,
       CAST(total_gross_sales AS DOUBLE) AS total_gross_sales,
       CAST(total_synthetic_gross_sales AS DOUBLE) AS total_synthetic_gross_sales,
       CAST(total_give_away AS DOUBLE) AS total_give_away,
       CAST(total_synthetic_give_away AS DOUBLE) AS total_synthetic_give_away,
       raw_discount_percentage, synthetic_discount_percentage, sequentialweek, week_start, month
FROM sales_measures""", "sales_measures")

ORACLE["sales_weekly"] = with_ctes(f"""
SELECT {_CATS}, item_sku_id, sequentialweek, week_start, {_M}
FROM sales_weekly""", "sales_weekly")

ORACLE["sales_monthly"] = with_ctes(f"""
SELECT {_CATS}, item_sku_id, month, {_M}
FROM sales_monthly""", "sales_monthly")

ORACLE["sales_refresh_monthly"] = ORACLE["sales_monthly"]

ORACLE["category_slice"] = with_ctes(f"""
SELECT {_CATS}, item_sku_id, month, {_M}
FROM sales_monthly
WHERE item_third_cate_cd IN {_in(FIXTURE_SLICE['third'])}
   OR item_first_cate_cd IN {_in(FIXTURE_SLICE['first'])}
   OR item_second_cate_cd IN {_in(FIXTURE_SLICE['second'])}""", "sales_monthly")

# ---- L3 ---------------------------------------------------------------------
ORACLE["price_elasticity"] = with_ctes("SELECT item_sku_id, pe FROM pe_literal", "pe_literal")
ORACLE["price_elasticity_fallback"] = with_ctes("SELECT item_sku_id, pe FROM pe_fallback", "pe_fallback")

# ---- L4 ---------------------------------------------------------------------
for _mode, _period in (("weekly", "sequentialweek"), ("monthly", "month")):
    ORACLE[f"trailing_sales_{_mode}"] = with_ctes(f"""
SELECT item_sku_id, item_third_cate_cd, {_period},
       CAST(total_net_sales_recent_three_months AS DOUBLE) AS total_net_sales_recent_three_months
FROM trailing_{_mode}""", f"trailing_{_mode}")
    ORACLE[f"top_selling_{_mode}"] = with_ctes(f"""
SELECT item_third_cate_cd, item_sku_id, {_period}, true_top_saling_mark, sales_share_recent_three_months
FROM top_{_mode}""", f"top_{_mode}")

ORACLE["category_trailing_total"] = with_ctes("""
SELECT month, item_third_cate_cd,
       CAST(sum(total_net_sales_recent_three_months) AS DOUBLE) AS cate3_total_net_sales_recent_three_months
FROM trailing_monthly WHERE item_third_cate_cd IS NOT NULL
GROUP BY month, item_third_cate_cd""", "trailing_monthly")

# ---- L5 ---------------------------------------------------------------------
_FEATURES = feature_sql()
for _name, _sql in _FEATURES.items():
    ORACLE[feature_query_name(_name)] = with_ctes(_sql, "discount_keyed")

_joins = "\n".join(f"LEFT JOIN ({sql}) f{i} USING (tm_key, item_third_cate_cd)"
                   for i, sql in enumerate(_FEATURES.values()))
ORACLE["discount_features_wide"] = with_ctes(f"""
SELECT * FROM (SELECT DISTINCT tm_key, item_third_cate_cd FROM discount_keyed) g
{_joins}""", "discount_keyed")

# ---- L7 ---------------------------------------------------------------------
_FEATS = feature_names()
_MATRIX_COLS = ("tm_key, item_third_cate_cd, CAST(gmv AS DOUBLE) AS gmv, n_orders, "
                "CAST(order_value AS DOUBLE) AS order_value, " + ", ".join(_FEATS[2:]))

ORACLE["join_time_features"] = with_ctes("""
SELECT tm_key, item_third_cate_cd, CAST(gmv AS DOUBLE) AS gmv, n_orders,
       CAST(order_value AS DOUBLE) AS order_value
FROM target LEFT JOIN time_features USING (tm_key)""", "target", "time_features")

ORACLE["join_category_features"] = with_ctes(f"""
SELECT tm_key, item_third_cate_cd, CAST(gmv AS DOUBLE) AS gmv, {", ".join(_FEATS[2:])}
FROM target LEFT JOIN wide_features USING (tm_key, item_third_cate_cd)""", "target", "wide_features")

ORACLE["feature_matrix"] = with_ctes(f"SELECT {_MATRIX_COLS} FROM feature_matrix", "feature_matrix")
ORACLE["fill_missing_batch"] = with_ctes(f"SELECT {_MATRIX_COLS} FROM filled", "filled")
ORACLE["fill_missing_global"] = with_ctes(
    f"SELECT {_MATRIX_COLS} FROM ({filled_sql(True)}) g", "feature_matrix")
ORACLE["split_train"] = with_ctes(
    f"SELECT {_MATRIX_COLS}, split FROM labeled_all WHERE split = 'train'", "labeled_all")
ORACLE["split_test"] = with_ctes(
    f"SELECT {_MATRIX_COLS}, split FROM labeled_all WHERE split = 'test'", "labeled_all")
ORACLE["eligible_batches"] = with_ctes("SELECT * FROM eligible", "eligible")
ORACLE["forecast_ols_one_feature"] = with_ctes("SELECT * FROM ols1", "ols1")
ORACLE["clip_predictions"] = with_ctes("SELECT * FROM ols1_clipped", "ols1_clipped")
ORACLE["zero_negative_rows"] = with_ctes("""
SELECT CASE WHEN y_ < 0 THEN '0' ELSE tm_key END AS tm_key,
       CASE WHEN y_ < 0 THEN 0 ELSE item_third_cate_cd END AS item_third_cate_cd,
       split,
       CASE WHEN y_ < 0 THEN 0.0 ELSE gmv END AS gmv,
       CASE WHEN y_ < 0 THEN 0 ELSE n_orders END AS n_orders,
       CASE WHEN y_ < 0 THEN 0.0 ELSE y_ END AS y_
FROM ols1""", "ols1")
ORACLE["forecast_hit_rate"] = with_ctes("""
SELECT split, avg(CASE WHEN ape <= 0.15 THEN 1.0 ELSE 0.0 END) AS hit_rate
FROM ols1_ape GROUP BY split""", "ols1_ape")
ORACLE["forecast_hit_rate_pad"] = with_ctes("""
SELECT split, avg(CASE WHEN padded <= 0.15 THEN 1.0 ELSE 0.0 END) AS hit_rate
FROM (SELECT split, coalesce(ape, last_value(ape IGNORE NULLS) OVER (
          PARTITION BY split ORDER BY item_third_cate_cd, tm_key
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS padded
      FROM ols1_ape) t
GROUP BY split""", "ols1_ape")
ORACLE["forecast_total_error"] = with_ctes(f"""
SELECT split, round({pdiv('abs(coalesce(sum(gmv), 0.0) - coalesce(sum(y_), 0.0))', 'coalesce(sum(gmv), 0.0)')}, 9)
         AS total_error
FROM ols1_clipped GROUP BY split""", "ols1_clipped")

# ---- sources and sinks --------------------------------------------------------
ORACLE["tsv_roundtrip"] = ORACLE["sales_monthly"]
ORACLE["table_rebuild"] = ORACLE["sales_monthly"]
ORACLE["preview"] = with_ctes(f"""
SELECT {_CATS}, item_sku_id, month, {_M}
FROM sales_monthly
ORDER BY item_first_cate_cd, item_second_cate_cd, item_third_cate_cd, item_sku_id, month
LIMIT 5""", "sales_monthly")
ORACLE["numbered_feature_files"] = with_ctes("\nUNION ALL\n".join(
    f"SELECT tm_key, item_third_cate_cd, '{name}' AS feature, "
    f"{'round(' + name + ', 9)' if name == 'overall_discount' else name} AS value FROM ({sql}) t"
    for name, sql in _FEATURES.items()), "discount_keyed")

ORACLE["sales_daily_of_weeks"] = with_ctes(f"""
SELECT sale_ord_dt, item_sku_id, CAST(net_sales AS DOUBLE) AS net_sales,
       CAST(gross_sales AS DOUBLE) AS gross_sales, CAST(unit_volume AS DOUBLE) AS unit_volume,
       net_price, gross_price
FROM sales_daily JOIN dim_date ON sale_ord_dt = date
WHERE sequentialweek BETWEEN {PRUNED_WEEKS[0]} AND {PRUNED_WEEKS[1]}""", "sales_daily", "dim_date")
ORACLE["tsv_bad_rows"] = with_ctes("""
SELECT CASE item_sku_id % 50 WHEN 0 THEN 'wrong number of cells' WHEN 1 THEN 'total_net_sales is not double'
       ELSE 'good' END AS reason, count(*) AS n_rows
FROM sales_monthly GROUP BY 1""", "sales_monthly")

# ---- weekly mode, the L6 batch, more fixtures ------------------------------------
define_slice(FIXTURE_SLICE["third"], FIXTURE_SLICE["first"], FIXTURE_SLICE["second"])
_WIDE_COLS = "tm_key, item_third_cate_cd, " + ", ".join(
    f"round({c}, 9) AS {c}" if c == "overall_discount" else c for c in _FEATURES)
ORACLE["discount_features_wide_weekly"] = with_ctes(
    f"SELECT {_WIDE_COLS} FROM wide_features_weekly", "wide_features_weekly")
ORACLE["feature_pipeline_monthly"] = with_ctes(
    f"SELECT {_WIDE_COLS} FROM wide_features_slice", "wide_features_slice")
ORACLE["calendar_weeks"] = with_ctes("SELECT sequentialweek, date FROM dim_week", "dim_week")
ORACLE["history_order_lines"] = with_ctes(f"""
SELECT sale_ord_dt, item_sku_id, CAST(after_prefr_amount AS DOUBLE) AS after_prefr_amount,
       CAST(before_prefr_amount AS DOUBLE) AS before_prefr_amount,
       CAST(sale_qtty AS DOUBLE) AS sale_qtty, sale_ord_valid_flag, dp, dt
FROM order_detail
WHERE dp = 'HISTORY' AND dt >= '{HISTORY_START}' AND sale_ord_dt >= '{HISTORY_START}'
  AND sale_ord_valid_flag = 1""", "order_detail")
ORACLE["forecast_ridge_one_feature"] = with_ctes("SELECT * FROM ridge1", "ridge1")
ORACLE["forecast_hit_rate_parity"] = with_ctes(f"""
SELECT split, avg(CASE WHEN padded <= 0.15 THEN 1.0 ELSE 0.0 END) AS hit_rate
FROM (SELECT split, coalesce(ape, last_value(ape IGNORE NULLS) OVER (
          PARTITION BY split ORDER BY item_third_cate_cd, tm_key
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS padded
      FROM (SELECT split, item_third_cate_cd, tm_key,
                   CASE WHEN abs(e) <> CAST('inf' AS DOUBLE) THEN e END AS ape
            FROM (SELECT split, item_third_cate_cd, tm_key,
                         {pdiv('abs((CASE WHEN y_ < 0 THEN 0.0 ELSE gmv END) - (CASE WHEN y_ < 0 THEN 0.0 ELSE y_ END))',
                               'CASE WHEN y_ < 0 THEN 0.0 ELSE gmv END')} AS e
                  FROM ols1) z) a) t
GROUP BY split""", "ols1")

ORACLE["feature_matrix_from_files"] = ORACLE["fill_missing_batch"]

ORACLE["top_selling_monthly_double"] = with_ctes("""
SELECT item_third_cate_cd, item_sku_id, month, true_top_saling_mark,
       round(sales_share_recent_three_months, 9) AS sales_share_recent_three_months
FROM top_monthly_double""", "top_monthly_double")
ORACLE["sku_snapshot_partition"] = with_ctes(f"""
SELECT item_sku_id, {_CATS} FROM sku_dim WHERE dt = '{SKU_SNAPSHOT_DT}'""", "sku_dim")

# ---- two regressors -----------------------------------------------------------
_ROUNDED = "SELECT tm_key, item_third_cate_cd, split, gmv, round(y_, 1) AS y_ FROM "
ORACLE["forecast_ols"] = with_ctes(_ROUNDED + "ols2", "ols2")
ORACLE["forecast_python_model"] = ORACLE["forecast_ols"]
ORACLE["forecast_ridge"] = with_ctes(_ROUNDED + "ridge2", "ridge2")
ORACLE["forecast_gbt"] = with_ctes("""
SELECT split, count(*) AS n_rows, count(*) AS n_predicted,
       CASE WHEN split = 'train' THEN true END AS train_beats_mean
FROM labeled GROUP BY split""", "labeled")
ORACLE["forecast_mergeable_model"] = ORACLE["forecast_ols"]

# ---- all features: residuals at right angles to the regressors ------------------
_REGRESSORS = "\nUNION ALL\n".join(
    f"SELECT item_third_cate_cd, '{c}' AS regressor, "
    f"count(*) FILTER (isfinite(CAST({c} AS DOUBLE)) AND {c} <> 0) AS nz, count(*) AS n FROM fitted GROUP BY item_third_cate_cd"
    for c in feature_names())
ORACLE["forecast_ols_normal_equations"] = with_ctes(f"""
SELECT item_third_cate_cd, regressor, CAST(n AS BIGINT) AS n_train, CAST(nz AS BIGINT) AS n_not_zero,
       CAST(0 AS DOUBLE) AS cosine
FROM (WITH fitted AS (SELECT * FROM labeled WHERE split = 'train')
{_REGRESSORS}
UNION ALL
SELECT item_third_cate_cd, 'intercept', count(*), count(*) FROM fitted GROUP BY item_third_cate_cd) r""", "labeled")

# ---- D1: every origin fitted anew -------------------------------------------------
_ORIGINS = ", ".join(f"('{o}')" for o in ROLLING_ORIGINS)
ORACLE["rolling_origin_scores"] = with_ctes(f"""
SELECT m AS origin, count(DISTINCT item_third_cate_cd) AS n_batches, count(*) AS n_rows,
       round(avg(CASE WHEN gmv <> 0 AND abs(gmv - p) / gmv <= 0.15 THEN 1.0 ELSE 0.0 END), 6) AS hit_rate,
       round({pdiv('abs(sum(gmv) - sum(p))', 'sum(gmv)')}, 6) AS total_error
FROM (
  SELECT m, t.item_third_cate_cd, t.gmv, greatest(f.b0 + f.b1 * t.x, 0.0) AS p
  FROM (
    SELECT m, item_third_cate_cd, coalesce(regr_slope(gmv, x), 0.0) AS b1,
           avg(gmv) - coalesce(regr_slope(gmv, x), 0.0) * avg(x) AS b0
    FROM origins JOIN dated ON period <= m GROUP BY m, item_third_cate_cd) f
  JOIN dated t ON t.item_third_cate_cd = f.item_third_cate_cd AND t.period > m AND t.period <= m + {ROLLING_SPAN}) s
GROUP BY m""".replace("origins JOIN", f"(SELECT CAST(left(o, 4) AS BIGINT) * 12 + CAST(right(o, 2) AS BIGINT) AS m "
                      f"FROM (VALUES {_ORIGINS}) v(o)) origins JOIN").replace(" dated", """ (
      SELECT item_third_cate_cd, CAST(gmv AS DOUBLE) AS gmv, coalesce(CAST(n_orders AS DOUBLE), 0.0) AS x,
             CAST(left(tm_key, 4) AS BIGINT) * 12 + CAST(right(tm_key, 2) AS BIGINT) AS period
      FROM filled) dated""").replace(") dated t ON", ") t ON"), "filled")
ORACLE["forecast_pipeline_metrics"] = with_ctes(f"""
SELECT split, avg(CASE WHEN abs(e) <> CAST('inf' AS DOUBLE) AND e <= 0.15 THEN 1.0 ELSE 0.0 END) AS hit_rate,
       round({pdiv('abs(sum(gmv) - sum(p))', 'sum(gmv)')}, 6) AS total_error
FROM (SELECT split, gmv, p, {pdiv('abs(gmv - p)', 'gmv')} AS e
      FROM (SELECT split, gmv, CASE WHEN y_ < 0 THEN 0.0 ELSE y_ END AS p FROM ols2) c) t
GROUP BY split""", "ols2")

ORACLE["forecast_metrics_while_writing"] = ORACLE["forecast_pipeline_metrics"]
