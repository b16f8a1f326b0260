"""The reference's shapes written directly in Spark, for benchmarking only.

same computation: k shifted self-joins for trailing sums (J10), an aggregate
joined back for category totals (J11), one window per category for running
sums (W3, W4), one group-by per feature (the 19 scans of L5) and a sequential
loop over batches for the per-category fit (A17).
These are not registered as queries and not used by the library.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skuflow.operators import discounts as D
from skuflow.operators import topsell as T
from skuflow.operators.forecast import SPLIT, TRAIN, fit_linear, predict_linear


def trailing_by_self_joins(facts: DataFrame, mode: str = "monthly") -> DataFrame:
    """Shift the period by 1..k, left join on (SKU, period), fill 0, add."""
    period, lookback = T.mode_spec(mode)
    base = facts.where(F.col(period).isNotNull()).withColumn("_idx", T.period_index(mode))
    sales = F.when(F.col(T.SALES) < 0, F.lit(0)).otherwise(F.col(T.SALES))
    shifted_src = base.select(T.SKU, "_idx", sales.alias("_s"))
    out = base.withColumn(T.TRAILING, F.lit(0).cast("decimal(38,4)"))
    for i in range(1, lookback + 1):
        shifted = shifted_src.select(T.SKU, (F.col("_idx") + i).alias("_idx"),
                                     F.col("_s").alias(f"_s{i}"))
        out = (out.join(shifted, [T.SKU, "_idx"], "left")
               .withColumn(T.TRAILING, F.col(T.TRAILING) + F.coalesce(F.col(f"_s{i}"), F.lit(0)))
               .drop(f"_s{i}"))
    return out.drop("_idx")


def category_total_by_join(trailing: DataFrame, mode: str = "monthly") -> DataFrame:
    """Aggregate by (period, category) and join the total back."""
    totals = T.category_trailing_total(trailing, mode)
    period, _ = T.mode_spec(mode)
    return trailing.join(totals, [period, T.CATE3], "inner")


def features_by_separate_groupbys(prepared: DataFrame) -> DataFrame:
    """L5 as the reference runs it: one aggregate per feature, joined on the keys."""
    singles = [D.discount_feature(prepared, name) for name in D.FEATURE_NAMES]
    keys = list(D.KEYS)
    groups = prepared.where(F.col("tm_key").isNotNull() & F.col(T.CATE3).isNotNull()) \
        .select(*keys).distinct()
    return reduce(lambda left, right: left.join(right, keys, "left"), singles, groups)


def top_selling_plain_window(facts: DataFrame, mode: str = "monthly") -> DataFrame:
    """W3/W4 as one window per (period, category): a category is one task's."""
    period, _ = T.mode_spec(mode)
    trailing = T.trailing_sales(facts, mode).where(F.col(T.CATE3).isNotNull())
    group = Window.partitionBy(period, T.CATE3)
    ahead = group.orderBy(F.col(T.TRAILING).desc(), T.SKU).rowsBetween(Window.unboundedPreceding, 0)
    return T.pareto_marks(trailing.withColumn(T.CATE_TOTAL, F.sum(T.TRAILING).over(group))
                          .withColumn(T.CUMULATED, F.sum(T.TRAILING).over(ahead)))


def forecast_batch_by_batch(labeled: DataFrame, keys_batch: list[str], features: list[str],
                            target: str) -> DataFrame:
    """A sequential loop over batches, each fitted on its own."""
    fits = []
    for row in labeled.select(*keys_batch).distinct().collect():
        own = reduce(lambda a, b: a & b, [F.col(k) == row[k] for k in keys_batch])
        train = labeled.where(own & (F.col(SPLIT) == TRAIN))
        fits.append(fit_linear(train, keys_batch, features, target).collect())
    schema = fit_linear(labeled, keys_batch, features, target).schema
    found = labeled.sparkSession.createDataFrame([r for rows in fits for r in rows], schema)
    return predict_linear(labeled, found, keys_batch, features)
