"""Category x period discount features (L5: J6, J7, F7, F12, P10-P15, A5-A13).

The reference runs 19 separate group-bys over the joined frame.  Here every
feature is a conditional sum inside **one** ``groupBy(tm_key, category)``: one
scan, one shuffle of partial aggregates, hot categories combined map-side.

pandas-regime rules kept (SURVEY §1.3, Q9-Q11):
* group sums skip missing values and an all-missing sum is 0;
* ratio features use pandas division (0/0 missing, x/0 +-inf);
* a masked feature (A6-A12) has no value for a group without a qualifying row
  (NULL in the wide table; the group is absent in the single-feature form);
* A5 and A13 exist for every group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.functions.numeric import band_label, pdiv, pdiv_sql
from skuflow.operators.topsell import CATE3, MARK, SHARE, SHARE_PLACES, SKU, mode_spec, top_selling

# Fixed values of the reference's feature set.
HIGH_PE_BELOW = -12.5      # pe < -12.5 is high elasticity
ON_SALE_FROM = 0.05        # SKU discount >= 0.05 is on sale
BANDS = ((0, 1), (0.05, 1), (0.1, 1), (0.2, 1), (0, 0.1), (0.1, 0.2))  # f7..f18, in order

KEYS = ("tm_key", CATE3)
GA, SG, NET = "total_synthetic_give_away", "total_synthetic_gross_sales", "total_net_sales"


@dataclass(frozen=True)
class Feature:
    name: str
    kind: str            # "overall" | "ratio" | "band_ratio" | "band_gmv"
    mask: str | None     # row condition as SQL over the prepared columns


def _band(low: float, high: float) -> str:
    return f"{MARK} AND discount > {float(low)!r}D AND discount <= {float(high)!r}D"


def feature_list() -> list[Feature]:
    """The 19 features in the reference's order (f0..f18)."""
    feats = [
        Feature("overall_discount", "overall", None),
        Feature("top_saling_discount", "ratio", MARK),
        Feature("long_tail_discount", "ratio", f"NOT {MARK}"),
        Feature("high_pe_discount", "ratio", f"pe < {HIGH_PE_BELOW!r}D"),
        Feature("low_pe_discount", "ratio", f"pe >= {HIGH_PE_BELOW!r}D"),
        Feature("on_sale_discount", "ratio", f"discount >= {ON_SALE_FROM!r}D"),
        Feature("off_sale_discount", "ratio", f"discount < {ON_SALE_FROM!r}D"),
    ]
    for low, high in BANDS:
        label = band_label(low, high)
        feats.append(Feature(f"top_saling_on_sale_discount_{label}", "band_ratio", _band(low, high)))
        feats.append(Feature(f"top_saling_on_sale_gmv_percent_{label}", "band_gmv", _band(low, high)))
    return feats


FEATURE_NAMES = [f.name for f in feature_list()]


def prepare_discount_input(sales: DataFrame, elasticity: DataFrame,
                           top: DataFrame | None = None, mode: str = "monthly", stored: bool = False) -> DataFrame:
    """J6+J7+F7+P14+F12: facts with ``pe``, top-selling mark and share, period
    renamed ``tm_key`` and the SKU discount ``discount``, rounded to 9 places
    before it meets the band limits (Q7).

    ``top`` is a top-selling table to left-join on (category, SKU, period) as
    the reference does.  Without it the marks are computed on ``sales`` itself
    (same rows, one window pass instead of a second join).  The elasticity is
    joined first: a shuffle join on SKU leaves the rows partitioned by SKU,
    which the per-SKU trailing window reuses.  ``stored`` is handed to
    ``top_selling``.
    """
    period, _ = mode_spec(mode)
    pe = elasticity.select(SKU, "pe")
    if top is None:
        unused = [c for c in sales.columns if c.startswith("total_") and c not in (NET, GA, SG)]
        with_pe = sales.drop(*unused).join(pe, SKU, "left")  # top_selling hands whole rows to Python workers
        df = top_selling(with_pe, mode, keep_columns=True, stored=stored)
    else:
        df = sales.join(pe, SKU, "left")
        df = df.join(top.select(CATE3, SKU, period, MARK, SHARE), [CATE3, SKU, period], "left")
    return (df.withColumn("pe", F.coalesce(F.col("pe"), F.lit(0.0)))
              .withColumn(MARK, F.coalesce(F.col(MARK), F.lit(False)))
              .withColumn(SHARE, F.coalesce(F.col(SHARE), F.lit(0.0)))
              .withColumnRenamed(period, "tm_key")
              .withColumn("discount", F.round(F.coalesce(pdiv(GA, SG), F.lit(0.0)), SHARE_PLACES)))


def _aggregates(feat: Feature) -> list[Column]:
    """Aggregate expressions of one feature, as SQL (one JVM call each).

    pandas group sums skip missing values and sum nothing to 0, hence the
    ``coalesce(sum(...), 0)``."""
    n = feat.name
    if feat.kind == "overall":
        row = f"coalesce({pdiv_sql(f'{SHARE} * {GA}', SG)}, 0.0D)"
        return [F.expr(f"sum({row})").alias(n)]
    if feat.kind == "band_gmv":
        return [F.expr(f"sum(CASE WHEN {feat.mask} THEN {NET} END)").alias(f"_{n}_net"),
                F.expr(f"coalesce(sum({NET}), 0)").alias(f"_{n}_all")]
    return [F.expr(f"coalesce(sum(CASE WHEN {feat.mask} THEN {GA} END), 0)").alias(f"_{n}_ga"),
            F.expr(f"coalesce(sum(CASE WHEN {feat.mask} THEN {SG} END), 0)").alias(f"_{n}_sg"),
            F.expr(f"count_if({feat.mask})").alias(f"_{n}_rows")]


def _final(feat: Feature, inf_as_null: bool = False) -> Column:
    n = feat.name
    if feat.kind == "overall":
        return F.col(n)
    if feat.kind == "band_gmv":
        return F.expr(f"coalesce({pdiv_sql(f'_{n}_net', f'_{n}_all', inf_as_null)}, 0.0D)")
    ratio = pdiv_sql(f"_{n}_ga", f"_{n}_sg", inf_as_null)
    if feat.kind == "band_ratio":
        ratio = f"coalesce({ratio}, 0.0D)"
    return F.expr(f"CASE WHEN _{n}_rows > 0 THEN {ratio} END")


def _keyed(prepared: DataFrame) -> DataFrame:
    """Q8: rows with a missing group key drop out, as in a pandas group-by."""
    return prepared.where(F.col("tm_key").isNotNull() & F.col(CATE3).isNotNull())


def discount_features(prepared: DataFrame, names: list[str] | None = None,
                      keep_row_counts: bool = False, inf_as_null: bool = False) -> DataFrame:
    """All (or the named) features as columns of one aggregate per (tm_key, category).

    A ratio to 0 is infinite as in pandas; ``inf_as_null`` makes it missing (Q10)."""
    feats = [f for f in feature_list() if names is None or f.name in names]
    aggs = [a for f in feats for a in _aggregates(f)]
    grouped = _keyed(prepared).groupBy(*KEYS).agg(*aggs)
    cols = [F.col(k) for k in KEYS] + [_final(f, inf_as_null).alias(f.name) for f in feats]
    if keep_row_counts:
        cols += [F.col(f"_{f.name}_rows") for f in feats if f.kind in ("ratio", "band_ratio")]
    return grouped.select(*cols)


def discount_feature(prepared: DataFrame, name: str) -> DataFrame:
    """One feature as the reference writes it: ``tm_key, category, <name>``,
    with only the groups that have a qualifying row for A6-A12."""
    feat = next(f for f in feature_list() if f.name == name)
    wide = discount_features(prepared, [name], keep_row_counts=True)
    if feat.kind in ("ratio", "band_ratio"):
        wide = wide.where(F.col(f"_{name}_rows") > 0)
    return wide.select(*KEYS, name)
