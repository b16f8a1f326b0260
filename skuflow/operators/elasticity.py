"""Price elasticity per SKU from SKU, brand and category estimates (L3: J5, F5).

The reference left-joins the brand and category estimates but then requires
their snapshot day in ``WHERE``, which rejects the NULL rows: the joins behave
as inner joins and SKUs without a brand or category row vanish (Q2).  That is
the default here; ``fallback=True`` filters the lookups first and keeps the
left joins, so the category value fills in wherever a finer one is missing.

The lookups are small in practice but not bounded by construction: adaptive
execution broadcasts them from their runtime size, and otherwise splits the
sort-merge partition of a brand that owns a large share of SKUs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuflow.sources.tables import snapshot

REFERENCE_ELASTICITY_DT = "2017-06-17"
CATE3 = "item_third_cate_cd"


def price_elasticity(sku: DataFrame, brand: DataFrame, cate: DataFrame,
                     dt: str = REFERENCE_ELASTICITY_DT, fallback: bool = False) -> DataFrame:
    """``item_sku_id, pe`` with ``pe = COALESCE(sku, brand, category estimate)``."""
    a = snapshot(sku, dt).select(
        "skuid", "brand_code", CATE3, F.col("e_value").alias("_e_sku"))
    b = snapshot(brand, dt).select(
        "brand_code", CATE3, F.col("e_value").alias("_e_brand"))
    c = snapshot(cate, dt).select(CATE3, F.col("e_value").alias("_e_cate"))
    how = "left" if fallback else "inner"
    joined = a.join(b, ["brand_code", CATE3], how).join(c, [CATE3], how)
    return joined.select(F.col("skuid").alias("item_sku_id"),
                         F.coalesce("_e_sku", "_e_brand", "_e_cate").alias("pe"))
