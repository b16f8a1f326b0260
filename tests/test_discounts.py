"""Discount features on hand-made rows (FIXTURES.md §3 band and elasticity edges)."""

import math

import pytest

from skuflow.operators import discounts as D
from skuflow.operators import topsell as T

PREPARED = ("tm_key string, item_third_cate_cd int, item_sku_id bigint, pe double, "
            "true_top_saling_mark boolean, sales_share_recent_three_months double, "
            "total_net_sales double, total_synthetic_give_away double, "
            "total_synthetic_gross_sales double")


def prepared(spark, data):
    df = spark.createDataFrame(data, PREPARED)
    from pyspark.sql import functions as F
    from skuflow.functions.numeric import pdiv
    return df.withColumn("discount", F.coalesce(pdiv(D.GA, D.SG), F.lit(0.0)))


def row(sku, mark, disc, pe=-1.0, net=10.0, share=0.1, key="m1", cat=1, gross=100.0):
    # give-away rounded so that e.g. 0.1 * 100 is exactly 10 and 10 / 100 == 0.1
    return (key, cat, sku, pe, mark, share, net, round(disc * gross, 9), gross)


def test_band_edges_open_closed(spark):
    # discounts 0, 0.1, 0.2, 1.0, 1.2 on marked rows
    data = [row(i, True, d) for i, d in enumerate((0.0, 0.1, 0.2, 1.0, 1.2))]
    wide = D.discount_features(prepared(spark, data)).first()
    # gmv percent: net 10 per row, total 50
    assert wide["top_saling_on_sale_gmv_percent_0_to_10"] == pytest.approx(10 / 50)
    assert wide["top_saling_on_sale_gmv_percent_10_to_20"] == pytest.approx(10 / 50)
    assert wide["top_saling_on_sale_gmv_percent_0_to_100"] == pytest.approx(30 / 50)
    assert wide["top_saling_on_sale_discount_0_to_100"] == pytest.approx((10 + 20 + 100) / 300)
    assert wide["on_sale_discount"] == pytest.approx((10 + 20 + 100 + 120) / 400)


def test_elasticity_edge_and_missing_counts_low(spark):
    data = [row(1, False, 0.1, pe=-12.5), row(2, False, 0.2, pe=-12.6), row(3, False, 0.3, pe=0.0)]
    wide = D.discount_features(prepared(spark, data)).first()
    assert wide["high_pe_discount"] == pytest.approx(0.2)
    assert wide["low_pe_discount"] == pytest.approx((10 + 30) / 200)


def test_absent_group_vs_present_group(spark):
    # group m2 has no marked row: masked features are NULL in the wide table,
    # absent in the single-feature table; overall and GMV percent exist.
    data = [row(1, True, 0.1, key="m1"), row(2, False, 0.1, key="m2")]
    p = prepared(spark, data)
    wide = {r.tm_key: r for r in D.discount_features(p).collect()}
    assert wide["m2"]["top_saling_discount"] is None
    assert wide["m2"]["top_saling_on_sale_discount_0_to_100"] is None
    assert wide["m2"]["top_saling_on_sale_gmv_percent_0_to_100"] == 0.0
    single = D.discount_feature(p, "top_saling_discount").collect()
    assert [r.tm_key for r in single] == ["m1"]


def test_zero_gross_gives_missing_or_infinite(spark):
    data = [row(1, True, 0.0, gross=0.0), ("m1", 1, 2, -1.0, True, 0.5, 10.0, None, None)]
    p = prepared(spark, data)
    wide = D.discount_features(p).first()
    assert wide["top_saling_discount"] is None         # 0/0 stays missing
    assert wide["top_saling_on_sale_discount_0_to_100"] is None  # no row in the band
    assert wide["overall_discount"] == 0.0             # row NaN -> 0 before the sum
    inf = [("m1", 1, 1, -1.0, True, 0.5, 10.0, 5.0, 0.0)]
    assert D.discount_features(prepared(spark, inf)).first()["top_saling_discount"] == math.inf


def test_null_keys_drop_out(spark):
    data = [row(1, True, 0.1, cat=None), row(2, True, 0.1, key=None), row(3, True, 0.1)]
    assert D.discount_features(prepared(spark, data)).count() == 1


def test_top_and_long_tail_numerators_add_up(spark):
    data = [row(i, i % 2 == 0, 0.05 * (i % 5), gross=10.0 + i) for i in range(20)]
    p = prepared(spark, data)
    w = D.discount_features(p).first()
    top_sg = sum(10.0 + i for i in range(20) if i % 2 == 0)
    tail_sg = sum(10.0 + i for i in range(20) if i % 2 == 1)
    all_ga = sum(0.05 * (i % 5) * (10.0 + i) for i in range(20))
    assert w["top_saling_discount"] * top_sg + w["long_tail_discount"] * tail_sg == \
        pytest.approx(all_ga)


def test_adjacent_bands_add_up(spark):
    data = [row(i, True, 0.013 * i) for i in range(25)]
    w = D.discount_features(prepared(spark, data)).first()
    parts = sum(w[f"top_saling_on_sale_gmv_percent_{b}"] for b in ("0_to_10", "10_to_20", "20_to_100"))
    assert parts == pytest.approx(w["top_saling_on_sale_gmv_percent_0_to_100"])


def test_feature_order_is_the_reference_order():
    assert D.FEATURE_NAMES[:7] == ["overall_discount", "top_saling_discount", "long_tail_discount",
                                   "high_pe_discount", "low_pe_discount", "on_sale_discount",
                                   "off_sale_discount"]
    assert len(D.FEATURE_NAMES) == 19
    assert D.FEATURE_NAMES[7:9] == ["top_saling_on_sale_discount_0_to_100",
                                    "top_saling_on_sale_gmv_percent_0_to_100"]


def test_joined_and_fused_marks_agree(spark):
    facts = spark.createDataFrame(
        [(1, s, m, float(v), float(v) / 10, float(v)) for s in range(1, 6)
         for m, v in (("2017-01", s * 3), ("2017-02", 10 - s), ("2017-03", s))],
        "item_third_cate_cd int, item_sku_id bigint, month string, total_net_sales double, "
        "total_synthetic_give_away double, total_synthetic_gross_sales double")
    pe = spark.createDataFrame([(s, -float(s) * 5) for s in range(1, 6)], "item_sku_id bigint, pe double")
    fused = D.discount_features(D.prepare_discount_input(facts, pe))
    top = T.top_selling(facts, "monthly")
    joined = D.discount_features(D.prepare_discount_input(facts, pe, top=top))
    # double inputs: sums may differ in the last bit between the two plans
    a = sorted(fused.collect(), key=lambda r: r.tm_key)
    b = sorted(joined.collect(), key=lambda r: r.tm_key)
    assert len(a) == len(b) == 3
    for x, y in zip(a, b):
        for k in x.asDict():
            if isinstance(x[k], float):
                assert x[k] == pytest.approx(y[k], rel=1e-12)
            else:
                assert x[k] == y[k]
