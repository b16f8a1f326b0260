"""Three-level elasticity lookup: literal (inner) and fallback (left) forms."""

from skuflow.operators.elasticity import price_elasticity

DT = "2017-06-17"


def tables(spark):
    sku = spark.createDataFrame(
        [(1, "b1", 10, -3.0, DT),     # own value
         (2, "b1", 10, None, DT),     # falls back to brand
         (3, "b2", 10, None, DT),     # brand value NULL -> category
         (4, "b9", 10, -1.0, DT),     # no brand row: dropped by the literal form
         (5, "b1", 11, None, DT),     # no category row: dropped by the literal form
         (6, "b1", 10, -7.0, "2016-01-01")],   # other snapshot
        "skuid bigint, brand_code string, item_third_cate_cd int, e_value double, dt string")
    brand = spark.createDataFrame(
        [("b1", 10, -5.0, DT), ("b2", 10, None, DT), ("b1", 11, -6.0, DT), ("b1", 10, -50.0, "2016-01-01")],
        "brand_code string, item_third_cate_cd int, e_value double, dt string")
    cate = spark.createDataFrame([(10, -9.0, DT), (10, -90.0, "2016-01-01")],
                                 "item_third_cate_cd int, e_value double, dt string")
    return sku, brand, cate


def test_literal_form_behaves_as_inner_joins(spark):
    got = dict(map(tuple, price_elasticity(*tables(spark), dt=DT).collect()))
    assert got == {1: -3.0, 2: -5.0, 3: -9.0}


def test_fallback_keeps_every_sku_of_the_snapshot(spark):
    got = dict(map(tuple, price_elasticity(*tables(spark), dt=DT, fallback=True).collect()))
    assert got == {1: -3.0, 2: -5.0, 3: -9.0, 4: -1.0, 5: -6.0}
