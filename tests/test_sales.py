from decimal import Decimal

from pyspark.sql import functions as F

from helpers import rows
from skuflow.operators import sales as S
from skuflow.plans.pipelines import build_sales_facts

ORDER_SCHEMA = ("sale_ord_dt string, item_sku_id bigint, after_prefr_amount decimal(18,4), "
                "before_prefr_amount decimal(12,2), sale_qtty decimal(8,2), "
                "sale_ord_valid_flag int, dp string, dt string")


def D(x):
    return Decimal(str(x))


def order_lines(spark):
    data = [
        # sku 1: two lines on one day, price 10
        ("2017-01-02", 1, D("8.0000"), D("10.00"), D("1.00"), 1, "HISTORY", "2017-01-02"),
        ("2017-01-02", 1, D("17.0000"), D("20.00"), D("2.00"), 1, "HISTORY", "2017-01-02"),
        # sku 2: zero price row
        ("2017-01-03", 2, D("5.0000"), D("6.00"), D("1.00"), 1, "HISTORY", "2017-01-03"),
        # sku 3: no price row
        ("2017-01-09", 3, D("4.0000"), D("4.00"), D("1.00"), 1, "HISTORY", "2017-01-09"),
        # sku 4: zero units -> unit prices NULL, no error
        ("2017-02-01", 4, D("3.0000"), D("3.00"), D("0.00"), 1, "HISTORY", "2017-02-01"),
        # filtered out: invalid, not history, before the floor
        ("2017-01-02", 1, D("99.0000"), D("99.00"), D("9.00"), 0, "HISTORY", "2017-01-02"),
        ("2017-01-02", 1, D("99.0000"), D("99.00"), D("9.00"), 1, "ACTIVE", "2017-01-02"),
        ("2013-01-02", 1, D("99.0000"), D("99.00"), D("9.00"), 1, "HISTORY", "2013-01-02"),
    ]
    return spark.createDataFrame(data, ORDER_SCHEMA)


def dims(spark):
    price = spark.createDataFrame(
        [("2017-01-02", 1, D("10.00")), ("2017-01-03", 2, D("0.00")), ("2017-02-01", 4, D("2.00"))],
        "date string, productkey bigint, syntheticgrossprice decimal(12,2)")
    sku = spark.createDataFrame(
        [(k, 1, 2, 30 + k % 2, "2017-04-28") for k in (1, 2, 3, 4)]
        + [(k, 9, 9, 99, "2016-01-01") for k in (1, 2, 3, 4)],
        "item_sku_id bigint, item_first_cate_cd int, item_second_cate_cd int, "
        "item_third_cate_cd int, dt string")
    days = spark.createDataFrame(
        [("2017-01-02", 0), ("2017-01-03", 0), ("2017-01-09", 1), ("2017-02-01", 4)],
        "date string, sequentialweek int")
    weeks = spark.createDataFrame([(0, "2017-01-02"), (4, "2017-01-30")],
                                  "sequentialweek int, date string")  # week 1 missing
    return price, sku, days, weeks


def build(spark):
    price, sku, days, weeks = dims(spark)
    return build_sales_facts(price, sku, days, weeks, order_detail=order_lines(spark))


def test_daily_sums_filters_and_unit_prices(spark):
    daily = build(spark).daily
    got = {r.item_sku_id: r for r in daily.collect()}
    assert set(got) == {1, 2, 3, 4}
    assert got[1].net_sales == D("25.0000") and got[1].unit_volume == D("3.00")
    assert got[1].gross_price == 10.0
    assert got[4].net_price is None and got[4].gross_price is None


def test_measures_zero_null_price_and_week_left_join(spark):
    m = {r.item_sku_id: r for r in build(spark).measures.collect()}
    # price 10, 3 units, net 25: synthetic gross 30, give-away 5
    assert m[1].total_synthetic_gross_sales == D("30.0000")
    assert m[1].total_synthetic_give_away == D("5.0000")
    assert abs(m[1].synthetic_discount_percentage - 1 / 6) < 1e-15
    assert m[2].total_synthetic_give_away == 0            # zero price -> zero give-away
    assert m[3].total_synthetic_give_away is None          # no price row -> NULL
    assert m[3].week_start is None                         # week 1 not in the week dimension
    assert m[4].total_synthetic_give_away is None          # zero units -> net price NULL
    assert m[1].month == "2017-01" and m[1].item_third_cate_cd == 31   # current snapshot


def test_rollups_sum_to_daily_totals(spark):
    facts = build(spark)
    total = facts.measures.agg(F.sum("total_net_sales")).first()[0]
    assert facts.weekly.agg(F.sum("total_net_sales")).first()[0] == total
    assert facts.monthly.agg(F.sum("total_net_sales")).first()[0] == total
    assert rows(facts.monthly, "item_sku_id", "month") == [
        (1, "2017-01"), (2, "2017-01"), (3, "2017-01"), (4, "2017-02")]


def test_refresh_from_stored_daily_base_equals_full_build(spark):
    price, sku, days, weeks = dims(spark)
    full = build(spark).monthly
    again = build_sales_facts(price, sku, days, weeks, daily_base=build(spark).daily).monthly
    assert sorted(full.collect()) == sorted(again.collect())


def test_category_slice_is_a_disjunction(spark):
    facts = build(spark).monthly
    assert facts.transform(lambda d: S.category_slice(d, third=(31,), first=(), second=())).count() == 2
    assert facts.transform(lambda d: S.category_slice(d, third=(), first=(1,), second=())).count() == 4
