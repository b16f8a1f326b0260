"""Top-selling marks: hand-computed cases (FIXTURES.md §3) and the sliced
running sum against a plain window."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skuflow.operators import topsell as T
from skuflow.operators.ranking import running_sum_by_group, value_slice

WEEKLY = "item_third_cate_cd int, item_sku_id bigint, sequentialweek int, total_net_sales double"


def weekly(spark, data):
    return spark.createDataFrame(data, WEEKLY)


def test_trailing_sum_counts_gaps_as_zero(spark):
    df = weekly(spark, [(1, 7, w, s) for w, s in ((1, 5.0), (2, 7.0), (14, 9.0), (15, 1.0))])
    out = T.trailing_sales(df, "weekly").orderBy("sequentialweek").collect()
    assert [r[T.TRAILING] for r in out] == [0, 5.0, 7.0, 9.0]


def test_negative_sales_clamped_in_trailing_sum(spark):
    df = weekly(spark, [(1, 7, 1, -5.0), (1, 7, 2, 3.0), (1, 7, 3, 0.0)])
    out = T.trailing_sales(df, "weekly").orderBy("sequentialweek").collect()
    assert [r[T.TRAILING] for r in out] == [0, 0.0, 3.0]


def marks_for(spark, trailing_by_sku):
    """One category, week 2; trailing sales come from week 1."""
    data = [(1, sku, 1, float(v)) for sku, v in trailing_by_sku.items()]
    data += [(1, sku, 2, 0.0) for sku in trailing_by_sku]
    out = T.top_selling(weekly(spark, data), "weekly")
    return {r.item_sku_id: (r[T.MARK], r[T.SHARE]) for r in out.where("sequentialweek = 2").collect()}


def test_pareto_crossing(spark):
    got = marks_for(spark, {1: 70, 2: 20, 3: 10})
    assert [got[k][0] for k in (1, 2, 3)] == [True, True, False]
    assert got[1][1] == pytest.approx(0.7)


def test_first_alone_over_80_percent(spark):
    got = marks_for(spark, {1: 90, 2: 10})
    assert [got[k][0] for k in (1, 2)] == [True, False]


def test_empty_category_marks_nothing(spark):
    got = marks_for(spark, {1: 0, 2: 0})
    assert got == {1: (False, 0.0), 2: (False, 0.0)}


def test_tie_at_border_broken_by_sku(spark):
    # SKUs 1, 3, 2 with 70, 15, 15: order 1, 2, 3; cumulative 0.70, 0.85, 1.
    got = marks_for(spark, {1: 70, 3: 15, 2: 15})
    assert (got[1][0], got[2][0], got[3][0]) == (True, True, False)


def test_first_period_has_no_history(spark):
    out = T.top_selling(weekly(spark, [(1, 1, 1, 5.0), (1, 2, 1, 3.0)]), "weekly").collect()
    assert all(not r[T.MARK] and r[T.SHARE] == 0.0 for r in out)


def test_null_category_rows_drop_out(spark):
    out = T.top_selling(weekly(spark, [(None, 1, 1, 5.0), (1, 2, 1, 3.0)]), "weekly")
    assert [r.item_sku_id for r in out.collect()] == [2]


def test_unknown_mode_raises(spark):
    with pytest.raises(ValueError):
        T.top_selling(weekly(spark, [(1, 1, 1, 1.0)]), "daily")


def plain_window(df):
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), F.col("k").asc())
    return (df.withColumn("cum", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("total", F.sum("v").over(Window.partitionBy("g"))))


def test_sliced_running_sum_equals_a_plain_window_on_decimals(spark):
    """A third of all rows in one group; ties, zeros, negative and NULL values."""
    rnd = random.Random(7)
    data = [(0 if i % 3 == 0 else rnd.randrange(1, 40), i,
             rnd.choice([None, "0", "0", "-3.25", str(rnd.randrange(0, 50)), f"{rnd.random() * 10 ** rnd.randrange(6):.4f}"]))
            for i in range(6000)]
    df = spark.createDataFrame(data, "g int, k bigint, v string").withColumn("v", F.col("v").cast("decimal(18,4)"))
    sliced = running_sum_by_group(df.repartition(5), ["g"], "v", "k", "cum", "total")
    a, b = (sorted(map(tuple, x.select("g", "k", "cum", "total").collect()), key=str)
            for x in (sliced, plain_window(df).withColumn("cum", F.coalesce("cum", F.lit(0)))))
    assert len(a) == 6000 and a == b


def test_sliced_running_sum_on_fractional_doubles(spark):
    """The last digits of a DOUBLE sum depend on the order of addition; shares
    rounded to 9 places, and so the marks, do not."""
    rnd = random.Random(3)
    data = [(i % 3, i, rnd.random() * 10 ** rnd.randrange(-3, 6)) for i in range(9000)]
    df = spark.createDataFrame(data, "g int, k bigint, v double")
    got = {r.k: r for r in running_sum_by_group(df, ["g"], "v", "k", "cum", "total").collect()}
    for r in plain_window(df).collect():
        assert got[r.k].cum == pytest.approx(r.cum, rel=1e-12) and got[r.k].total == pytest.approx(r.total, rel=1e-12)
        assert round(got[r.k].cum / got[r.k].total, 9) == round(r.cum / r.total, 9)


def test_slices_never_fall_as_values_rise(spark):
    values = sorted([-1e300, -5.0, -1e-300, 0.0, 5e-324, 1e-300, 0.5, 1.0, 1.01, 1.02, 1.03, 2.0, 1e18, 1e308])
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double")
           .select(value_slice(F.col("v"))).collect()]
    assert got == sorted(got) and len(set(got)) > 10


def test_twenty_equal_sellers_of_double_money(spark):
    """Sixteen of twenty equal shares reach 0.8, whatever the unit price."""
    data = [(c, 100 * c + k, w, 0.1 * (c + 1) if w == 1 else 0.0) for c in range(150) for k in range(20) for w in (1, 2)]
    out = T.top_selling(weekly(spark, data), "weekly").where("sequentialweek = 2")
    assert {r["n"] for r in out.groupBy(T.CATE3).agg(F.count_if(T.MARK).alias("n")).collect()} == {16}


def test_a_repeated_sku_and_period_is_an_error_unless_summed_first(spark):
    df = weekly(spark, [(1, 7, 1, 5.0), (1, 7, 1, 5.0), (1, 7, 2, 1.0)])
    with pytest.raises(Exception, match="not unique"):
        T.top_selling(df, "weekly").collect()
    once = T.one_row_per_period(df, "weekly")
    assert {(r.sequentialweek, r.total_net_sales, r.rows_summed) for r in once.collect()} == {(1, 10.0, 2), (2, 1.0, 1)}
    assert [r[T.TRAILING] for r in T.trailing_sales(once, "weekly").orderBy("sequentialweek").collect()] == [0, 10.0]


def test_stored_trailing_sales_give_the_same_marks(spark):
    rows = [(7, k, w, float((k * w) % 5), f"x{k}") for k in range(40) for w in range(1, 9)]
    df = spark.createDataFrame(rows, f"{T.CATE3} int, {T.SKU} bigint, sequentialweek int, {T.SALES} double, other string")
    for keep in (False, True):
        one, two = (T.top_selling(df, "weekly", keep, stored=s) for s in (False, True))
        assert one.columns == two.columns and one.count() == len(rows)
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
