"""Slices of one total order: hot groups, equal values and keys of any type."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skuflow.operators import features as Fe
from skuflow.operators import topsell as T
from skuflow.operators.ordered import KIND, ROW, SLICE, in_slices
from skuflow.operators.ranking import _EndGroups, running_sum_by_group


def plain_sums(df):
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), F.col("k").asc())
    return df.select("g", "k", F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)).alias("cum"),
                     F.sum("v").over(Window.partitionBy("g")).alias("total"))


def same(a, b):
    a, b = (sorted(map(tuple, x.select("g", "k", "cum", "total").collect()), key=str) for x in (a, b))
    assert a == b and a


@pytest.mark.parametrize("tie", ["bigint", "string"])
def test_equal_sellers_of_one_group_lie_over_many_slices(spark, tie):
    df = (spark.range(60_000).select(F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 97)).alias("g"),
                                     F.col("id").cast(tie).alias("k"), F.lit("2.50").cast("decimal(18,2)").alias("v")))
    same(running_sum_by_group(df.repartition(5), ["g"], "v", "k", "cum", "total"), plain_sums(df))
    keyed = df.withColumn("_rs_value", F.col("v"))
    sliced = in_slices(keyed, [F.col("g"), F.col("v").desc(), F.col("k")], lambda: _EndGroups(["g"]), slices=20)
    rows = sliced.where((F.col(KIND) == ROW) & (F.col("g") == "hot")).groupBy(SLICE).count().collect()
    assert len(rows) > 10 and max(r["count"] for r in rows) < 60_000 / 8


def test_groups_of_null_values_and_of_one_row(spark):
    data = [("a", 1, None), ("a", 2, None), ("b", 1, None), ("b", 2, Decimal("3")), ("c", 1, Decimal("-1")), ("c", 2, Decimal("0"))]
    data += [(f"d{i}", 1, Decimal(i)) for i in range(30)]
    df = spark.createDataFrame(data, "g string, k bigint, v decimal(10,2)")
    for part in (df, df.where("g = 'a'"), df.where("g = 'b'")):
        same(running_sum_by_group(part, ["g"], "v", "k", "cum", "total"), plain_sums(part))
    assert running_sum_by_group(df.limit(0), ["g"], "v", "k", "cum", "total").count() == 0


def test_two_group_columns_of_other_types_and_whole_values(spark):
    rnd = random.Random(5)
    data = [(f"2017-{i % 3:02d}", i % 2, i, rnd.choice([0, 0, 1, 1, 7])) for i in range(3_000)]
    df = spark.createDataFrame(data, "m string, c int, k bigint, v bigint")
    out = running_sum_by_group(df, ["m", "c"], "v", "k", "cum", "total")
    w = Window.partitionBy("m", "c").orderBy(F.col("v").desc(), "k").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("m", "c", "k", "v", F.sum("v").over(w).alias("cum"), F.sum("v").over(Window.partitionBy("m", "c")).alias("total"))
    assert out.schema["cum"].dataType == want.schema["cum"].dataType
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("key", ["string", "double", "date"])
def test_global_fill_by_any_key_plans_no_single_partition(spark, key):
    rnd = random.Random(1)
    text = {"string": lambda i: f"https://example.org/{i:05d}", "double": lambda i: i / 7, "date": lambda i: f"20{i % 90 + 10}-01-{i % 28 + 1:02d}"}[key]
    data = [(text(i), i, Decimal(i) if rnd.random() < 0.003 else None, rnd.choice([None, f"s{i}"])) for i in range(2_000)]
    df = spark.createDataFrame(data, f"t {'double' if key == 'double' else 'string'}, i int, x decimal(9,1), s string")
    df = df.withColumn("t", F.col("t").cast(key))
    out = Fe.fill_missing_global(df.repartition(6), ["t", "i"], ["x", "s"])
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    w = Window.orderBy("t", "i")
    ahead, behind = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    want = df.select("t", "i", *[F.coalesce(F.last(c, True).over(ahead), F.first(c, True).over(behind)).alias(c) for c in ("x", "s")])
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))


def test_global_fill_of_a_column_that_is_empty_or_known_once(spark):
    df = spark.range(1_000).select("id", F.lit(None).cast("double").alias("never"), F.when(F.col("id") == 700, 7.0).alias("once"))
    out = Fe.fill_missing_global(df.repartition(9), ["id"], ["never", "once"])
    assert {tuple(r) for r in out.select("never", "once").collect()} == {(None, 7.0)}
    pad = Fe.fill_missing_global(df, ["id"], ["once"], backward=False)
    assert pad.where("once IS NULL").count() == 700


def test_one_hot_order_key_is_cut_by_the_next_one(spark):
    df = spark.range(20_000).select(F.lit("same").alias("t"), "id", F.when(F.col("id") % 5_000 == 17, F.col("id")).alias("x"))
    out = Fe.fill_missing_global(df.repartition(4), ["t", "id"], ["x"])
    assert out.where("x != greatest(17, floor((id - 17) / 5000) * 5000 + 17)").count() == 0
    tied = Fe.fill_missing_global(df.drop("id").withColumn("x", F.col("x").cast("string")), ["t"], ["x"])
    assert tied.where("x IS NULL").count() == 0


def test_marks_of_many_equal_sellers_keep_the_order_of_skus(spark):
    n = 20_000
    data = spark.range(n).select(F.lit(1).alias(T.CATE3), F.col("id").alias(T.SKU), F.explode(F.array(F.lit(1), F.lit(2))).alias("sequentialweek"))
    df = data.withColumn(T.SALES, F.when(F.col("sequentialweek") == 1, 0.1).otherwise(0.0))
    out = T.top_selling(df, "weekly").where("sequentialweek = 2").where(T.MARK)
    assert [r[0] for r in out.select(T.SKU).orderBy(T.SKU).collect()] == list(range(int(0.8 * n)))
