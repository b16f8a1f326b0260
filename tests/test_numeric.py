import math

from pyspark.sql import functions as F

from skuflow.functions.numeric import (band_label, clamp_negative, clip_at_zero, month_index,
                                       pdiv, sql_div)


def test_sql_and_pandas_division(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (0.0, 0.0), (-3.0, 0.0), (None, 1.0)],
                               "n double, d double")
    out = df.select(sql_div("n", "d").alias("s"), pdiv("n", "d").alias("p"),
                    pdiv("n", "d", inf_as_null=True).alias("q")).collect()
    assert [r.s for r in out] == [0.5, None, None, None, None]
    assert out[0].p == 0.5 and out[1].p == math.inf and out[2].p is None
    assert out[3].p == -math.inf and out[4].p is None
    assert [r.q for r in out] == [0.5, None, None, None, None]


def test_decimal_ratio_is_double_division(spark):
    df = spark.createDataFrame([("1.0000", "3.0000")], "n string, d string") \
        .select(F.col("n").cast("decimal(18,4)").alias("n"), F.col("d").cast("decimal(18,4)").alias("d"))
    assert df.select(sql_div("n", "d").alias("r")).first().r == 1.0 / 3.0


def test_clamp_and_clip_keep_null(spark):
    df = spark.createDataFrame([(-5.0,), (3.0,), (None,)], "x double")
    assert [r.c for r in df.select(clamp_negative("x").alias("c")).collect()] == [0, 3.0, None]
    assert [r.c for r in df.select(clip_at_zero("x").alias("c")).collect()] == [0.0, 3.0, None]


def test_band_labels_match_percent_formatting():
    assert [band_label(a, b) for a, b in ((0, 1), (0.05, 1), (0.1, 1), (0.2, 1), (0, 0.1), (0.1, 0.2))] \
        == ["0_to_100", "5_to_100", "10_to_100", "20_to_100", "0_to_10", "10_to_20"]


def test_month_index_differences(spark):
    df = spark.createDataFrame([("2016-11",), ("2016-12",), ("2017-01",), ("2017-03",)], "m string")
    idx = [r.i for r in df.select(month_index("m").alias("i")).collect()]
    assert [b - a for a, b in zip(idx, idx[1:])] == [1, 1, 2]
