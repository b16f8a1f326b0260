"""TSV hand-over files, feature folders, table rebuilds and previews."""

import math

import pytest

from skuflow.sources.tsv import (PANDAS_NA_TOKENS, list_tables, preview, read_feature_dir, read_tsv,
                                 write_numbered_features, write_tsv)
from skuflow.sources.warehouse import rebuild_table


def test_read_tsv_missing_tokens_and_types(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text("month\tsku\tv\tflag\n2017-03\t1\t1.5\tTrue\n2017-04\t2\tNA\tFalse\n"
                    "nan\t3\tinf\tFalse\n2017-06\t4\t\tTrue\n")
    df = read_tsv(spark, str(path), {"month": "string", "sku": "bigint", "v": "double",
                                     "flag": "boolean"})
    got = sorted(map(tuple, df.collect()), key=lambda r: r[1])
    assert got[0] == ("2017-03", 1, 1.5, True)          # month stays a string
    assert got[1][2] is None and got[2][0] is None      # NA, nan -> NULL
    assert got[2][2] == math.inf and got[3][2] is None
    assert "NULL" in PANDAS_NA_TOKENS


def test_roundtrip_and_numbered_features(spark, tmp_path):
    wide = spark.createDataFrame([("m1", 1, 0.5, 2.0, 1), ("m2", 1, None, math.inf, 0)],
                                 "tm_key string, c int, a double, b double, _b_rows int")
    folder = str(tmp_path / "features")
    assert write_numbered_features(wide, folder, ["tm_key", "c"], ["a", "b"], {"b": "_b_rows"}) == 2
    tables = read_feature_dir(spark, folder, {"tm_key": "string", "c": "int"})
    assert [t.columns[-1] for t in tables] == ["a", "b"]
    assert sorted(map(tuple, tables[0].collect())) == [("m1", 1, 0.5), ("m2", 1, None)]
    assert sorted(map(tuple, tables[1].collect())) == [("m1", 1, 2.0)]   # group without rows left out
    back = read_tsv(spark, write_tsv(wide, str(tmp_path / "w")),
                    {"tm_key": "string", "c": "int", "a": "double", "b": "double", "_b_rows": "int"})
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, wide.collect()), key=str)


def test_rebuild_table_overwrites_and_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "2017-01-01"), (2, "2017-01-02")], "k int, dt string")
    path = str(tmp_path / "t")
    rebuild_table(df, path=path, partition_by=["dt"])
    again = rebuild_table(df.where("k = 1"), path=path, partition_by=["dt"])
    assert [r.k for r in again.collect()] == [1]
    plan = again.where("dt = '2017-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_preview_is_ordered_head(spark):
    df = spark.createDataFrame([(i,) for i in range(20, 0, -1)], "k int")
    assert [r.k for r in preview(df, 5, ["k"]).collect()] == [1, 2, 3, 4, 5]


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    a = spark.createDataFrame([(i, float(i)) for i in range(200)], "sku bigint, v double")
    b = spark.createDataFrame([(i, i % 7) for i in range(200)], "sku bigint, c int")
    ta = rebuild_table(a, table="bucket_a", path=str(tmp_path / "a"), bucket_by=(["sku"], 4))
    tb = rebuild_table(b, table="bucket_b", path=str(tmp_path / "b"), bucket_by=(["sku"], 4))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        joined = ta.join(tb, "sku")
        assert joined.count() == 200
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_feature_dir_column_types(spark, tmp_path):
    df = spark.createDataFrame([("m1", 3, 1.5)], "tm_key string, n bigint, x double")
    write_tsv(df, str(tmp_path / "feats" / "t0"))
    (table,) = read_feature_dir(spark, str(tmp_path / "feats"), {"tm_key": "string"},
                                column_types={"n": "bigint"})
    assert dict(table.dtypes) == {"tm_key": "string", "n": "bigint", "x": "double"}


def test_whole_numbers_written_with_a_fraction_of_zero(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text("k\tv\n672.0\t1\nNA\t2\n9007199254740993\t3\n")
    got = read_tsv(spark, str(path), {"k": "bigint", "v": "int"})
    assert sorted(map(tuple, got.collect()), key=str) == [(672, 1), (9007199254740993, 3), (None, 2)]
    path.write_text("k\n1.5\n")
    with pytest.raises(Exception, match="not a whole number"):
        read_tsv(spark, str(path), {"k": "int"}).collect()


def test_quotes_are_doubled_as_pandas_does(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text('a\tb\n"say ""x""\ty"\t1\n')
    assert read_tsv(spark, str(path), {"a": "string", "b": "int"}).collect() == [('say "x"\ty', 1)]
    df = spark.createDataFrame([('q"uote\ttab', 2)], "a string, b int")
    assert read_tsv(spark, write_tsv(df, str(tmp_path / "w")), {"a": "string", "b": "int"}).collect() == df.collect()


def test_many_parts_are_one_table(spark, tmp_path):
    write_tsv(spark.range(200).repartition(40), str(tmp_path / "f" / "t0"))
    (tmp_path / "f" / "single.tsv").write_text("id\n1\n")
    assert [p.rsplit("/", 1)[-1] for p in list_tables(spark, str(tmp_path / "f"))] == ["single.tsv", "t0"]


def test_ratio_features_may_be_missing_instead_of_infinite(spark):
    from skuflow.operators import discounts as D
    row = [("2017-01", 7, 1, 5.0, 0.0, 5.0, 0.0, False, 0.0, 0.0)]
    df = spark.createDataFrame(row, "tm_key string, item_third_cate_cd int, item_sku_id bigint, "
                               "total_synthetic_give_away double, total_synthetic_gross_sales double, total_net_sales double, "
                               "pe double, true_top_saling_mark boolean, sales_share_recent_three_months double, discount double")
    assert D.discount_features(df).first().long_tail_discount == math.inf
    assert D.discount_features(df, inf_as_null=True).first().long_tail_discount is None
