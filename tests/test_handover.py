"""Numbered feature files in one job, bad rows kept apart, order lines by day,
metrics observed while writing."""

import os

import pytest
from pyspark.sql import functions as F

from skuflow.operators import metrics as Me
from skuflow.operators import sales as S
from skuflow.sources.tsv import read_feature_dir, read_tsv_checked, write_numbered_features
from skuflow.sources.warehouse import rebuild_table


def wide(spark, n=40):
    return spark.range(n).select(
        F.concat(F.lit("2017-"), F.lpad(F.col("id").cast("string"), 2, "0")).alias("tm_key"), (F.col("id") % 3).cast("int").alias("c"),
        (F.col("id") / 7).alias("a"), F.when(F.col("id") % 2 == 0, F.col("id") * 1.0).alias("b"), F.lit('say "x"\tnow').alias("s"),
        (F.col("id") % 4).alias("_b_rows"), F.lit(0).alias("_a_rows"))


def test_numbered_files_come_from_one_job_with_a_header_in_each_part(spark, tmp_path):
    folder = f"file://{tmp_path}/features"
    df = wide(spark).repartition(5)
    context = spark.sparkContext
    context.setJobGroup("numbered", "numbered")
    end = write_numbered_features(df, folder, ["tm_key", "c"], ["a", "b", "s"], {"b": "_b_rows"}, first=4)
    jobs = context.statusTracker().getJobIdsForGroup("numbered")
    context.setLocalProperty("spark.jobGroup.id", None)
    assert end == 7 and sorted(os.listdir(tmp_path / "features")) == ["f4", "f5", "f6"]
    with_tasks = [j for j in jobs if any(context.statusTracker().getStageInfo(s).numCompletedTasks
                                         for s in context.statusTracker().getJobInfo(j).stageIds)]
    assert len(with_tasks) <= 2  # the repartition above and the write
    for f, name in (("f4", "a"), ("f5", "b"), ("f6", "s")):
        parts = [p for p in os.listdir(tmp_path / "features" / f) if p.startswith("part-")]
        assert parts
        for p in parts:
            lines = (tmp_path / "features" / f / p).read_text().split("\n")
            assert lines[0] == f"tm_key\tc\t{name}" and lines.count(lines[0]) == 1
    a, b, s = read_feature_dir(spark, folder, {"tm_key": "string", "c": "int"}, column_types={"s": "string"})
    want = df.collect()
    assert sorted(map(tuple, a.collect())) == sorted((r.tm_key, r.c, r.a) for r in want)
    assert sorted(map(tuple, b.collect()), key=str) == sorted(((r.tm_key, r.c, r.b) for r in want if r._b_rows), key=str)
    assert {r.s for r in s.collect()} == {'say "x"\tnow'}


def test_a_feature_without_rows_keeps_its_file_and_files_are_replaced(spark, tmp_path):
    folder = f"file://{tmp_path}/features"
    for _ in range(2):
        write_numbered_features(wide(spark), folder, ["tm_key", "c"], ["a", "b"], {"a": "_a_rows"})
    tables = read_feature_dir(spark, folder, {"tm_key": "string", "c": "int"})
    assert [t.columns[-1] for t in tables] == ["a", "b"] and [t.count() for t in tables] == [0, 40]


def test_bad_rows_neither_abort_nor_vanish(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("k\tn\tx\n1\t5.0\t2.5\n2\tNaN\t\n3\n4\tseven\t1\n5\t1.5\t1\n6\t1\t1\t9\n7\t2\t3,5\n")
    (tmp_path / "b.tsv").write_text("k\tn\tx\n8\t3\t1e3\n")
    good, bad = read_tsv_checked(spark, f"file://{tmp_path}", {"k": "string", "n": "int", "x": "double"})
    assert sorted(map(tuple, good.collect()), key=str) == [("1", 5, 2.5), ("2", None, None), ("8", 3, 1000.0)]
    got = {(r.path.rsplit("/", 1)[1], r.line, r.reason) for r in bad.collect()}
    assert got == {("a.tsv", "3", "wrong number of cells"), ("a.tsv", "4\tseven\t1", "n is not int"), ("a.tsv", "5\t1.5\t1", "n is not int"),
                   ("a.tsv", "6\t1\t1\t9", "wrong number of cells"), ("a.tsv", "7\t2\t3,5", "x is not double")}
    with pytest.raises(ValueError, match="not in the header"):
        read_tsv_checked(spark, f"file://{tmp_path}", {"other": "string"})


def test_a_calendar_filter_prunes_the_days_of_the_lines(spark, tmp_path):
    lines = spark.range(600).select(F.date_format(F.date_add(F.lit("2017-01-01").cast("date"), (F.col("id") % 30).cast("int")),
                                                  "yyyy-MM-dd").alias("dt"), "id")
    stored = rebuild_table(lines.repartition("dt"), path=f"file://{tmp_path}/lines", partition_by=["dt"])
    days = spark.range(30).select(F.date_format(F.date_add(F.lit("2017-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("date"),
                                  F.floor(F.col("id") / 7).alias("week"))
    days.write.parquet(f"file://{tmp_path}/days")
    calendar = spark.read.parquet(f"file://{tmp_path}/days")
    out = S.lines_of_days(stored, calendar.where("week = 2"))
    assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString().lower()
    assert out.count() == 140 and set(out.columns) == set(stored.columns)


def test_metrics_are_observed_while_predictions_are_written(spark, tmp_path):
    rows = [("train", 10.0, 11.0), ("train", 0.0, 1.0), ("train", 10.0, -4.0), ("test", 5.0, 5.0)]
    df = spark.createDataFrame(rows, "split string, y double, y_ double")
    path = f"file://{tmp_path}/out"
    got = sorted(map(tuple, Me.write_and_score(df, "y", path).collect()))
    want = sorted(map(tuple, Me.score(df, "y").select("split", "hit_rate", "total_error").collect()))
    assert got == want
    assert sorted(r.y_ for r in spark.read.parquet(path).collect()) == [0.0, 1.0, 5.0, 11.0]
    missing = df.unionAll(spark.createDataFrame([("test", 1.0, None)], df.schema))
    by = {r.split: r.total_error for r in Me.write_and_score(missing, "y", path).collect()}
    assert by["test"] is None and by["train"] is not None
