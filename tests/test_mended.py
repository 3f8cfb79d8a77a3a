"""Faults once found: one test each."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import text
from millrace.operators import filters, ranges, shape
from millrace.plans import declination
from millrace.session import scratch_path
from millrace.sources import files, tables
from millrace.streaming import streams


def test_each_file_is_read_by_its_own_header(spark):
    root = scratch_path(spark, "heads")
    spark.createDataFrame([("10", "1.5")], "`Claim No` string, Paid string").coalesce(1).write.csv(f"{root}/in/a", header=True)
    spark.createDataFrame([("2.5", "20")], "paid string, `claim no` string").coalesce(1).write.mode("append").csv(f"{root}/in/a", header=True)
    spark.createDataFrame([("10", "1.5")], "`Claim No` string, Paid string").coalesce(1).write.csv(f"{root}/in2/a", header=True)
    schema = T.StructType([T.StructField("CLAIM_NO", T.StringType()), T.StructField("PAID", T.DoubleType())])
    got = files.ingest_files(spark, [f"{root}/in/a", f"{root}/in2/a"], schema).collect()
    assert sorted((r["CLAIM_NO"], r["PAID"]) for r in got) == [("10", 1.5), ("10", 1.5), ("20", 2.5)]
    assert len({r["source_file"] for r in got}) == 3


def test_quoted_line_break(spark):
    path = scratch_path(spark, "breaks")
    spark.createDataFrame([('1,"x\ny"',)], "value string").coalesce(1).write.text(path)
    got = files.read_csv(spark, path, "a int, b string", header=False, multi_line=True).collect()
    assert [tuple(r) for r in got] == [(1, "x\ny")]


def test_dates_of_two_digits_and_day_first(spark):
    cases = {"1/2/19": (2019, 1, 2), "1-2-19": (2019, 1, 2), "13/01/2019": (2019, 1, 13), "12/31/70": (1970, 12, 31), "1/2/2019": (2019, 1, 2), "2019-1-2": (2019, 1, 2), "13/13/2019": None, "31.12.99": (1999, 12, 31)}
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = {r["t"]: r["d"] for r in df.select("t", text.date_in(F.col("t")).alias("d")).collect()}
    assert got == {c: d and dt.date(*d) for c, d in cases.items()}


def test_bad_cells_are_null(spark):
    df = spark.createDataFrame([("9" * 20, "12a4")], "a string, b string")
    assert shape.conform(df, T.StructType([T.StructField("a", T.LongType())]), fold=False).first()[0] is None
    assert shape.cast_all(df, {"b": "bigint"}).first()["b"] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        shape.cast_all(df, {"b": "bigint"}, strict=True).collect()
    sample = spark.createDataFrame([("5:99999999999", 1000)], "member string, score bigint")
    assert streams.parse_sample(sample).first()["mem_whole"] is None
    assert text.split_part(sample, "member", ":", 1, "x", as_int=True).first()["x"] is None


def test_fixed_width_refuses_long_values(spark):
    with pytest.raises(Exception, match="longer than 3"):
        files.write_fixed(spark.createDataFrame([("abcdef",)], "a string"), scratch_path(spark, "fixed"), [("a", 1, 3, "string")])


def test_membership_keeps_column_order(spark):
    df = spark.range(1000).select((F.col("id") * 2).alias("a"), F.col("id").alias("b"), F.lit(1).alias("c"))
    for values in (range(500), spark.range(500).toDF("v")):
        got = filters.is_any(df, "b", values)
        assert got.columns == ["a", "b", "c"] and got.count() == 500


def test_open_ended_intervals(spark):
    far, day = dt.datetime(9999, 12, 31), dt.datetime(2024, 1, 1)
    a = spark.createDataFrame([(1, day, far), (1, dt.datetime(1, 1, 2), day)], "k int, s timestamp, e timestamp")
    b = spark.createDataFrame([(1, day + dt.timedelta(hours=5), far), (1, day - dt.timedelta(hours=1), day + dt.timedelta(hours=1))], "k int, s2 timestamp, e2 timestamp")
    assert ranges.overlap_join(a, b, "k", ("s", "e"), ("s2", "e2")).count() == 3
    points = b.select("k", F.col("s2").alias("t"))
    assert ranges.interval_join(points, a, "k", "t", "s", "e", hours=1).count() == 2


def test_increment_is_pushed_down(spark):
    path = scratch_path(spark, "increment")
    df = spark.range(10).select("id", F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("d"))
    df.write.parquet(path)
    source = spark.read.parquet(path)
    got = tables.incremental(source, source.filter("id < 6"), "d")
    assert got.count() == 4 and tables.incremental(source, source.filter("id < 0"), "d").count() == 10
    assert tables.incremental(source, source.filter("id < 6"), "d", lookback_days=2).count() == 6
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_compaction_leaves_fewer_files(spark):
    many, few = scratch_path(spark, "many"), scratch_path(spark, "few")
    spark.range(1000).repartition(16).write.parquet(many)
    files.compact(spark, many, few)
    assert len(spark.read.parquet(few).inputFiles()) == 1 < len(spark.read.parquet(many).inputFiles()) and spark.read.parquet(few).count() == 1000


def test_compaction_under_readers(spark):
    root = scratch_path(spark, "versions")
    with pytest.raises(ValueError):
        files.published(spark, root)
    assert files.newest_version(spark, root) == (0, None)
    assert files.publish(spark.range(1000).repartition(16), root) == 1
    reader = files.published(spark, root)
    assert files.compact_published(spark, root) == 2
    now = files.published(spark, root)
    assert len(now.inputFiles()) == 1 < len(reader.inputFiles()) and now.count() == reader.count() == 1000
    assert files.publish(spark.range(0), root) == 3 and files.published(spark, root).count() == 0 and now.count() == 1000
    spark.range(5).write.parquet(f"{root}/versions/unfinished")  # a folder that the log does not name is not read
    assert files.published(spark, root).count() == 0


def test_csv_keeps_white_space(spark):
    df = spark.createDataFrame([(" a", "b "), ("c", None)], "x string, y string")
    files.write_report(df, [("x", "X"), ("y", "Y")], path := scratch_path(spark, "report"))
    assert Counter(files.read_csv(spark, path, sep="\t").collect()) == Counter(df.collect())
    files.export_csv(df, path := scratch_path(spark, "export"))
    assert Counter(files.read_csv(spark, path).collect()) == Counter(df.collect())


def test_measures_need_exactly_one_account_information(spark):
    infos = spark.createDataFrame([(1, 10), (2, 20), (2, 21), (3, None)], "smmry_optn_id long, accnt_infrmtn_id long")
    assert {tuple(r) for r in declination.lone_information(infos).collect()} == {(1, 10), (3, None)}


def test_table_sees_new_files(spark):
    from millrace.catalog.registry import table

    root = scratch_path(spark, "grown")
    spark.range(5).coalesce(1).write.parquet(f"{root}/t.parquet")
    assert table(spark, root, "t").count() == 5
    spark.range(5).coalesce(1).write.mode("append").parquet(f"{root}/t.parquet")
    assert table(spark, root, "t").count() == 10


def test_partitions_are_pruned(spark):
    import __spark_entry__ as entry

    plan = entry.queries()["partition_pruning"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
