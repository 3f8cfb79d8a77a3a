"""The linkage as a job that runs again and again, the reader of files with their own headers, and the interval index."""

import datetime as dt

import pytest
from conftest import SF
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog import claims
from millrace.operators import ranges
from millrace.plans import linkage, scoring
from millrace.session import scratch_path
from millrace.sources import files, tables

SHEETS = "CLAIM_NUMBER string, CLAIMANT_NAME string, ACCIDENT_DATE string, VALUATION_DATE string, POLICY_EFFECTIVE_DATE string, ENTITY string, SUBJECT string, RECEIVED string"


def drop(spark, inbox, rows):
    spark.createDataFrame(rows, SHEETS).coalesce(1).write.mode("append").csv(inbox, header=True)


def test_linkage_run_takes_files_once(spark):
    """A second run reads new files only; a run without files, or a batch run again, changes nothing; rows of earlier batches are not added again."""
    inbox, home = scratch_path(spark, "inbox"), scratch_path(spark, "home")
    requests, master = claims._requests(spark, SF), claims._master(spark, SF).limit(5)
    shown = lambda: sorted((r["batch"], r["CLAIM_NUMBER"] or "") for r in linkage.read_history(spark, home).where("IS_SHEET = 1").collect())
    row = lambda n, day: (n, "Ann, B", "1/2/1996", day, None, "Nobody Knows", None, "1996-05-05")
    drop(spark, inbox, [row("A1", "1996-03-03"), row("A1", "1996-03-03"), row("A2", None)])
    linkage.run(spark, inbox, home, requests, master, F.lit("1996-06-01"))
    assert shown() == [(0, "A1"), (0, "A2")]
    linkage.run(spark, inbox, home, requests, master, F.lit("1996-06-02"))
    assert shown() == [(0, "A1"), (0, "A2")]
    drop(spark, inbox, [row("A2", None), row("A3", "1996-04-04")])
    linkage.run(spark, inbox, home, requests, master, F.lit("1996-07-01"))
    assert shown() == [(0, "A1"), (0, "A2"), (1, "A3")]
    assert linkage.read_history(spark, home).where("batch = 1 and IS_SHEET is null").count() == 0  # the master has nothing new
    before = sorted(map(str, linkage.read_history(spark, home).collect()))
    again = spark.read.schema(linkage.claim_sheet()).parquet(f"{home}/sheets/batch=1").collect()
    linkage.link_batch(spark.createDataFrame(again, linkage.claim_sheet()), 1, home, requests, master, F.lit("1996-07-01"))
    assert sorted(map(str, linkage.read_history(spark, home).collect())) == before


def test_history_window_bounds_what_is_read_again(spark):
    """Stored sheets outside 13 months back to 3 ahead of the last insertion are not linked again, those inside are."""
    home = scratch_path(spark, "home")
    requests = spark.createDataFrame([("Acme", dt.date(1996, 6, 1), dt.date(1996, 1, 1), "Open", "New")], "account_name string, term_effctv_date date, mdfd_date date, status string, new_renewal string")
    master = claims._master(spark, SF).limit(0)
    days = {"OLD": dt.date(1994, 1, 1), "IN": dt.date(1996, 1, 1), "LATE": dt.date(1997, 12, 1)}
    sheet = lambda n, d: spark.createDataFrame([(n, d)], "CLAIM_NUMBER string, VALUATION_DATE date").withColumn(linkage.MATCH, F.lit("ACMES"))
    full = lambda df, day: linkage.conform(df.withColumn("RECORD_INSERTION_DATE", F.lit(day).cast("date")), linkage.claim_sheet())
    first = sheet("OLD", days["OLD"]).unionByName(sheet("IN", days["IN"])).unionByName(sheet("LATE", days["LATE"]))
    linkage.link_batch(full(first, "1996-02-01"), 0, home, requests.where("false"), master, F.lit("1996-02-01"))
    linkage.link_batch(full(sheet("NEW", days["IN"]), "1996-03-01"), 1, home, requests, master, F.lit("1996-03-01"), 80)
    got = linkage.read_history(spark, home).where("batch = 1").collect()
    assert sorted((r["CLAIM_NUMBER"], r["ACCOUNT_NAME"]) for r in got) == [("IN", "Acme"), ("NEW", "Acme")]


def test_files_to_rows(spark):
    cells = [
        ("a.csv", 'Claim No,Name\r\n1,"x, ""y""\nz"\r\n2\r\n\r\n3,,\r\n4,\r\n'), ("b.csv", "name,other,claim no\nq,9,5"), ("c.csv", ""), ("d.csv", None), ("e.csv", "Other\n7\n"),
    ]
    got = files.files_to_rows(spark.createDataFrame(cells, "file string, content string"), ["CLAIM_NO", "NAME"])
    want = [("1", 'x, "y"\nz', "a.csv"), ("4", None, "a.csv"), ("5", "q", "b.csv"), (None, None, "e.csv")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and got.columns == ["CLAIM_NO", "NAME", "file"]
    with pytest.raises(Exception, match="collide"):
        files.files_to_rows(spark.createDataFrame([("x", "a b,A_B\n1,2")], "file string, content string"), ["A_B"]).collect()


def test_ingest_reads_files_once_without_the_driver(spark):
    path = scratch_path(spark, "drop")
    spark.createDataFrame([(k, f"n{k}") for k in range(20)], "key int, name string").repartition(4).write.csv(path, header=True)
    out = files.ingest_files(spark, path, T.StructType([T.StructField("KEY", T.LongType()), T.StructField("NAME", T.StringType())]))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and out.count() == 20


def test_incremental_keeps_null_times_of_a_first_load(spark):
    rows = spark.createDataFrame([(1, None), (2, dt.datetime(2024, 1, 1)), (3, dt.datetime(2024, 1, 3))], "id int, ts timestamp")
    taken = lambda target: sorted(r["id"] for r in tables.incremental(rows, target, "ts").collect())
    assert taken(rows.where("false")) == [1, 2, 3] and taken(rows.where("id = 2")) == [3] and taken(rows.where("id = 1")) == [1, 2, 3]


T0 = dt.datetime(2000, 1, 1)


def stamp(h):
    return T0 + dt.timedelta(hours=h)


def test_interval_index_copies(spark):
    """However long an interval is, it lies on one or two nodes, before 1970 too."""
    rows = [(1, dt.datetime(1900, 1, 1), dt.datetime(9999, 12, 31)), (2, stamp(0), stamp(0.5)), (3, stamp(0.5), stamp(1.5)), (4, dt.datetime(1899, 1, 1), dt.datetime(1970, 1, 2)), (5, stamp(7), stamp(8761))]
    placed = ranges._on_nodes(spark.createDataFrame(rows, "id int, a timestamp_ntz, b timestamp_ntz"), F.col("a"), F.col("b"), 1)
    copies = {r["id"]: r["count"] for r in placed.groupBy("id").count().collect()}
    assert set(copies) == {1, 2, 3, 4, 5} and max(copies.values()) <= 2


def test_interval_joins_match_plain_ones(spark):
    import random

    rng = random.Random(3)
    span = lambda: (rng.randint(0, 300), rng.choice([0, 1, 2, 7, 40, 10**5]))
    a = [(k % 3, k, s, s + n) for k in range(60) for s, n in [span()]] + [(0, 900, -10**5, 10**7), (None, 901, 0, 5)]
    b = [(k % 3, k, s, s + n) for k in range(60) for s, n in [span()]] + [(0, 900, -10**6, 10**6), (None, 901, 0, 5)]
    frame = lambda rows, n: spark.createDataFrame([(g, k, stamp(x), stamp(y)) for g, k, x, y in rows], f"g int, {n} int, {n}0 timestamp_ntz, {n}1 timestamp_ntz")
    fa, fb = frame(a, "a"), frame(b, "b")
    got = sorted((r["a"], r["b"]) for r in ranges.overlap_join(fa, fb, "g", ("a0", "a1"), ("b0", "b1")).collect())
    want = sorted((k, m) for g, k, x, y in a for h, m, u, v in b if g is not None and g == h and x < y and u < v and x < v and y > u)
    assert got == want
    for hours in (1, 24 * 92):
        got = sorted((r["a"], r["b"]) for r in ranges.interval_join(fa.drop("a1"), fb, "g", "a0", "b0", "b1", hours).collect())
        assert got == sorted((k, m) for g, k, x, _ in a for h, m, u, v in b if g is not None and g == h and u <= x < v)



def test_a_batch_run_again_replaces_itself_only(spark):
    import glob
    import os

    path = scratch_path(spark, "tiers")
    rows = lambda *n: spark.createDataFrame([(k,) for k in n], "k int")
    scoring.store_batch(rows(1, 2), 1, path)
    scoring.store_batch(rows(3), 2, path)
    first = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/iteration_nbr=1/*.parquet")}
    scoring.store_batch(rows(4, 5), 2, path)
    assert sorted(map(tuple, spark.read.parquet(path).select("iteration_nbr", "k").collect())) == [(1, 1), (1, 2), (2, 4), (2, 5)]
    assert first == {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/iteration_nbr=1/*.parquet")}
