"""What the fourth round of findings asked for."""

from conftest import SF
from pyspark.sql import functions as F

from millrace.session import kept, passing, shared_dir


def test_a_small_file_of_many_rows_is_not_broadcast(spark):
    """Files of a few megabytes hold rows of ten times that: only measured rows may be broadcast, not files taken for them."""
    rows = spark.range(300_000, numPartitions=4).select(F.col("id").alias("k"), F.concat(F.repeat(F.lit("some long subject line "), 20), F.col("id").cast("string")).alias("text"))
    frame = kept(rows)
    size = int(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    assert size > 10 << 20, size  # more than the limit below
    plan = spark.range(10**7).withColumnRenamed("id", "k").join(frame, "k")._jdf.queryExecution()
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b" and "BroadcastHashJoin" not in plan.sparkPlan().toString()
    few = kept(spark.range(1000).withColumnRenamed("id", "k"))
    assert "BroadcastHashJoin" in spark.range(10**7).withColumnRenamed("id", "k").join(few, "k")._jdf.queryExecution().sparkPlan().toString()


def folders(spark):
    import os

    return {f for f in os.listdir(shared_dir(spark)) if os.path.isdir(f"{shared_dir(spark)}/{f}")}


def test_what_is_kept_for_a_step_goes_with_it(spark):
    before = folders(spark)
    with passing(spark):
        first = kept(spark.range(10))
        with passing(spark):
            inner, last = kept(first), kept(first, stays=True)
            assert len(folders(spark) - before) == 3 and inner.count() == 10
        assert len(folders(spark) - before) == 2 and last.count() == 10
    assert folders(spark) == before
    with passing(spark):
        out = kept(spark.range(3), stays=True)
    assert out.count() == 3 and len(folders(spark) - before) == 1


def test_scored_batches_leave_their_rows_alone_and_no_scratch(spark):
    from millrace.catalog import policies

    before = folders(spark)
    assert policies.tier_rerun(spark, SF).count() > 0
    left = folders(spark) - before
    assert len(left) == 1 and left.pop().startswith("tiers-")


def test_the_report_file_leaves_no_other_scratch(spark):
    from millrace.catalog import reports

    before = folders(spark)
    assert reports.declination_file(spark, SF).count() > 0
    left = folders(spark) - before
    assert len(left) == 1 and left.pop().startswith("declined-")


def test_the_report_keeps_one_frame_of_its_requests(spark):
    """The rows kept on the way are gone when the report is built; the last ones stay, as the result reads them."""
    from millrace.catalog import reports

    before = folders(spark)
    report = reports.declination_report(spark, SF)
    assert len(folders(spark) - before) == 1 and report.count() > 0


def test_shuffle_files_go_with_their_job(spark):
    """A frame that was written leaves no shuffle files behind; one that is collected twice gives the same rows."""
    import glob
    import time

    files = lambda: set(glob.glob(f"{spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].toString()}/*/shuffle_*.data"))
    before = files()
    rows = spark.range(10_000).groupBy((F.col("id") % 7).alias("k")).count()
    kept(rows)
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, rows.collect())) and len(rows.collect()) == 7
