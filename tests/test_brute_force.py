"""Blocked and bucketed operators against plain Python over random data, hot keys included."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import fuzzy, ranges, sessions

EPOCH = dt.datetime(2024, 1, 1)


def test_fuzzy_equals_all_pairs(spark):
    rng = random.Random(5)
    words = ["ALPHA", "BETA", "GAMMA", "NORTH", "RIVER", "STEEL", "AMERICAN", "UNION"]

    def edit(s):
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(s) + 1)
            s = s[:i] + rng.choice(["", "X", "E "]) + s[i + rng.randint(0, 1):]
        return s

    # A third of the names share their first word.
    rights = ["AMERICAN " * (i % 3 == 0) + " ".join(rng.choices(words, k=rng.randint(1, 4))) for i in range(120)] + ["A", "AB", ""]
    lefts = [edit(rng.choice(rights) or "Q") for _ in range(250)] + ["A", "B", "AB", ""]
    left = spark.createDataFrame([(x,) for x in lefts], "n string")
    right = spark.createDataFrame([(x,) for x in rights], "n string")
    for min_score in (80, 90):
        got = {r.n: (r.matched, r.score) for r in fuzzy.fuzzy_best(left, right, "n", min_score=min_score).collect()}
        for x in set(lefts):
            ratios = [(fuzzy.indel_ratio(x, y), y) for y in set(rights) if x and y]
            want = min(((-round(100 * r), -r, y) for r, y in ratios if round(100 * r) > min_score), default=None)
            assert got[x] == ((want[2], -want[0]) if want else (None, None)), x


@settings(max_examples=200, deadline=None)
@given(st.text("ABC ", max_size=12), st.text("ABC ", max_size=12))
def test_lcs_length(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert fuzzy.lcs_length(a, b) == table[-1][-1]


@pytest.mark.parametrize("hours", [1, 6, 48])
def test_sessions_do_not_depend_on_buckets(spark, hours):
    rng = random.Random(hours)
    # Key 1 holds most rows; some signals last longer than a bucket; times repeat.
    data = [(1 if rng.random() < 0.7 else rng.choice([2, 3, None]), EPOCH + dt.timedelta(minutes=rng.randrange(4000)), rng.choice([10, 60, 20000])) for _ in range(400)]
    df = spark.createDataFrame(data, "k int, ts timestamp_ntz, d int")
    got = sorted(((r.k, r.start_time, r.end_time, r.signals, r.watch_seconds) for r in sessions.sessionize(df, ["k"], "ts", "d", 900, hours).collect()), key=str)
    want = []
    for k in {x[0] for x in data}:
        cur = None
        for _, t, d in sorted((x for x in data if x[0] == k), key=lambda x: (x[1], x[2])):
            end = t + dt.timedelta(seconds=d)
            if cur is None or t > cur[2] + dt.timedelta(seconds=900):
                if cur:
                    want.append(tuple(cur))
                cur = [k, t, end, 1, d]
            else:
                cur[2], cur[3], cur[4] = max(cur[2], end), cur[3] + 1, cur[4] + d
        want.append(tuple(cur))
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("hours", [1, 24 * 30])
def test_range_joins_equal_all_pairs(spark, hours):
    rng = random.Random(3)

    def when():
        return EPOCH + dt.timedelta(minutes=rng.randrange(60 * 24 * 20))

    pts = [(rng.choice(["hot", "hot", "x"]), when(), i) for i in range(120)]
    ivs = [(rng.choice(["hot", "x"]), *sorted((when(), when())), i) for i in range(40)]
    a = spark.createDataFrame(pts, "k string, ts timestamp_ntz, i int")
    b = spark.createDataFrame(ivs, "k string, s timestamp_ntz, e timestamp_ntz, j int")
    got = sorted((r.i, r.j) for r in ranges.interval_join(a, b, "k", "ts", "s", "e", hours).collect())
    assert got == sorted((p[2], v[3]) for p in pts for v in ivs if p[0] == v[0] and v[1] <= p[1] < v[2])
    long = a.withColumn("te", F.col("ts") + F.make_dt_interval(hours=F.lit(30)))
    got = sorted((r.i, r.j) for r in ranges.overlap_join(long, b, "k", ("ts", "te"), ("s", "e"), max(hours, 6)).collect())
    day = dt.timedelta(hours=30)
    assert got == sorted((p[2], v[3]) for p in pts for v in ivs if p[0] == v[0] and p[1] < v[2] and p[1] + day > v[1] and v[1] < v[2])


@pytest.mark.parametrize("hours", [24, 24 * 366])
def test_asof_equals_scan(spark, hours):
    rng = random.Random(9)

    def day():
        return (EPOCH + dt.timedelta(days=rng.randrange(900))).date()

    left = [(rng.choice(["hot", "hot", "x", "none"]), day(), i) for i in range(200)]
    snaps = [(rng.choice(["hot", "x"]), day(), float(rng.randrange(100))) for _ in range(150)]
    got = ranges.asof_latest(
        spark.createDataFrame(left, "k string, d date, i int"), spark.createDataFrame(snaps, "k string, s date, v double"), "k", "d", "s", [F.sum("v").alias("v")], hours
    )
    for r in got.collect():
        before = [s for s in snaps if s[0] == r.k and s[1] < r.d]
        last = max((s[1] for s in before), default=None)
        assert (r.asof_s, r.v) == (last, sum(s[2] for s in before if s[1] == last) if before else None)
