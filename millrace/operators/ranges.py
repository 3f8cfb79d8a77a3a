"""Joins on time: point in interval, lookback, overlap, as-of.

All of them stay equality joins for the planner. Intervals are indexed by length class: the
time axis is cut into cells, and an interval that touches up to 2**k of them lies on the one or two
nodes of 2**k cells it touches, however long it is. A point asks one node per class that has intervals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.dates import add_months_eom, hour_no, micros


def bucket_no(ts: Column, hours: int) -> Column:
    return F.floor(hour_no(ts) / hours)


def _on_nodes(df: DataFrame, first: Column, last: Column, hours: int) -> DataFrame:
    """Rows with ``__level`` and ``__node``, one or two copies each: the nodes of their length class."""
    cells = df.withColumns({"__from": bucket_no(first, hours), "__to": bucket_no(last, hours)}).filter("__from <= __to")
    classed = cells.withColumn("__level", F.expr("CASE WHEN __from = __to THEN 0 ELSE length(bin(__to - __from)) END"))
    node = F.explode(F.sequence(F.expr("shiftright(__from, __level)"), F.expr("shiftright(__to, __level)")))
    return classed.withColumn("__node", node).drop("__from", "__to")


def stab_join(points: DataFrame, intervals: DataFrame, key: str, ts: Column, first: Column, last: Column, inside: Column, hours: int) -> DataFrame:
    """Points with every interval of their key for which ``inside`` holds, which must imply ``first <= ts <= last``.

    The classes in use, at most some forty small numbers, are a scalar subquery over the intervals; each point is copied once per class.
    Intervals of one length make one class, so neither side grows much; an interval open at both ends lies on two nodes at most.
    """
    placed = _on_nodes(intervals, first, last, hours)
    classes = placed.agg(F.collect_set("__level")).scalar()
    asked = points.filter(F.col(key).isNotNull() & ts.isNotNull()).withColumns({"__cell": bucket_no(ts, hours), "__level": F.explode(classes)})
    asked = asked.withColumn("__node", F.expr("shiftright(__cell, __level)")).drop("__cell")
    return asked.join(placed, [key, "__level", "__node"]).filter(inside).drop("__level", "__node")


def interval_join(events: DataFrame, terms: DataFrame, key: str, ts: str, start: str, end: str,
                  hours: int = 24 * 92) -> DataFrame:
    """Events with every term of their key where ``start <= ts < end``.

    ``hours`` is the width of a cell: a fraction of the usual term length keeps the pairs per node few.
    """
    at, begin, stop = F.col(ts), F.col(start), F.col(end)
    return stab_join(events, terms.filter(begin < stop), key, at, begin, stop, (at >= begin) & (at < stop), hours)


def lookback_join(a: DataFrame, b: DataFrame, key: str, v: str, t: str, months: int = 12, floor=None,
                  hours: int = 24 * 92) -> DataFrame:
    """``a`` with every row of ``b`` of its key where ``t - months < v < t`` (and ``v >= floor``)."""
    low = add_months_eom(F.col(t), -months)
    points = a if floor is None else a.filter(F.col(v) >= F.lit(floor).cast("date"))
    inside = (F.col(v) < F.col(t)) & (F.col(v) > low)
    return stab_join(points, b.filter(F.col(t).isNotNull()), key, F.col(v), low, F.col(t), inside, hours)


def overlap_join(a: DataFrame, b: DataFrame, key: str, a_iv: tuple[str, str], b_iv: tuple[str, str],
                 hours: int = 1, clip: tuple[str, str] = ("overlap_start", "overlap_end"), instants: bool = False) -> DataFrame:
    """Pairs of one key whose half-open intervals share time, with the shared stretch.

    Two intervals share time where the later start lies in the other interval. So there are two joins of
    starts with intervals, which have no pair in common: a's start in b, and b's later start in a. Intervals without
    length share no time; with ``instants`` those of ``a`` that lie inside b, not on its ends, are paired too.
    """
    (a0, a1), (b0, b1) = (map(F.col, iv) for iv in (a_iv, b_iv))
    left, right = a.filter(a0 < a1), b.filter(b0 < b1)
    within_b = stab_join(a if instants else left, right, key, a0, b0, b1, (a0 >= b0) & (a0 < b1) & (a1 > b0), hours)
    within_a = stab_join(right, left, key, b0, a0, a1, (b0 > a0) & (b0 < a1), hours)
    names = [key, *[c for c in (*a.columns, *b.columns) if c != key]]
    return within_b.select(*names).unionByName(within_a.select(*names)).withColumns({clip[0]: F.greatest(a0, b0), clip[1]: F.least(a1, b1)})


def match_null_safe(a: DataFrame, b: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on keys that may be null on both sides; the right copies of the keys are dropped."""
    right = b.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return a.join(right, on, how).drop(*[f"__r_{k}" for k in keys])


def max_before(df: DataFrame, keys: list[str], bucket: str, order: str, value: str, out: str, strict: bool = True) -> DataFrame:
    """Greatest ``value`` among rows of the key that come before this one in ``order``.

    A prefix scan in two levels: a window inside each (key, bucket), plus the
    greatest value of all earlier buckets, found on one row per bucket. ``bucket``
    must not decrease along ``order``. ``strict`` leaves out rows with equal order;
    otherwise the row itself and its equals count.
    """
    inner = Window.partitionBy(*keys, bucket).orderBy(order).rangeBetween(Window.unboundedPreceding, -1 if strict else 0)
    local = df.withColumn("__local", F.max(value).over(inner))
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        df.groupBy(*keys, bucket).agg(F.max(value).alias("__top"))
        .select(*keys, bucket, F.max("__top").over(earlier).alias("__carry"))
    )
    return (
        match_null_safe(local, carry, [*keys, bucket])
        .withColumn(out, F.greatest("__local", "__carry"))
        .drop("__local", "__carry")
    )


def asof_latest(left: DataFrame, snaps: DataFrame, key: str, left_ts: str, snap_ts: str,
                measures: list[Column], hours: int = 24 * 366) -> DataFrame:
    """Aggregate of the latest snapshot strictly before each row's date; null if there is none.

    Snapshots are summed per (key, date) and the lookups reduced to distinct
    (key, date) pairs before anything is ordered, so the ordered part holds at most
    one row per key and date; it is then scanned bucket by bucket.
    """
    states = snaps.filter(F.col(key).isNotNull() & F.col(snap_ts).isNotNull()).groupBy(key, snap_ts).agg(*measures)
    asks = left.select(key, F.col(left_ts).alias("__at")).filter(F.col(key).isNotNull() & F.col("__at").isNotNull()).distinct()
    kind = dict(snaps.dtypes)[snap_ts]
    marks = states.select(key, F.col(snap_ts).alias("__at"), F.col(snap_ts).alias("__snap"), F.lit(False).alias("__ask"))
    probes = asks.select(key, F.col("__at").cast(kind).alias("__at"), F.lit(None).cast(kind).alias("__snap"), F.lit(True).alias("__ask"))
    line = marks.unionByName(probes).withColumns({
        "__bucket": bucket_no(F.col("__at"), hours),
        "__order": micros(F.col("__at")),
    })
    found = (
        max_before(line, [key], "__bucket", "__order", "__snap", "__hit")
        .filter(F.col("__ask") & F.col("__hit").isNotNull())
        .select(key, F.col("__at").alias("__ask_at"), F.col("__hit").alias(snap_ts))
    )
    answers = found.join(states, [key, snap_ts])
    # Snapshot names are set aside so that they cannot clash with columns of ``left``.
    answers = answers.withColumnRenamed(snap_ts, "__snap_ts").withColumnRenamed(key, "__key")
    on = (F.col(key) == F.col("__key")) & (F.col(left_ts).cast(kind) == F.col("__ask_at"))
    return left.join(answers, on, "left").drop("__key", "__ask_at").withColumnRenamed("__snap_ts", "asof_" + snap_ts)
