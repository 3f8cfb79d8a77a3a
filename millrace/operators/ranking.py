"""One row per key, and numbering.

``row_number() = 1`` filters are planned with a group limit in front of the
shuffle, so each map task forwards at most one row per key: a key holding a
third of the table costs its reducer one row per map task, not the whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import kept, passing


def _cols(items) -> list[Column]:
    return [F.col(i) if isinstance(i, str) else i for i in items]


def top_one(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    """First row per key in the given order."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def latest(df: DataFrame, keys: list, order: list, ties: list = ()) -> DataFrame:
    """Row with the greatest ``order`` values per key; a null order value counts as greatest.

    ``ties`` (greatest first) make the pick repeatable when order values repeat.
    """
    return top_one(df, keys, [c.desc_nulls_first() for c in _cols([*order, *ties])])


def keep_last(df: DataFrame, keys: list, order: list, ties: list = ()) -> DataFrame:
    """Sort ascending with nulls last, keep the last row per key (keys may be null)."""
    return latest(df, keys, order, ties)


def priority_of(col: str, values: list) -> Column:
    """Position of the value in ``values`` from 1; anything else comes after them."""
    expr = F
    for i, v in enumerate(values, 1):
        expr = expr.when(F.col(col) == v, i)
    return expr.otherwise(len(values) + 1)


def first_by(df: DataFrame, key, priority: tuple[str, list] | None, order: list[Column]) -> DataFrame:
    """First row per key by listed priority of a column, then by ``order``."""
    keys = [key] if isinstance(key, str) else list(key)
    head = [priority_of(*priority).asc()] if priority else []
    return top_one(df, keys, [*head, *order])


def number_rows(df: DataFrame, order: list[Column], out: str = "row_no") -> DataFrame:
    """1, 2, 3 … over the whole frame without sending it through one task.

    Rows are kept, so that the sample for the ranges reads the order columns only, then range-partitioned, sorted and
    kept with their places, and each partition adds the number of rows before it. Only one count per partition meets in one place.
    """
    with passing(df.sparkSession):
        rows = kept(df, "unnumbered")
        placed = kept(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({
            "__part": F.spark_partition_id(),
            "__pos": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
        }), "numbered", stays=True)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("__part").agg(F.count("*").alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    )
    # One row per partition of the sorted frame: bounded by the partition count.
    return (
        placed.join(F.broadcast(offsets), "__part")
        .withColumn(out, F.col("__off") + F.col("__pos") + 1)
        .drop("__part", "__pos", "__off")
    )


def surrogate(df: DataFrame, key: str, order: list[Column], suffix: str = "AUTOGEN", mode: str = "running") -> DataFrame:
    """Fill a missing ``key``: ``running`` uses the row's number over the whole result plus ``suffix``;
    ``hash`` a digest of the order columns (no sort, no second pass)."""
    if mode == "hash":
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in df.columns if c != key]
        made = F.concat(F.sha2(F.concat_ws("\u0001", *parts), 256), F.lit(suffix))
        return df.withColumn(key, F.coalesce(F.col(key), made))
    if mode != "running":
        raise ValueError(f"unknown mode {mode!r}")
    numbered = number_rows(df, order, "__no")
    made = F.concat(F.col("__no").cast("string"), F.lit(suffix))
    return numbered.withColumn(key, F.coalesce(F.col(key), made)).drop("__no")


def first_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of a named order."""
    return df.orderBy(*order).limit(n)
