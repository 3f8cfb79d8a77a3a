"""Equality joins, lookups and merges.

Sides are never broadcast by hand here: adaptive execution measures them at run
time and broadcasts only below ``spark.sql.autoBroadcastJoinThreshold``; larger
sides are sort-merge joined and oversized partitions split by the skew rule.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranking import top_one


def null_safe(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(and_, [a[k].eqNullSafe(b[k]) for k in keys])


def missing_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``a`` without a partner in ``b`` (a null key has no partner)."""
    return a.join(b.select(*keys).distinct(), keys, "left_anti")


def existing_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``a`` with at least one partner in ``b``."""
    return a.join(b.select(*keys), keys, "left_semi")


def join_on_text(a: DataFrame, b: DataFrame, a_parts: list[str], b_parts: list[str], how: str = "inner",
                 by_parts: bool = True) -> DataFrame:
    """Join on several columns read as one key. ``by_parts`` compares them one by one, so that
    ('1', '23') and ('12', '3') differ; otherwise their concatenation is compared."""
    if by_parts:
        cond = reduce(and_, [F.col(f"a.{x}") == F.col(f"b.{y}") for x, y in zip(a_parts, b_parts, strict=True)])
    else:
        cond = F.concat(*[F.col(f"a.{x}").cast("string") for x in a_parts]) == F.concat(
            *[F.col(f"b.{y}").cast("string") for y in b_parts]
        )
    return a.alias("a").join(b.alias("b"), cond, how)


def merge_outer(a: DataFrame, b: DataFrame, keys: list[str], suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Full outer join where null keys match null keys; other shared columns get suffixes.

    Planned as (a left join b) plus the rows of b whose key a lacks: unlike a full
    outer join, both halves can be split by the skew rule when one key is hot.
    """
    shared = [c for c in a.columns if c in b.columns and c not in keys]
    left = a.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    right = b.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    extra = [c for c in right.columns if c not in keys]
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = reduce(and_, [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys])
    matched = left.join(renamed, on, "left").select(*left.columns, *extra)
    known = left.select(*keys).distinct()
    only_right = right.join(known, null_safe(right, known, keys), "left_anti").select(*keys, *extra)
    return matched.unionByName(only_right, allowMissingColumns=True)


def coalesce_pairs(df: DataFrame, pairs: dict[str, list[str]], drop: bool = True) -> DataFrame:
    """For each output the first non-null of its source columns, in order."""
    out = df.withColumns({o: F.coalesce(*[F.col(c) for c in cols]) for o, cols in pairs.items()})
    used = {c for cols in pairs.values() for c in cols} - set(pairs)
    return out.drop(*used) if drop else out


def choose_key(df: DataFrame, master: DataFrame, master_col: str, first: str, second: str, out: str) -> DataFrame:
    """``first`` where the master knows it, else ``second``."""
    known = master.select(F.col(master_col).alias(first)).where(F.col(master_col).isNotNull()).distinct()
    known = known.withColumn("__known", F.lit(True))
    return (
        df.join(known, first, "left")
        .withColumn(out, F.when(F.col("__known"), F.col(first)).otherwise(F.col(second)))
        .select(*df.columns, out)
    )


def map_values(df: DataFrame, col: str, dim: DataFrame) -> DataFrame:
    """Left join to a (col, value) lookup; unmatched values stay null."""
    return df.join(dim, col, "left")


def first_lookup(left: DataFrame, right: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """At most one row of ``right`` per key (the first in ``order``), nulls if there is none."""
    return left.join(top_one(right, [key], order), key, "left")


def fallback_lookup(requests: DataFrame, tiers: list[DataFrame], key: str, id_col: str) -> DataFrame:
    """Newest row of the first tier that has any for the key.

    Every tier has the columns ``key`` and ``id_col`` plus the payload; tiers are
    ranked in the order given and the newest (greatest ``id_col``) row is taken.
    """
    ranked = reduce(
        lambda x, y: x.unionByName(y),
        [t.withColumn("__tier", F.lit(i)) for i, t in enumerate(tiers)],
    )
    best = top_one(ranked, [key], [F.col("__tier").asc(), F.col(id_col).desc_nulls_last()])
    return requests.join(best.drop("__tier"), key, "left")


def spread_max(df: DataFrame, keys: list[str], col: str, out: str) -> DataFrame:
    """Every row gets the greatest ``col`` of its key group; a row with a null key gets null.

    Aggregate-and-join rather than a window: the aggregate is combined before its
    shuffle and the join can be split, so no task holds a whole hot group.
    """
    tops = df.groupBy(*keys).agg(F.max(col).alias(out))
    return df.join(tops, keys, "left")
