"""Aggregations. Each is one grouped pass that combines rows before its shuffle."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import kept

def masked_sum(col: str, flag: str) -> Column:
    """Sum of the amounts whose 0/1 flag is 1."""
    return F.sum(F.col(col) * F.col(flag))


def pivot_counts(df: DataFrame, keys: list[str], specs: dict[str, dict[str, str]], total: tuple[str, str] | None = None) -> DataFrame:
    """Counts of listed values as columns, all columns in one pass; a value that never occurs is null.

    ``specs`` maps a source column to {value: output name}; ``total`` is (column, output)
    for the count of its non-null values.
    """
    aggs = [F.count(total[0]).alias(total[1])] if total else []
    for col, values in specs.items():
        aggs += [F.nullif(F.count(F.when(F.col(col) == v, 1)), F.lit(0)).alias(name) for v, name in values.items()]
    return df.groupBy(*keys).agg(*aggs)


def sum_across(cols: list[str], null_as_zero: bool = False) -> Column:
    """Row-wise sum; null if any part is, unless ``null_as_zero``."""
    parts = [F.coalesce(F.col(c), F.lit(0)) if null_as_zero else F.col(c) for c in cols]
    return reduce(add, parts)


def count_distinct(df: DataFrame, cols: list[str], out: str = "n", approximate: bool = False) -> DataFrame:
    """Distinct combinations with no null part."""
    key = F.when(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]), F.struct(*cols))
    return df.agg((F.approx_count_distinct(key) if approximate else F.count_distinct(key)).alias(out))


def check_grain(df: DataFrame, keys: list[str]) -> DataFrame:
    """Row count beside the number of distinct keys (null counts as a value)."""
    return df.groupBy(*keys).agg(F.count("*").alias("__n")).agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys")
    ).withColumn("unique", F.when(F.col("n_rows") == F.col("n_keys"), 1).otherwise(0))


def find_duplicates(df: DataFrame, keys: list[str], out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(out)).filter(F.col(out) > 1)


def _picked(number: Column, wanted) -> Column:
    """``wanted`` is one element number, a (low, high) pair or a list."""
    if isinstance(wanted, tuple):
        return number.between(*wanted)
    if isinstance(wanted, (list, set, frozenset)):
        return number.isin(*sorted(wanted))
    return number == wanted


def eav_sums(number: Column, value: Column, wanted: dict[str, object], zero_fill: tuple[str, ...] = ()) -> list[Column]:
    """One sum per measure over the rows of its elements; a measure without rows is null.

    Measures in ``zero_fill`` read a null value as 0 (their sum is null only without rows).
    """
    return [
        F.sum(F.when(_picked(number, w), F.coalesce(value, F.lit(0)) if name in zero_fill else value)).alias(name)
        for name, w in wanted.items()
    ]


def eav_scalars(number: Column, value: Column, text: Column, wanted: dict[str, int]) -> list[Column]:
    """The text of an element, else its number as text; null unless the entity has exactly one such row."""
    picked = F.coalesce(text, value)
    return [
        F.when(F.count(F.when(number == w, 1)) == 1, F.max(F.when(number == w, picked))).alias(name)
        for name, w in wanted.items()
    ]


def eav_pivot(vals: DataFrame, elems: DataFrame, entity: str, element: str, number: str, value: str,
              wanted: dict[str, object], zero_fill: tuple[str, ...] = ()) -> DataFrame:
    """Long (entity, element, value) rows to one wide row per entity.

    The elements are kept first (which runs a job): of known size, a short list is broadcast from the start, so values are not brought together by
    element, of which there are few, and are combined per entity before they move.
    """
    return vals.join(kept(elems), element).groupBy(entity).agg(*eav_sums(F.col(number), F.col(value), wanted, zero_fill))


def eav_scalar(vals: DataFrame, elems: DataFrame, entity: str, element: str, number: str, value_text: Column, text: str,
               wanted: dict[str, int]) -> DataFrame:
    return vals.join(kept(elems), element).groupBy(entity).agg(
        *eav_scalars(F.col(number), value_text, F.col(text), wanted)
    )


def share_of(df: DataFrame, keys: list[str], cond: Column, v: str, names: tuple[str, str, str], digits: int = 2) -> DataFrame:
    """Conditional sum, total and percentage; a zero sum is reported as null."""
    part, whole, pct = names
    value = F.coalesce(F.col(v), F.lit(0))
    sums = df.groupBy(*keys).agg(
        F.sum(F.when(cond, value).otherwise(0)).alias(part), F.sum(value).alias(whole)
    )
    return share_columns(sums, names, digits)


def share_columns(df: DataFrame, names: tuple[str, str, str], digits: int = 2) -> DataFrame:
    """Percentage of the first in the second sum; zero sums become null afterwards."""
    part, whole, pct = names
    ratio = F.try_divide(F.coalesce(F.col(part).cast("double"), F.lit(0.0)) * 100, F.col(whole).cast("double"))
    out = df.withColumn(pct, F.round(ratio, digits))
    return out.withColumns({n: F.when(F.col(n) != 0, F.col(n)) for n in (part, whole)})


def list_values(df: DataFrame, key: str, col: str, out: str, sep: str = ",") -> DataFrame:
    """Distinct values of the key in order, joined; null if there is none.

    Sets are built before the shuffle, so only distinct values of a key travel and meet.
    """
    return df.groupBy(key).agg(F.array_sort(F.collect_set(col)).alias("__all")).select(
        key, F.when(F.size("__all") > 0, F.array_join("__all", sep)).alias(out)
    )


def pivot_first(df: DataFrame, key: str, role: str, value: str, roles: dict[str, str]) -> DataFrame:
    """Smallest value per role, one column per role."""
    return df.groupBy(key).agg(*[F.min(F.when(F.col(role) == r, F.col(value))).alias(name) for r, name in roles.items()])


def rollup_labels(df: DataFrame, keys: list[str], label: str, rules: dict[str, Column], sums: list[str], keep_own: bool = True) -> DataFrame:
    """Totals per label where a row may belong to several labels.

    Rows are summed to their own labels first; only that summary is copied into
    the wider labels and summed again.
    """
    inner = [c for c in df.columns if c not in sums]
    base = df.groupBy(*inner).agg(*[F.sum(s).alias(s) for s in sums])
    labels = [F.when(cond, F.lit(name)) for name, cond in rules.items()]
    if keep_own:
        labels.append(F.col(label))
    member = F.array_compact(F.array(*labels))
    group = [k for k in keys if k != label]
    return (
        base.withColumn("__label", F.explode(member))
        .groupBy(*group, F.col("__label").alias(label)).agg(*[F.sum(s).alias(s) for s in sums])
    )


def signal_counts(df: DataFrame, day: str, device: str, out: str = "signal_count") -> DataFrame:
    return df.groupBy(day, device).agg(F.count("*").alias(out))


def daily_actives(raw: DataFrame, day: Column, keys: list[str], ts: str, ties: list[str], attrs: list[str]) -> DataFrame:
    """One row per device and day: number of signals and the attributes of its last signal."""
    last = F.max_by(F.struct(*attrs), F.struct(ts, *ties)).alias("__last")
    return (
        raw.groupBy(day.alias("date"), *keys).agg(F.count("*").alias("number_of_signals"), last)
        .select("date", *keys, "number_of_signals", *[F.col(f"__last.{a}").alias(a) for a in attrs])
    )


def weighted_means(df: DataFrame, keys: list[str], products: dict[str, tuple[str, str]], means: dict[str, tuple[str, str]]) -> DataFrame:
    """Additive products for later roll-ups: Σ(x·w) per product, and Σ(x·w) / Σw per mean."""
    pairs = {**products, **means}
    terms = {f"__{n}": F.col(x) * F.col(w) for n, (x, w) in pairs.items()}
    wide = df.withColumns(terms)
    aggs = [F.sum(f"__{n}").alias(n) for n in products]
    for n, (_, w) in means.items():
        aggs += [F.sum(f"__{n}").alias(f"__num_{n}"), F.sum(F.when(F.col(f"__{n}").isNotNull(), F.col(w))).alias(f"__den_{n}")]
    out = wide.groupBy(*keys).agg(*aggs)
    return out.select(*keys, *products, *[F.try_divide(f"__num_{n}", f"__den_{n}").alias(n) for n in means])
