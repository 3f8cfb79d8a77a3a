"""Row filters."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Name patterns that mark a "do not use" account.
DO_NOT_USE = (
    "{DNU%", "%{%DNU%}%", "%*%DNU%*%", "%(%DNU%)%", "%DNU-%", "%-DNU%", "%- DNU", "%DNU- %",
)


def exclude_like(df: DataFrame, col: str, patterns=DO_NOT_USE) -> DataFrame:
    """Drop rows matching any LIKE pattern; a null value is dropped too."""
    return df.filter(~reduce(or_, [F.col(col).like(p) for p in patterns]))


def is_any(df: DataFrame, col: str, values) -> DataFrame:
    """Membership in a list, as one predicate, or in a one-column frame, as a semi-join; columns keep their order."""
    if isinstance(values, DataFrame):
        keys = values.select(F.col(values.columns[0]).alias(col)).distinct()
        return df.join(keys, col, "left_semi").select(*df.columns)
    return df.filter(F.col(col).isin(list(values)))


def not_equal(df: DataFrame, col: str, value) -> DataFrame:
    """Rows whose value is known and differs."""
    return df.filter(F.col(col) != F.lit(value))


def optional_filter(df: DataFrame, col: str, value: str | None, within: bool = False, all_word: str = "ALL") -> DataFrame:
    """No filter when ``value`` is None or ALL; ``within`` keeps rows whose text occurs inside ``value``."""
    if value is None or value == all_word:
        return df
    return df.filter(F.instr(F.lit(value), F.col(col)) > 0 if within else F.col(col) == value)


def contains(df: DataFrame, col: str, text: str) -> DataFrame:
    return df.filter(F.col(col).contains(text))


def within_lookback(df: DataFrame, val: str, term: str, days: int = 365) -> DataFrame:
    """Value date at most ``days`` before the term date and not after it, or either date missing."""
    v, t = F.col(val), F.col(term)
    return df.filter(((v >= F.date_sub(t, days)) & (v <= t)) | t.isNull() | v.isNull())


def in_year(df: DataFrame, col: str, year: int) -> DataFrame:
    """A year as a half-open range, so the scan can skip row groups."""
    return df.filter((F.col(col) >= F.lit(f"{year}-01-01").cast("date")) & (F.col(col) < F.lit(f"{year + 1}-01-01").cast("date")))


def same_text(a: Column, b) -> Column:
    """Equality without regard to case and outer blanks."""
    return F.upper(F.trim(a)) == F.upper(F.trim(b if isinstance(b, Column) else F.lit(b)))


def min_duration(df: DataFrame, col: str, floor: float = 600) -> DataFrame:
    return df.filter(F.col(col) > floor)


def zero_audit(df: DataFrame, cols: list[str], tier: str = "touch", low: str = "LOW") -> DataFrame:
    """Rows where every amount is exactly zero and yet the tier is ``low``."""
    return df.filter(reduce(and_, [F.col(c) == 0 for c in cols]) & (F.col(tier) == low))


def keep_listed(df: DataFrame, approved: DataFrame, key: str) -> DataFrame:
    return df.join(approved.select(key).distinct(), key, "left_semi")
