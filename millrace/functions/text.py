"""Text expressions: identifiers, names, numbers and dates found in free text.

Everything is a column expression except the Unicode fold, which needs NFKD and
therefore one Arrow-batched UDF; ASCII-only values reach it as nulls.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def join_text(df: DataFrame, out: str, *cols: str) -> DataFrame:
    """Concatenate with null read as empty text."""
    return df.withColumn(out, F.concat_ws("", *[F.col(c).cast("string") for c in cols]))


def split_id(c: Column) -> Column:
    """Characters 1-4, a blank, characters 6-11."""
    return F.concat(F.substring(c, 1, 4), F.lit(" "), F.substring(c, 6, 6))


def reformat_id(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, split_id(F.col(col)))


def market_of(c: Column) -> Column:
    head = F.regexp_replace(F.split(c, "-").getItem(0), r"\s", "")
    bare = F.regexp_replace(head, r"\(Rural\)|\(Urban\)|Rural|Urban", "")
    return F.trim(F.regexp_replace(bare, "/", "-"))


def market_from_region(df: DataFrame, col: str, out: str = "market") -> DataFrame:
    """Text before the first dash, without blanks or rural/urban tags, ``/`` as ``-``."""
    return df.withColumn(out, market_of(F.col(col)))


# Tags dropped from channel names.
NAME_TAGS = ("tbr", "nw", "na", "v")


def tidy_of(c: Column, tags=NAME_TAGS) -> Column:
    bare = F.regexp_replace(c, r"(?i)\((" + "|".join(tags) + r")\)", "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, "_", " "), " +", " "))


def tidy_names(df: DataFrame, col: str, tags=NAME_TAGS) -> DataFrame:
    return df.withColumn(col, tidy_of(F.col(col), tags))


def fold_text(s: str | None) -> str | None:
    if s is None or s.isascii():
        return s
    split = unicodedata.normalize("NFKD", s).replace("\u2013", "-").replace("\u2014", "-")
    return "".join(ch for ch in split if not unicodedata.combining(ch)).encode("ascii", "ignore").decode("ascii")


@F.pandas_udf(T.StringType())
def _nfkd(values: pd.Series) -> pd.Series:
    return values.map(fold_text, na_action="ignore")


@F.pandas_udf(T.StringType())
def _nfkd_rows(rows: pd.Series) -> pd.Series:
    """Rows as JSON arrays: a text column crosses several times faster than one of arrays, null or not."""
    return rows.map(lambda row: json.dumps([s if s is None else fold_text(s) for s in json.loads(row)]), na_action="ignore")


NON_ASCII = r"[^\x00-\x7F]"


def folded(c: Column) -> Column:
    """ASCII form: marks dropped, long dashes as ``-``, anything else non-ASCII dropped.

    ASCII-only values reach the UDF as null, so they cost no transfer.
    """
    return F.coalesce(_nfkd(F.when(c.rlike(NON_ASCII), c)), c)


def ascii_fold(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fold many text columns with one call per batch; rows without any non-ASCII text are not sent."""
    if not cols:
        return df
    cells = [F.col(f"`{c}`") for c in cols]
    sent = F.when(F.concat_ws("", *cells).rlike(NON_ASCII), F.to_json(F.array(*cells)))
    packed = df.withColumn("__fold", F.from_json(_nfkd_rows(sent), "array<string>"))
    done = F.col("__fold").isNotNull()
    return packed.withColumns({
        c: F.when(done, F.get("__fold", F.lit(i))).otherwise(cell) for i, (c, cell) in enumerate(zip(cols, cells))
    }).drop("__fold")


NUMBER = r"([-+]?\d*\.\d+|\d+)"


def number_in(c: Column, thousands: bool = False) -> Column:
    """First number in the text; a sign counts only in front of a decimal number."""
    text = F.regexp_replace(c, r"(\d),(\d)", "$1$2") if thousands else c
    return F.regexp_extract(text, NUMBER, 1).try_cast("double")


def first_number(df: DataFrame, cols: list[str], thousands: bool = False) -> DataFrame:
    return df.withColumns({c: number_in(F.col(c).cast("string"), thousands) for c in cols})


DATE_TEXT = r"(\d{1,4}[/.-]\d+[/.-]\d{1,4})"
DATE_FORMATS = (
    "yyyy-M-d", "M/d/yyyy", "yyyy/M/d", "M-d-yyyy", "M.d.yyyy", "yyyy.M.d", "M/d/yy", "M-d-yy", "M.d.yy",
    "d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "d/M/yy", "d-M-yy", "d.M.yy",
)


def _date_as(x: Column, form: str) -> Column:
    """A date in one format, tried only on text of its shape; two-digit years from 69 on lie in the last century."""
    year = "y" * form.count("y")
    digits = {"yyyy": r"\d{4}", "yy": r"\d{2}", "M": r"\d{1,2}", "d": r"\d{1,2}"}
    shape = "^" + "".join(digits.get(p, "[.]" if p == "." else p) for p in re.split(r"([/.-])", form)) + "$"
    day = F.try_to_date(x, form)
    if year == "yy":
        day = F.when(F.year(day) > 2068, F.add_months(day, -1200)).otherwise(day)
    return F.when(x.rlike(shape), day)


def date_in(c: Column, formats=DATE_FORMATS) -> Column:
    """First date-like run in the text, read with the first format that fits (month first, then day first); else null."""
    return once(F.regexp_extract(c, DATE_TEXT, 1), lambda x: F.coalesce(*[_date_as(x, f) for f in formats]))


def first_date(df: DataFrame, cols: list[str], formats=DATE_FORMATS) -> DataFrame:
    return df.withColumns({c: date_in(F.col(c).cast("string"), formats) for c in cols})


# Ordered (pattern, replacement) steps of the account-name cleaner.
ACCOUNT_STEPS = (
    (r"FW: ", ""),
    (r"RE: ", ""),
    (r" +", " "),
    (r"^\s", ""),
    (r"^NATIONAL", ""),
    (r" +", " "),
    (r"^\s", ""),
    (r"^ACCOUNTS", ""),
    (r"^ACCOUNT", ""),
    (r"SUBMISSION", ""),
    (r"ONLY", ""),
    (r"LOSS", ""),
    (r"RUN[^\n]*", ""),
    (r"/[^\n]*", ""),
    (r"\d+/\d+/\d+", ""),
    (r"\d+-\d+-\d+", ""),
    (r"\d\d\d\d", ""),
    (r"\bEFF\b", ""),
    (r"C[0-9]+", ""),
    (r"^\W+", ""),
    (r"\W+\z", ""),
    (r" +", " "),
    (r"^ ", ""),
    (r" \z", ""),
)

# Legal-form words dropped from match keys, in order.
LEGAL_WORDS = (
    "INC", "LLC", "LLP", "CTR", "CNTR", "LTD", "JS", "LP", "SC", "CO", "CORP", "CORPORATION", "COMPANY",
    "CNTR'S", "CNTRS", "HOLDINGS", "GROUP", "GROUPS", "SERVICE", "SERVICES", "L", "C", "INCORPORATED", "WC", "LL",
)

# Text that stands for a missing value: dropped inside words by the legacy rule, as a whole value otherwise.
MISSING_WORDS = ("NONE", "NAN")


def _steps(c: Column, steps) -> Column:
    return reduce(lambda acc, step: F.regexp_replace(acc, step[0], step[1]), steps, c)


def once(expr: Column, use) -> Column:
    """``use(x)`` with ``x`` bound to ``expr``: a long chain is written into the plan and evaluated once."""
    return F.get(F.transform(F.array(expr), use), F.lit(0))


def _drop_missing(c: Column, legacy: bool) -> Column:
    words = "|".join(MISSING_WORDS)
    c = F.regexp_replace(c, f"(?i)({words})" if legacy else rf"(?i)^({words})\z", "")
    # First non-empty element of a one-element array: null for empty text, with ``c`` used once.
    return F.get(F.filter(F.array(c), lambda x: F.length(x) > 0), F.lit(0))


def account_name_of(c: Column, legacy: bool = False) -> Column:
    return _drop_missing(_steps(F.upper(folded(F.upper(c))), ACCOUNT_STEPS), legacy)


def clean_account(df: DataFrame, col: str, legacy: bool = False, out: str | None = None) -> DataFrame:
    """Account name without mail prefixes, report words, dates and edge punctuation; null if nothing is left."""
    return df.withColumn(out or col, account_name_of(F.col(col), legacy))


def strip_legal_words(c: Column) -> Column:
    """Match-key steps that follow the account cleaner: last ' - …' tail, brackets, punctuation, legal words."""
    # The greedy head keeps everything before the last " - " of the last line.
    head = F.regexp_replace(c, r"^([\s\S]*) - [^\n]*\z", "$1")
    plain = _steps(head, [(r"\([^()]*\)", ""), (r"[^\w\s]", ""), (r" +", " ")])
    # One alternation, longest first, equals the word-by-word chain: a removal leaves blanks, never joins words.
    words = "|".join(sorted(LEGAL_WORDS, key=lambda w: (-len(w), w)))
    return _steps(plain, [(rf"\b({words})\b", ""), (r" +", " "), (r"^ ", ""), (r" \z", "")])


def match_key_of(c: Column, legacy: bool = False) -> Column:
    return _drop_missing(strip_legal_words(account_name_of(c, legacy)), legacy)


def match_key(df: DataFrame, col: str, legacy: bool = False, out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, match_key_of(F.col(col), legacy))


def token_key_of(c: Column, legacy: bool = False) -> Column:
    text = F.upper(folded(F.upper(c)))
    key = F.array_join(F.sort_array(F.split(text, r"\W+")), " ")
    # Outer punctuation leaves empty words in front; the legacy rule removes only one of the blanks they add.
    key = _steps(key, [(r"^ ", ""), (r" \z", "")]) if legacy else F.trim(key)
    return _drop_missing(key, legacy)


def token_key(df: DataFrame, col: str, legacy: bool = False, out: str | None = None) -> DataFrame:
    """Words of the folded upper-case text, sorted and joined by one blank."""
    return df.withColumn(out or col, token_key_of(F.col(col), legacy))


def scrubbed(c: Column, drop_commas: bool = False) -> Column:
    text = F.regexp_replace(c, "\n", " ")
    return F.rtrim(F.regexp_replace(text, ",", " ") if drop_commas else text)


def scrub(df: DataFrame, cols: list[str], drop_commas: bool = False) -> DataFrame:
    """Line feeds (and commas) as blanks, blanks at the end removed."""
    return df.withColumns({c: scrubbed(F.col(c), drop_commas) for c in cols})


def person_name(df: DataFrame, last: str, first: str, out: str) -> DataFrame:
    """``last,first``; null only when both are."""
    both = F.col(last).isNull() & F.col(first).isNull()
    text = F.concat(F.coalesce(F.col(last), F.lit("")), F.lit(","), F.coalesce(F.col(first), F.lit("")))
    return df.withColumn(out, F.when(~both, text))


def phone_of(area: Column, exchange: Column, number: Column, extension: Column) -> Column:
    blank = F.lit("")
    return F.concat(
        F.coalesce(area, blank), F.lit(" "), F.coalesce(exchange, blank), F.lit(" "), F.coalesce(number, blank),
        F.lit(" "), F.when(extension.isNotNull(), F.concat(F.lit("x"), extension)).otherwise(blank),
    )


def phone_text(df: DataFrame, parts: list[str], out: str) -> DataFrame:
    """``area exchange number xExtension`` from four text columns."""
    return df.withColumn(out, phone_of(*[F.col(p) for p in parts]))


def split_part(df: DataFrame, col: str, sep: str, i: int, out: str, as_int: bool = False) -> DataFrame:
    """The ``i``-th (from 0) piece of ``col``; ``as_int`` cuts a decimal number to its whole part."""
    piece = F.get(F.split(F.col(col), "\\Q" + sep + "\\E"), F.lit(i))
    return df.withColumn(out, piece.try_cast("double").try_cast("int") if as_int else piece)


def display_number(df: DataFrame, col: str, n: int, out: str | None = None) -> DataFrame:
    """Grouped thousands with ``n`` decimals."""
    return df.withColumn(out or col, F.format_number(F.col(col), n))


def recode(df: DataFrame, col: str, mapping: dict[str, str], out: str | None = None) -> DataFrame:
    """Replace listed values, keep the rest."""
    expr = reduce(lambda acc, kv: acc.when(F.col(col) == kv[0], kv[1]), mapping.items(), F)
    return df.withColumn(out or col, expr.otherwise(F.col(col)))


def flatten_array(df: DataFrame, col: str, dim: DataFrame | None = None, sep: str = ",",
                  text_out: str | None = None, code_out: str | None = None) -> DataFrame:
    """Array to joined text and, with a (text, code) dimension, the code of its first element."""
    text_out, code_out = text_out or f"{col}_text", code_out or f"{col}_code"
    flat = df.withColumns({text_out: F.array_join(F.col(col), sep), "__first": F.try_element_at(F.col(col), F.lit(1))})
    if dim is None:
        return flat.drop("__first")
    key, code = dim.columns[:2]
    lookup = dim.select(F.col(key).alias("__first"), F.col(code).alias(code_out))
    return flat.join(lookup, "__first", "left").drop("__first")


def as_plain(number: Column) -> Column:
    """A number as text, whole numbers without a decimal point."""
    return F.when(number == F.floor(number), number.cast("decimal(38,0)").cast("string")).otherwise(number.cast("string"))
