"""Date, time and calendar expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hour bands of a day, [start, end) with wrap-around, first hit wins.
DAY_BANDS = (
    (6, 10, "Morning"),
    (10, 17, "Daytime"),
    (17, 23, "Primetime"),
    (23, 2, "Latenight"),
)
DAY_REST = "Overnight"


def parse_dates(df: DataFrame, cols: list[str], fmt: str = "MM/dd/yyyy", strict: bool = False) -> DataFrame:
    """Text to date; unparsable text raises when ``strict`` and turns null otherwise."""
    parse = F.to_date if strict else F.try_to_date
    return df.withColumns({c: parse(F.col(c), fmt) for c in cols})


def format_dates(df: DataFrame, cols: list[str], fmt: str = "MM/dd/yyyy") -> DataFrame:
    return df.withColumns({c: F.date_format(F.col(c), fmt) for c in cols})


def quarter_of(d: Column) -> Column:
    """``1Q2020`` style label."""
    return F.concat(F.quarter(d).cast("string"), F.lit("Q"), F.year(d).cast("string"))


def quarter_label(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, quarter_of(F.col(col)))


def capped_days(start: Column, end: Column, cap: int = 365) -> Column:
    """Days from start to end, at most ``cap``; null when either date is (``least`` alone would skip it)."""
    days = F.datediff(end, start)
    return F.when(days.isNotNull(), F.least(days, F.lit(cap)))


def term_days(df: DataFrame, start: str, end: str, cap: int = 365, out: str = "policy_term") -> DataFrame:
    return df.withColumn(out, capped_days(F.col(start), F.col(end), cap))


def yearly(x: Column, days: Column) -> Column:
    """Scale an amount for ``days`` to a 365-day year; null for a zero-day term."""
    return x.cast("double") * F.try_divide(F.lit(365.0), days.cast("double"))


def annualise(df: DataFrame, cols: list[str], days: str, strict: bool = False) -> DataFrame:
    """``strict`` raises on a zero-day term instead of returning null."""
    if strict:
        rate = F.lit(365.0) / F.when(F.col(days) == 0, F.raise_error(F.lit("zero-day term")).cast("double")).otherwise(
            F.col(days).cast("double")
        )
        return df.withColumns({c: F.col(c).cast("double") * rate for c in cols})
    return df.withColumns({c: yearly(F.col(c), F.col(days)) for c in cols})


def add_months_eom(d: Column, n: int) -> Column:
    """Calendar months, where the last day of a month stays the last day."""
    moved = F.add_months(d, n)
    return F.when(F.to_date(d) == F.last_day(d), F.last_day(moved)).otherwise(moved)


# Whole days a midnight date moves by N average months of 365.2425/12 days.
MEAN_MONTH_DAYS = 365.2425 / 12


def shift_months(df: DataFrame, col: str, n: int, mode: str = "calendar", out: str | None = None) -> DataFrame:
    """``calendar`` keeps month ends; ``fixed`` moves a date by N average months, cut to whole days."""
    if mode == "calendar":
        moved = add_months_eom(F.col(col), n)
    elif mode == "fixed":
        whole = int(n * MEAN_MONTH_DAYS // 1)
        moved = F.date_add(F.to_date(F.col(col)), whole)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return df.withColumn(out or col, moved)


def day_gap(df: DataFrame, a: str, b: str, out: str = "day_diff") -> DataFrame:
    """Whole days from ``b`` to ``a``."""
    return df.withColumn(out, F.datediff(F.col(a), F.col(b)))


def weekday(df: DataFrame, ts: str, out: str = "weekday") -> DataFrame:
    """Mon … Sun."""
    return df.withColumn(out, F.date_format(F.col(ts), "E"))


def band_of(hour: Column, bands=DAY_BANDS, rest: str = DAY_REST) -> Column:
    expr = None
    for lo, hi, name in bands:
        inside = (hour >= lo) & (hour < hi) if lo < hi else (hour >= lo) | (hour < hi)
        expr = F.when(inside, name) if expr is None else expr.when(inside, name)
    return F.when(hour.isNotNull(), expr.otherwise(rest))


def day_part(df: DataFrame, ts: str, bands=DAY_BANDS, rest: str = DAY_REST, out: str = "day_part") -> DataFrame:
    return df.withColumn(out, band_of(F.hour(F.col(ts)), bands, rest))


def phase_of(days: Column, early: int = 90, late: int = 275) -> Column:
    return F.when(days <= early, "Startperiod").when(days >= late, "Endperiod")


def term_phase(df: DataFrame, days: str, early: int = 90, late: int = 275, out: str = "term_phase") -> DataFrame:
    return df.withColumn(out, phase_of(F.col(days), early, late))


def prime_flag(df: DataFrame, ts: str, first: int = 18, last: int = 23, out: str = "pt_npt", as_int: bool = False) -> DataFrame:
    """Prime when the hour is in [first, last)."""
    hour = F.hour(F.col(ts))
    inside = (hour >= first) & (hour < last)
    if as_int:
        return df.withColumn(out, F.when(inside, 1).otherwise(0))
    return df.withColumn(out, F.when(inside, "Prime").otherwise("Non Prime"))


def slot_start(ts: Column, minutes: int = 30) -> Column:
    """Start of the slot holding ``ts``; slots begin at midnight and must divide a day."""
    if (24 * 60) % minutes:
        raise ValueError("slot length must divide a day")
    of_day = F.floor((F.hour(ts) * 60 + F.minute(ts)) / minutes) * minutes
    return F.date_trunc("DAY", ts).cast("timestamp_ntz") + F.make_dt_interval(mins=of_day.cast("int"))


def band_label(ts: Column, minutes: int = 30) -> Column:
    """``18:30-19:00`` style label of the slot holding ``ts``."""
    of_day = (F.floor((F.hour(ts) * 60 + F.minute(ts)) / minutes) * minutes).cast("int")
    end = (of_day + minutes) % (24 * 60)

    def clock(m: Column) -> Column:
        return F.concat_ws(
            ":", F.lpad(F.floor(m / 60).cast("string"), 2, "0"), F.lpad((m % 60).cast("string"), 2, "0")
        )

    return F.concat_ws("-", clock(of_day), clock(end))


def slot_of(df: DataFrame, ts: str, minutes: int = 30, out: str = "slot_start", label: str = "timeband") -> DataFrame:
    return df.withColumns({out: slot_start(F.col(ts), minutes), label: band_label(F.col(ts), minutes)})


def to_local(df: DataFrame, epoch: str, unit: str = "milliseconds", tz: str = "Asia/Kolkata",
             utc_out: str = "ts_utc", local_out: str = "ts_local") -> DataFrame:
    """Epoch number to a UTC wall clock and to the wall clock of ``tz`` (both without zone)."""
    make = {"seconds": F.timestamp_seconds, "milliseconds": F.timestamp_millis, "microseconds": F.timestamp_micros}[unit]
    instant = make(F.col(epoch))
    return df.withColumns({
        utc_out: F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz")),
        local_out: F.convert_timezone(F.current_timezone(), F.lit(tz), instant.cast("timestamp_ntz")),
    })


def month_of_text(df: DataFrame, col: str, month_out: str = "month", date_out: str = "date") -> DataFrame:
    """``2018/03/17`` to month ``03`` and date ``2018-03-17``."""
    return df.withColumns({
        month_out: F.substring(F.col(col), 6, 2),
        date_out: F.regexp_replace(F.col(col), "/", "-"),
    })


def hour_no(ts: Column) -> Column:
    """Whole hours since 1970-01-01 on the wall clock; never decreases as ``ts`` grows."""
    return F.datediff(ts, F.lit("1970-01-01").cast("date")).cast("long") * 24 + F.hour(ts)


def micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 on the wall clock."""
    return F.unix_micros(ts.cast("timestamp"))
