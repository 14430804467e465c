"""Reference-month arithmetic and date expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


def month_start(ref_month: str, shift: int = 0) -> date:
    """First day of a ``yyyyMM`` month, moved by `shift` months."""
    index = int(ref_month[:4]) * 12 + int(ref_month[4:6]) - 1 + shift
    return date(index // 12, index % 12 + 1, 1)


def shifted(ref_month: str, months: int) -> str:
    """The ``yyyyMM`` month that is `months` months later."""
    return month_start(ref_month, months).strftime("%Y%m")


def month_list(first: str, count: int) -> list[str]:
    """`count` consecutive ``yyyyMM`` months from `first` on."""
    return [shifted(first, months) for months in range(count)]


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyyMM")


def parse_day(text: Column) -> Column:
    """``yyyyMMdd`` text to a date."""
    return F.to_date(text, "yyyyMMdd")


def elapsed_months(day: Column, ref_month: str) -> Column:
    """Whole months from `day` to the first day of the reference month.

    Truncated toward zero, so a day later in the reference month gives 0. Works for dates
    and for timestamps with a time of day.
    """
    end = month_start(ref_month)
    difference = (F.lit(end.year) - F.year(day)) * 12 + F.lit(end.month) - F.month(day)
    started = (day <= F.lit(end)) & (day > F.trunc(day, "month"))
    return (difference - F.when(started, 1).otherwise(0)).cast("int")


def whole_periods(first: Column, last: Column, days: int = 30) -> Column:
    return F.floor(F.datediff(last, first) / F.lit(days)).cast("int")


def epoch_seconds(day: Column) -> Column:
    """Seconds from 1970-01-01 to the start of a date, whatever the session's time zone."""
    return F.unix_date(day).cast("bigint") * DAY_SECONDS


def from_epoch_seconds(seconds: Column) -> Column:
    return F.date_from_unix_date(F.floor(seconds / DAY_SECONDS).cast("int"))
