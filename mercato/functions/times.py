"""Calendar expressions on zone-free timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def day(ts: Column) -> Column:
    return ts.cast("date")


def day_start(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz")


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month").cast("timestamp_ntz")


def months_between_starts(later: Column, earlier: Column) -> Column:
    """Whole months between two month starts; negative when ``later`` comes first."""
    years = F.year(later) - F.year(earlier)
    return (years * 12 + F.month(later) - F.month(earlier)).cast("int")


def iso_weekday(ts: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(ts) + 1).cast("int")


def is_weekend(ts: Column) -> Column:
    return iso_weekday(ts).isin(6, 7)


def weekday_name(ts: Column, padded: bool = False) -> Column:
    """English weekday name; ``padded`` blank-fills it to nine characters."""
    name = F.date_format(ts, "EEEE")
    return F.rpad(name, 9, " ") if padded else name


def month_name(ts: Column, padded: bool = False) -> Column:
    name = F.date_format(ts, "MMMM")
    return F.rpad(name, 9, " ") if padded else name


def date_id(ts: Column) -> Column:
    """The calendar day as the number yyyymmdd."""
    return (F.year(ts) * 10_000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def micros(ts: Column) -> Column:
    """Microseconds since 1970, an orderable whole number (session zone UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def ntz(moment: dt.datetime | str) -> Column:
    return F.lit(str(moment)).cast("timestamp_ntz")


def in_month(ts: Column, year: int, month: int) -> Column:
    """One calendar month as a half-open range; on a stored column it reaches the file scan."""
    start = dt.datetime(year, month, 1)
    end = dt.datetime(year + month // 12, month % 12 + 1, 1)
    return (ts >= ntz(start)) & (ts < ntz(end))
