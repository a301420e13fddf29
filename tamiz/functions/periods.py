"""Accounting periods (``YYYYMM``), date keys (``YYYYMMDD``) and reference dates.

``as_of`` is always an explicit date. Everything derived from it is computed once on the
driver and enters the plan as a literal, so period and key filters prune at the scan.
"""

from __future__ import annotations

import calendar
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(a: Column, b: Column | int) -> Column:
    """Integer division (SQL ``div``); ``/`` would be fractional."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


# ---- driver-side arithmetic on the reference date ------------------------------------

def period_of(day: date) -> int:
    return day.year * 100 + day.month


def date_key(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def months_back(as_of: date, months: int) -> date:
    """Same day ``months`` earlier, clamped to the end of a shorter month."""
    index = as_of.year * 12 + as_of.month - 1 - months
    year, month = divmod(index, 12)
    month += 1
    return date(year, month, min(as_of.day, calendar.monthrange(year, month)[1]))


def days_back(as_of: date, days: int) -> date:
    return as_of - timedelta(days=days)


def period_floor(as_of: date, months: int) -> int:
    return period_of(months_back(as_of, months))


def elapsed_days(as_of: date, cap: int | None = None) -> int:
    """Complete days of the month before ``as_of``, at most ``cap``."""
    days = max(as_of.day - 1, 0)
    return days if cap is None else min(cap, days)


# ---- columns ------------------------------------------------------------------------

def required_days(day: Column | str, cap: int = 15) -> Column:
    """``elapsed_days`` as a column, for a date column of reference dates."""
    return F.least(F.lit(cap), F.greatest(F.dayofmonth(_col(day)) - 1, F.lit(0)))


def period_date(period: Column | str) -> Column:
    """First day of a period; NULL when it is not a real ``YYYYMM``."""
    p = _col(period)
    ok = p.between(100001, 999912) & (p % 100).between(1, 12)
    return F.when(ok, F.make_date(int_div(p, 100).cast("int"), (p % 100).cast("int"), F.lit(1)))


def date_of_key(key: Column | str) -> Column:
    """Calendar date of a ``YYYYMMDD`` key; NULL for malformed or impossible keys."""
    k = _col(key)
    return F.when(valid_date_key(k), F.try_to_date(k.cast("string"), "yyyyMMdd"))


def period_of_key(key: Column | str) -> Column:
    return int_div(_col(key), 100).cast("int")


def period_of_ts(ts: Column | str) -> Column:
    t = _col(ts)
    return (F.year(t) * 100 + F.month(t)).cast("int")


def valid_date_key(key: Column | str) -> Column:
    """Exactly eight digits. As a range test on the integer it reaches the scan."""
    return _col(key).between(10_000_000, 99_999_999)


def same_month(key: Column | str, period: Column | str) -> Column:
    return int_div(_col(key), 100) == _col(period)


def days_in_period(period: Column | str) -> Column:
    return F.dayofmonth(F.last_day(period_date(period)))


def period_label(period: Column | str, as_of: date) -> Column:
    p = _col(period)
    return F.concat(p.cast("string"), F.when(p == period_of(as_of), F.lit(" (en curso)")).otherwise(F.lit("")))
