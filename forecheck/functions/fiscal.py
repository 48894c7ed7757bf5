"""Fiscal week keys and dates.

A fiscal week key is the integer ``year * 100 + week``. Here the fiscal
calendar is the ISO calendar (weeks start on Monday).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def week_key(day: Column | str) -> Column:
    """ISO ``year * 100 + week`` of a date or timestamp, as bigint."""
    d = F.to_date(_col(day))
    return (F.extract(F.lit("YEAROFWEEK"), d).cast("bigint") * 100
            + F.weekofyear(d).cast("bigint"))


def iso_year(day: Column | str) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), F.to_date(_col(day))).cast("bigint")


def iso_week(day: Column | str) -> Column:
    return F.weekofyear(F.to_date(_col(day))).cast("bigint")


def key_year(key: Column | str) -> Column:
    """First four characters of the key, as bigint (``LEFT(CAST(k AS STRING), 4)``)."""
    return F.left(_col(key).cast("string"), F.lit(4)).cast("bigint")


def key_week(key: Column | str) -> Column:
    """Last two characters of the key, as bigint (``RIGHT(CAST(k AS STRING), 2)``)."""
    return F.right(_col(key).cast("string"), F.lit(2)).cast("bigint")


def key_year_text(key: Column | str) -> Column:
    """Characters 1-4 of the key, kept as a string."""
    return F.substring(_col(key).cast("string"), 1, 4)


def key_week_text(key: Column | str) -> Column:
    """Characters 5-6 of the key, kept as a string (leading zero kept)."""
    return F.substring(_col(key).cast("string"), 5, 2)


def shift_years(key: Column | str, years: int = 1, step: int = 100) -> Column:
    """Move a week key by whole years; 53-week years do not line up."""
    return _col(key) + F.lit(step * years)


def saturday_on_or_before(day: Column | str) -> Column:
    """Start of the Saturday-based week containing ``day``.

    ``next_day`` returns the first Saturday strictly after the date, so one
    week earlier is the Saturday on or before it.
    """
    return F.date_sub(F.next_day(F.to_date(_col(day)), "Sat"), 7)


def saturday_on_or_before_py(day: dt.date) -> dt.date:
    """Driver-side twin for literal dates (weekday(): Monday=0 .. Saturday=5)."""
    return day - dt.timedelta(days=(day.weekday() - 5) % 7)
