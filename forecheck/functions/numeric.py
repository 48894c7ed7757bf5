"""Arithmetic helpers with warehouse semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """NULL instead of an error when the divisor is zero."""
    return F.try_divide(_col(num), _col(den))


def within_band(value: Column | str, base: Column | str, lo: float, hi: float) -> Column:
    """``value BETWEEN base * lo AND base * hi`` with double bounds."""
    b = _col(base)
    return _col(value).between(b * F.lit(float(lo)), b * F.lit(float(hi)))


def flag(cond: Column) -> Column:
    """1 when the condition is true, else 0 (NULL counts as false)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))
