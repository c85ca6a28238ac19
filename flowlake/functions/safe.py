"""Arithmetic and casts that stay total under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def quoted(name: str) -> Column:
    """Column by literal name; dots are part of the name, not struct access."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_infinite(col: Column) -> Column:
    return col.isin(INF, -INF)


def try_num(col: Column) -> Column:
    """Number or null, whatever the text holds."""
    return col.try_cast("double")


def try_int(col: Column) -> Column:
    """Integer or null; a fraction is cut towards zero, also when it arrives as text."""
    return col.try_cast("double").try_cast("int")


def try_ratio(num: Column, den: Column, offset: float = 0.0) -> Column:
    """``num / (den + offset)``, null where the divisor is zero."""
    return F.try_divide(num.cast("double"), den.cast("double") + F.lit(float(offset)))


def finite_or(col: Column, default: float = 0.0) -> Column:
    """The value, or ``default`` for null, NaN and both infinities."""
    return F.when(col.isNull() | F.isnan(col) | is_infinite(col), F.lit(default)).otherwise(col)


def finite_or_null(col: Column, limit: float | None = None) -> Column:
    """The value, or null for NaN, infinities and, if given, magnitudes above ``limit``."""
    bad = F.isnan(col) | is_infinite(col)
    if limit is not None:
        bad = bad | (F.abs(col) > F.lit(limit))
    return F.when(~bad, col)


def scrub(col: Column) -> Column:
    """Double with null, NaN and non-numeric text turned into zero (infinities stay)."""
    number = try_num(col)
    return F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0))
