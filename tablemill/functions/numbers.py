"""Numeric expressions that stay defined under ANSI rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_column


def sqrt_value(value: Column | str, use_abs: bool = False) -> Column:
    """NaN below zero unless ``use_abs``."""
    column = as_column(value)
    return F.sqrt(F.abs(column) if use_abs else column)


def log1p_value(value: Column | str, use_abs: bool = False) -> Column:
    """``ln(1 + x)``, NULL at or below -1 unless ``use_abs``."""
    column = as_column(value)
    return F.log1p(F.abs(column) if use_abs else column)


def reciprocal(value: Column | str) -> Column:
    """``1 / (x + 1)``, NULL at -1."""
    return F.try_divide(F.lit(1.0), as_column(value).cast("double") + 1)


def rounded(value: Column | str, digits: int = 2) -> Column:
    return F.round(as_column(value), digits)


def tip_rate(tip: Column | str, fare: Column | str) -> Column:
    """Aggregate: total tips as a percentage of total fares."""
    return F.try_divide(F.sum(as_column(tip)), F.sum(as_column(fare))) * 100
