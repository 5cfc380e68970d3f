"""Numeric helpers whose NULL rules differ from Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def newest_of(first: str, *others: str) -> Column:
    """Latest of several timestamps; NULL exactly when ``first`` is NULL."""
    if not others:
        return F.col(first)
    return F.when(F.col(first).isNotNull(), F.greatest(first, *others))


def newest_after(bound: Column, first: str, *others: str) -> Column:
    """``newest_of(...) > bound`` as an OR of plain comparisons.

    The newest value passes a bound exactly when one of the values does, and
    this form reaches the Parquet scan as a pushed filter.
    """
    passed = F.col(first) > bound
    for name in others:
        passed = passed | (F.col(name) > bound)
    return F.col(first).isNotNull() & passed


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rounded_mean(total: Column, count: Column, digits: int) -> Column:
    """Mean of an integer column from its sum and count, halves away from zero.

    Worked in decimals: the double form of a mean may sit on the wrong side of
    a half.
    """
    whole = T.DecimalType(20, 0)
    return F.round(F.try_divide(total.cast(whole), count.cast(whole)), digits)
