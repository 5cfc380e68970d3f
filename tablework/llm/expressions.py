"""Column helpers for arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, also where the body uses it in a loop."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def up_to(stop: Column) -> Column:
    """0, 1, ... stop - 1; empty when the stop is not positive."""
    return F.when(stop > 0, F.sequence(F.lit(0), stop - 1)).otherwise(F.array().cast("array<int>"))


def common_head(a: Column, b: Column, most: int) -> Column:
    """How many leading elements of two arrays agree, ``most`` at most."""
    return F.aggregate(F.sequence(F.lit(0), F.lit(most - 1)), F.lit(0), lambda n, i: F.when(
        (n == i) & (F.get(a, i) == F.get(b, i)), n + 1).otherwise(n))
