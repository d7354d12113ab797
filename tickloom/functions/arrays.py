"""Array expressions. All stay on the JVM side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times inside `body`, lambdas included.

    Spark evaluates everything in a lambda body once per element, so an array that is filtered or
    sorted first must be bound outside of it.
    """
    return F.transform(F.array(value), body).getItem(0)


def to_delta(values: Column, scale: Column | float) -> Column:
    """MTH1: difference from the first value there is, times a multiplier; missing values stay
    missing, and an empty array stays empty."""
    factor = scale if isinstance(scale, Column) else F.lit(float(scale))
    first = F.coalesce(F.get(values, F.lit(0)), F.get(F.filter(values, lambda x: x.isNotNull()), F.lit(0)))
    base = F.struct(first.alias("first"), factor.alias("factor"))
    return let(base, lambda b: F.transform(values, lambda x: (x - b["first"]) * b["factor"]))


def prefix(values: Column, length: int) -> Column:
    """ARR3: the first `length` values."""
    return F.slice(values, 1, length)


def candidate_starts(n: Column, length: int, include_last: bool = False) -> Column:
    """ARR4: positions a window of `length` may start at, in a series of `n` points.

    The last position that would still fit is left out unless `include_last` is set.
    """
    last = n - F.lit(length if include_last else length + 1)
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(
        F.array().cast("array<int>")
    )
