"""NaN-safe comparisons.

Spark orders NaN above every number, so ``NaN > x`` is true; the survey rules want it false. These
helpers also turn NULL into false, so that they can be negated safely.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def real(value: Column) -> Column:
    """NaN becomes NULL."""
    value = value.cast("double")
    return F.nanvl(value, F.lit(None).cast("double"))


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def above(value: Column, limit) -> Column:
    return _flag(real(value) > limit)


def at_least(value: Column, limit) -> Column:
    return _flag(real(value) >= limit)


def below(value: Column, limit) -> Column:
    return _flag(real(value) < limit)


def at_most(value: Column, limit) -> Column:
    return _flag(real(value) <= limit)


def inside(value: Column, low, high) -> Column:
    """Open interval."""
    return above(value, low) & below(value, high)


def finite(value: Column) -> Column:
    value = value.cast("double")
    return _flag(~F.isnan(value) & (F.abs(value) < float("inf")))


def finite_or(value: Column, fallback: float) -> Column:
    return F.when(finite(value), value.cast("double")).otherwise(F.lit(fallback))
