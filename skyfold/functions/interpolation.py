"""Piecewise-linear curves as a CASE over their knots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from skyfold.functions.guards import real


def piecewise_linear(value: Column, knots: Sequence[float], levels: Sequence[float], outside: str | float = 0.0) -> Column:
    """Linear interpolation between sorted knots.

    ``outside`` is the value beyond the ends, ``"null"``, or ``"raise"`` to fail the query.
    NaN and NULL inputs count as outside.
    """
    if len(knots) != len(levels) or len(knots) < 2:
        raise ValueError("need two or more knots and as many levels")
    if any(b <= a for a, b in zip(knots, knots[1:])):
        raise ValueError("knots must increase")
    x = real(value)
    if outside == "null":
        beyond = F.lit(None).cast("double")
    elif outside == "raise":
        beyond = F.raise_error(F.lit("value outside the interpolation range")).cast("double")
    else:
        beyond = F.lit(float(outside))
    out = F.when(x.isNull() | (x < knots[0]) | (x > knots[-1]), beyond)
    for k0, k1, y0, y1 in zip(knots, knots[1:], levels, levels[1:]):
        slope = (y1 - y0) / (k1 - k0)
        out = out.when(x <= k1, F.lit(y0) + F.lit(slope) * (x - F.lit(k0)))
    return out
