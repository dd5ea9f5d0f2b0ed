"""Star/galaxy classes as sums of NaN-safe comparisons. -9 marks a failure."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from skyfold.functions.guards import above, below, finite, real
from skyfold.functions.interpolation import piecewise_linear

FAILED = -9

# Fixed values: (error multiple, cut) of the three spread-model tests per variant.
SPREAD_CUTS = {
    "default": ((3.0, 0.005), (1.0, 0.003), (-1.0, 0.003)),
    "wavg": ((3.0, 0.005), (1.0, 0.003), (-0.5, 0.001)),
    "coadd": ((3.0, 0.005), (1.0, 0.003), (-1.0, 0.002)),
    "wavg_dr3": ((3.0, 0.005), (1.0, 0.003), (-0.5, 0.001)),
}

# Size thresholds as curves of log10 signal-to-noise.
SIZE_KNOTS_INNER = (0.79891862, 0.90845217, 0.98558583, 1.05791208, 1.13603715, 1.22479487, 1.33572223, 1.48983602, 1.74124395, 2.43187589)
SIZE_STAR = (0.028, 0.028, 0.008, 0.0, 0.004, 0.012, 0.012, 0.004, 0.012, 0.024, 0.04, 0.04)
SIZE_LIKELY = (-0.028, -0.028, -0.04, -0.032, -0.036, -0.032, -0.028, -0.016, -0.012, 0.008, 0.016, 0.016)
SIZE_LIKELY_GOLD = (-0.028, -0.028, -0.028, -0.028, -0.028, -0.028, -0.028, -0.012, 0.005, 0.022, 0.04, 0.04)
SIZE_PURE_STAR = (-0.1, -0.1, -0.1, -0.1, -0.1, -0.1, -0.1, -0.1, -0.012, 0.008, 0.016, 0.016)
SIZE_PURE_GALAXY = (0.252, 0.252, 0.188, 0.14, 0.096, 0.104, 0.052, 0.048, 0.04, 0.052, 0.088, 0.088)
SIZE_FAILED = -9.999e9
SIZE_VARIANTS = {
    "year6_first": ((-1.0, *SIZE_KNOTS_INNER, 5.0), (SIZE_STAR, SIZE_LIKELY, SIZE_PURE_STAR)),
    "year6": ((-3.0, *SIZE_KNOTS_INNER, 6.0), (SIZE_STAR, SIZE_LIKELY, SIZE_PURE_STAR, SIZE_PURE_GALAXY)),
    "range": ((-3.0, *SIZE_KNOTS_INNER, 6.0), (SIZE_STAR, SIZE_LIKELY, SIZE_PURE_STAR, SIZE_PURE_GALAXY)),
    "gold": ((-3.0, *SIZE_KNOTS_INNER, 6.0), (SIZE_STAR, SIZE_LIKELY_GOLD, SIZE_PURE_STAR, SIZE_PURE_GALAXY)),
    "dr3_gold": ((-3.0, *SIZE_KNOTS_INNER, 6.0), (SIZE_STAR, SIZE_LIKELY_GOLD, SIZE_PURE_STAR, SIZE_PURE_GALAXY)),
}
PROBABILITY_CUTS = (0.865, 0.11, 0.045, 0.015)
FEATURES = ["SPREAD_MODEL_I", "SPREADERR_MODEL_I", "WAVG_SPREAD_MODEL_I", "WAVG_SPREADERR_MODEL_I", "BDF_T", "BDF_S2N"]


def _total(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [f.cast("int") for f in flags])


def spread_class(spread: Column, error: Column, variant: str = "default") -> Column:
    """0 sure star .. 3 sure galaxy."""
    spread, error = spread.cast("double"), error.cast("double")
    value = _total([above(spread + F.lit(k) * error, cut) for k, cut in SPREAD_CUTS[variant]])
    if variant == "wavg_dr3":
        failed = (spread == -99.0) | (error == -99.0)
    else:
        failed = (spread == -1.0) | ((spread == 0.0) & (error == 0.0)) | ((spread == 1.0) & (error == 1.0))
    return F.when(F.coalesce(failed, F.lit(False)), F.lit(FAILED)).otherwise(value)


def spread_boundaries(error: Column, variant: str = "wavg") -> list[Column]:
    """Spread at the cuts of a variant, each a straight line in the error; errors beyond 1 raise."""
    return [piecewise_linear(error, (-1.0, 1.0), (cut + k, cut - k), outside="raise") for k, cut in SPREAD_CUTS[variant]]


def _near(value: Column, target: float) -> Column:
    """Equal within the customary relative 1e-5 and absolute 1e-8."""
    return F.coalesce(F.abs(real(value) - target) <= 1e-8 + 1e-5 * abs(target), F.lit(False))


def log_s2n(s2n: Column) -> Column:
    """log10 of a signal-to-noise ratio that is positive and finite, else null."""
    s2n = s2n.cast("double")
    return F.when(above(s2n, 0.0) & finite(s2n), F.log10(s2n))


def size_class(s2n: Column, size: Column, variant: str = "year6", logs: Column | None = None) -> Column:
    """0 sure star .. 4 pure galaxy from object size against log10 signal-to-noise.

    ``logs`` is a column that holds :func:`log_s2n` already; four curves of a dozen knots each refer to it, so a scan
    that filters by the class should compute it once (see :mod:`skyfold.functions.staging`).
    """
    knots, curves = SIZE_VARIANTS[variant]
    s2n, size = s2n.cast("double"), size.cast("double")
    logs = log_s2n(s2n) if logs is None else logs
    zero = F.coalesce(s2n == 0.0, F.lit(False))
    infinite = F.coalesce(s2n == float("inf"), F.lit(False))
    if variant in ("year6", "gold"):
        x, outside = F.coalesce(logs, F.lit(knots[0])), "null"
    elif variant == "dr3_gold":
        x = F.greatest(F.least(F.coalesce(logs, F.lit(knots[0])), F.lit(knots[-1])), F.lit(knots[0]))
        outside = "null"
    else:
        x, outside = logs, "null"
    value = _total([above(size, piecewise_linear(x, knots, levels, outside=outside)) for levels in curves])
    sentinel = _near(size, SIZE_FAILED) | _near(s2n, SIZE_FAILED) | F.coalesce(real(s2n) <= 0.0, F.lit(False))
    far = below(logs, knots[0]) | above(logs, knots[-1])
    failed = {
        "year6_first": F.lit(False),
        "range": far | zero | infinite,
        "year6": sentinel,
        "gold": sentinel | above(logs, knots[-1]),
        "dr3_gold": sentinel | far | logs.isNull(),
    }[variant]
    return F.when(failed, F.lit(FAILED)).otherwise(value)


def concentration_class(psf_mag: Column, model_mag: Column) -> Column:
    """True for galaxies."""
    return _concentrated(psf_mag, model_mag, 0.03, 0.1, 22.0)


def aperture_concentration_class(psf_mag: Column, model_mag: Column) -> Column:
    """True for galaxies."""
    return _concentrated(psf_mag, model_mag, 0.04, 0.1, 21.0)


def _concentrated(psf_mag: Column, model_mag: Column, tight: float, loose: float, bright: float) -> Column:
    excess = psf_mag.cast("double") - model_mag.cast("double")
    return ~(below(excess, tight) | (below(excess, loose) & below(psf_mag, bright)))


def extendedness_class(extendedness: Column) -> Column:
    """True for galaxies."""
    return ~F.coalesce(extendedness == 0, F.lit(False))


def merged_class(size: Column, wavg: Column, coadd: Column) -> Column:
    """First of the three that did not fail."""
    usable = [F.when(c > FAILED, c) for c in (size, wavg, coadd)]
    return F.coalesce(*usable, F.lit(FAILED))


def probability_class(probability: Column) -> Column:
    value = _total([below(probability, cut) for cut in PROBABILITY_CUTS])
    return F.when(below(probability, 0.0), F.lit(FAILED)).otherwise(value)


def feature_columns(names: list[str] | None = None) -> list[Column]:
    return [F.col(n) for n in (names or FEATURES)]
