"""Magnitudes, extinction and colour transforms as column expressions."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from skyfold.functions.guards import above, at_most, finite, inside, real
from skyfold.functions.interpolation import piecewise_linear
from skyfold.schema import BAD_MAG

MAG_PER_RATIO = 2.5 / math.log(10.0)

# A_b / E(B-V) coefficient sets.
EXTINCTION_SETS = {
    "schlafly11": {"g": 3.237, "r": 2.176, "i": 1.595, "z": 1.217, "Y": 1.058, "y": 1.058},
    "scan2012": {"g": 3.704722, "r": 2.610357, "i": 1.947345, "z": 1.496843, "Y": 1.311188, "y": 1.311188},
    "scan2013": {"u": 4.708272, "g": 3.682995, "r": 2.604808, "i": 1.940133, "z": 1.450496, "Y": 1.277421, "y": 1.277421},
    "year3": {"g": 3.185, "r": 2.140, "i": 1.571, "z": 1.198, "Y": 1.052, "y": 1.052},
    "release1": {"g": 3.186, "r": 2.140, "i": 1.569, "z": 1.196, "Y": 1.048, "y": 1.048},
    "ps1": {"g": 3.172, "r": 2.271, "i": 1.682, "z": 1.322, "y": 1.087, "w": 2.341},
}
EXTINCTION_SETS["release2"] = EXTINCTION_SETS["release1"]

# Linear colour terms (slope, offset) from the reference catalog to the survey bands.
LINEAR_COEFFICIENTS = {
    "original": {"g": (0.0994, -0.0076), "r": (-0.1335, 0.0189), "i": (-0.3407, 0.0026), "z": (-0.2575, -0.0074), "Y": (-0.6032, 0.0185)},
    "refcat": {
        "g": (0.0994, -0.0076 - 0.0243), "r": (-0.1335, 0.0189 + 0.0026), "i": (-0.3407, 0.0026 - 0.0039),
        "z": (-0.2575, -0.0074 - 0.0127), "Y": (-0.6032, 0.0185),
    },
    "identity": {b: (0.0, 0.0) for b in "grizY"},
}

# Offsets in mmag (north, south) added to the interpolated colour terms.
INTERPOLATION_SHIFTS = {
    "g": (3.1 - 0.1, 2.4 + 1.2), "r": (-0.2 + 0.0, 1.8 - 0.3), "i": (-0.0 - 0.1, -0.5 - 0.4), "z": (-1.0 + 0.1, -3.8 + 1.2),
}
SPLIT_DEC = -30.0

# Model of the wide Gaia G band from griz.
GAIA_WAVELENGTH = (4790.28076172, 6403.26367188, 7802.49755859, 9158.77441406)
GAIA_FUDGE = (0.25, 1.0, 1.0, 0.25)
GAIA_MODEL = {
    "dr2": {
        "color": (1.43223290, 1.50877061, 0.843173013, -5.99023967e-04),
        "weight": (0.406188382, 0.311181978, 0.251002598, 1.0e-05),
        "curve": (4.94284725e-03, 1.80499806e-03), "shift": 0.0,
    },
    "edr3": {
        "color": (2.61815727, 2.69372875, 1.45644592, -5.99023051e-04),
        "weight": (0.397535324, 0.315794343, 0.255484718, 1.0e-05),
        "curve": (8.30152817e-04, -3.57980758e-04), "shift": 2.4e-3,
    },
}
GAIA_ZEROPOINT_AB = {"dr2": 25.7933969562, "edr3": 25.8010446445}


def snr_to_magerr(snr):
    """Magnitude error of a signal-to-noise ratio (a number or a column)."""
    return MAG_PER_RATIO / snr


def flux_to_mag(flux: Column, zeropoint: Column, bad: float = BAD_MAG) -> Column:
    """Pogson magnitude; not computable or a zeropoint outside [0, 90] gives the sentinel."""
    zp = real(zeropoint)
    usable = above(flux, 0.0) & finite(flux) & F.coalesce(zp.between(0.0, 90.0), F.lit(False))
    return F.when(usable, -2.5 * F.log10(flux.cast("double")) + zp).otherwise(F.lit(bad))


def flux_to_magerr(flux: Column, fluxerr: Column, bad: float = BAD_MAG) -> Column:
    ratio = F.try_divide(fluxerr.cast("double"), flux.cast("double"))
    return F.when(finite(ratio), MAG_PER_RATIO * ratio).otherwise(F.lit(bad))


def gaia_flux_to_ab(flux: Column, version: str = "dr2") -> Column:
    """AB magnitude of a Gaia G flux; NULL when the flux is not positive."""
    return F.lit(GAIA_ZEROPOINT_AB[version]) - 2.5 * F.log10(flux.cast("double"))


def extinction(ebv: Column, band: Column | str, coefficients: str | Mapping[str, float] = "release1") -> Column:
    """``R_band * E(B-V)``; an unknown literal band is an error, an unknown band value is NULL."""
    table = EXTINCTION_SETS[coefficients] if isinstance(coefficients, str) else coefficients
    if isinstance(band, str):
        return F.lit(table[band]) * ebv
    factor = reduce(lambda acc, item: acc.when(band == item[0], F.lit(item[1])), list(table.items())[1:],
                    F.when(band == next(iter(table)), F.lit(next(iter(table.values())))))
    return factor * ebv


def _reference_color(band: str) -> tuple[str, str, float, str, str]:
    """Colour pair, upper colour bound, base magnitude and base error of a band."""
    if band in ("g", "r"):
        return "G", "R", 1.2, band.upper(), "D" + band.upper()
    if band in ("i", "z", "Y"):
        base = "I" if band == "i" else "Z"
        return "I", "Z", 0.3, base, "D" + base
    raise ValueError(f"unrecognized band: {band}")


def linear_transform(band: str, coefficients: str | Mapping = "refcat") -> tuple[Column, Column, Column]:
    """(magnitude, error, usable) in the survey band from reference columns G, R, I, Z."""
    table = LINEAR_COEFFICIENTS[coefficients] if isinstance(coefficients, str) else coefficients
    blue, red, upper, base, error = _reference_color(band)
    color = F.col(blue).cast("double") - F.col(red).cast("double")
    slope, offset = table[band]
    mag = F.col(base).cast("double") + F.lit(slope) * color + F.lit(offset)
    return mag, F.col(error).cast("double"), above(color, -0.2) & at_most(color, upper)


def interpolated_transform(
    band: str, north: tuple[Sequence[float], Sequence[float]], south: tuple[Sequence[float], Sequence[float]],
    shifts: tuple[float, float] | None = None, dec: str = "DEC",
) -> tuple[Column, Column, Column]:
    """(magnitude, error, usable) from tabulated offsets north and south of the split declination."""
    if band not in ("g", "r", "i", "z"):
        raise ValueError(f"unrecognized band: {band}")
    blue, red, upper, base, error = _reference_color(band)
    upper = 1.0 if band in ("g", "r") else upper
    color = F.col(blue).cast("double") - F.col(red).cast("double")
    shift_n, shift_s = (s / 1000.0 for s in (shifts or INTERPOLATION_SHIFTS[band]))
    in_north, in_south = above(F.col(dec), SPLIT_DEC), at_most(F.col(dec), SPLIT_DEC)
    offset = (
        F.when(in_north, piecewise_linear(color, *north, outside=0.0) + F.lit(shift_n))
        .when(in_south, piecewise_linear(color, *south, outside=0.0) + F.lit(shift_s))
        .otherwise(F.lit(0.0))
    )
    return F.col(base).cast("double") + offset, F.col(error).cast("double"), above(color, -0.2) & at_most(color, upper)


def by_band(band: Column, choices: Mapping[str, Column]) -> Column:
    """The column chosen by a band value; NULL for other bands."""
    out = None
    for name, value in choices.items():
        out = F.when(band == name, value) if out is None else out.when(band == name, value)
    return out


def predicted_gaia_g(g: Column, r: Column, i: Column, z: Column, version: str = "dr2") -> Column:
    """Gaia G predicted from griz: flux-weighted sum with slope terms, then a magnitude curve."""
    if version not in GAIA_MODEL:
        raise ValueError(f"unrecognized Gaia version: {version}")
    model, wave = GAIA_MODEL[version], GAIA_WAVELENGTH
    mags = [m.cast("double") for m in (g, r, i, z)]
    slope = [
        (mags[k + 1] - mags[k]) * F.lit(-1.0 / MAG_PER_RATIO / (wave[k + 1] - wave[k])) for k in range(3)
    ]
    tail = GAIA_FUDGE[3] * (wave[3] - wave[2]) / (wave[3] - wave[1])
    prime = [
        slope[0] + F.lit(GAIA_FUDGE[0]) * (slope[1] + slope[0]),
        F.lit(GAIA_FUDGE[1] / 2.0) * (slope[0] + slope[1]),
        F.lit(GAIA_FUDGE[2] / 2.0) * (slope[1] + slope[2]),
        slope[2] + F.lit(tail) * (slope[2] - slope[1]),
    ]
    flux = reduce(
        lambda a, b: a + b,
        [
            F.lit(k) * F.pow(F.lit(10.0), m / -2.5) * (1.0 + p * F.lit(c))
            for k, m, p, c in zip(model["weight"], mags, prime, model["color"])
        ],
    )
    r1, r2 = model["curve"]
    bright = mags[1] - 17.0
    return -2.5 * F.log10(flux) + F.lit(r1) * bright + F.lit(r2) * bright * bright + F.lit(model["shift"])


def good_star_mag(mag: str, low: float, high: float) -> Column:
    return inside(F.col(mag), low, high)
