"""Boolean selections."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from skyfold.functions.guards import above, at_least, at_most, below, inside
from skyfold.schema import BAD_MAG, BANDS, MAGS, band_column, band_columns

# Rounded 2.5/ln(10), limits per band, class members and colour windows.
ROUNDED_MAG_PER_RATIO = 1.0857362
BAD_IMAGE_BITS = 2047
MAG_LIMITS = {"g": 23.0, "r": 23.0, "i": 22.5, "z": 22.0, "Y": 21.0}
CLASS_MEMBERS = {"star": [0, 1], "gal": [2, 3], True: [0, 1, 2, 3]}
COLOR_WINDOWS = {"gr": ((0.1, 0.3), (17.0, 20.0)), "gi": ((0.2, 0.4), (17.0, 20.0))}


def every(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def clean_image(flags: str = "IMAFLAGS_ISO") -> Column:
    return F.coalesce(F.col(flags).cast("int").bitwiseAND(F.lit(BAD_IMAGE_BITS)) == 0, F.lit(False))


def detection_quality() -> Column:
    """Positive fluxes, unsaturated, clean image, magnitude error below 0.5."""
    ratio = F.try_divide(F.col("FLUXERR_PSF").cast("double"), F.col("FLUX_PSF").cast("double"))
    return (
        above(F.col("FLUX_PSF"), 0.0) & above(F.col("FLUX_AUTO"), 0.0) & below(F.col("FLAGS"), 4)
        & clean_image() & below(F.lit(ROUNDED_MAG_PER_RATIO) * ratio, 0.5)
    )


def calibration_input() -> Column:
    """Positive flux, unsaturated, clean image, signal-to-noise above 5."""
    snr = F.try_divide(F.col("FLUX_PSF").cast("double"), F.col("FLUXERR_PSF").cast("double"))
    infinite = above(F.col("FLUX_PSF"), 0.0) & (F.col("FLUXERR_PSF") == 0)
    return above(F.col("FLUX_PSF"), 0.0) & below(F.col("FLAGS"), 4) & clean_image() & (above(snr, 5.0) | F.coalesce(infinite, F.lit(False)))


def good_object(split_flag: bool = False) -> Column:
    """Single-epoch rows fit for the coadd."""
    mags = [inside(F.col(m), 0.0, BAD_MAG) for m in MAGS]
    out = every(mags) & inside(F.col("SPREAD_MODEL"), -99.0, 99.0) & inside(F.col("SPREADERR_MODEL"), 0.0, 99.0) & below(F.col("FLAGS"), 4)
    if split_flag:
        out = out & ~F.coalesce(F.col("SPLIT_FLAG") == "merged", F.lit(False))
    return out


def band_count(field: str = "MAG_PSF", bands: Sequence[str] = BANDS) -> Column:
    """Number of bands with a valid magnitude."""
    return reduce(lambda a, b: a + b, [below(F.col(c), BAD_MAG).cast("int") for c in band_columns(field, bands)])


def mag_window(name: str, window=None) -> Column:
    """All (None), an upper bound (number), or an open window (pair)."""
    if window is None:
        return F.lit(True)
    if isinstance(window, (int, float)):
        return below(F.col(name), window)
    if len(window) == 2:
        return inside(F.col(name), *window)
    raise ValueError(f"magnitude window must be None, a number or a pair: {window}")


def color_window(name1: str, name2: str, window=None) -> Column:
    if window is None:
        return F.lit(True)
    return inside(F.col(name1).cast("double") - F.col(name2).cast("double"), *window)


def class_members(name: str, values=None) -> Column:
    return F.lit(True) if values is None else F.coalesce(F.col(name).isin(list(values)), F.lit(False))


def catalog_selection(
    bands: str | None, mag: bool = True, color: bool = False, extclass=None, mag_field: str = "WAVG_MAG_PSF", class_field: str = "EXTENDED_CLASS"
) -> Column:
    """Selection named by its bands: ``"r"``, ``"griz"``, a colour such as ``"gr"``, or ``"any"``."""
    if bands is None or bands == "any":
        return F.lit(True)
    parts: list[Column] = []
    if mag:
        parts += [mag_window(band_column(mag_field, b), MAG_LIMITS[b]) for b in bands]
    if color:
        window, mag_limits = COLOR_WINDOWS[bands]
        first, second = (band_column(mag_field, b) for b in bands[:2])
        parts += [color_window(first, second, window), mag_window(first, mag_limits)]
    if extclass:
        parts += [class_members(band_column(class_field, b), CLASS_MEMBERS[extclass]) for b in bands]
    return every(parts)


def galaxy_density_cut(mag: str = "WAVG_MAG_AUTO_I", spread: str = "WAVG_SPREAD_MODEL_I") -> Column:
    return inside(F.col(mag), 19.5, 20.5) & above(F.col(spread), 0.005)


def star_selection(
    spread: str, mag: str, low: float, high: float, nepochs: str | None = None,
    color: tuple[str, str, float, float] | None = None, others: Sequence[str] = (), spread_limit: float = 0.002,
) -> Column:
    """Validation stars: compact, inside a magnitude window, optionally multi-epoch and in a colour window."""
    parts = [below(F.abs(F.col(spread).cast("double")), spread_limit), inside(F.col(mag), low, high)]
    parts += [below(F.col(m), 90.0) for m in others]
    if nepochs is not None:
        parts.append(above(F.col(nepochs), 1))
    if color is not None:
        parts.append(color_window(color[0], color[1], (color[2], color[3])))
    return every(parts)


def calibration_star(mag: str = "MAG_STD") -> Column:
    """Rows used to derive zeropoints, before the cut around the global median."""
    snr = F.try_divide(F.col("FLUX_PSF").cast("double"), F.col("FLUXERR_PSF").cast("double"))
    return (
        at_least(F.col(mag), 0.0) & at_most(F.col(mag), 25.0) & above(F.col("FLUX_PSF"), 10.0) & below(F.col("FLAGS"), 2)
        & below(F.abs(F.col("SPREAD_MODEL").cast("double")), 0.01)
        & (above(snr, 10.0) | F.coalesce((F.col("FLUXERR_PSF") == 0) & (F.col("FLUX_PSF") > 0), F.lit(False)))
    )
