"""Width and line of the stellar colour locus per pixel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyfold.functions.classes import log_s2n, size_class
from skyfold.functions.guards import below, inside
from skyfold.functions.healpix import with_pixel
from skyfold.functions.photometry import extinction
from skyfold.functions.staging import fixed
from skyfold.operators.quantiles import exact_median, exact_percentiles
from skyfold.session import materialize

# Fit window, axis origin, window along the locus, clip, magnitude windows, MAD scale.
FIT_WINDOW = (0.3, 1.1)
ORIGIN = 0.3
ALONG = (-0.2, 0.6)
CLIP_SIGMAS = 3.0
MIN_STARS = 10
MAG_WINDOWS = {"G": (16.0, 22.0), "R": (16.0, 21.0), "I": (16.0, 21.0)}
MAD_SCALE = 1.4826


def filter_stars(df: DataFrame, ebv: str = "EBV", mag_base: str = "MAG_PSF_{}", coefficients: str = "release1", variant: str = "year6") -> DataFrame:
    """Point sources in the magnitude windows with dereddened ``g0, r0, i0`` and colours ``gr, ri``."""
    columns = df.columns
    df = fixed(df, {"_s2n": F.col("BDF_S2N").cast("double"), "_size": F.col("BDF_T").cast("double"), "_logs": log_s2n(F.col("BDF_S2N"))})
    keep = size_class(F.col("_s2n"), F.col("_size"), variant, F.col("_logs")) == 0
    for band, (low, high) in MAG_WINDOWS.items():
        keep = keep & inside(F.col(mag_base.format(band)), low, high)
    stars = df.where(keep).select(*columns).withColumns({f"{b}0": F.col(mag_base.format(b.upper())) - extinction(F.col(ebv), b, coefficients) for b in "gri"})
    return stars.withColumns({"gr": F.col("g0") - F.col("r0"), "ri": F.col("r0") - F.col("i0")})


def _axes(slope: Column, intercept: Column) -> tuple[Column, Column]:
    """Coordinates along (P1) and across (P2) the line ri = slope * gr + intercept, from g0, r0, i0.

    P2 weighs (g, r, i) by (-m, m+1, -1); both its weights and its offset are scaled to unit weight norm.
    """
    g, r, i = F.col("g0"), F.col("r0"), F.col("i0")
    norm = F.sqrt(slope * slope + (slope + 1.0) * (slope + 1.0) + 1.0)
    across = (-slope * g + (slope + 1.0) * r - i - intercept) / norm
    angle = F.atan(slope)
    x0, y0 = F.lit(ORIGIN), slope * ORIGIN + intercept
    along = F.cos(angle) * (g - r - x0) + F.sin(angle) * (r - i - y0)
    return along, across


def _ok_colors() -> Column:
    faint = below(F.col("g0"), 20.0) & below(F.col("r0"), 20.0) & below(F.col("i0"), 20.0)
    return inside(F.col("gr"), *FIT_WINDOW) & below(F.abs(F.col("ri")), 1.0) & faint


def _fit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.regr_slope("ri", "gr").alias("slope"), F.regr_intercept("ri", "gr").alias("intercept"), F.count(F.lit(1)).alias("n_fit")
    )


def color_locus(df: DataFrame, keys: Sequence[str] = ("pix",)) -> DataFrame:
    """``keys, n, width, slope, intercept``; NULL where the locus cannot be measured.

    Fit, rotate, clip across the locus by quartiles, fit again; the width is the scaled median absolute
    deviation across. Each step is a grouped aggregation joined back to the stars.
    """
    keys = list(keys)
    df = materialize(df.select(*keys, "g0", "r0", "i0", "gr", "ri"), "stars")
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_all"))
    enough = counts.where(F.col("n_all") > MIN_STARS).select(*keys)
    stars = df.join(enough, keys, "left_semi").withColumn("_ok", _ok_colors())
    first = _fit(stars.where("_ok"), keys).where(F.col("slope").isNotNull()).drop("n_fit")
    along, across = _axes(F.col("slope"), F.col("intercept"))
    placed = materialize(stars.join(first, keys).withColumns({"_p1": along, "_p2": across}), "placed")
    middle = placed.where(inside(F.col("_p1"), *ALONG))
    quart = exact_percentiles(middle, keys, {"_q1": ("_p2", 0.25), "_q3": ("_p2", 0.75)}, extra=[F.count(F.lit(1)).alias("_n")])
    clip = quart.where(F.col("_n") >= MIN_STARS).select(*keys, (F.lit(CLIP_SIGMAS * 0.74) * (F.col("_q3") - F.col("_q1"))).alias("_clip"))
    kept = placed.join(clip, keys).where(F.col("_ok") & (F.abs("_p2") < F.col("_clip"))).drop("slope", "intercept")
    second = _fit(kept, keys).where((F.col("n_fit") >= MIN_STARS) & F.col("slope").isNotNull()).drop("n_fit")
    second = materialize(second, "fit")
    along, across = _axes(F.col("slope"), F.col("intercept"))
    final = stars.join(second, keys).withColumns({"_p1": along, "_p2": across}).where(inside(F.col("_p1"), *ALONG))
    final = materialize(final.select(*keys, "_p2"), "across")
    centre = exact_median(final, keys, "_p2", "_centre", extra=[F.count(F.lit(1)).alias("_n")])
    deviation = final.join(centre, keys).withColumn("_dev", F.abs(F.col("_p2") - F.col("_centre")))
    mad = exact_median(deviation, keys, "_dev", "_mad", extra=[F.count(F.lit(1)).alias("_n")])
    result = counts.join(second, keys, "left").join(mad, keys, "left")
    good = F.col("_n") >= MIN_STARS
    # Pixels with few stars report all of them; measured ones report the stars of the width.
    n = F.when(F.col("n_all") <= MIN_STARS, F.col("n_all")).otherwise(F.col("_n"))
    return result.select(
        *keys, n.alias("n"), F.when(good, MAD_SCALE * F.col("_mad")).alias("width"), F.when(good, F.col("slope")).alias("slope"),
        F.when(good, F.col("intercept")).alias("intercept"),
    )


def locus_map(df: DataFrame, nside: int, **options) -> DataFrame:
    """Locus of every pixel that holds any object; pixels without point sources report n = 0."""
    pixels = with_pixel(df, nside)
    stars = filter_stars(pixels, **options)
    return _all_pixels(pixels, color_locus(stars, ["pix"]))


def _all_pixels(pixels: DataFrame, locus: DataFrame) -> DataFrame:
    joined = pixels.select("pix").distinct().join(locus.withColumn("_has", F.lit(True)), "pix", "left")
    return joined.withColumn("n", F.when(F.col("_has").isNull(), F.lit(0)).otherwise(F.col("n"))).drop("_has")


def locus_width(df: DataFrame, keys: Sequence[str] = ("pix",)) -> DataFrame:
    return color_locus(df, keys).select(*keys, "width")
