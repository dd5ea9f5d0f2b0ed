"""Histograms, modes, clipped statistics and confusion matrices, per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from skyfold.functions.guards import above, below, finite, real
from skyfold.operators.quantiles import exact_median, exact_percentiles
from skyfold.session import discard, materialize

GRID = 1000
#: Bandwidths beyond which a Gaussian is exactly zero in double precision.
KERNEL_REACH = 39.0
EVERYTHING = "_everything"


def bin_index(value: Column, low: float, width: float, bins: int, closed: bool = True) -> Column:
    """Bin number 0 .. bins-1; the last bin includes its right edge when ``closed``. NULL outside."""
    v = real(value)
    high = low + bins * width
    last = F.when(v == high, F.lit(bins - 1)) if closed else F.when(F.lit(False), F.lit(0))
    # The small shift keeps a value written like an edge in the bin that starts there.
    return last.when((v >= low) & (v < high), F.least(F.floor((v - low) / width + 1e-9).cast("int"), F.lit(bins - 1)))


def histogram(df: DataFrame, keys: Sequence[str], value: str, low: float, high: float, bins: int, overflow: bool = False) -> DataFrame:
    """``keys, bin, left, n``. ``overflow`` counts values beyond the range in the end bins."""
    width = (high - low) / bins
    v = real(F.col(value))
    if overflow:
        v = F.when(v.isNotNull(), F.greatest(F.least(v, F.lit(high)), F.lit(low)))
    binned = df.withColumn("bin", bin_index(v, low, width, bins)).where(F.col("bin").isNotNull())
    return binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n")).withColumn("left", F.lit(low) + F.col("bin") * width)


def histogram2d(df: DataFrame, x: str, y: str, xr: tuple[float, float, int], yr: tuple[float, float, int]) -> DataFrame:
    cells = df.select(
        bin_index(F.col(x), xr[0], (xr[1] - xr[0]) / xr[2], xr[2]).alias("xbin"), bin_index(F.col(y), yr[0], (yr[1] - yr[0]) / yr[2], yr[2]).alias("ybin")
    )
    return cells.where(F.col("xbin").isNotNull() & F.col("ybin").isNotNull()).groupBy("xbin", "ybin").agg(F.count(F.lit(1)).alias("n"))


def cumulative_from_top(hist: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Adds ``n_above``: rows in this bin and all higher ones (a window over bins, never over rows)."""
    window = W.partitionBy(*keys).orderBy(F.col("bin").desc()) if keys else W.orderBy(F.col("bin").desc())
    return hist.withColumn("n_above", F.sum("n").over(window))


def histogram_mode(df: DataFrame, keys: Sequence[str], value: str, low: float, high: float, width: float) -> DataFrame:
    """Left edge of the fullest bin, the first on ties: ``keys, mode``."""
    bins = round((high - low) / width)
    hist = histogram(df, keys, value, low, low + bins * width, bins)
    best = hist.groupBy(*keys).agg(F.max(F.struct(F.col("n"), (-F.col("bin")).alias("b"))).alias("_b"))
    return best.select(*keys, (F.lit(low) - F.col("_b.b") * F.lit(width)).alias("mode"))


def density_mode(df: DataFrame, keys: Sequence[str], value: str, grid: int = GRID, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Mode of a Gaussian kernel density on an even grid, bandwidth n^(-1/5) times the sample deviation.

    Each distinct value adds to the grid points within reach of its kernel; the sums are formed map-side, so a group
    sends at most ``grid`` rows per task however many values it has. Groups of one, without spread, or whose values
    all lie out of reach of the grid, have no mode.
    """
    keys = list(keys)
    width = df.groupBy(*keys).agg((F.pow(F.count(value), F.lit(-0.2)) * F.stddev_samp(value)).alias("_h"))
    usable = df.join(width.where(F.col("_h") > 0), keys) if keys else df.withColumn("_h", width.scalar()).where(F.col("_h") > 0)
    step = (high - low) / (grid - 1)
    # Copies of a value count once with their number.
    weighted = usable.groupBy(*keys, F.col(value).alias("_v"), "_h").agg(F.count(F.lit(1)).alias("_c"))
    place = lambda x: (x - low) / step
    on_grid = lambda x: F.least(F.greatest(x, F.lit(-1.0)), F.lit(float(grid)))
    first = F.greatest(F.ceil(on_grid(place(F.col("_v") - KERNEL_REACH * F.col("_h")))), F.lit(0)).cast("int")
    last = F.least(F.floor(on_grid(place(F.col("_v") + KERNEL_REACH * F.col("_h")))), F.lit(grid - 1)).cast("int")
    reaching = weighted.withColumns({"_first": first, "_last": last}).where("_first <= _last")
    spread = reaching.select(*keys, "_v", "_h", "_c", F.explode(F.sequence("_first", "_last")).alias("_g"))
    d = (F.lit(low) + F.col("_g") * step - F.col("_v")) / F.col("_h")
    sums = spread.groupBy(*keys, "_g").agg(F.sum(F.col("_c") * F.exp(-0.5 * d * d)).alias("_s"))
    best = sums.groupBy(*keys).agg(F.max(F.struct("_s", (-F.col("_g")).alias("b"))).alias("_b"))
    return best.select(*keys, (F.lit(low) - F.col("_b.b") * F.lit(step)).alias("mode"))


def distribution_summary(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Percentiles 5/16/50/84/95, the 68% width, mean, population deviation and RMS of finite values."""
    v = F.col(value).cast("double")
    clean = df.where(finite(v))
    wanted = {f"q{q:02d}": (value, q / 100.0) for q in (5, 16, 50, 84, 95)}
    extra = [F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.sqrt(F.avg(v * v)).alias("rms")]
    return exact_percentiles(clean, keys, wanted, extra=extra).withColumn("width68", F.col("q84") - F.col("q16"))


def histogram_peak(df: DataFrame, keys: Sequence[str], value: str, low: float, high: float, bins: int) -> DataFrame:
    """Centre of the fullest bin."""
    width = (high - low) / bins
    return histogram_mode(df, keys, value, low, high, width).select(*keys, (F.col("mode") + width / 2).alias("peak"))


def quartile_clipped(df: DataFrame, keys: Sequence[str], value: str, sigmas: float = 3.0) -> DataFrame:
    """Median of all rows; mean, deviation and RMS of rows within ``sigmas * 0.74 * IQR`` of it."""
    keys = list(keys)
    if not keys:
        return quartile_clipped(df.withColumn(EVERYTHING, F.lit(0)), [EVERYTHING], value, sigmas).drop(EVERYTHING)
    quart = exact_percentiles(df, keys, {"_q1": (value, 0.25), "median": (value, 0.5), "_q3": (value, 0.75)})
    quart = quart.select(*keys, "median", (F.lit(sigmas * 0.74) * (F.col("_q3") - F.col("_q1"))).alias("clip"))
    v = F.col(value)
    kept = df.join(quart, keys).where(~(F.abs(v - F.col("median")) > F.col("clip")))
    stats = kept.groupBy(*keys).agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.sqrt(F.avg(v * v)).alias("rms"), F.count(v).alias("n_kept"))
    return quart.join(stats, keys, "left")


def sigma_clipped(df: DataFrame, keys: Sequence[str], value: str, sigmas: float = 5.0) -> DataFrame:
    """Clip around the mean until no row goes, then median, mean and population deviation.

    Each pass is one aggregation joined back; groups that have settled lose nothing more. Every pass but the last
    removes rows, so the loop ends by itself.
    """
    keys = list(keys)
    if not keys:
        return sigma_clipped(df.withColumn(EVERYTHING, F.lit(0)), [EVERYTHING], value, sigmas).drop(EVERYTHING)
    current = materialize(df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col(value).isNotNull() & ~F.isnan(value)), "clip")
    n, left = current.count(), -1
    while n != left:
        stats = current.groupBy(*keys).agg(F.avg("_v").alias("_m"), F.stddev_pop("_v").alias("_s"))
        near = F.col("_v").between(F.col("_m") - sigmas * F.col("_s"), F.col("_m") + sigmas * F.col("_s"))
        kept = materialize(current.join(stats, keys).where(near).drop("_m", "_s"), "clip")
        left, n = n, kept.count()
        discard(current)
        current = kept
    extra = [F.avg("_v").alias("mean"), F.stddev_pop("_v").alias("sigma"), F.count("_v").alias("n")]
    return exact_median(current, keys, "_v", "median", extra=extra)


def binned_error(df: DataFrame, mag: str, error: str, low: float = 16.0, high: float = 25.0, bins: int = 99, keys: Sequence[str] = ()) -> DataFrame:
    """Median, mean and population deviation of the error per magnitude bin."""
    width = (high - low) / bins
    rows = df.withColumn("bin", bin_index(F.col(mag), low, width, bins, closed=False)).where(F.col("bin").isNotNull())
    extra = [F.avg(error).alias("mean"), F.stddev_pop(error).alias("std"), F.count(error).alias("n")]
    out = exact_median(rows, [*keys, "bin"], error, "median", extra=extra)
    return out.withColumns({"left": F.lit(low) + F.col("bin") * width, "center": F.lit(low) + (F.col("bin") + 0.5) * width})


def magnitude_limit(profile: DataFrame, keys: Sequence[str] = (), threshold: float = 0.1) -> DataFrame:
    """Middle of the two bin edges where the median error first exceeds the threshold."""
    window = W.partitionBy(*keys).orderBy("bin") if keys else W.orderBy("bin")
    mid = (F.col("left") + F.lag("left").over(window)) / 2.0
    crossed = profile.withColumn("_mid", mid).where(F.col("median") > threshold)
    first = crossed.groupBy(*keys).agg(F.min(F.struct("bin", "_mid")).alias("_f"))
    return first.select(*keys, F.col("_f._mid").alias("maglim"))


CONFUSION_RATIOS = {
    "TPR": ("TP", "P"), "FNR": ("FN", "P"), "TNR": ("TN", "N"), "FPR": ("FP", "N"), "PPV": ("TP", "class_npos"), "FDR": ("FP", "class_npos"),
    "FOR": ("FN", "class_nneg"), "NPV": ("TN", "class_nneg"),
}


def confusion_matrix(
    df: DataFrame, class_pos: Column, class_neg: Column, true_pos: Column, true_neg: Column, mag: Column | None = None,
    low: float | None = None, width: float | None = None, bins: int | None = None,
) -> DataFrame:
    """Counts and rates per bin of ``mag``; one bin over everything without ``mag``. An empty denominator gives NULL."""
    index = F.lit(0) if mag is None else bin_index(mag, low, width, bins)
    flags = df.select(index.alias("bin"), class_pos.alias("cp"), class_neg.alias("cn"), true_pos.alias("tp"), true_neg.alias("tn"))
    both = lambda a, b: F.count_if(F.col(a) & F.col(b))
    counts = flags.where(F.col("bin").isNotNull()).groupBy("bin").agg(
        both("cp", "tp").alias("TP"), both("cn", "tn").alias("TN"), both("cp", "tn").alias("FP"), both("cn", "tp").alias("FN"),
        F.count_if("cp").alias("class_npos"), F.count_if("cn").alias("class_nneg"), F.count_if("tp").alias("P"), F.count_if("tn").alias("N"),
    )
    ratio = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b))
    out = counts.withColumns({k: ratio(a, b) for k, (a, b) in CONFUSION_RATIOS.items()})
    return out.withColumns(
        {
            "ACC": F.try_divide((F.col("TP") + F.col("TN")).cast("double"), F.col("P") + F.col("N")),
            "PRV": F.try_divide(F.col("class_npos").cast("double"), F.col("P") + F.col("N")),
            "PLR": F.try_divide(F.col("TPR"), F.col("FPR")), "NLR": F.try_divide(F.col("FNR"), F.col("TNR")),
        }
    )


def class_thresholds(df: DataFrame, value: str, mag: str, low: float, high: float, star_q: float = 0.8, galaxy_q: float = 0.2) -> DataFrame:
    """80th and 20th percentile of a class column inside a magnitude window, and the rows beyond each."""
    window = df.where(above(F.col(mag), low) & below(F.col(mag), high))
    cuts = exact_percentiles(window, [], {"star": (value, star_q), "galaxy": (value, galaxy_q)})
    star, galaxy = cuts.select("star").scalar(), cuts.select("galaxy").scalar()
    return window.agg(
        F.max(star).alias("star_threshold"), F.max(galaxy).alias("galaxy_threshold"),
        F.count_if(F.col(value) > star).alias("n_star"), F.count_if(F.col(value) < galaxy).alias("n_galaxy"),
    )


def value_range(df: DataFrame, value: str, positional: bool = True, low: float = 0.005, high: float = 0.995) -> DataFrame:
    """Range of a map for display: values at sorted positions ``int(n*q)`` of the positive pixels, or percentiles."""
    if not positional:
        return exact_percentiles(df.where(finite(F.col(value))), [], {"vmin": (value, low), "vmax": (value, high)})
    kept = df.where(above(F.col(value), 0.0)).select(F.col(value).cast("double").alias("_v"))
    n = kept.agg(F.count(F.lit(1))).first()[0]
    if n == 0:
        return kept.agg(F.max("_v").alias("vmin"), F.max("_v").alias("vmax"))
    # The value at position k is the percentile k/(n-1): no ranking of all rows in one task.
    place = lambda q: min(int(n * q), n - 1) / max(n - 1, 1)
    return exact_percentiles(kept, [], {"vmin": ("_v", place(low)), "vmax": ("_v", place(high))})
