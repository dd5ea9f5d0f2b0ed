"""Zeropoints of exposures from matches with a reference catalog.

One job handles every exposure: groups are (EXPNUM, CCDNUM) and the band comes from the row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyfold.functions.coords import chord_to_angle
from skyfold.functions.guards import inside
from skyfold.functions.healpix import disc_pixels, with_pixel
from skyfold.functions.photometry import by_band, interpolated_transform, linear_transform
from skyfold.functions.selections import calibration_star
from skyfold.operators.nearest import nearest_in_cells
from skyfold.operators.quantiles import exact_percentiles
from skyfold.operators.spatial import ARCSEC, CELLS_PER_RADIUS, as_points, with_cell
from skyfold.session import discard, materialize

SIGMAS = 3.0
REMOVALS = 2
ROUNDING = 1e-13
HALF_WINDOW = 5.0
CONE_DEG = 1.2
MATCH_ARCSEC = 0.5


def merge_reference(detections: DataFrame, reference: DataFrame, det_id: str, ref_id: str, arcsec: float = 1.0) -> DataFrame:
    """Nearest detection of each *reference* row within (strictly) ``arcsec``.

    Reference positions become ``RA_REF, DEC_REF``. A detection may serve several reference rows.
    """
    det_cols = [c for c in detections.columns if c != det_id]
    ref = reference.withColumnsRenamed({"RA": "RA_REF", "DEC": "DEC_REF"})
    ref_cols = [c for c in ref.columns if c != ref_id]
    radius = arcsec * ARCSEC
    owners = as_points(detections.withColumn("row", F.struct(*det_cols)), det_id, keep=["row"]).withColumn("scope", F.lit(0))
    seekers = as_points(ref.withColumn("_ref", F.struct(*ref_cols)), ref_id, "RA_REF", "DEC_REF", keep=["_ref"])
    seekers = with_cell(seekers, min(radius * CELLS_PER_RADIUS, 180.0), name="_home").withColumn("kept", F.struct("_home", "_ref"))
    near = nearest_in_cells(owners, seekers, radius)
    best = near.groupBy("kept._home", "seeker").agg(F.min(F.struct("d2", "owner", "row")).alias("_b"), F.first("kept._ref").alias("_a"))
    return best.select(
        F.col("seeker").alias(ref_id), F.col("_b.owner").alias(det_id), chord_to_angle(F.col("_b.d2")).alias("sep"), "_a.*", "_b.row.*"
    )


def merge_reference_by_exposure(
    detections: DataFrame, reference: DataFrame, exposures: DataFrame, det_id: str, ref_id: str,
    arcsec: float = MATCH_ARCSEC, cone_deg: float = CONE_DEG, nside: int = 32,
) -> DataFrame:
    """The same match done inside each exposure, for all exposures at once.

    Detections meet reference rows in one cell join that does not know of exposures, so a reference row is copied for
    the cells it touches and never for the exposures that see it. Only the nearest detection of each exposure leaves a
    cell. It counts when the exposure's cone holds the reference row's shard pixel.
    """
    ref = with_pixel(reference.withColumnsRenamed({"RA": "RA_REF", "DEC": "DEC_REF"}), nside, "RA_REF", "DEC_REF", name="_hpx")
    ref_cols, det_cols = ([c for c in df.columns if c not in (key, "EXPNUM", "_hpx")] for df, key in ((ref, ref_id), (detections, det_id)))
    owners = as_points(detections.withColumnsRenamed({"EXPNUM": "scope"}).withColumn("row", F.struct(*det_cols)), det_id, keep=["scope", "row"])
    seekers = as_points(ref.withColumn("kept", F.struct("_hpx", F.struct(*ref_cols).alias("_ref"))), ref_id, "RA_REF", "DEC_REF", keep=["kept"])
    near = nearest_in_cells(owners, seekers, arcsec * ARCSEC)
    pairs = near.select(F.col("scope").alias("EXPNUM"), F.col("seeker").alias(ref_id), "kept._hpx", "kept._ref", F.struct("d2", F.col("owner").alias("did"), "row").alias("_near"))
    cones = disc_pixels(exposures.select("EXPNUM", "TELRA", "TELDEC"), nside, "TELRA", "TELDEC", cone_deg, inclusive=True, name="_hpx")
    seen = pairs.join(cones.select("EXPNUM", "_hpx").distinct(), ["EXPNUM", "_hpx"], "left_semi")
    best = seen.groupBy("EXPNUM", ref_id).agg(F.min("_near").alias("_b"), F.first("_ref").alias("_a"))
    return best.select("EXPNUM", ref_id, F.col("_b.did").alias(det_id), chord_to_angle(F.col("_b.d2")).alias("sep"), "_a.*", "_b.row.*")


def add_standard_mag(
    df: DataFrame, coefficients: str | Mapping = "refcat", tables: Mapping | None = None, transform: str = "linear", bands: Sequence[str] = ("g", "r", "i", "z", "Y")
) -> DataFrame:
    """``MAG_STD, MAGERR_STD, STD_OK`` from the reference columns, chosen by the row's band.

    ``tables`` maps a band to its (north, south) curves for ``transform="interp"``.
    """
    if transform == "linear":
        made = {b: linear_transform(b, coefficients) for b in bands}
    else:
        made = {b: interpolated_transform(b, *tables[b]) for b in bands if b in tables}
    band = F.rtrim("BAND")
    picks = [by_band(band, {b: m[k] for b, m in made.items()}) for k in range(3)]
    return df.withColumns({"MAG_STD": picks[0], "MAGERR_STD": picks[1], "STD_OK": F.coalesce(picks[2], F.lit(False))})


def compare_transforms(df: DataFrame, tables: Mapping, coefficients: str | Mapping = "refcat") -> DataFrame:
    """Both transforms side by side and their difference."""
    bands = tuple(tables)
    linear = add_standard_mag(df, coefficients, bands=bands).withColumnsRenamed({"MAG_STD": "MAG_LINEAR", "MAGERR_STD": "ERR_LINEAR", "STD_OK": "OK_LINEAR"})
    both = add_standard_mag(linear, tables=tables, transform="interp").withColumnsRenamed({"MAG_STD": "MAG_INTERP", "MAGERR_STD": "ERR_INTERP", "STD_OK": "OK_INTERP"})
    return both.withColumn("MAG_DELTA", F.col("MAG_LINEAR") - F.col("MAG_INTERP"))


def clip_limits(df: DataFrame, keys: Sequence[str], value: str, sigmas: float = SIGMAS, removals: int = REMOVALS) -> DataFrame:
    """Written table of each group's mean and sample deviation before each removal: ``_m0, _s0, _m1, _s1, ...``

    Counts, means and squared deviations merge, so they come from partial sums, and what a removal takes away is summed
    over the removed rows alone and subtracted. ``df`` is read once for each removal and should be a written table.
    """
    v = F.col(value).cast("double")
    moments = lambda n, m, q: (F.count(v).alias(n), F.avg(v).alias(m), (F.var_pop(v) * F.count(v)).alias(q))
    deviation = F.when(F.col("_n") > 1, F.sqrt(F.col("_q") / (F.col("_n") - 1)))
    now = materialize(df.groupBy(*keys).agg(*moments("_n", "_m0", "_q")).withColumn("_s0", deviation), "moments")
    for k in range(1, removals):
        gone = df.join(now, list(keys)).where(outlying(value, k, sigmas) & ~outlying(value, k - 1, sigmas)).groupBy(*keys).agg(*moments("_r", "_a", "_b"))
        n, r, m = F.col("_n"), F.coalesce("_r", F.lit(0)), F.col(f"_m{k - 1}")
        both = now.join(gone, list(keys), "left").withColumn(f"_m{k}", F.when(r == 0, m).otherwise(F.try_divide(n * m - r * F.col("_a"), n - r)))
        left = F.col("_q") - F.col("_b") - F.pow(F.col("_a") - F.col(f"_m{k}"), 2) * (n - r) * r / n
        both = both.withColumns({"_q": F.when(r == 0, F.col("_q")).otherwise(F.greatest(left, F.lit(0.0))), "_n": n - r})
        last, now = now, materialize(both.withColumn(f"_s{k}", deviation).drop("_r", "_a", "_b"), "moments")
        discard(last)
    return now.drop("_n", "_q")


def outlying(value: str, removals: int, sigmas: float) -> Column:
    """Whether one of the removals takes the row, given the columns of :func:`clip_limits`; unknown deviations take none.

    A distance from the mean that is rounding alone, as among equal values, takes no row either.
    """
    far = F.lit(False)
    for k in range(removals):
        apart = F.abs(F.col(value) - F.col(f"_m{k}"))
        beyond = (apart > sigmas * F.col(f"_s{k}")) & (apart > ROUNDING * F.abs(f"_m{k}")) & ~F.isnan(f"_s{k}")
        far = far | F.coalesce(beyond, F.lit(False))
    return far


def clip_groups(df: DataFrame, keys: Sequence[str], value: str, sigmas: float = SIGMAS, removals: int = REMOVALS) -> DataFrame:
    """Removes rows further than ``sigmas`` sample deviations from their group mean, ``removals`` times.

    A group of one has no deviation and is kept. A row whose key is null belongs to no group and goes.
    """
    if not removals:
        return df
    limits = clip_limits(df, keys, value, sigmas, removals)
    return df.join(limits, list(keys)).where(~outlying(value, removals, sigmas)).select(*df.columns)


def zeropoint_statistics(df: DataFrame, keys: Sequence[str], value: str = "MAG_DIFF") -> DataFrame:
    """Median, mean, sample deviation, error of the mean and count."""
    n = F.count(value)
    extra = [
        F.avg(value).alias("MAG_ZERO_MEAN"), F.stddev_samp(value).alias("MAG_ZERO_STD"),
        F.try_divide(F.stddev_samp(value), F.sqrt(n - 1)).alias("MAG_ZERO_MEAN_ERR"), n.cast("int").alias("MAG_ZERO_NUM"),
    ]
    return exact_percentiles(df, keys, {"MAG_ZERO_MEDIAN": (value, 0.5)}, extra=extra)


def calibration_differences(df: DataFrame, scope: Sequence[str] = ("EXPNUM",), keep: Sequence[str] = ("EXPNUM", "CCDNUM")) -> DataFrame:
    """Written ``keep`` columns and ``MAG_DIFF`` of usable rows, kept within 5 mag of the median of their scope (one exposure)."""
    usable = df.where(F.col("STD_OK")).where(calibration_star("MAG_STD"))
    narrow = usable.select(*dict.fromkeys([*scope, *keep]), (F.col("MAG_STD") + 2.5 * F.log10(F.col("FLUX_PSF").cast("double"))).alias("MAG_DIFF"))
    obs = materialize(narrow, "differences")
    centre = exact_percentiles(obs, list(scope), {"_centre": ("MAG_DIFF", 0.5)})
    near = inside(F.col("MAG_DIFF") - F.col("_centre"), -HALF_WINDOW, HALF_WINDOW)
    kept = materialize(obs.join(centre, list(scope)).where(near).drop("_centre"), "differences")
    discard(obs)
    return kept


#: What zeropoints need of a detection and of a reference row, where it is there.
DETECTION_COLUMNS = ("EXPNUM", "CCDNUM", "BAND", "EXPTIME", "FILENAME", "T_EFF", "RA", "DEC", "FLUX_PSF", "FLUXERR_PSF", "FLAGS", "SPREAD_MODEL")
REFERENCE_COLUMNS = ("RA", "DEC", "G", "R", "I", "Z", "DG", "DR", "DI", "DZ")


def derive_zeropoints(
    df: DataFrame, coefficients: str | Mapping = "refcat", tables: Mapping | None = None, transform: str = "linear",
    scope: Sequence[str] = ("EXPNUM",), removals: int = REMOVALS,
) -> DataFrame:
    """Zeropoint statistics per CCD from detections merged with the reference catalog.

    The differences are written once as a narrow table; clipping and statistics read only that.
    """
    keys = ["EXPNUM", "CCDNUM", "BAND", "EXPTIME"] + [c for c in ("FILENAME", "T_EFF") if c in df.columns]
    obs = calibration_differences(add_standard_mag(df, coefficients, tables, transform), scope, keys)
    return zeropoint_statistics(clip_groups(obs, ["EXPNUM", "CCDNUM"], "MAG_DIFF", removals=removals), keys)


def calibrate(
    detections: DataFrame, reference: DataFrame, exposures: DataFrame, det_id: str, ref_id: str, select: Column | None = None,
    coefficients: str | Mapping = "refcat", tables: Mapping | None = None, transform: str = "linear",
    arcsec: float = MATCH_ARCSEC, cone_deg: float = CONE_DEG, nside: int = 32,
) -> DataFrame:
    """Zeropoints of all exposures in one job, from detections and a reference catalog.

    Selects detections, matches them with the reference rows in the cone of their exposure, transforms the reference
    magnitudes to the band of each detection, and gives the clipped statistics of each CCD. Only the columns that this
    needs are read and shuffled. Exposures without usable matches have no rows: see :func:`failed_exposures`.
    """
    chosen = detections if select is None else detections.where(select)
    narrow = lambda df, key, wanted: df.select(key, *[c for c in wanted if c in df.columns and c != key])
    merged = merge_reference_by_exposure(
        narrow(chosen, det_id, DETECTION_COLUMNS), narrow(reference, ref_id, REFERENCE_COLUMNS), exposures, det_id, ref_id, arcsec, cone_deg, nside
    )
    return derive_zeropoints(merged, coefficients, tables, transform)


def failed_exposures(exposures: DataFrame, zeropoints: DataFrame) -> DataFrame:
    """Exposures that gave no zeropoint."""
    return exposures.join(zeropoints.select("EXPNUM").distinct(), "EXPNUM", "left_anti")


