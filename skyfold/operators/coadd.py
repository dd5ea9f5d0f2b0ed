"""From calibrated detections to one row per object.

Everything per (object, band) comes from one hash aggregation with map-side partial sums; the bands are then
pivoted by conditional aggregation over at most one row per band.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyfold.functions.classes import spread_class
from skyfold.functions.coords import unit_vector, vector_lonlat
from skyfold.functions.guards import below
from skyfold.functions.healpix import with_pixel
from skyfold.functions.photometry import extinction
from skyfold.functions.selections import band_count, good_object
from skyfold.operators.maps import interpolate_map
from skyfold.operators.quantiles import HOT_GROUP_ROWS, exact_percentiles
from skyfold.schema import (
    BAD_MAG, BANDS, BEST_COLUMNS, HPX_NSIDE, MIN_BANDS, OBJECT_ID, UNIQUE_ID, apply_catalog_schema, band_column, band_columns, checked_catalog,
)


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.try_divide(F.sum(weight * value), F.sum(weight))


def weighted_scatter(value: Column, weight: Column) -> Column:
    """Reliability-weighted standard deviation; the largest error for a group of one.

    The weighted sum of squares around the weighted mean m is  n (cov(w v, v) - m cov(w, v)),  and both
    covariances are central moments that merge between partial aggregates without cancellation, so one pass gives
    what the textbook two passes give.
    """
    n, v1, v2 = F.count(value), F.sum(weight), F.sum(weight * weight)
    mean = F.try_divide(F.sum(weight * value), v1)
    squares = n * (F.covar_pop(weight * value, value) - mean * F.covar_pop(weight, value))
    variance = F.try_divide(F.greatest(squares, F.lit(0.0)) * v1, v1 * v1 - v2)
    return F.when(n > 1, F.sqrt(variance)).otherwise(F.max(F.sqrt(F.try_divide(F.lit(1.0), weight))))


def quadrature_error(error: Column) -> Column:
    return F.sqrt(F.sum(error * error)) / F.count(error)


def weighted_statistics(value: str, error: str, names: Sequence[str]) -> list[Column]:
    """Weighted mean, quadrature error and weighted scatter; scatter that cannot be computed is the sentinel."""
    v, e = F.col(value).cast("double"), F.col(error).cast("double")
    w = F.try_divide(F.lit(1.0), e * e)
    scatter = F.nanvl(F.coalesce(weighted_scatter(v, w), F.lit(BAD_MAG)), F.lit(BAD_MAG))
    return [weighted_mean(v, w).alias(names[0]), quadrature_error(e).alias(names[1]), scatter.alias(names[2])]


def coadd_mag(df: DataFrame, keys: Sequence[str], kind: str = "PSF") -> DataFrame:
    names = [f"WAVG_MAG_{kind}", f"WAVG_MAGERR_{kind}", f"WAVG_MAGRMS_{kind}"]
    return df.groupBy(*keys).agg(*weighted_statistics(f"MAG_{kind}", f"MAGERR_{kind}", names))


def coadd_spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    names = ["WAVG_SPREAD_MODEL", "WAVG_SPREADERR_MODEL", "WAVG_SPREADRMS_MODEL"]
    return df.groupBy(*keys).agg(*weighted_statistics("SPREAD_MODEL", "SPREADERR_MODEL", names))


def coadd_class(df: DataFrame, keys: Sequence[str], value: str = "CLASS_STAR") -> DataFrame:
    c = F.col(value).cast("double")
    return df.groupBy(*keys).agg(
        F.avg(c).alias("CLASS_AVG"), F.stddev_pop(c).alias("CLASS_STD"), F.min(c).alias("CLASS_MIN"), F.max(c).alias("CLASS_MAX")
    )


def low_bits_or(flags: str = "FLAGS") -> Column:
    """OR of the low eight bits."""
    return F.bit_or(F.col(flags).cast("int").bitwiseAND(F.lit(255)))


def coadd_flags(df: DataFrame, keys: Sequence[str], value: str = "FLAGS") -> DataFrame:
    return df.groupBy(*keys).agg(low_bits_or(value).alias("WAVG_FLAGS"))


def coadd_mjd(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return exact_percentiles(df, keys, {"MJD_OBS": ("MJD_OBS", 0.5)})


def coadd_coords(df: DataFrame, keys: Sequence[str], extra: dict[str, tuple[str, float]] | None = None, hot_rows: int | None = HOT_GROUP_ROWS) -> DataFrame:
    """Median direction of each object, and other percentiles of the same pass."""
    vectors = df.withColumns(dict(zip(("_x", "_y", "_z"), unit_vector(F.col("RA"), F.col("DEC")))))
    medians = exact_percentiles(vectors, keys, {c: (c, 0.5) for c in ("_x", "_y", "_z")} | (extra or {}), hot_rows)
    lon, lat = vector_lonlat(F.col("_x"), F.col("_y"), F.col("_z"))
    return medians.select(*keys, lon.alias("RA"), lat.alias("DEC"), *(extra or {}))


def coadd_healpix(df: DataFrame, nsides: Sequence[int] = (HPX_NSIDE,), lon: str = "RA", lat: str = "DEC") -> DataFrame:
    for nside in nsides:
        df = with_pixel(df, nside, lon, lat, nest=True, name=f"HPX{nside}")
    return df


def best_rows(df: DataFrame, keys: Sequence[str], score: Column, columns: Sequence[str], id_col: str, largest: bool = True) -> DataFrame:
    """Columns of the row with the largest (or smallest) score per group; ties go to the smallest id.

    Rows with a missing score come last.
    """
    row = F.struct(_place(-score if largest else score).alias("_score"), F.col(id_col).alias("_id"), *[F.col(c) for c in columns])
    return df.groupBy(*keys).agg(F.min(row).alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in columns])


def _place(score: Column) -> Column:
    """A score to take the smallest of, with NULL and NaN behind all others."""
    return F.coalesce(F.nanvl(score.cast("double"), F.lit(None).cast("double")), F.lit(float("inf")))


def epoch_score() -> Column:
    return F.col("T_EFF").cast("double") * F.col("EXPTIME").cast("double")


def coadd_bands(df: DataFrame, id_col: str, objid: str = OBJECT_ID) -> DataFrame:
    """One row per (object, band): epochs, best-epoch columns, weighted statistics, flag union, best id."""
    carried = [c for c in BEST_COLUMNS if c in df.columns]
    best = F.struct(_place(-epoch_score()).alias("_score"), F.col(id_col).alias("_best_id"), *[F.col(c) for c in carried])
    stats = df.groupBy(objid, "BAND").agg(
        F.count(F.lit(1)).alias("NEPOCHS"),
        F.min(best).alias("_best"),
        *weighted_statistics("MAG_PSF", "MAGERR_PSF", ["WAVG_MAG_PSF", "WAVG_MAGERR_PSF", "WAVG_MAGRMS_PSF"]),
        *weighted_statistics("MAG_AUTO", "MAGERR_AUTO", ["WAVG_MAG_AUTO", "WAVG_MAGERR_AUTO", "WAVG_MAGRMS_AUTO"]),
        *weighted_statistics("SPREAD_MODEL", "SPREADERR_MODEL", ["WAVG_SPREAD_MODEL", "WAVG_SPREADERR_MODEL", "WAVG_SPREADRMS_MODEL"]),
        low_bits_or().alias("WAVG_FLAGS"),
    )
    return stats.select("*", F.col("_best._best_id").alias("_best_id"), *[F.col(f"_best.{c}").alias(c) for c in carried]).drop("_best")


def pivot_bands(per_band: DataFrame, fields: Sequence[str], bands: Sequence[str], objid: str = OBJECT_ID, whole: bool = False) -> DataFrame:
    """One row per object from at most one row per (object, band).

    With ``whole`` a band travels as one struct: an aggregate of its own for each field and band makes code too long to
    be compiled once most of them are read, but lets the unread ones go.
    """
    if whole:
        row = F.struct(*[F.col(f) for f in fields])
        wide = per_band.groupBy(objid).agg(*[F.max(F.when(F.col("BAND") == b, row)).alias(f"_row_{b}") for b in bands])
        return wide.select(objid, *[F.col(f"_row_{b}").getField(f).alias(band_column(f, b)) for f in fields for b in bands])
    picks = [F.expr(f"max(CASE WHEN BAND = '{b}' THEN `{f}` END) AS `{band_column(f, b)}`") for f in fields for b in bands]
    return per_band.groupBy(objid).agg(*picks)


#: Objects of more rows than this are not brought together; rows are counted in so many slots of objects.
GATHERED_ROWS = 1_000_000
GATHER_SLOTS = 1 << 16


def crowded(df: DataFrame, objid: str = OBJECT_ID) -> bool:
    """Whether an object may have more than ``GATHERED_ROWS`` rows."""
    slots = df.groupBy(F.pmod(F.xxhash64(objid), F.lit(GATHER_SLOTS)).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    return (slots.agg(F.max("n")).first()[0] or 0) > GATHERED_ROWS


def coadd_objects(df: DataFrame, id_col: str, bands: Sequence[str] = BANDS, objid: str = OBJECT_ID, whole: bool = False, gather: bool = False) -> tuple[DataFrame, DataFrame]:
    """The object catalog and the table that ties detections to objects.

    In the key table ``UNIQUE_ID`` is the object id on the best epoch of each band and -1 elsewhere. ``whole`` is for
    readers of all columns (:func:`pivot_bands`). ``gather``, for a written table, brings the rows of an object
    together before they are added up: the partial sums of a row are several times as wide as the row, and few rows of an
    object meet in a task before. Where an object is crowded, partial sums are merged all the same.
    """
    trimmed = df.withColumn("BAND", F.rtrim("BAND"))
    gather = gather and not crowded(df, objid)
    if gather:
        trimmed = trimmed.repartition(objid)
    per_band = coadd_bands(trimmed.where(F.col("BAND").isin(list(bands))), id_col, objid)
    fields = [c for c in per_band.columns if c not in (objid, "BAND", "_best_id")]
    wide = pivot_bands(per_band, fields, bands, objid, whole)
    place = coadd_coords(trimmed, [objid], {"MJD_OBS": ("MJD_OBS", 0.5)}, None if gather else HOT_GROUP_ROWS)
    catalog = coadd_healpix(place).join(wide, objid, "left")
    best = per_band.select(objid, "BAND", F.col("_best_id").alias("_best_id"))
    index = [c for c in (id_col, objid, "BAND", "FILENAME", "OBJECT_NUMBER", "EXPNUM", "CCDNUM") if c in trimmed.columns]
    keys = df.withColumn("BAND", F.rtrim("BAND")).select(*index).join(best, [objid, "BAND"], "left")
    unique = F.when(F.col("_best_id") == F.col(id_col), F.col(objid)).otherwise(F.lit(-1)).cast("long")
    return catalog, keys.withColumn(UNIQUE_ID, unique).drop("_best_id")


def add_extinction(catalog: DataFrame, bands: Sequence[str], ebv_map: DataFrame, nside: int, coefficients="release1", galactic: bool = True) -> DataFrame:
    """``EBV`` interpolated from a map, and ``EXTINCTION_b``. ``galactic=False`` reads the map in equatorial coordinates."""
    out = interpolate_map(catalog, ebv_map, nside, OBJECT_ID, value="ebv", name="EBV", galactic=galactic)
    return out.withColumns({band_column("EXTINCTION", b): extinction(F.col("EBV"), b, coefficients) for b in bands})


def add_extended_class(catalog: DataFrame, bands: Sequence[str], variant: str = "default") -> DataFrame:
    return catalog.withColumns(
        {
            band_column("EXTENDED_CLASS", b): spread_class(F.col(band_column("SPREAD_MODEL", b)), F.col(band_column("SPREADERR_MODEL", b)), variant)
            for b in bands
        }
    )


def dereddened(catalog: DataFrame, bands: Sequence[str], fields: Sequence[str] = ("MAG_PSF", "MAG_AUTO", "WAVG_MAG_PSF", "WAVG_MAG_AUTO"), suffix: str = "SFD") -> DataFrame:
    """``MAG_SFD_b = MAG_b - EXTINCTION_b`` for each magnitude and band."""
    new = {}
    for field in fields:
        for b in bands:
            new[band_column(f"{field}_{suffix}", b)] = F.col(band_column(field, b)) - F.col(band_column("EXTINCTION", b))
    return catalog.withColumns(new)


def quality_cuts(catalog: DataFrame, keys: DataFrame | None = None, bands: Sequence[str] = BANDS, min_bands: int = MIN_BANDS, objid: str = OBJECT_ID):
    """Objects seen in enough bands, and their keys."""
    enough = band_count("MAG_PSF", bands) >= min_bands
    kept = catalog.where(enough)
    if keys is None:
        return kept
    return kept, keys.join(catalog.where(~enough).select(objid), objid, "left_anti")


def key_balance(catalog: DataFrame, keys: DataFrame, bands: Sequence[str] = BANDS) -> DataFrame:
    """One row: unique keys, valid band magnitudes, and whether they agree."""
    n_keys = keys.agg(F.count_if(F.col(UNIQUE_ID) > 0)).scalar()
    valid = [F.count_if(below(F.col(c), BAD_MAG)) for c in band_columns("MAG_PSF", bands)]
    n_mags = catalog.agg(sum(valid[1:], valid[0]).alias("n_mags"))
    return n_mags.select(n_keys.alias("n_keys"), "n_mags").withColumn("balanced", F.col("n_keys") == F.col("n_mags"))


def build_catalog(
    df: DataFrame, id_col: str, bands: Sequence[str] = BANDS, min_bands: int = MIN_BANDS, ebv_map: DataFrame | None = None, ebv_nside: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Good detections -> catalog in the output schema and key table."""
    catalog, keys = coadd_objects(df.where(good_object()), id_col, bands)
    catalog = apply_catalog_schema(catalog, bands)
    if ebv_map is not None:
        catalog = add_extinction(catalog, bands, ebv_map, ebv_nside)
    catalog = checked_catalog(add_extended_class(catalog, bands), bands)
    return quality_cuts(catalog, keys, bands, min_bands)
