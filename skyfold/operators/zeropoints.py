"""Zeropoint tables and calibrated magnitudes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from skyfold.functions.coords import angular_separation
from skyfold.functions.guards import above, below
from skyfold.functions.photometry import flux_to_mag, flux_to_magerr
from skyfold.functions.staging import fixed
from skyfold.schema import BAD_MAG, BAD_ZP_FLAG

KEY = ["EXPNUM", "CCDNUM"]
CCDS = (1, 62)
# Zeropoints of the constant table; other bands get 1.0.
CONSTANT_ZEROPOINTS = {"i": 30.0, "z": 29.67}


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def load_blacklist(tables: DataFrame | Sequence[DataFrame]) -> DataFrame:
    """Stacked exclusion lists with upper-case names."""
    tables = [tables] if isinstance(tables, DataFrame) else list(tables)
    out = upper_names(tables[0])
    for other in tables[1:]:
        out = out.unionByName(upper_names(other), allowMissingColumns=True)
    return out


def load_zeropoints(df: DataFrame, blacklist: DataFrame | None = None) -> DataFrame:
    """Usable zeropoints: sign turned when over 90% are negative, positive, flag 0, not blacklisted."""
    zp = upper_names(df)
    negative = zp.agg(F.avg(below(F.col("MAG_ZERO"), 0.0).cast("int"))).scalar()
    zp = zp.withColumn("MAG_ZERO", F.when(negative > 0.90, -F.col("MAG_ZERO")).otherwise(F.col("MAG_ZERO")))
    zp = zp.where(above(F.col("MAG_ZERO"), 0.0) & (F.col("ZP_FLAG") == 0))
    return zp if blacklist is None else without_blacklisted(zp, blacklist)


def without_blacklisted(df: DataFrame, blacklist: DataFrame) -> DataFrame:
    return df.join(upper_names(blacklist).select(*KEY).distinct(), KEY, "left_anti")


def unique_zeropoints(zp: DataFrame) -> DataFrame:
    """One zeropoint per key: smallest error, then smallest value."""
    others = [c for c in zp.columns if c not in KEY]
    ranked = F.struct(F.coalesce(F.col("SIGMA_MAG_ZERO"), F.lit(float("inf"))).alias("_s"), F.col("MAG_ZERO").alias("_m"), *others)
    return zp.groupBy(*KEY).agg(F.min(ranked).alias("_r")).select(*KEY, *[F.col(f"_r.{c}").alias(c) for c in others])


def apply_zeropoints(df: DataFrame, zp: DataFrame) -> DataFrame:
    """Calibrated magnitudes and errors; rows without a zeropoint carry sentinels.

    The zeropoint side is one row per (EXPNUM, CCDNUM). It is not hinted: Spark broadcasts it when its
    measured size allows and otherwise shuffles, splitting skewed exposures.
    """
    side = unique_zeropoints(zp.select(*KEY, "MAG_ZERO", "SIGMA_MAG_ZERO", "ZP_FLAG"))
    side = side.withColumnsRenamed({"MAG_ZERO": "_mz", "SIGMA_MAG_ZERO": "_sz", "ZP_FLAG": "_fz"}).withColumn("_hit", F.lit(True))
    joined = df.join(side, KEY, "left")
    hit = F.col("_hit").isNotNull()
    new = {}
    for kind in ("PSF", "AUTO"):
        flux, error = F.col(f"FLUX_{kind}"), F.col(f"FLUXERR_{kind}")
        new[f"MAG_{kind}"] = F.when(hit, flux_to_mag(flux, F.col("_mz"))).otherwise(F.lit(BAD_MAG))
        new[f"MAGERR_{kind}"] = F.when(hit, flux_to_magerr(flux, error)).otherwise(F.lit(BAD_MAG))
    new["MAG_ZERO"] = F.when(hit, F.col("_mz").cast("double")).otherwise(F.lit(BAD_MAG))
    new["SIGMA_MAG_ZERO"] = F.when(hit, F.col("_sz").cast("double")).otherwise(F.lit(BAD_MAG))
    new["ZP_FLAG"] = F.when(hit, F.col("_fz").cast("int")).otherwise(F.lit(BAD_ZP_FLAG))
    # Computed once: a later filter on magnitudes would otherwise copy these expressions into each of its conditions.
    staged = fixed(joined, {f"_n_{c}": value for c, value in new.items()})
    names = [c for c in joined.columns if c not in ("_mz", "_sz", "_fz", "_hit")]
    return staged.select(*[F.col(f"_n_{c}").alias(c) if c in new else c for c in names], *[F.col(f"_n_{c}").alias(c) for c in new if c not in names])


def zeropoint_pairs(first: DataFrame, second: DataFrame, pos=("RA", "DEC")) -> DataFrame:
    """Two zeropoint sets joined on (EXPNUM, CCDNUM): ``dzero`` and separation of the CCD centres."""
    a = first.select(*KEY, "BAND", F.col("MAG_ZERO").alias("zero_1"), F.col(pos[0]).alias("ra_1"), F.col(pos[1]).alias("dec_1"))
    b = second.select(*KEY, F.col("MAG_ZERO").alias("zero_2"), F.col(pos[0]).alias("ra_2"), F.col(pos[1]).alias("dec_2"))
    sep = angular_separation(F.col("ra_1"), F.col("dec_1"), F.col("ra_2"), F.col("dec_2"))
    return a.join(b, KEY).withColumns({"dzero": F.col("zero_1") - F.col("zero_2"), "sep": sep})


def unpaired_zeropoints(first: DataFrame, second: DataFrame) -> DataFrame:
    """Keys that do not pair one to one; empty when the sets agree."""
    a = first.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_1"))
    b = second.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_2"))
    both = a.join(b, KEY, "full_outer").na.fill(0, ["n_1", "n_2"])
    return both.where((F.col("n_1") != 1) | (F.col("n_2") != 1))


def constant_zeropoints(exposures: DataFrame) -> DataFrame:
    """A constant zeropoint for every exposure and CCD."""
    zero = F.lit(1.0)
    for band, value in CONSTANT_ZEROPOINTS.items():
        zero = F.when(F.col("band") == band, F.lit(value)).otherwise(zero)
    return exposures.select(
        F.lit("").alias("FILENAME"), F.col("expnum").alias("EXPNUM"), F.explode(F.sequence(F.lit(CCDS[0]), F.lit(CCDS[1]))).alias("CCDNUM"),
        F.col("band").alias("BAND"), zero.alias("MAG_ZERO"), F.lit(float("nan")).alias("SIGMA_MAG_ZERO"), F.col("telra").alias("RA_MEAN"),
        F.col("teldec").alias("DEC_MEAN"), F.lit(0).alias("NCALSTARS"), F.lit(0).cast("short").alias("QSLR_FLAG"),
    )


def lookup_exposure(df: DataFrame, exposures: DataFrame, columns: Sequence[str] = ("MJD_OBS", "EXPTIME")) -> DataFrame:
    """Columns of the exposure list by EXPNUM. Every row must find its exposure, and only once."""
    side = exposures.groupBy("EXPNUM").agg(*[F.first(c).alias(c) for c in columns], F.count(F.lit(1)).alias("_times"))
    kept = df.drop(*columns)
    joined = kept.join(side, "EXPNUM", "left")
    complaint = F.raise_error(F.format_string("exposure %s is missing or listed twice", F.col("EXPNUM").cast("string")))
    checked = F.when(F.coalesce(F.col("_times"), F.lit(0)) == 1, F.col(columns[0])).otherwise(complaint.cast(dict(exposures.dtypes)[columns[0]]))
    return joined.withColumn(columns[0], checked).drop("_times")


def update_from_exposures(df: DataFrame, exposures: DataFrame, column: str = "TAG") -> DataFrame:
    """Replaces a column by the exposure list's value where it has one."""
    side = exposures.groupBy("EXPNUM").agg(F.max(column).alias("_new"))
    return df.join(side, "EXPNUM", "left").withColumn(column, F.coalesce(F.col("_new"), F.col(column))).drop("_new")


def bad_ccds(df: DataFrame, threshold: float = 0.15, limit: float = -0.005) -> DataFrame:
    """(expnum, ccdnum) where too many detections have a very negative spread."""
    share = F.avg(below(F.col("SPREAD_MODEL"), limit).cast("int"))
    ccds = df.where(F.col("CCDNUM").between(*CCDS)).groupBy(*KEY).agg(share.alias("_share"))
    return ccds.where(F.col("_share") > threshold).select(F.col("EXPNUM").alias("expnum"), F.col("CCDNUM").alias("ccdnum"))
