"""Inputs shared by the registered queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyfold.functions.selections import good_object
from skyfold.operators.coadd import coadd_objects
from skyfold.operators.zeropoints import apply_zeropoints, load_zeropoints
from skyfold.plans import views
from skyfold.schema import BEST_COLUMNS, OBJECT_ID, catalog_schema
from skyfold.session import materialize


def rounded(df: DataFrame, names: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison with the oracle."""
    chosen = names or [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({n: F.round(F.col(n).cast("double"), digits) for n in chosen})


def as_long(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


def calibrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = materialize(views.zeropoints(spark, sf_dir).select("EXPNUM", "CCDNUM", "MAG_ZERO", "SIGMA_MAG_ZERO", "ZP_FLAG"), "zeropoints")
    usable = load_zeropoints(stored, views.blacklisted(stored))
    return apply_zeropoints(views.detections(spark, sf_dir), usable)


def good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated detections fit for the coadd, labelled by their true object."""
    return calibrated(spark, sf_dir).where(good_object()).withColumn(OBJECT_ID, F.col("TRUE_ID"))


def coadd_input(spark: SparkSession, sf_dir: str, best: Sequence[str] = BEST_COLUMNS) -> DataFrame:
    """Written: what the coadd reads of the good detections, with the wanted columns of best epochs."""
    used = ["det_id", OBJECT_ID, "BAND", "RA", "DEC", "MJD_OBS", "MAG_PSF", "MAGERR_PSF", "MAG_AUTO", "MAGERR_AUTO", "SPREAD_MODEL", "SPREADERR_MODEL", *best]
    return materialize(good(spark, sf_dir).select(*dict.fromkeys(used)), "good")


def objects(spark: SparkSession, sf_dir: str, best: Sequence[str] = BEST_COLUMNS, gather: bool = False) -> DataFrame:
    """Object catalog in the output schema, but in double precision, with TRUE_ID.

    Columns of best epochs that are not in ``best`` have their defaults. ``gather``: see :func:`coadd_objects`.
    """
    catalog, _ = coadd_objects(coadd_input(spark, sf_dir, best), "det_id", gather=gather)
    return _defaults(catalog).withColumn("TRUE_ID", F.col(OBJECT_ID))


def _defaults(catalog: DataFrame) -> DataFrame:
    out = []
    for name, kind, default in catalog_schema():
        wide = "double" if kind.typeName() == "float" else kind.simpleString()
        value = F.lit(default) if name not in catalog.columns else F.coalesce(F.col(name), F.lit(default))
        out.append(value.cast(wide).alias(name))
    return catalog.select(*out)
