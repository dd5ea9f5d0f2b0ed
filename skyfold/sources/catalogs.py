"""External catalogs, stored as parquet partitioned by ``hpx32`` (ring order)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyfold.functions.coords import angular_separation
from skyfold.functions.guards import above, at_most, below
from skyfold.functions.healpix import disc_pixels
from skyfold.functions.photometry import SPLIT_DEC, gaia_flux_to_ab, snr_to_magerr

NSIDE = 32
# Columns read from each catalog.
CATALOG_COLUMNS = {
    "gaia_dr1": ["SOURCE_ID", "RA", "DEC"], "gaia_dr2": ["SOURCE_ID", "RA", "DEC"], "gaia_edr3": ["SOURCE_ID", "RA", "DEC"],
    "gaia_dr3": ["SOURCE_ID", "RA", "DEC"], "atlas": ["OBJID", "RA", "DEC", "G"], "ps1": ["RA", "DEC"], "decals": ["OBJID", "RA", "DEC"],
}
REFERENCE_RENAMES = {
    "COADD_OBJECT_ID": "OBJID", "RA": "RA", "DEC": "DEC", "WAVG_MAG_PSF_G": "G", "WAVG_MAGERR_PSF_G": "DG", "WAVG_MAG_PSF_R": "R",
    "WAVG_MAGERR_PSF_R": "DR", "WAVG_MAG_PSF_I": "I", "WAVG_MAGERR_PSF_I": "DI", "WAVG_MAG_PSF_Z": "Z", "WAVG_MAGERR_PSF_Z": "DZ",
}
REFERENCE_LIMIT_R = 21.0
CONTRIBUTION_BITS = 2 | 4
SNR_NORTH, SNR_SOUTH = 30.0, 20.0


def catalog_columns(name: str) -> list[str]:
    name = name.lower()
    if name == "gaia":
        name = "gaia_dr2"
    for key in ("atlas", "ps1", "decals"):
        if key in name:
            name = key
    if name not in CATALOG_COLUMNS:
        raise ValueError(f"unrecognized catalog: {name}")
    return CATALOG_COLUMNS[name]


def cone_pixels(spark: SparkSession, ra: float, dec: float, radius_deg: float, nside: int = NSIDE) -> list[int]:
    """Pixels that touch one cone. The driver gets at most the pixel count of the shard resolution."""
    point = spark.range(1).select(F.lit(float(ra)).alias("ra"), F.lit(float(dec)).alias("dec"))
    rows = disc_pixels(point, nside, "ra", "dec", radius_deg, inclusive=True).select("pix").collect()
    return sorted(r.pix for r in rows)


def read_cone(table: DataFrame, ra: float, dec: float, radius_deg: float, columns: Sequence[str] | None = None, hpx: str = "hpx32", exact: bool = False) -> DataFrame:
    """Rows of the shards that touch a cone; ``exact`` also cuts at the radius. Literal pixels prune partitions."""
    pixels = cone_pixels(table.sparkSession, ra, dec, radius_deg)
    out = table.where(F.col(hpx).isin(pixels))
    if exact:
        out = out.where(angular_separation(F.col("RA"), F.col("DEC"), F.lit(float(ra)), F.lit(float(dec))) <= radius_deg)
    return out.select(*columns) if columns else out


def local_catalog(table: DataFrame, ra: float, dec: float, radius_deg: float, catalog: str) -> DataFrame:
    return read_cone(table, ra, dec, radius_deg, catalog_columns(catalog))


def rename_reference(df: DataFrame) -> DataFrame:
    """Another survey's columns under reference names, r < 21."""
    return df.where(below(F.col("WAVG_MAG_PSF_R"), REFERENCE_LIMIT_R)).select(*[F.col(a).alias(b) for a, b in REFERENCE_RENAMES.items()])


def clean_reference(df: DataFrame) -> DataFrame:
    """Quality and signal-to-noise cuts of the all-sky reference catalog."""
    keep = [F.coalesce(F.col("DUPVAR").isin(0, 2), F.lit(False))]
    north, south = above(F.col("DEC"), SPLIT_DEC), at_most(F.col("DEC"), SPLIT_DEC)
    for b in "GRIZ":
        keep.append(at_most(F.col(f"{b}CHI"), 10.0))
        keep.append(F.coalesce(F.col(f"{b}CONTRIB").bitwiseAND(F.lit(CONTRIBUTION_BITS)) > 0, F.lit(False)))
        keep.append(~north | at_most(F.col(f"D{b}"), snr_to_magerr(SNR_NORTH)))
        keep.append(~south | at_most(F.col(f"D{b}"), snr_to_magerr(SNR_SOUTH)))
    return df.where(reduce(lambda a, b: a & b, keep))


def catalog_pixel(table: DataFrame, pixel: int | Sequence[int], columns: Sequence[str], hpx: str = "hpx32") -> DataFrame:
    """One shard (or some) of a catalog."""
    pixels = [pixel] if isinstance(pixel, int) else list(pixel)
    return table.where(F.col(hpx).isin(pixels)).select(*columns)


def with_gaia_mag(df: DataFrame, version: str = "dr2") -> DataFrame:
    return df.withColumn("PHOT_G_MEAN_MAG_AB", gaia_flux_to_ab(F.col("PHOT_G_MEAN_FLUX"), version))
