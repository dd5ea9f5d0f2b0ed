"""Column names, bands, sentinels and output schemas."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Bands, sentinels and defaults that readers of the catalog rely on.
BANDS = ["g", "r", "i", "z", "Y"]
MIN_BANDS = 2
BAD_MAG = 99.0
BAD_VALUE = -1
BAD_ZP_FLAG = 2
OBJECT_ID = "QUICK_OBJECT_ID"
UNIQUE_ID = "UNIQUE_ID"
HPX_NSIDE = 2048
RADEC_ALIASES = [("RA", "DEC"), ("RA", "Dec"), ("ALPHAWIN_J2000", "DELTAWIN_J2000")]

MAGS = ["MAG_PSF", "MAGERR_PSF", "MAG_AUTO", "MAGERR_AUTO"]
BEST_COLUMNS = MAGS + [
    "SPREAD_MODEL", "SPREADERR_MODEL", "CLASS_STAR", "FLAGS", "EXPNUM", "CCDNUM",
    "T_EFF", "EXPTIME", "A_IMAGE", "B_IMAGE", "THETA_IMAGE",
]
WAVG_COLUMNS = [
    "WAVG_MAG_PSF", "WAVG_MAGERR_PSF", "WAVG_MAGRMS_PSF",
    "WAVG_MAG_AUTO", "WAVG_MAGERR_AUTO", "WAVG_MAGRMS_AUTO",
    "WAVG_SPREAD_MODEL", "WAVG_SPREADERR_MODEL", "WAVG_SPREADRMS_MODEL", "WAVG_FLAGS",
]

DETECTION_SCHEMA = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in [
            ("FILENAME", T.StringType()), ("PFW_ATTEMPT_ID", T.LongType()), ("TAG", T.StringType()),
            ("UNITNAME", T.StringType()), ("REQNUM", T.IntegerType()), ("ATTNUM", T.ShortType()),
            ("EXPNUM", T.LongType()), ("CCDNUM", T.ShortType()), ("BAND", T.StringType()),
            ("T_EFF", T.FloatType()), ("FWHM_WORLD", T.FloatType()), ("FLAGS", T.ShortType()),
            ("OBJECT_NUMBER", T.IntegerType()), ("RA", T.DoubleType()), ("DEC", T.DoubleType()),
            ("FLUX_PSF", T.FloatType()), ("FLUXERR_PSF", T.FloatType()), ("FLUX_AUTO", T.FloatType()),
            ("FLUXERR_AUTO", T.FloatType()), ("A_IMAGE", T.FloatType()), ("B_IMAGE", T.FloatType()),
            ("THETA_IMAGE", T.FloatType()), ("CLASS_STAR", T.FloatType()), ("SPREAD_MODEL", T.FloatType()),
            ("SPREADERR_MODEL", T.FloatType()), ("IMAFLAGS_ISO", T.ShortType()), ("MJD_OBS", T.DoubleType()),
            ("EXPTIME", T.FloatType()),
        ]
    ]
)


def band_column(field: str, band: str) -> str:
    """``FIELD_BAND`` in upper case."""
    return f"{field}_{band.strip()}".upper()


def band_columns(fields: str | Iterable[str], bands: str | Iterable[str]) -> list[str]:
    """Field-major product of fields and bands."""
    fields = [fields] if isinstance(fields, str) else list(fields)
    bands = [bands] if isinstance(bands, str) else list(bands)
    return [band_column(f, b) for f, b in product(fields, bands)]


def footprint_columns(bands: Iterable[str] = BANDS, extclass: bool = False, deredden: bool = False) -> list[str]:
    """Columns the footprint maps need."""
    bands = list(bands)
    names = ["RA", "DEC"] + band_columns("WAVG_MAG_PSF", bands)
    if extclass:
        names += band_columns("EXTENDED_CLASS", bands)
    if deredden:
        names += band_columns("EXTINCTION", bands)
    return names


def catalog_schema(bands: Iterable[str] = BANDS) -> list[tuple[str, T.DataType, object]]:
    """Ordered ``(name, type, default)`` of the object catalog."""
    bands = list(bands)
    long_, short, int_ = T.LongType(), T.ShortType(), T.IntegerType()
    real, double = T.FloatType(), T.DoubleType()
    nan = float("nan")
    out: list[tuple[str, T.DataType, object]] = [
        (OBJECT_ID, long_, -1), ("RA", double, nan), ("DEC", double, nan), ("MJD_OBS", double, nan),
        (f"HPX{HPX_NSIDE}", long_, -1),
    ]
    per_band = [
        (["NEPOCHS"], short, 0), (MAGS, real, BAD_MAG), (["SPREAD_MODEL"], real, -1.0),
        (["SPREADERR_MODEL"], real, 1.0), (["CLASS_STAR"], real, -1.0), (["FLAGS"], short, 99),
        (WAVG_COLUMNS[:6], real, BAD_MAG), (["WAVG_SPREAD_MODEL"], real, -1.0),
        (["WAVG_SPREADERR_MODEL", "WAVG_SPREADRMS_MODEL"], real, 1.0), (["WAVG_FLAGS"], short, 99),
        (["EXPNUM", "CCDNUM"], int_, -1), (["T_EFF", "EXPTIME"], real, -1.0),
        (["A_IMAGE", "B_IMAGE", "THETA_IMAGE"], real, -1.0),
    ]
    for fields, kind, default in per_band:
        out += [(name, kind, default) for name in band_columns(fields, bands)]
    out.append(("EBV", real, -1.0))
    out += [(name, real, -1.0) for name in band_columns("EXTINCTION", bands)]
    out += [(name, short, -9) for name in band_columns("EXTENDED_CLASS", bands)]
    return out


def typed_default(df: DataFrame, name: str, kind: T.DataType, default: object) -> Column:
    """``df[name]`` cast to its output type with the sentinel in place of NULL or an absent column."""
    if name not in df.columns:
        return F.lit(default).cast(kind).alias(name)
    return F.coalesce(F.col(name).cast(kind), F.lit(default).cast(kind)).alias(name)


def apply_catalog_schema(df: DataFrame, bands: Iterable[str] = BANDS) -> DataFrame:
    return df.select(*[typed_default(df, *entry) for entry in catalog_schema(bands)])


def catalog_struct(bands: Iterable[str] = BANDS) -> T.StructType:
    """The object catalog as a schema: order, types, and no column that may be null."""
    return T.StructType([T.StructField(name, kind, False) for name, kind, _ in catalog_schema(bands)])


def checked_catalog(df: DataFrame, bands: Iterable[str] = BANDS, required: Iterable[str] = (OBJECT_ID, "RA", "DEC")) -> DataFrame:
    """``df`` in the catalog's schema, checked when the plan is made.

    Absent columns get their default and nulls theirs, so the result has the order, types and nullability of
    :func:`catalog_struct`. A missing required column, a name that is there twice and a column whose type cannot be
    cast raise at once; numbers that their type does not hold raise when they are written.
    """
    bands = list(bands)
    require_columns(df, required)
    names = [n.lower() for n in df.columns]
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"columns listed twice: {twice}")
    numbers = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    kinds = dict(df.dtypes)
    if odd := [n for n, _, _ in catalog_schema(bands) if n in kinds and kinds[n] not in numbers and not kinds[n].startswith("decimal")]:
        raise ValueError(f"columns that are no numbers: {odd}")
    out = apply_catalog_schema(df, bands)
    if [(f.name, f.dataType) for f in out.schema] != [(f.name, f.dataType) for f in catalog_struct(bands)] or any(f.nullable for f in out.schema):
        raise ValueError("the catalog differs from its schema")
    return out


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
