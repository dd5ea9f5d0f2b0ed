"""Positions on the sphere as column expressions. Angles are degrees."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# J2000 equatorial to galactic rotation.
GALACTIC_ROTATION = (
    (-0.0548755604, -0.8734370902, -0.4838350155),
    (0.4941094279, -0.4448296300, 0.7469822445),
    (-0.8676661490, -0.1980763734, 0.4559837762),
)


def unit_vector(lon: Column, lat: Column) -> tuple[Column, Column, Column]:
    lonr, latr = F.radians(lon), F.radians(lat)
    return F.cos(lonr) * F.cos(latr), F.sin(lonr) * F.cos(latr), F.sin(latr)


def with_vector(df: DataFrame, lon: str = "RA", lat: str = "DEC", names=("x", "y", "z")) -> DataFrame:
    return df.withColumns(dict(zip(names, unit_vector(F.col(lon), F.col(lat)))))


def vector_lonlat(x: Column, y: Column, z: Column) -> tuple[Column, Column]:
    """Direction of a vector of any length, longitude in [0, 360)."""
    lon = F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0))
    return lon, F.degrees(F.atan2(z, F.sqrt(x * x + y * y)))


def chord(radius_deg: float) -> float:
    """Straight-line distance between unit vectors ``radius_deg`` apart."""
    return 2.0 * math.sin(math.radians(radius_deg) / 2.0)


def chord_to_angle(chord2: Column) -> Column:
    """Angle in degrees from a squared chord."""
    return F.degrees(2.0 * F.asin(F.least(F.sqrt(chord2) / 2.0, F.lit(1.0))))


def angular_separation(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    dlat = F.radians(lat2 - lat1) / 2.0
    dlon = F.radians(lon2 - lon1) / 2.0
    hav = F.pow(F.sin(dlat), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), F.lit(2.0))
    return F.degrees(2.0 * F.asin(F.least(F.sqrt(hav), F.lit(1.0))))


def galactic_vector(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    return tuple(F.lit(a) * x + F.lit(b) * y + F.lit(c) * z for a, b, c in GALACTIC_ROTATION)


def equatorial_to_galactic(lon: Column, lat: Column) -> tuple[Column, Column]:
    return vector_lonlat(*galactic_vector(*unit_vector(lon, lat)))


def tile_position(tile: Column) -> tuple[Column, Column]:
    """RA and DEC of a tile named ``XXXhhmm+ddmm``; "-00" keeps its sign."""
    number = lambda start: F.substring(tile, start, 2).cast("double")
    ra = (number(4) + number(6) / 60.0) * 15.0
    size = number(9) + number(11) / 60.0
    return ra, F.when(F.substring(tile, 8, 1) == "-", -size).otherwise(size)


def exposure_ccd_uid(expnum: Column, ccdnum: Column) -> Column:
    return expnum + ccdnum / F.lit(100.0)


def split_exposure_ccd_uid(uid: Column) -> tuple[Column, Column]:
    expnum = F.floor(uid)
    return expnum.cast("long"), F.round(100.0 * (uid - expnum)).cast("int")
