import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyfold.functions import healpix as hp


@pytest.mark.parametrize("nside", [1, 2, 4, 8])
def test_every_center_returns_to_its_pixel(spark, nside):
    df = spark.range(hp.npix(nside)).withColumnRenamed("id", "p")
    ring = hp.with_pixel(hp.with_pixel_center(df, nside, "p"), nside, "lon", "lat", name="back")
    assert ring.where("p <> back").count() == 0
    nest = hp.with_pixel(hp.with_pixel_center(df, nside, "p", nest=True), nside, "lon", "lat", nest=True, name="back")
    assert nest.where("p <> back").count() == 0
    both = hp.ring_to_nest(hp.nest_to_ring(df, nside, "p", "r"), nside, "r", "n")
    assert both.where("p <> n").count() == 0
    assert both.select("r").distinct().count() == hp.npix(nside)


def test_large_nside_poles_and_belt(spark):
    rows = [(0.0, 90.0), (10.0, -90.0), (359.999, 89.9999), (45.0, 41.8103), (0.0, 0.0), (360.0, 0.0), (180.0, -41.8104)]
    df = spark.createDataFrame(rows, "lon double, lat double")
    out = hp.with_pixel(hp.with_pixel(df, 2048, "lon", "lat", name="r"), 2048, "lon", "lat", nest=True, name="n")
    out = hp.nest_to_ring(out, 2048, "n", "r2")
    got = out.collect()
    assert all(r.r == r.r2 and 0 <= r.r < hp.npix(2048) for r in got)
    assert got[4].r == got[5].r


def test_parent_is_the_coarser_pixel(spark):
    df = spark.range(5000).select(F.rand(1).alias("u"), F.rand(2).alias("v")).select((F.col("u") * 360).alias("RA"), F.degrees(F.asin(2 * F.col("v") - 1)).alias("DEC"))
    out = hp.with_pixel(hp.with_pixel(df, 2048, nest=True, name="fine"), 16, nest=True, name="coarse")
    assert out.where(hp.parent_pixel(F.col("fine"), 2048, 16) != F.col("coarse")).count() == 0
    ring = hp.degrade_ring(hp.with_pixel(df, 64, name="fr"), 64, 16, "fr", "up")
    assert hp.with_pixel(ring, 16, name="direct").where("up <> direct").count() == 0
    low, high = hp.nested_range(3, 16)
    assert (low, high) == (3 * 4**7, 4 * 4**7)


def test_interpolation_weights(spark):
    df = spark.range(4000).select(F.rand(3).alias("u"), F.rand(4).alias("v")).select((F.col("u") * 360).alias("lon"), F.degrees(F.asin(2 * F.col("v") - 1)).alias("lat"))
    df = df.union(spark.createDataFrame([(0.0, 90.0), (77.0, -90.0), (12.0, 89.99), (300.0, -89.99)], "lon double, lat double"))
    taps = hp.with_interpolation(df, 8, "lon", "lat").select("lon", "lat", F.inline("taps"))
    per = taps.groupBy("lon", "lat").agg(F.sum("weight").alias("s"), F.min("weight").alias("lo"), F.min("pix").alias("p0"), F.max("pix").alias("p1"))
    assert per.where((F.abs(F.col("s") - 1) > 1e-12) | (F.col("lo") < -1e-12) | (F.col("p0") < 0) | (F.col("p1") >= hp.npix(8))).count() == 0
    # at a pixel centre all weight falls on that pixel
    centers = hp.with_pixel_center(spark.range(hp.npix(8)).withColumnRenamed("id", "p"), 8, "p")
    top = hp.with_interpolation(centers, 8, "lon", "lat").select("p", F.inline("taps")).where("pix = p").groupBy("p").agg(F.sum("weight").alias("w"))
    assert top.where("abs(w - 1) > 1e-9").count() == 0 and top.count() == hp.npix(8)


@pytest.mark.parametrize("inclusive", [False, True])
def test_disc(spark, inclusive):
    centers = hp.with_pixel_center(spark.range(hp.npix(16)).withColumnRenamed("id", "p"), 16, "p").toPandas()
    lon, lat = np.radians(centers.lon), np.radians(centers.lat)
    vec = np.stack([np.cos(lon) * np.cos(lat), np.sin(lon) * np.cos(lat), np.sin(lat)], 1)
    for k, (ra, dec, r) in enumerate([(0.1, 5, 7.0), (200, 89, 6.0), (50, -90, 4.0), (359, -70, 12.0), (10, 30, 180.0), (120, 60, 0.01)]):
        pos = spark.createDataFrame([(float(ra), float(dec))], "a double, d double")
        got = {x.pix for x in hp.disc_pixels(pos, 16, "a", "d", r, inclusive).collect()}
        a, d = math.radians(ra), math.radians(dec)
        sep = np.degrees(np.arccos(np.clip(vec @ [math.cos(a) * math.cos(d), math.sin(a) * math.cos(d), math.sin(d)], -1, 1)))
        reach = min(r + (hp.max_pixel_radius_deg(16) if inclusive else 0), 180)
        assert got == set(centers.p[sep <= reach + 1e-9]) or got == set(centers.p[sep <= reach - 1e-9]), k
