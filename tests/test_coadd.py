import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyfold.functions import classes
from skyfold.functions.interpolation import piecewise_linear
from skyfold.functions.photometry import extinction, flux_to_mag, flux_to_magerr, linear_transform
from skyfold.functions.selections import good_object
from skyfold.operators import calibration, coadd, zeropoints
from skyfold.operators.quantiles import exact_percentiles
from skyfold.schema import band_columns


def textbook(v, w):
    m = (w * v).sum() / w.sum()
    s = (w * (v - m) ** 2).sum() * w.sum() / (w.sum() ** 2 - (w * w).sum())
    return m, math.sqrt(s)


def test_one_pass_weighted_statistics(spark):
    rng = np.random.default_rng(1)
    rows, want = [], {}
    for g in range(20):
        n = int(rng.integers(2, 40))
        v, e = 20 + rng.normal(0, 10 ** rng.uniform(-5, 0), n), rng.uniform(1e-3, 0.3, n)
        want[g] = textbook(v, 1 / e**2)
        rows += [(g, float(a), float(b)) for a, b in zip(v, e)]
    rows += [(100, 20.0, 0.1), (101, 21.5, 0.1), (101, 21.5, 0.2)]
    df = spark.createDataFrame(rows, "g int, v double, e double")
    got = {r.g: r for r in df.groupBy("g").agg(*coadd.weighted_statistics("v", "e", ["m", "q", "s"])).collect()}
    for g, (m, s) in want.items():
        assert got[g].m == pytest.approx(m, rel=1e-12) and got[g].s == pytest.approx(s, rel=1e-7)
    assert got[100].s == pytest.approx(0.1) and got[101].s == 0.0


def detection(i, obj, band, mag, teff, flags=0, **over):
    row = dict(id=i, QUICK_OBJECT_ID=obj, BAND=band, RA=10.0 + i * 1e-6, DEC=-5.0, MJD_OBS=100.0 + i, MAG_PSF=mag, MAGERR_PSF=0.1, MAG_AUTO=mag, MAGERR_AUTO=0.1,
               SPREAD_MODEL=0.001, SPREADERR_MODEL=0.0015, CLASS_STAR=0.5, FLAGS=flags, EXPNUM=i, CCDNUM=1, T_EFF=teff, EXPTIME=90.0, A_IMAGE=1.0, B_IMAGE=1.0, THETA_IMAGE=0.0, FILENAME="f", OBJECT_NUMBER=i)
    return row | over


def test_catalog_and_keys(spark):
    rows = [detection(1, 7, "g ", 20.0, 0.5, 1), detection(2, 7, "g ", 21.0, 0.9, 2), detection(3, 7, "r ", 19.0, 0.5), detection(4, 8, "g ", 22.0, 0.5), detection(5, 8, "g ", 22.0, 0.5, MAG_PSF=99.0)]
    df = spark.createDataFrame(rows)
    catalog, keys = coadd.build_catalog(df, "id", min_bands=2)
    row = catalog.collect()
    assert len(row) == 1 and row[0].QUICK_OBJECT_ID == 7
    r = row[0]
    assert (r.NEPOCHS_G, r.NEPOCHS_R, r.NEPOCHS_I) == (2, 1, 0) and r.MAG_PSF_G == 21.0 and r.MAG_PSF_I == 99.0 and r.WAVG_FLAGS_G == 3
    assert r.EXTENDED_CLASS_G == 1 and r.EXTENDED_CLASS_I == -9 and r.EBV == -1.0 and r.MJD_OBS == 102.0
    marked = {k.id: k.UNIQUE_ID for k in keys.collect()}
    assert marked == {1: -1, 2: 7, 3: 7}
    full, allkeys = coadd.coadd_objects(df.where("MAG_PSF < 99"), "id")
    assert coadd.key_balance(*coadd.quality_cuts(full, allkeys)).first().balanced
    assert set(band_columns("MAG_PSF", list("grizY"))) <= set(catalog.columns)


def test_magnitude_sentinels(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(100.0, 1.0, 30.0), (0.0, 1.0, 30.0), (-5.0, 1.0, 30.0), (nan, 1.0, 30.0), (inf, 1.0, 30.0), (100.0, 1.0, 99.0), (100.0, 1.0, -1.0), (100.0, nan, nan)], "f double, e double, z double")
    got = df.select(flux_to_mag(F.col("f"), F.col("z")).alias("m"), flux_to_magerr(F.col("f"), F.col("e")).alias("s")).collect()
    assert [r.m for r in got] == [25.0, 99, 99, 99, 99, 99, 99, 99]
    assert got[0].s == pytest.approx(0.010857362, rel=1e-6) and got[1].s == 99 and got[3].s == 99 and got[7].s == 99


def test_zeropoints(spark):
    zp = spark.createDataFrame([(1, 1, -30.0, 0.1, 0), (1, 1, -30.0, 0.05, 0), (1, 2, -31.0, 0.1, 1), (2, 1, -29.0, 0.1, 0)], "expnum long, ccdnum int, mag_zero double, sigma_mag_zero double, zp_flag int")
    bl = spark.createDataFrame([(2, 1)], "expnum long, ccdnum int")
    usable = zeropoints.load_zeropoints(zp, bl)
    assert {(r.EXPNUM, r.CCDNUM, r.MAG_ZERO) for r in usable.collect()} == {(1, 1, 30.0)}
    det = spark.createDataFrame([(1, 1, 10.0), (1, 2, 10.0)], "EXPNUM long, CCDNUM int, FLUX_PSF double").withColumns({"FLUXERR_PSF": F.lit(1.0), "FLUX_AUTO": F.lit(10.0), "FLUXERR_AUTO": F.lit(1.0)})
    got = {r.CCDNUM: r for r in zeropoints.apply_zeropoints(det, usable).collect()}
    assert got[1].MAG_PSF == 27.5 and got[1].SIGMA_MAG_ZERO == 0.05 and got[2].MAG_PSF == 99.0 and got[2].ZP_FLAG == 2
    with pytest.raises(Exception, match="missing or listed twice"):
        zeropoints.lookup_exposure(det, spark.createDataFrame([(5, 1.0, 2.0)], "EXPNUM long, MJD_OBS double, EXPTIME double")).collect()


def test_clip_and_statistics_of_small_groups(spark):
    rows = [(1, 5.0), (2, 1.0), (2, 3.0)] + [(3, 0.01 * i) for i in range(30)] + [(3, 50.0), (3, 9.0)]
    df = spark.createDataFrame(rows, "k int, v double")
    got = calibration.clip_groups(df, ["k"], "v").groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in got} == {1: 1, 2: 2, 3: 30}
    stats = {r.k: r for r in calibration.zeropoint_statistics(df, ["k"], "v").collect()}
    assert stats[1].MAG_ZERO_STD is None and stats[1].MAG_ZERO_MEAN_ERR is None and stats[2].MAG_ZERO_MEDIAN == 2.0


def test_hot_groups_keep_exact_percentiles(spark):
    rng = np.random.default_rng(3)
    big, dup = rng.normal(0, 1, 6001), rng.integers(0, 3, 5000).astype(float)
    rows = [(1, float(v)) for v in big] + [(2, float(v)) for v in dup] + [(3, 1.0), (3, 4.0), (4, float("nan")), (4, 2.0)]
    df = spark.createDataFrame(rows, "k int, v double")
    wanted = {"lo": ("v", 0.0), "q": ("v", 0.25), "m": ("v", 0.5), "p": ("v", 0.995), "hi": ("v", 1.0)}
    got = {r.k: r for r in exact_percentiles(df, ["k"], wanted, hot_rows=1000, extra=[F.count(F.lit(1)).alias("n")]).collect()}
    for k, data in ((1, big), (2, dup), (3, np.array([1.0, 4.0])), (4, np.array([2.0]))):
        for name, (_, q) in wanted.items():
            assert got[k][name] == pytest.approx(np.percentile(data, 100 * q), abs=1e-12), (k, name)
    assert got[1].n == 6001
    whole = exact_percentiles(df.where("k = 1"), [], wanted, hot_rows=1000).first()
    assert whole.m == pytest.approx(np.median(big), abs=1e-12)


def test_interpolation_ends(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.5,), (2.0,), (3.0,), (float("nan"),), (None,)], "x double")
    got = [r.y for r in df.select(piecewise_linear(F.col("x"), (0.0, 1.0, 2.0), (0.0, 10.0, 0.0), outside=-7.0).alias("y")).collect()]
    assert got == [-7.0, 0.0, 5.0, 0.0, -7.0, -7.0, -7.0]
    with pytest.raises(Exception, match="outside the interpolation range"):
        df.select(piecewise_linear(F.col("x"), (0.0, 1.0), (0.0, 1.0), outside="raise")).collect()


def test_classes_and_bands(spark):
    df = spark.createDataFrame([(-1.0, 0.1), (0.0, 0.0), (1.0, 1.0), (0.01, 0.001), (0.0, 1e-4), (float("nan"), 0.1)], "s double, e double")
    assert [r.c for r in df.select(classes.spread_class(F.col("s"), F.col("e")).alias("c")).collect()] == [-9, -9, -9, 3, 0, 0]
    with pytest.raises(KeyError):
        extinction(F.col("s"), "q")
    with pytest.raises(ValueError):
        linear_transform("u")


def test_catalog_schema_is_checked_when_the_plan_is_made(spark):
    from skyfold import schema

    df = spark.createDataFrame([(1, 10.0, 20.0, None, 3), (2, 11.0, None, 17.5, None)], "QUICK_OBJECT_ID long, RA double, DEC double, MAG_PSF_G double, NEPOCHS_G int")
    out = schema.checked_catalog(df)
    assert out.schema == schema.catalog_struct() and len(out.columns) == 146
    rows = {r.QUICK_OBJECT_ID: r for r in out.collect()}
    assert rows[1].MAG_PSF_G == 99.0 and rows[2].NEPOCHS_G == 0 and math.isnan(rows[2].DEC) and rows[1].EXTENDED_CLASS_Y == -9
    with pytest.raises(ValueError, match="missing columns"):
        schema.checked_catalog(df.drop("RA"))
    with pytest.raises(ValueError, match="listed twice"):
        schema.checked_catalog(df.withColumn("x", F.lit(1)).select("*", F.col("x").alias("X")))
    with pytest.raises(ValueError, match="no numbers"):
        schema.checked_catalog(df.withColumn("MAG_PSF_G", F.array("MAG_PSF_G")))


def test_magnitudes_are_computed_once(spark):
    """A filter on calibrated magnitudes reads them: it does not repeat their logarithms in each condition."""
    cols = "EXPNUM long, CCDNUM long, FLUX_PSF double, FLUXERR_PSF double, FLUX_AUTO double, FLUXERR_AUTO double, SPREAD_MODEL double, SPREADERR_MODEL double, FLAGS int, ZP_FLAG int"
    det = spark.createDataFrame([(1, 1, 100.0, 1.0, 90.0, 1.0, 0.0, 0.1, 0, 9), (2, 1, 100.0, 1.0, 90.0, 1.0, 0.0, 0.1, 0, 9), (None, 1, 100.0, 1.0, 90.0, 1.0, 0.0, 0.1, 0, 9)], cols)
    zp = spark.createDataFrame([(1, 1, 30.0, 0.01, 0)], "EXPNUM long, CCDNUM long, MAG_ZERO double, SIGMA_MAG_ZERO double, ZP_FLAG int")
    out = zeropoints.apply_zeropoints(det, zp)
    assert out.columns == [*cols.replace(" long", "").replace(" double", "").replace(" int", "").split(", "), "MAG_PSF", "MAGERR_PSF", "MAG_AUTO", "MAGERR_AUTO", "MAG_ZERO", "SIGMA_MAG_ZERO"]
    assert sorted((r.MAG_PSF, r.ZP_FLAG) for r in out.collect()) == [(25.0, 0), (99.0, 2), (99.0, 2)]
    good = out.where(good_object())
    assert good.count() == 1
    assert good._jdf.queryExecution().optimizedPlan().toString().upper().count("LOG10(") == 2


def test_pivot_of_whole_bands(spark):
    rows = spark.createDataFrame([(1, "g", 1.5, 2, None), (1, "r", float("nan"), 3, "b"), (2, "Y", None, None, "c")], "QUICK_OBJECT_ID long, BAND string, a double, n int, s string")
    plain, whole = (coadd.pivot_bands(rows, ["a", "n", "s"], ["g", "r", "Y"], whole=w).orderBy("QUICK_OBJECT_ID") for w in (False, True))
    assert plain.dtypes == whole.dtypes and str(plain.collect()) == str(whole.collect())


def test_gathered_objects_are_the_same(spark, monkeypatch):
    rows = [detection(i, i % 7, "grizY"[i % 5], 20 + i % 11 * 0.1, 0.1 + i % 4 * 0.2, i % 3) for i in range(210)] + [detection(900, 50, "g ", 21.0, 0.5)]
    df = spark.createDataFrame(rows)
    whole = lambda **how: sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in coadd.coadd_objects(df, "id", whole=True, **how)[0].collect()], key=str)
    expected = whole()
    assert len(expected) == 8 and whole(gather=True) == expected
    # Rows travel once for the bands and once for the positions; no partial sums do.
    plan = coadd.coadd_objects(df, "id", whole=True, gather=True)[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 2 and "ENSURE_REQUIREMENTS" not in plan
    monkeypatch.setattr(coadd, "GATHERED_ROWS", 20)
    assert coadd.crowded(df) and whole(gather=True) == expected


def test_no_hot_groups_by_the_callers_word(spark):
    df = spark.createDataFrame([(k % 3, float(k * 7 % 11)) for k in range(40)] + [(9, None), (9, float("nan"))], "k int, v double")
    rows = lambda **how: sorted(map(tuple, exact_percentiles(df, ["k"], {"m": ("v", 0.5)}, **how).collect()))
    assert rows(hot_rows=None) == rows()
