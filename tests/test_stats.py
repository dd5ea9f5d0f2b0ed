import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyfold.functions import healpix as hp
from skyfold.operators import maps, stats, survey
from skyfold.operators.masks import mask_values, tile_coordinates


def test_density_mode_matches_a_direct_sum(spark):
    rng = np.random.default_rng(1)
    rows, want = [], {}
    for g in range(3):
        v = rng.normal(0.3 + 0.1 * g, 0.05, 200)
        h = len(v) ** -0.2 * v.std(ddof=1)
        grid = np.linspace(0, 1, 1000)
        want[g] = grid[np.argmax(np.exp(-0.5 * ((grid[:, None] - v) / h) ** 2).sum(1))]
        rows += [(g, float(x)) for x in v]
    rows += [(9, 0.5), (8, 0.5), (8, 0.5)]
    got = {r.g: r.mode for r in stats.density_mode(spark.createDataFrame(rows, "g int, v double"), ["g"], "v").collect()}
    assert got.keys() == want.keys() and all(abs(got[g] - want[g]) < 1e-9 for g in want)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.3,), (0.9999,), (1.0,), (1.1,), (float("nan"),), (-0.1,)], "v double")
    hist = {r.bin: r.n for r in stats.histogram(df, [], "v", 0.0, 1.0, 10).collect()}
    assert hist == {0: 1, 1: 1, 3: 1, 9: 2}
    top = {r.bin: r.n_above for r in stats.cumulative_from_top(stats.histogram(df, [], "v", 0.0, 1.0, 10)).collect()}
    assert top[0] == 5 and top[9] == 2
    over = stats.histogram(df, [], "v", 0.0, 1.0, 10, overflow=True).agg(F.sum("n")).first()[0]
    assert over == 7


def test_sigma_clip_converges(spark):
    rng = np.random.default_rng(2)
    v = np.concatenate([rng.normal(0, 1, 500), [40.0, 30.0, -90.0]])
    keep = v.copy()
    while True:
        m, s = keep.mean(), keep.std()
        nxt = keep[(keep >= m - 5 * s) & (keep <= m + 5 * s)]
        if len(nxt) == len(keep):
            break
        keep = nxt
    got = stats.sigma_clipped(spark.createDataFrame([(1, float(x)) for x in v], "k int, v double"), ["k"], "v").first()
    assert got.n == len(keep) and got.median == pytest.approx(np.median(keep)) and got.sigma == pytest.approx(keep.std())


def test_homogenize_follows_the_sequence(spark):
    rng = np.random.default_rng(3)
    n, nside, radius = 150, 16, 5.0
    pdf = pd.DataFrame({"expnum": np.arange(n), "telra": rng.uniform(0, 40, n), "teldec": rng.uniform(-15, 15, n), "band": rng.choice(list("gr"), n), "t_eff": rng.uniform(0.1, 1, n).round(1), "exptime": 90.0})
    pix = survey.footprint_pixels(spark.createDataFrame(pdf), nside, radius).select("expnum", "pix").toPandas().groupby("expnum").pix.apply(np.array)
    score = pdf.t_eff * pdf.exptime
    order = sorted(range(n), key=lambda i: (-score[i], i))
    want = set()
    for mode, limit in (("sum", 150.0), ("num", 3.0)):
        level = {b: np.zeros(hp.npix(nside)) for b in "gr"}
        for i in order:
            lv = level[pdf.band[i]]
            if np.percentile(lv[pix[i]], 10) < limit:
                lv[pix[i]] += score[i] if mode == "sum" else 1
                want.add((mode, i))
    out = survey.homogenize(spark.createDataFrame(pdf), sum_threshold=150.0, num_threshold=3.0, nside=nside, radius_deg=radius).toPandas()
    assert len(out) == 2 * n
    assert set(zip(out[out.accepted]["mode"], out[out.accepted].expnum)) == want


def test_homogenize_in_parts_and_small_groups(spark):
    rng = np.random.default_rng(4)
    n, nside, radius = 240, 16, 5.0
    pdf = pd.DataFrame({"expnum": np.arange(n), "telra": rng.uniform(0, 40, n), "teldec": rng.uniform(-15, 15, n), "band": "g", "t_eff": rng.uniform(0.1, 1, n), "exptime": 90.0})
    frame = spark.createDataFrame(pdf)
    pix = survey.footprint_pixels(frame, nside, radius).select("expnum", "pix").toPandas().groupby("expnum").pix.apply(np.array)
    score, level, want = (pdf.t_eff * pdf.exptime).to_numpy(), np.zeros(hp.npix(nside)), set()
    for i in sorted(range(n), key=lambda i: -score[i]):
        if np.percentile(level[pix[i]], 10) < 150.0:
            level[pix[i]] += score[i]
            want.add(i)
    out = survey.homogenize(frame, sum_threshold=150.0, num_threshold=3.0, nside=nside, radius_deg=radius, part_rows=60, group_pixels=1500).toPandas()
    assert len(out) == 2 * n and set(out[out.accepted & (out["mode"] == "sum")].expnum) == want


def test_homogenize_decides_a_chain_in_few_rounds(spark, monkeypatch):
    rounds, written = [], survey.materialize
    monkeypatch.setattr(survey, "materialize", lambda df, label="step": (rounds.append(label), written(df, label))[1])
    chain = spark.createDataFrame([(k, 10.0 + 0.4 * k, 5.0, "g", 1.0 - k / 100, 90.0) for k in range(12)], "expnum long, telra double, teldec double, band string, t_eff double, exptime double")
    out = survey.homogenize(chain, nside=64, radius_deg=1.0).toPandas()
    assert out.accepted.all() and len(out) == 24 and rounds.count("decided") <= 3
    assert survey.homogenize(chain.limit(0)).isEmpty()


def test_confusion_totals(spark):
    df = spark.createDataFrame([(True, True, 1.0), (True, False, 1.0), (False, True, 2.0), (False, False, 2.0), (True, True, 3.0)], "c boolean, t boolean, m double")
    got = {r.bin: r for r in stats.confusion_matrix(df, F.col("c"), ~F.col("c"), F.col("t"), ~F.col("t"), F.col("m"), 1.0, 1.0, 2).collect()}
    assert (got[0].TP, got[0].FP, got[1].TP, got[1].FN, got[1].TN) == (1, 1, 1, 1, 1)
    assert all(r.TP + r.FN == r.P and r.TN + r.FP == r.N for r in got.values())
    assert stats.confusion_matrix(df, F.col("c"), ~F.col("c"), F.col("t"), ~F.col("t")).first().TP == 2


def test_constant_map_interpolates_to_itself(spark):
    sky = spark.range(hp.npix(4)).select(F.col("id").alias("pix"), F.lit(0.25).alias("ebv"))
    df = spark.createDataFrame([(1, 12.0, 30.0), (2, 200.0, -89.0)], "id int, RA double, DEC double")
    got = maps.interpolate_map(df, sky, 4, "id", value="ebv", name="EBV").collect()
    assert all(abs(r.EBV - 0.25) < 1e-12 for r in got)


def test_depth_of_a_known_slope(spark):
    rng = np.random.default_rng(5)
    mag = np.concatenate([rng.uniform(18, 22, 300), np.full(60, 22.05)])
    n = len(mag)
    pdf = pd.DataFrame({"id": np.arange(n), "HPX": 0, "RA": rng.uniform(10, 12, n), "DEC": rng.uniform(0, 2, n), "MAG_PSF_G": mag, "MAGERR_PSF_G": 10 ** (0.4 * (mag - 24) + rng.normal(0, 0.01, n)), "WAVG_SPREAD_MODEL_G": 0.0})
    out = maps.depth_map(spark.createDataFrame(pdf), "id", nside=4, snr=10.0, bands=["g"]).toPandas()
    assert np.allclose(out.maglim, 24 + math.log10(2.5 / math.log(10) / 10) / 0.4, atol=0.2)


def test_masks(spark):
    tiles = spark.createDataFrame([("a", 10.0, 0.0, 0.01, 50, 50, 0, 100, 0, 100), ("b", 10.5, 0.0, 0.01, 50, 50, 0, 100, 0, 100)], "tile string, ra0 double, dec0 double, scale double, x0 int, y0 int, xmin int, xmax int, ymin int, ymax int")
    df = spark.createDataFrame([(1, 10.25, 0.0), (2, 9.6, 0.1), (3, 50.0, 0.0)], "id int, RA double, DEC double")
    placed = tile_coordinates(df, tiles, "id")
    raster = placed.select("tile", "xpix", "ypix", F.when(F.col("tile") == "a", 1).otherwise(4).alias("value"))
    got = {r.id: r["mask"] for r in mask_values(df, raster, placed, "id").collect()}
    assert got == {1: 5, 2: 1, 3: 8192}


def test_sigma_clipping_goes_on_until_nothing_goes(spark):
    values = [1.2 + i / 1000 for i in range(4)] + [10.0 * 1.9**i for i in range(40)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    kept = np.array(values)
    while True:
        near = kept[np.abs(kept - kept.mean()) <= 1.5 * kept.std()]
        if len(near) == len(kept):
            break
        kept = near
    got = stats.sigma_clipped(df, [], "v", sigmas=1.5).first()
    assert got.n == len(kept) < 10 and got.median == pytest.approx(np.median(kept))


def test_quartile_clipping_without_keys(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 1000]], "v double")
    got = stats.quartile_clipped(df, [], "v").first()
    assert got.median == 3.5 and got.n_kept == 5


def test_density_mode_of_far_values(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(0.4, 0.05, 200), [900.0, -900.0]])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    h = len(values) ** -0.2 * values.std(ddof=1)
    grid = np.linspace(0, 1, 1000)
    dense = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(1)
    assert stats.density_mode(df, [], "v").first()["mode"] == pytest.approx(grid[dense.argmax()])
    far = spark.createDataFrame([(1, 5e9), (1, 5e9 + 1)], "k int, v double")
    assert stats.density_mode(far, ["k"], "v").count() == 0 and stats.density_mode(far, [], "v").first()["mode"] is None


def test_tiles_meet_few_positions_outside_them(spark, monkeypatch):
    from skyfold.operators import masks

    rng = np.random.default_rng(6)
    sides = {}
    for name in ("with_cell", "in_covering_cells"):
        made = getattr(masks, name)
        monkeypatch.setattr(masks, name, lambda *a, made=made, name=name, **k: sides.setdefault(name, made(*a, **k)))
    tiles = pd.DataFrame({"tile": range(60), "ra0": rng.uniform(0, 40, 60), "dec0": rng.uniform(-15, 15, 60)}).assign(scale=0.5, x0=5.25, y0=4.75, xmin=0.5, xmax=9.5, ymin=1.0, ymax=9.0)
    df = pd.DataFrame({"id": range(400), "RA": rng.uniform(0, 40, 400), "DEC": rng.uniform(-15, 15, 400)})
    got = {tuple(r) for r in masks.tile_coordinates(spark.createDataFrame(df), spark.createDataFrame(tiles), "id").collect()}
    r, d, r0, d0 = (np.radians(v) for v in (df.RA.to_numpy()[:, None], df.DEC.to_numpy()[:, None], tiles.ra0.to_numpy(), tiles.dec0.to_numpy()))
    cosc = np.sin(d0) * np.sin(d) + np.cos(d0) * np.cos(d) * np.cos(r - r0)
    x = 5.25 - np.degrees(np.cos(d) * np.sin(r - r0) / cosc) / 0.5
    y = 4.75 + np.degrees((np.cos(d0) * np.sin(d) - np.sin(d0) * np.cos(d) * np.cos(r - r0)) / cosc) / 0.5
    assert got == {(i, t, int(x[i, t]), int(y[i, t])) for i, t in zip(*np.nonzero((cosc > 0) & (x > 0.5) & (x < 9.5) & (y > 1) & (y < 9)))}
    assert sides["with_cell"].join(sides["in_covering_cells"], "cell").count() < 4 * len(got)
