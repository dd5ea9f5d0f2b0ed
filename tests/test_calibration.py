"""Matching of overlapping exposures, clipping by moments, exact percentiles of hot groups."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyfold.operators import calibration, nearest
from skyfold.operators.quantiles import exact_percentiles
from skyfold.operators.spatial import as_points


def separation(a, b):
    (ra1, de1), (ra2, de2) = (map(math.radians, p) for p in (a, b))
    h = math.sin((de2 - de1) / 2) ** 2 + math.cos(de1) * math.cos(de2) * math.sin((ra2 - ra1) / 2) ** 2
    return math.degrees(2 * math.asin(math.sqrt(h)))


@pytest.fixture(scope="module")
def field():
    """Three exposures on one piece of sky across RA 0, a dense reference, and a far exposure that sees nothing."""
    r = random.Random(1)
    reference = [(i, (359.9 + r.random() * 0.2) % 360, 10 + r.random() * 0.1) for i in range(400)]
    detections, k = [], 0
    for e in (1, 2, 3):
        for _, ra, dec in reference:
            for _ in range(r.choice([0, 1, 1, 2])):
                detections.append((k, e, (ra + r.uniform(-1, 1) / 3600) % 360, dec + r.uniform(-0.6, 0.6) / 3600))
                k += 1
    return reference, detections, [(1, 0.0, 10.05), (2, 0.0, 11.0), (3, 40.0, -50.0)]


def test_match_within_exposures(spark, field):
    reference, detections, exposures = field
    ref = spark.createDataFrame(reference, "OBJID long, RA double, DEC double").withColumn("G", F.col("OBJID") / 10)
    det = spark.createDataFrame(detections, "det_id long, EXPNUM long, RA double, DEC double").withColumn("FLUX_PSF", F.col("det_id") * 2.0)
    exp = spark.createDataFrame(exposures, "EXPNUM long, TELRA double, TELDEC double")
    got = calibration.merge_reference_by_exposure(det, ref, exp, "det_id", "OBJID", 0.5)
    want = {}
    for k, e, ra, dec in detections:
        for i, ra2, dec2 in reference:
            s = separation((ra, dec), (ra2, dec2))
            if e != 3 and s < 0.5 / 3600:
                want[e, i] = min(want.get((e, i), (9, 0)), (s, k))
    found = {(r.EXPNUM, r.OBJID): (r.sep, r.det_id, r.G, r.FLUX_PSF) for r in got.collect()}
    assert found.keys() == want.keys() and len(found) > 200
    for (e, i), (s, k) in want.items():
        assert found[e, i][1:] == (k, i / 10, k * 2.0) and found[e, i][0] == pytest.approx(s, abs=1e-9)
    assert set(got.columns) == {"EXPNUM", "OBJID", "det_id", "sep", "RA_REF", "DEC_REF", "G", "RA", "DEC", "FLUX_PSF"}


def test_failed_exposures_and_empty_inputs(spark, field):
    reference, detections, exposures = field
    mags = {c: F.lit(m) for c, m in zip("GRIZ", (18.8, 18.2, 18.1, 18.0))} | {f"D{c}": F.lit(0.01) for c in "GRIZ"}
    ref = spark.createDataFrame(reference, "OBJID long, RA double, DEC double").withColumns(mags)
    det = spark.createDataFrame(detections, "det_id long, EXPNUM long, RA double, DEC double").withColumns(
        {"CCDNUM": F.lit(1), "BAND": F.lit("r"), "EXPTIME": F.lit(90.0), "FLUX_PSF": F.lit(1e4), "FLUXERR_PSF": F.lit(10.0), "FLAGS": F.lit(0), "SPREAD_MODEL": F.lit(0.0)}
    )
    exp = spark.createDataFrame(exposures, "EXPNUM long, TELRA double, TELDEC double")
    zps = calibration.calibrate(det, ref, exp, "det_id", "OBJID")
    rows = {r.EXPNUM: r for r in zps.collect()}
    assert rows.keys() == {1, 2} and all(r.MAG_ZERO_STD == pytest.approx(0, abs=1e-9) for r in rows.values())
    assert [r.EXPNUM for r in calibration.failed_exposures(exp, zps).collect()] == [3]
    assert calibration.calibrate(det.where("false"), ref, exp, "det_id", "OBJID").count() == 0
    assert calibration.calibrate(det, ref.where("false"), exp, "det_id", "OBJID").count() == 0


@pytest.mark.parametrize("removals", [0, 1, 2, 4])
def test_clipping_against_a_loop(spark, removals):
    r = np.random.default_rng(removals)
    groups = {1: r.normal(0, 1, 400), 2: r.normal(1e6, 1e-2, 300), 3: np.array([5.0]), 4: np.array([1.0, 9.0]), 5: np.full(50, 7.0), 6: r.standard_cauchy(500)}
    rows = [(k, float(x)) for k, v in groups.items() for x in v]
    got = {k: [] for k in groups}
    for row in calibration.clip_groups(spark.createDataFrame(rows, "k int, v double"), ["k"], "v", 2.0, removals).collect():
        got[row.k].append(row.v)
    for k, v in groups.items():
        for _ in range(removals):
            far = np.abs(v - v.mean()) > 2.0 * v.std(ddof=1) if len(v) > 1 else np.zeros(len(v), bool)
            v = v[~far]
        assert sorted(got[k]) == sorted(v.tolist()), k


def test_hot_groups_with_ties(spark):
    r = np.random.default_rng(5)
    groups = {1: np.repeat([1.0, 2.0], 4000), 2: np.full(9000, 3.0), 3: np.append(np.full(5000, -1.0), r.normal(0, 1, 5001)), None: r.integers(0, 4, 6000) * 1.0, 5: np.array([2.0, 4.0])}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "k int, v double").repartition(8)
    wanted = {f"q{k}": ("v", k / 20) for k in range(21)}
    out = exact_percentiles(df, ["k"], wanted, hot_rows=1000, accuracy=500)
    for row in out.collect():
        for k in range(21):
            assert row[f"q{k}"] == pytest.approx(np.percentile(groups[row.k], 5 * k), abs=1e-12), (row.k, k)
    whole = exact_percentiles(df, [], wanted, hot_rows=1000, accuracy=500).first()
    every = np.concatenate(list(groups.values()))
    assert [whole[f"q{k}"] for k in range(21)] == pytest.approx([np.percentile(every, 5 * k) for k in range(21)], abs=1e-12)


def test_percentiles_are_one_lazy_plan(spark):
    tracker = spark.sparkContext.statusTracker()
    df = spark.range(10_000).selectExpr("id % 3 AS k", "cast(id AS double) AS v")
    before = len(tracker.getJobIdsForGroup(None))
    out = exact_percentiles(df, ["k"], {"m": ("v", 0.5)})
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert "Window" not in out._jdf.queryExecution().toString()
    assert exact_percentiles(df.where("false"), ["k"], {"m": ("v", 0.5)}).count() == 0
    assert exact_percentiles(df.where("false"), [], {"m": ("v", 0.5)}).first().m is None


def test_only_the_nearest_pair_leaves_a_cell(spark, monkeypatch):
    rng = random.Random(3)
    pool = [(10 + rng.random() * 1.2e-3, rng.random() * 1.2e-3) for _ in range(150)]
    places = [rng.choice(pool) for _ in range(400)] + [(359.9999, 89.99995), (0.0, 90.0), (0.0, 90.0)]
    dets = [(None if k == 7 else k // 2, k % 3, f"row {k}", *p) for k, p in enumerate(places)]
    refs = [(k // 2, f"ref {k}", 10 + rng.random() * 1.2e-3, rng.random() * 1.2e-3) for k in range(60)] + [(99, "pole", 120.0, 89.99999), (100, "far", 200.0, 5.0)]
    det = spark.createDataFrame(dets, "det_id long, EXPNUM long, name string, RA double, DEC double")
    ref = spark.createDataFrame(refs, "OBJID long, title string, RA double, DEC double")
    owners = as_points(det.withColumn("row", F.struct("name")), "det_id", keep=["row", "EXPNUM"]).withColumnRenamed("EXPNUM", "scope")
    seekers = as_points(ref.withColumn("kept", F.struct("title")), "OBJID", keep=["kept"])
    expected = {}
    for _, title, *p in refs:
        for d, e, name, *q in dets:
            if separation(p, q) * 3600 < 1.0:
                expected.setdefault((e, title), []).append((round(separation(p, q) * 3600, 6), -1 if d is None else d, name))
    for parts, rows in ((20_000, 1 << 16), (50, 16)):
        monkeypatch.setattr(nearest, "ROWS_AT_ONCE", rows)
        monkeypatch.setattr(nearest, "PAIRS_OF_A_CELL", rows)
        monkeypatch.setattr(nearest, "PAIRS_AT_ONCE", rows)
        near = nearest.nearest_in_cells(owners, seekers, 1.0 / 3600.0, parts)
        found = {}
        for r in near.collect():
            found.setdefault((r.scope, r.kept.title), []).append((round(2 * math.degrees(math.asin(math.sqrt(r.d2) / 2)) * 3600, 6), -1 if r.owner is None else r.owner, r.row.name))
        # Each cell a seeker touches, and each part of it, gives one pair of a scope at most.
        assert all(len(v) <= 4 * (1 if parts > 400 else 20) for v in found.values())
        assert {k: min(v) for k, v in found.items()} == {k: min(v) for k, v in expected.items()}
