import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyfold.operators import matching, spatial

ARC = 1.0 / 3600.0


def vectors(ra, dec):
    a, d = np.radians(ra), np.radians(dec)
    return np.stack([np.cos(a) * np.cos(d), np.sin(a) * np.cos(d), np.sin(d)], 1)


def near_matrix(ra, dec, radius):
    v = vectors(ra, dec)
    d2 = ((v[:, None, :] - v[None, :, :]) ** 2).sum(2)
    return d2, d2 <= (2 * np.sin(np.radians(radius) / 2)) ** 2


def field(seed, n=260, spread=3.0, center=(0.0, 10.0)):
    rng = np.random.default_rng(seed)
    hubs = rng.uniform(-spread, spread, (n // 12, 2)) * 3
    pts = hubs[rng.integers(0, len(hubs), n)] + rng.normal(0, 0.6, (n, 2))
    pts[: n // 6] = pts[n // 6 : 2 * (n // 6)]  # exact copies
    dec = center[1] + pts[:, 1] * ARC
    ra = (center[0] + pts[:, 0] * ARC / np.cos(np.radians(dec))) % 360
    return pd.DataFrame({"id": np.arange(n), "RA": ra, "DEC": dec, "EXPNUM": rng.integers(0, 9, n)})


def sequential(pdf, radius, min_obs=1):
    _, near = near_matrix(pdf.RA.values, pdf.DEC.values, radius)
    degree = near.sum(1)
    order = sorted(range(len(pdf)), key=lambda i: (-degree[i], i))
    label = np.full(len(pdf), -1)
    groups = {}
    for i in order:
        if label[i] >= 0 or degree[i] < min_obs:
            continue
        label[near[i]] = i
        groups[i] = set(np.flatnonzero(near[i]))
    return label, groups


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


@pytest.mark.parametrize("seed,center,part", [(1, (0.0, 10.0), 20000), (2, (180.0, -60.0), 7), (3, (10.0, 89.9971), 20000), (4, (0.0, 0.0), 3)])
def test_friends_follow_the_sequential_rule(spark, seed, center, part):
    pdf = field(seed, center=center)
    want, _ = sequential(pdf, 1.0 * ARC)
    got = matching.match_friends(spark.createDataFrame(pdf), "id", 1.0, rows_per_part=part).toPandas().sort_values("id")
    assert len(got) == len(pdf)
    assert same_partition(want, got.match_id.values)
    assert sorted(set(got.match_id)) == list(range(got.match_id.nunique()))


def test_chain_and_string_ids(spark):
    pdf = pd.DataFrame({"id": [f"d{i:02d}" for i in range(9)], "RA": [(0.9 * i * ARC - 3 * ARC) % 360 for i in range(9)], "DEC": [0.0] * 9})
    want, _ = sequential(pdf, 1.0 * ARC)
    got = matching.match_friends(spark.createDataFrame(pdf), "id", 1.0).toPandas().sort_values("id")
    assert same_partition(want, got.match_id.values)


def test_groups_stay_apart(spark):
    pdf = field(5)
    both = pd.concat([pdf.assign(g=0), pdf.assign(g=1, id=pdf.id + 1000)])
    got = matching.match_friends(spark.createDataFrame(both), "id", 1.0, group=["g"]).toPandas()
    assert got.groupby("match_id").g.nunique().max() == 1
    want, _ = sequential(pdf, ARC)
    for g in (0, 1):
        assert same_partition(want, got[got.g == g].sort_values("id").match_id.values)


@pytest.mark.parametrize("min_obs", [1, 3])
def test_overlapping_groups(spark, min_obs):
    pdf = field(6)
    _, want = sequential(pdf, ARC, min_obs)
    got = matching.group_members(spark.createDataFrame(pdf), "id", ARC, min_obs=min_obs).toPandas()
    assert {s: set(g.member) for s, g in got.groupby("seed")} == want
    assert all(g.n_members.iloc[0] == len(g) for _, g in got.groupby("seed"))


@pytest.mark.parametrize("seed", [7, 8])
def test_exposure_sequence(spark, seed):
    pdf = field(seed)
    d2, near = near_matrix(pdf.RA.values, pdf.DEC.values, ARC)
    sizes = pdf.EXPNUM.value_counts()
    order = sorted(sizes.index, key=lambda e: (-sizes[e], e))
    label, unique, nxt = np.full(len(pdf), -1), [], 0
    for e in order:
        rows = np.flatnonzero(pdf.EXPNUM == e)
        fresh = []
        for i in rows:
            hits = [(d2[i, u], u) for u in unique if near[i, u]]
            if hits:
                label[i] = label[min(hits)[1]]
            else:
                fresh.append(i)
        for i in fresh:
            label[i] = nxt
            nxt += 1
        unique += fresh
    got = matching.match_exposures(spark.createDataFrame(pdf), "id", 1.0).toPandas().sort_values("id")
    assert (got.match_id.values == label).all()


def test_multi_stage_is_a_partition_near_its_medians(spark):
    pdf = field(9)
    got = matching.match_multi_stage(spark.createDataFrame(pdf), "id", 1.0).toPandas()
    assert sorted(got.id) == list(pdf.id)
    assert sorted(set(got.match_id)) == list(range(got.match_id.nunique()))


def test_invalid_positions_fail(spark):
    pdf = field(10)
    pdf.loc[3, "RA"] = np.nan
    with pytest.raises(Exception, match="invalid position"):
        matching.match_friends(spark.createDataFrame(pdf), "id", 1.0).count()


@pytest.mark.parametrize("radius,part", [(1.5 * ARC, 20000), (1.5 * ARC, 5), (40.0, 20000)])
def test_radius_and_nearest_join(spark, radius, part):
    rng = np.random.default_rng(11)
    if radius > 1:
        a, b = (pd.DataFrame({"id": np.arange(n), "RA": rng.uniform(0, 360, n), "DEC": np.degrees(np.arcsin(rng.uniform(-1, 1, n)))}) for n in (80, 90))
    else:
        a, b = field(12), field(13)
    va, vb = vectors(a.RA, a.DEC), vectors(b.RA, b.DEC)
    d2 = ((va[:, None, :] - vb[None, :, :]) ** 2).sum(2)
    close = d2 <= (2 * np.sin(np.radians(radius) / 2)) ** 2
    sa, sb = spark.createDataFrame(a), spark.createDataFrame(b)
    pairs = spatial.radius_join(sa, sb, radius, "id", "id", rows_per_part=part).toPandas()
    assert set(zip(pairs.left_id, pairs.right_id)) == set(zip(*np.nonzero(close))) and len(pairs) == close.sum()
    near = spatial.nearest_join(sa, sb, radius, "id", "id", rows_per_part=part, right_cols=["DEC"]).toPandas()
    want = {}
    for i in range(len(a)):
        if close[i].any():
            want[i] = min((d2[i, j], j) for j in np.flatnonzero(close[i]))[1]
    assert dict(zip(near.left_id, near.right_id)) == want
    assert np.allclose(near.DEC.values, b.DEC.values[near.right_id.values])


def test_nearest_other_has_no_limit(spark):
    rng = np.random.default_rng(14)
    pdf = pd.concat([field(15, 120), pd.DataFrame({"id": np.arange(500, 520), "RA": rng.uniform(0, 360, 20), "DEC": rng.uniform(-90, 90, 20), "EXPNUM": 0})])
    pdf = pd.concat([pdf, pd.DataFrame({"id": [999], "RA": [5.0], "DEC": [5.0], "EXPNUM": [77]})]).reset_index(drop=True)  # alone in its group
    got = spatial.nearest_other(spark.createDataFrame(pdf), "id", group=["EXPNUM"]).toPandas()
    v = vectors(pdf.RA.values, pdf.DEC.values)
    want = {}
    for i in range(len(pdf)):
        others = [j for j in range(len(pdf)) if j != i and pdf.EXPNUM[j] == pdf.EXPNUM[i]]
        if others:
            want[pdf.id[i]] = min((round(((v[i] - v[j]) ** 2).sum(), 30), pdf.id[j]) for j in others)[1]
    assert dict(zip(got.id, got.other_id)) == want and len(got) == len(want)


def test_centroid_wraps(spark):
    df = spark.createDataFrame([(1, 359.9999, 1.0), (1, 0.0001, 1.0), (2, 10.0, 90.0), (2, 190.0, 89.0)], "k int, RA double, DEC double")
    got = {r.k: r for r in matching.centroids(df, ["k"], stat="mean").collect()}
    assert min(got[1].lon, 360 - got[1].lon) < 1e-9 and abs(got[2].lat - 89.5) < 1e-6
    with pytest.raises(ValueError):
        matching.centroids(df, ["k"], stat="mode")


def test_match_objects_ids(spark):
    pdf = field(16).assign(HPX=lambda p: p.id % 2 + 41)
    df = spark.createDataFrame(pdf)
    out = matching.match_objects([df.where("EXPNUM < 4"), df.where("EXPNUM >= 4")], "id").toPandas()
    assert len(out) == len(pdf)
    for pix, g in out.groupby("HPX"):
        seq = sorted(set(g.QUICK_OBJECT_ID - 10**13 - pix * 10**8))
        assert seq == list(range(len(seq)))
    assert F.col is not None


def test_nearest_other_in_a_clump_and_an_empty_field(spark):
    """A clump within one mean spacing of the field around it, near RA 0 and near a pole."""
    rng = np.random.default_rng(4)
    clump = np.stack([(359.95 + 0.1 * rng.random(1500)) % 360, 20 + 0.1 * rng.random(1500)], 1)
    polar = np.stack([360 * rng.random(400), 89.9 + 0.1 * rng.random(400)], 1)
    field = np.stack([360 * rng.random(200), np.degrees(np.arcsin(2 * rng.random(200) - 1))], 1)
    pos = np.concatenate([clump, polar, field])
    lon, lat = np.radians(pos[:, 0]), np.radians(pos[:, 1])
    xyz = np.stack([np.cos(lon) * np.cos(lat), np.sin(lon) * np.cos(lat), np.sin(lat)], 1)
    d2 = ((xyz[:, None] - xyz[None]) ** 2).sum(2)
    np.fill_diagonal(d2, np.inf)
    df = spark.createDataFrame([(i, float(r), float(d)) for i, (r, d) in enumerate(pos)], "id long, RA double, DEC double").repartition(8)
    got = {r.id: (r.other_id, r.sep) for r in spatial.nearest_other(df, "id").collect()}
    assert len(got) == len(pos)
    for i, (other, sep) in got.items():
        assert other == d2[i].argmin() and sep == pytest.approx(np.degrees(2 * np.arcsin(np.sqrt(d2[i].min()) / 2)), abs=1e-9)


def test_nearest_other_with_broadcast_and_shuffled_searches(spark, monkeypatch):
    rng = np.random.default_rng(5)
    pdf = pd.concat([field(17, 150), pd.DataFrame({"id": np.arange(500, 530), "RA": rng.uniform(0, 360, 30), "DEC": rng.uniform(-90, 90, 30), "EXPNUM": 0})])
    df, found = spark.createDataFrame(pdf.reset_index(drop=True)), []
    for few in (0, 20_000):
        monkeypatch.setattr(spatial, "FEW_ROWS", few, raising=True)
        found.append(sorted(tuple(r) for r in spatial.nearest_other(df, "id", group=["EXPNUM"]).collect()))
    assert found[0] == found[1] and found[0]
