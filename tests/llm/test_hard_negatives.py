import math
import random

import duckdb
import numpy as np
import pytest

from skyfold.llm import hard_negatives, negative_queries

SF = "/root/testdata/sf0.001"
KIND = "vec_id long, embedding array<float>, label int, score string, slot int"


def brute(rows):
    """All scores of all anchors with whole numbers; repeated ids count once, as the smallest (label, vector)."""
    known = {}
    for i, x, label in rows:
        if i is None or x is None or label is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        v = [math.floor(256 * float(np.float32(c))) for c in x]
        known[i] = min(known.get(i, (99, [])), ((label + 1) % 10 if i % 7 == 0 else label, v))
    out = []
    for a, (own, w) in known.items():
        if a % 100:
            continue
        scores = sorted((-sum(p * q for p, q in zip(v, w)), i, label) for i, (label, v) in known.items() if i != a)
        for s, p, _ in [x for x in scores if x[2] == own][:5]:
            held = [x for x in scores if x[2] != own and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(a, p, k, i, -s, -x) for k, (x, i, _) in enumerate(held, 1)]
    return sorted(out)


def mined(spark, rows):
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], KIND)
    return sorted(tuple(r) for r in hard_negatives.mine(df).collect())


def vectors(seed, n, width, labels, spread=4):
    r = random.Random(seed)
    return [(i, [r.randrange(-spread, spread + 1) / spread for _ in range(width)], r.randrange(labels)) for i in range(n)]


NAN, INF = float("nan"), float("inf")
CASES = {
    "ties": vectors(1, 450, 5, 2, 1),
    "wide": vectors(2, 350, 33, 10),
    "one label": [(i, [1.0, float(i)], 3) for i in range(1, 210) if i % 7],
    "copies": [(i, [0.5, -0.5, 0.25], i % 3) for i in range(320)],
    "odd rows": [*vectors(3, 230, 9, 3), (100, [1.0] * 9, 0), (100, [1.0] * 9, 0), (200, None, 1), (300, [1.0] * 9, None), (400, [NAN] + [0.0] * 8, 1), (500, [INF] + [0.0] * 8, 1), (600, [None] + [1.0] * 8, 1), (None, [1.0] * 9, 1), (700, [], 2), (800, [1.0, 2.0], 0)],
    "large values": [(i, [3e4 * ((i * j) % 7 - 3) for j in range(1, 6)], i % 2) for i in range(220)],
    "alone": [(100, [1.0], 1)],
    "no rows": [],
}


@pytest.mark.parametrize("case", CASES)
def test_against_brute_force(spark, case):
    assert mined(spark, CASES[case]) == brute(CASES[case])


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHORS_IN_BLOCK", 1)
    rows = vectors(5, 700, 12, 4)
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], KIND).repartition(7)
    assert sorted(tuple(r) for r in hard_negatives.mine(df).collect()) == brute(rows)


def test_scan_drops_candidates_early():
    r = np.random.default_rng(1)
    columns = r.integers(-4, 5, (64, 4000))
    columns[:, :8] += 40
    lows, highs = columns.min(axis=1), columns.max(axis=1)
    anchor = np.where(np.arange(64) < 16, 100, 1)
    scan = hard_negatives.Scan(anchor, columns, lows, highs, np.arange(4000))
    ids, scores = hard_negatives.best_rows(scan, np.arange(4000), 5)
    whole = anchor @ columns
    want = np.lexsort((np.arange(4000), -whole))[:5]
    assert ids.tolist() == want.tolist() and scores.tolist() == whole[want].tolist() and len(scan.alive) <= 8


@pytest.mark.parametrize("score", [-11, -10, -1, 0, 1, 4, 5, 6, 999, 1000])
def test_lowest_negative(score):
    least = hard_negatives.lowest_negative(score)
    assert 100 * least >= 80 * score > 100 * (least - 1)


def test_whole_table_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    got = negative_queries.op12_negatives(spark, SF)
    want = con.sql(negative_queries.OP12_SQL)
    assert sorted(map(tuple, got.collect())) == sorted(want.project(", ".join(got.columns)).fetchall())
