import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from skyfold.llm import simhash
from skyfold.llm.components import components

KIND = "doc_id long, text string, fp string, component_id int"


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[ \t-\r]+", words) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None and (r not in least or d < least[r]):
            least[r] = d
    return sorted([(d, f"{f:016x}", least.get(find(i))) for i, ((d, _), f) in enumerate(zip(rows, fps, strict=True))], key=str)


def found(spark, rows):
    docs = spark.createDataFrame([(d, t, "x", 3) for d, t in rows], KIND)
    return sorted([tuple(r) for r in simhash.near_duplicates(docs).select("doc_id", simhash.hex_digits(F.col("fp")), "component_id").collect()], key=str)


def test_edge_rows(spark):
    long = "a b c d e f g " * 20_000
    rows = [(4, "One two three"), (2, "one  TWO\tthree"), (9, None), (8, ""), (7, " \n"), (None, "one two three"), (None, None), (5, "ÉTÉ été\xa0x y"), (5, "other words here now and then"), (5, "other words here now and then"), (1, long), (3, long + "h")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    assert found(spark, [(None, None)]) == [(None, "0" * 16, None)]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted([tuple(r) for r in simhash.near_duplicates(docs).select("doc_id", simhash.hex_digits(F.col("fp")), "component_id").collect()], key=str) == brute(rows)
    kept = {r.doc_id for r in simhash.keep_one(docs).collect()}
    assert kept == {c for _, _, c in brute(rows)}


@pytest.mark.parametrize("t", [1, 2, 3, 4])
def test_links_of_a_dense_cloud(spark, t, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 64)
    rng = np.random.default_rng(1)
    centre = int(rng.integers(0, 1 << 63))
    fps = {centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 9), replace=False)) for _ in range(300)} | {int(x) for x in rng.integers(0, 1 << 63, 300)}
    fps = np.array(sorted(fps), np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    label = np.arange(len(fps))
    while True:
        lower = np.where(near, label[None, :], len(fps)).min(1)
        if np.array_equal(lower, label):
            break
        label = lower
    distinct = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {np.int64(r.node).astype(np.uint64): np.int64(r.root).astype(np.uint64) for r in components(simhash.fingerprint_links(distinct, t)).collect()}
    groups = {}
    for f, k in zip(fps, label, strict=True):
        groups.setdefault(k, set()).add(int(f))
    mine = {}
    for f in fps:
        mine.setdefault(int(got.get(f, f)), set()).add(int(f))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_components_of_a_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(500, 501), (501, 500), (7, 7), (900, 900)], "a long, b long"))
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}
    assert components(edges.limit(0)).count() == 0


def test_exploded_keys_are_never_broadcast(spark):
    # Spark sizes the keys like the few bytes of the fingerprints before they were exploded.
    distinct = spark.range(50).select(F.xxhash64("id").alias("fp"))
    plan = simhash.fingerprint_links(distinct)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
