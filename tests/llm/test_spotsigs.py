import hashlib

import pytest
from pyspark.sql import functions as F

from skyfold.llm import spotsigs

SF = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, fingerprint string, n_chars long"


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out = []
    for k, (doc_id, text, *_) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(text)
        edited = text[: n - n // 2] + after[: n // 2]
        a, b, c = spotsigs.signatures(text), spotsigs.signatures(edited), spotsigs.signatures(after)
        jaccard = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        out.append((doc_id, n, hashlib.sha256(edited.encode()).hexdigest(), spotsigs.digest(a), spotsigs.digest(b), jaccard(a, b), jaccard(a, c), len(a)))
    return sorted(out, key=str)


def found(spark, rows):
    return sorted([tuple(r) for r in spotsigs.following_pairs(spark.createDataFrame(rows, KIND)).collect()], key=str)


@pytest.mark.parametrize("rows", [
    [],
    [(1, "The cat sat on the mat.", "x", 1)],
    [(1, None, "x", 1), (2, "", "x", 1), (None, "of the and", "x", 1), (3, "###", "x", 1), (3, "###", "x", 1), (3, None, "x", 1), (9, "zwölf Boxkämpfer 😀 jagen den Viktor", "x", 1)],
    [(7, "the of " * 30_000 + "word", "x", 1), (8, "the lone ranger rides", "x", 1)],
])
def test_edge_rows(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text, "", 0) for r in docs.select("doc_id", "text").collect()]
    assert sorted([tuple(r) for r in spotsigs.following_pairs(docs).collect()], key=str) == brute(rows)


def test_signature_chains():
    one = spotsigs.signatures("zebra crosses the wide river")
    assert len(one) == 2 and one == spotsigs.signatures("ZEBRA crosses, the wide river!")
    assert spotsigs.signatures(" \n") == set() and len(spotsigs.signatures("of the")) == 1
    assert spotsigs.likeness(set(), set()) == 1 and spotsigs.likeness(set(), {1}) == 0 and spotsigs.likeness({1, 2, 3}, {1}, 0.5) == 0


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_near_pairs_against_all_pairs(spark, threshold):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 30").withColumn("doc_id", F.col("doc_id") + 1000).withColumn("text", F.concat("text", F.lit(" the small change"))))
    sets = {r.doc_id: frozenset(spotsigs.signatures(r.text or "")) for r in docs.collect()}
    first = {}
    for d in sorted(sets):
        first.setdefault(sets[d], d)
    reps = sorted(first.items(), key=lambda x: x[1])
    want = {(a, b) for i, (x, a) in enumerate(reps) for y, b in reps[i + 1 :] if x and y and len(x & y) / len(x | y) >= threshold}
    pairs, members = spotsigs.near_pairs(docs, threshold)
    assert {(r.a, r.b) for r in pairs.collect()} == want and len(want) > 20
    assert {(r.doc_id, r.first_id) for r in members.collect()} == {(d, first[s]) for d, s in sets.items()}
