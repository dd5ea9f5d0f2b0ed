from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyfold.llm import mixing

DOCS = "doc_id long, text string, source string, lang string, weight double, key string"


def raked(cells, targets):
    """Plain proportional fitting: cells {(s, l, t): tokens}, targets {(margin, value): share}."""
    w = {c: n / sum(cells.values()) for c, n in cells.items() if n}
    for _ in range(500):
        for k, m in enumerate(mixing.MARGINS):
            sums = defaultdict(float)
            for c, v in w.items():
                sums[c[k]] += v
            w = {c: v * targets.get((m, c[k]), 0) / sums[c[k]] if sums[c[k]] else 0 for c, v in w.items()}
    return w


def test_raking_against_plain_fitting(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mixture(docs).collect()
    assert len(rows) == docs.count()
    cells = defaultdict(int)
    for r in rows:
        cells[r.source, r.lang, r.topic] += r.tokens
    targets = {}
    for k, m in enumerate(mixing.MARGINS):
        sums = defaultdict(float)
        for c, n in cells.items():
            sums[c[k]] += n
        powers = {v: n**mixing.TEMPER for v, n in sums.items()}
        targets |= {(m, v): p / sum(powers.values()) for v, p in powers.items()}
    want = raked(cells, targets)
    have = defaultdict(float)
    for r in rows:
        have[r.source, r.lang, r.topic] += r.weight
    assert all(have[c] == pytest.approx(want.get(c, 0), abs=1e-5) for c in cells)
    whole = sum(cells.values())
    ratio = {c: want[c] * whole / n for c, n in cells.items() if n}
    for r in rows:
        expected = min(ratio[r.source, r.lang, r.topic], mixing.EPOCHS) if r.tokens else 1.0
        assert r.expected == pytest.approx(expected, abs=1e-4)
        assert r.probability == pytest.approx(r.expected - np.floor(r.expected)) and r.copies in (np.floor(r.expected), np.floor(r.expected) + 1)
    assert max(r.copies for r in rows) > 1
    again = mixing.mixture(docs.repartition(7))
    assert {r.doc_id: r.copies for r in again.collect()} == {r.doc_id: r.copies for r in rows}
    kept = mixing.sampled_documents(docs).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in kept} == {r.doc_id: r.copies for r in rows if r.copies}


@pytest.mark.parametrize("size", [0.4, 1.0, 2.5])
def test_sample_has_the_target_mix(spark, size):
    """Token shares of the drawn copies, with no weights: about ninety are compared, so four standard errors are allowed."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mixed = mixing.mixture(docs, size=size, epochs=20).toPandas()
    cells = mixed.groupby(list(mixing.MARGINS))["tokens"].sum()
    t, p = mixed["tokens"].to_numpy(float), mixed["probability"].to_numpy()
    hoped = (t * mixed["expected"]).sum()
    shown = {(r.margin, r.value): r for r in mixing.margins(spark.createDataFrame(mixed)).collect()}
    for m in mixing.MARGINS:
        powers = cells.groupby(m).sum() ** mixing.TEMPER
        for value, share in (powers / powers.sum()).items():
            off = (mixed[m] == value).to_numpy() - share
            error = np.sqrt((t**2 * p * (1 - p) * off**2).sum()) / hoped
            row = shown[m, value]
            assert row.target == pytest.approx(share, abs=1e-5) and row.expected == pytest.approx(share, abs=1e-5)
            assert abs(row.reached - share) <= 4 * error + 1e-9, (m, value)
    assert hoped == pytest.approx(size * t.sum(), rel=1e-5)


def test_more_than_the_epochs_is_reported(spark):
    docs = spark.createDataFrame([(i, "w w w", "ab"[i == 0], "x", 0.0, "") for i in range(100)], DOCS)
    targets = spark.createDataFrame([("source", "a", 0.5), ("source", "b", 0.5), ("lang", "x", 1.0), ("topic", "prose", 1.0)], "margin string, value string, share double")
    mixed = mixing.mixture(docs, targets)
    shown = {r.value: r for r in mixing.margins(mixed).where("margin = 'source'").collect()}
    assert shown["b"].target == pytest.approx(0.5) and shown["b"].expected == pytest.approx(mixing.EPOCHS / (mixing.EPOCHS + 50), abs=1e-6)


def test_tables_without_source_or_lang(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    got = mixing.mixture(docs).collect()
    assert {(r.source, r.lang) for r in got} == {("", "")} and all(r.copies == 1 for r in got)


def test_given_targets(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 9 + 1), "ab"[i % 2], "xy"[i % 3 == 0], 0.0, "") for i in range(400)], DOCS)
    targets = spark.createDataFrame([("source", "a", 0.8), ("source", "b", 0.2), ("lang", "x", 0.5), ("lang", "y", 0.5), ("topic", "prose", 1.0)], "margin string, value string, share double")
    got = mixing.mixture(docs, targets)
    for m, v, s in targets.collect():
        assert got.where(F.col(m) == v).agg(F.sum("weight")).first()[0] == pytest.approx(s, abs=1e-5)
    only = mixing.mixture(docs, targets.where("value <> 'b'"))
    assert only.where("source = 'b' AND copies > 0").count() == 0


def test_edge_rows(spark):
    rows = [(1, None, None, None, 0.0, ""), (2, "", "s", "en", 0.0, ""), (None, "a b", "s", None, 0.0, ""), (3, "one two", "s", "en", 0.0, ""), (3, "one two", "s", "en", 0.0, ""), (3, "x", "t", "fr", 0.0, "")]
    got = mixing.mixture(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == 6 and sum(r.weight for r in got) == pytest.approx(1)
    assert all(r.copies == 1 and r.weight == 0 for r in got if r.doc_id in (1, 2))
    assert len({r.copies for r in got if r.doc_id == 3 and r.source == "s"}) == 1
    assert mixing.mixture(spark.createDataFrame([], DOCS)).count() == 0
    assert mixing.mixture(spark.createDataFrame(rows[:2], DOCS)).where("copies = 1").count() == 2
    kept = mixing.sampled_documents(spark.createDataFrame(rows, DOCS))
    assert kept.columns == ["doc_id", "text", "source", "lang", "weight", "key"]


def test_contradicting_targets_settle(spark):
    cells = spark.createDataFrame([("a", "x", "p", 10), ("b", "y", "p", 30)], "source string, lang string, topic string, tokens long")
    targets = spark.createDataFrame([("source", "a", 0.5), ("source", "b", 0.5), ("lang", "x", 0.9), ("lang", "y", 0.1), ("topic", "p", 1.0)], "margin string, value string, share double")
    fitted, gap = mixing.rake(cells, targets)
    assert fitted.agg(F.sum("weight")).first()[0] == pytest.approx(1) and gap == pytest.approx(0.4)


def test_slow_fits_go_on(spark):
    """Margins that depend on each other strongly: each sweep closes little of the gap, and the targets can be met."""
    cells = spark.createDataFrame([("a", "x", "p", 1000), ("a", "y", "p", 10), ("b", "x", "p", 10), ("b", "y", "p", 1000)], "source string, lang string, topic string, tokens long")
    targets = spark.createDataFrame([("source", "a", 0.6), ("source", "b", 0.4), ("lang", "x", 0.4), ("lang", "y", 0.6), ("topic", "p", 1.0)], "margin string, value string, share double")
    fitted, gap = mixing.rake(cells, targets, tolerance=1e-4)
    assert gap <= 1e-4
    for m, v, s in targets.collect():
        assert fitted.where(F.col(m) == v).agg(F.sum("weight")).first()[0] == pytest.approx(s, abs=2e-4)
