import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyfold.llm import mixing, positional, quality, simhash
from skyfold.llm.common import table
from skyfold.llm.pieces import coder

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        following = stage(spark, docs, SF).cache()
        out.append((name, docs, following))
        docs = following
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_keep_columns_and_decide(spark, stages):
    for name, docs, kept in stages[:-1]:
        assert kept.columns == docs.columns and ids(kept) <= ids(docs)
        assert kept.count() == len(ids(kept)) or name == "mixing to target weights"
    (_, a, b), (_, _, c), (_, _, d), (_, _, e), (_, _, f) = stages
    assert ids(a) - ids(b) == {r.doc_id for r in quality.quality(a, table(spark, SF, "labels")).where("predicted = 0").collect()} != set()
    assert ids(c) == {r.component_id for r in simhash.near_duplicates(b).collect()} != ids(b)
    hit = positional.contamination(c, table(spark, SF, "benchmark")).where("contaminated")
    assert ids(c) - ids(d) == ids(hit)
    copies = {r.doc_id: r.copies for r in mixing.mixture(d).collect() if r.copies}
    assert {r["doc_id"]: r["count"] for r in e.groupBy("doc_id").count().collect()} == copies
    assert {r["doc_id"]: r["count"] for r in f.groupBy("doc_id").count().collect()} == copies


def test_token_rows(stages):
    _, docs, found = stages[-1]
    start = 0
    rows = sorted(found.collect(), key=lambda r: r.start)
    whole = sorted(docs.collect(), key=lambda r: r.doc_id)
    assert len(rows) == len(whole)
    for row, r in zip(rows, whole):
        n = len(coder(corpus_pipeline.TOKENIZER).ids(r.text)) // 4 + 1
        assert (row.doc_id, row.start, row.n_tokens) == (r.doc_id, start, n)
        start += n


def test_run_equals_the_stages(spark, stages):
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(stages[-1][2])


def test_empty_and_odd_documents(spark):
    shape = table(spark, SF, "documents").schema
    empty = spark.createDataFrame([], shape)
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words here", None, "s", 3), (3, "x", "en", None, 1), (3, "x", "en", None, 1)], shape)
    for docs in (empty, odd.withColumn("_doc", F.lit("clash")).withColumn("_id", F.lit(0))):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, SF)
            most = mixing.EPOCHS if name == "mixing to target weights" else 1
            assert kept.columns == docs.columns and kept.count() <= most * docs.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
