import zlib

import numpy as np
import pytest

from skyfold.llm import quality, toxicity

DOCS = "doc_id long, text string, lang string, source string, score double, f0 string"
LABELS = "doc_id long, quality int, toxic int, text string"
SF = "/root/testdata/sf0.01"


def tables(spark, texts, labels):
    return spark.createDataFrame([(d, t, "en", "s", 0.0, "x") for d, t in texts], DOCS), spark.createDataFrame([(d, q, t, "") for d, q, t in labels], LABELS)


def brute_counts(docs, known):
    """Log ratios by the textbook recursion, from plain dictionaries."""
    from collections import Counter

    order, d = toxicity.ORDER, toxicity.DISCOUNT
    words = [Counter(), Counter(), Counter()]
    for doc_id, text in docs:
        own = set(toxicity.WORD.findall((text or "").lower()))
        words[0].update(own)
        if doc_id in known:
            words[1 + known[doc_id]].update(own)
    spelled = [Counter() for _ in words]
    for count, out in zip(words, spelled, strict=True):
        for w, n in count.items():
            for g in toxicity.grams(w):
                out[g] += n
    chain, level = {}, set(spelled[0])
    for n in range(order - 1, 0, -1):
        chain[n] = Counter()
        for g in level:
            chain[n][g[1:]] += 1
        level = set(chain[n])

    def below(g):
        n = len(g)
        if n == 0:
            return 1 / (len(chain[1]) + 1)
        same = [c for o, c in chain[n].items() if o[:-1] == g[:-1]]
        return max(chain[n][g] - d, 0) / sum(same) + d * len(same) / sum(same) * below(g[1:])

    def p(k, g):
        same = [c for o, c in spelled[k].items() if o[:-1] == g[:-1]]
        if not same:
            return below(g[1:])
        return max(spelled[k][g] - d, 0) / sum(same) + d * len(same) / sum(same) * below(g[1:])

    return {g: np.log(p(2, g) / p(1, g)) for g in spelled[0] if spelled[1][g] + spelled[2][g]}


def test_kneser_ney_ratios(spark):
    texts = [(1, "you idiot fool"), (2, "a kind word"), (3, "kind fool again"), (4, "Idiot idiots"), (5, "unlabelled kindness idiot"), (6, None)]
    docs, _ = tables(spark, texts, [])
    known = {1: 1, 2: 0, 3: 0, 4: 1}
    grams, heads = toxicity.fit_ratios(docs, np.array(sorted(known)), np.array([known[k] for k in sorted(known)]))
    want = brute_counts(texts, known)
    assert set(grams) == set(want) and all(grams[g] == pytest.approx(want[g], abs=1e-5) for g in want)
    assert toxicity.word_ratio("idiot", grams, heads) > 1 > -0.1 > toxicity.word_ratio("kind", grams, heads)


def test_no_ngram_is_left_out_of_the_model(spark, monkeypatch):
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdeé\U0001d4d0"), 6)) for _ in range(60)]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words, 12))) for i in range(40)], "doc_id long, text string")
    known, marks = np.arange(30), np.arange(30) % 2
    whole = toxicity.fit_ratios(docs, known, marks)
    monkeypatch.setattr(toxicity, "MODEL_GRAMS", 20)
    parted = toxicity.fit_ratios(docs, known, marks)
    assert all(len(a) == len(b) > 20 for a, b in zip(whole, parted, strict=True))
    assert [toxicity.word_ratio(w, *parted) for w in words] == [toxicity.word_ratio(w, *whole) for w in words]


@pytest.mark.parametrize("operator", [toxicity.toxicity, quality.quality])
def test_edge_rows(spark, operator):
    texts = [(0, None), (1, ""), (2, "a"), (2, "a"), (2, "%%% $$$"), (None, "some text"), (7, "word " * 50_000), (8, " \n\t")]
    labels = [(0, 1, 0), (2, 1, 1), (2, 0, 0), (7, None, None), (None, 1, 1), (99, 0, 1)]
    for given, marks in ((texts, labels), (texts, []), ([], labels), ([], [])):
        got = operator(*tables(spark, given, marks)).collect()
        assert len(got) == len(given)
        for r in got:
            fold = 0 if operator is toxicity.toxicity else 1
            n = 5 if operator is toxicity.toxicity else 3
            assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % n == fold)
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        twice = [r.score for r in got if r.doc_id == 2]
        assert not given or twice.count(twice[0]) >= 2 or twice.count(twice[1]) >= 2


@pytest.mark.parametrize(("operator", "label", "least"), [(toxicity.toxicity, "toxic", 0.9), (quality.quality, "quality", 0.95)])
def test_held_out_accuracy(spark, operator, label, least):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    rows = operator(docs, labels).where("held_out").join(labels, "doc_id").collect()
    y, s = np.array([r[label] for r in rows]), np.array([r.score for r in rows])
    area = (s[y == 1][:, None] > s[y == 0][None, :]).mean() + 0.5 * (s[y == 1][:, None] == s[y == 0][None, :]).mean()
    assert area > least and ((s >= 0.5) == y).mean() > least


@pytest.mark.parametrize("operator", [toxicity.toxicity, quality.quality])
def test_held_out_labels_are_not_read(spark, operator):
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("documents", "labels"))
    n, fold = (5, 0) if operator is toxicity.toxicity else (3, 1)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % n == fold
    other = labels.withColumns({c: F.when(held, 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")})
    one, two = ({r.doc_id: r.score for r in operator(docs, given).collect()} for given in (labels, other))
    assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k], abs=1e-9) for k in one)


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert (0, 1) in model.pairs and ((model.scores(x) > 0.5) == y).mean() > 0.9
    by_hand = model.constant + sum(t[np.searchsorted(c, x[0, k], side="right")] for k, (c, t) in enumerate(zip(model.cuts, model.tables, strict=True)))
    by_hand += sum(t[np.searchsorted(model.coarse[a], x[0, a], side="right"), np.searchsorted(model.coarse[b], x[0, b], side="right")] for (a, b), t in zip(model.pairs, model.pair_tables, strict=True))
    assert model.scores(x[:1])[0] == pytest.approx(1 / (1 + np.exp(-by_hand)))


def test_rejected_rows_go(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    bad = {r.doc_id for r in quality.quality(docs, labels).where("predicted = 0").collect()}
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()} - bad and bad
