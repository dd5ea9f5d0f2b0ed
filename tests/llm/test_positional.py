import re

import pytest
from pyspark.sql import functions as F

from skyfold.llm import positional

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, key string, n long, window_id int"
ITEMS = "item_id long, text string, words string"


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, names = words(t), set(), set()
        for win, ids in windows.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    names |= ids
        out.append((d, len(w), len(hit), sorted(str(n) for n in names if n is not None), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items):
    found = positional.contamination(spark.createDataFrame([(d, t, "k", 1, 2) for d, t in docs], DOCS), spark.createDataFrame([(i, t, "w") for i, t in items], ITEMS))
    return sorted([tuple(r) for r in found.collect()], key=str)


TEN = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
CASES = {
    "phrases": ([(1, f"x {TEN.upper()} lambda, y"), (2, TEN.replace(" ", "--")), (3, TEN[:-1]), (4, None), (5, ""), (6, "the the the the"), (7, "été ÉTÉ b\xadc"), (None, TEN), (None, None), (8, TEN + " " + TEN), (8, "beta"), (8, TEN), (8, TEN)],
                [(1, TEN + " lambda mu"), (2, TEN), (10, "the the"), (3, None), (4, "!!"), (5, "été"), (None, "beta"), (2, TEN), (6, "ÉTÉ"), (7, "not there at all")]),
    "long": ([(1, "a b " * 6000 + TEN), (2, "b a")], [(1, "a b a b a b a b a b a b"), (2, TEN)]),
    "no documents": ([], [(1, TEN)]),
    "no items": ([(1, TEN), (2, None)], []),
}


@pytest.mark.parametrize("case", CASES)
def test_against_brute_force(spark, case):
    docs, items = CASES[case]
    assert run(spark, docs, items) == brute(docs, items)


def test_whole_table(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("documents", "benchmark"))
    pairs = lambda df, k: [(r[k], r.text) for r in df.collect()]
    want = brute(pairs(docs, "doc_id"), pairs(items, "item_id"))
    assert sorted([tuple(r) for r in positional.contamination(docs, items).collect()], key=str) == want
    assert {r.doc_id for r in positional.clean_documents(docs, items).collect()} == {d for d, *_, hit in want if not hit}


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red x x green x blue"), (2, "blue green red"), (3, "red " + "x " * 30 + "green blue"), (4, "red green")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "red green blue")], "item_id long, text string")
    _, window_terms, terms = positional.windows_of(items)
    index = positional.build_index(docs, terms)
    assert {r.doc for r in positional.proximity_matches(index, window_terms, 5).collect()} == {1, 2}
    assert {r.doc for r in positional.proximity_matches(index, window_terms, 2).collect()} == {2}
    assert positional.phrase_matches(index, window_terms).count() == 0


def test_plan_has_no_python(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("documents", "benchmark"))
    plan = positional.contamination(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and F is not None
