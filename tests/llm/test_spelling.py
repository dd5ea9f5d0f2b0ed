import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from skyfold.llm import spelling, spelling_queries

SF = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, word string, n int, trie int"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def is_near(a, b):
    """One replaced, inserted or deleted letter, tried at each place."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(words):
    near = {w: [] for w in words}
    for a, b in itertools.combinations(words, 2):
        if abs(len(a) - len(b)) <= 1 and is_near(a, b):
            near[a].append(b)
            near[b].append(a)
    forms = {w: min(v, key=lambda x: (-words[x], x)) for w, v in near.items() if v}
    forms = {w: f for w, f in forms.items() if words[f] >= 2 * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        out.append((w, forms.get(w), root, n, len(near[w]), words[forms[w]] if w in forms else None))
    return sorted(out)


def found(spark, rows):
    return sorted(tuple(r) for r in spelling.variants(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], KIND)).collect())


def made(seed, letters, n, sizes, docs=40):
    """Words in many counts, with all kinds of edits."""
    r = random.Random(seed)
    words = ["".join(r.choice(letters) for _ in range(r.choice(sizes))) for _ in range(n)]
    for w in words[: n // 2]:
        k = r.randrange(len(w))
        words += [w[:k] + w[k + 1 :], w[:k] + r.choice(letters) + w[k:], w[:k] + r.choice(letters) + w[k + 1 :]]
    return [(i, " ".join(r.choice(words) for _ in range(300))) for i in range(docs)]


CASES = {
    "few letters": made(1, "ab", 60, [4, 5, 6, 7]),
    "many letters": made(2, "abcdefghijklmnopqrstuvwxyzéßøÀ÷", 300, [4, 5, 6, 9]),
    "long words": made(3, "ab", 6, [46, 47, 48, 49, 50, 300]),
    "odd rows": [(None, "colour colour colour color"), (None, None), (1, None), (2, ""), (3, "1234 ,.;"), (4, "Ünder ünder ÜNDER Under under"), (4, "color, colour; colors' colour"), (4, "color, colour; colors' colour"), (5, "日本color語 color" * 30), (6, "ΑΒΓ straße STRASSE strasse strasse strasse")],
    "chain": [(i, " ".join(["planet"] * 40 + ["planets"] * 16 + ["planetss"] * 6 + ["planetsss"] * 3)) for i in range(1)],
    "very long run": [(i, "a" * 3000 + " " + "a" * 2999 + " " + "a" * 2998 + "b") for i in range(5)],
    "no rows": [],
}


@pytest.mark.parametrize("case", CASES)
def test_against_brute_force(spark, case):
    assert found(spark, CASES[case]) == brute(counted(CASES[case]))


def test_pieces(spark, monkeypatch):
    rows = made(4, "abcde", 150, [5, 6])
    words = counted(rows)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    want = {w: k for w, *_, k, _ in brute(words) if k}
    monkeypatch.setattr(spelling, "PIECE", 10)
    assert {r.word: r.n_near for r in spelling.near_words(df).collect()} == want


@pytest.mark.parametrize("at_once", [1, 64])
def test_trie_loses_nothing(monkeypatch, at_once):
    monkeypatch.setattr(spelling, "AT_ONCE", at_once)
    r = np.random.default_rng(at_once)
    rows, queries = r.integers(0, 9, (300, 12)).astype(np.uint8) // 4, r.integers(0, 9, (100, 12)).astype(np.uint8) // 4
    change = rows[None].astype(int) - queries[:, None]
    want = np.argwhere((np.maximum(change, 0).sum(2) <= 1) & (np.maximum(-change, 0).sum(2) <= 1))
    got = sorted((int(q), int(k)) for a, b in spelling.Trie(rows).near(queries) for q, k in zip(a, b))
    assert got == [tuple(x) for x in want.tolist()] and got


def test_letters_of_the_groups():
    assert sorted(spelling.LETTERS) == sorted("abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100))))
    assert len(spelling.LETTERS) == len(spelling.CODES) and set(spelling.CODES) == set(spelling.ALL_CODES)


def test_whole_table_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = spelling_queries.op11_spelling(spark, SF)
    want = con.sql(spelling_queries.OP11_SQL)
    key = lambda row: row[0]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want.project(", ".join(got.columns)).fetchall(), key=key)
