import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import pytest

from skyfold.llm import secret_queries, secrets

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, spans string, n_hex int, suspects long"
ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
CLASSES = [("hex_digits", "[0-9A-Fa-f]+", 16, 3.0), ("capitals", "[A-Z0-9]+", 20, 3.6), ("base64", "[A-Za-z0-9+/_-]+", 24, 4.1)]


def entropy(window):
    return math.log2(len(window)) - sum(c * math.log2(c) for c in Counter(window).values()) / len(window)


def brute(text):
    """Base spans and entropy spans of a text, each window counted anew."""
    base = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    base += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    base += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    added = []
    for c in re.finditer("[A-Za-z0-9+/_.=:-]+", text):
        if len(c[0]) < 16 or any(re.search(a, c[0]) for a in secrets.ALLOWED):
            continue
        for no, (name, pattern, w, bits) in enumerate(CLASSES, 3):
            for r in re.finditer(pattern, c[0]):
                spans = []
                for i in range(len(r[0]) - w + 1):
                    if entropy(r[0][i : i + w]) >= bits - 1e-9:
                        at = c.start() + r.start() + i
                        if spans and at <= spans[-1][1]:
                            spans[-1][1] = at + w
                        else:
                            spans.append([at, at + w])
                added += [(b, no, e, name) for b, e in spans]
    listed = lambda rows: ",".join(f"{k}:{b}:{e}" for b, _, e, k in sorted(rows))
    kinds = Counter(k for *_, k in base)
    return kinds["assign"], kinds["access"], kinds["hex"], len(added), hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + added)


def noise(seed, alphabet, n):
    r = random.Random(seed)
    return "".join(r.choice(alphabet) for _ in range(n))


B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
TEXTS = [
    None, "", "a", "é" * 40, "password=short", "password=exactly12chr", 'Token": \'abcdefgh.ijkl\' x', "password=token:abcdefghijklmnop", "API_KEY = = abcdefghijkl", "passWD\t=abcdefghijklmn",
    "paſſword=abcdefghijklmnop", "xAKIA" + "Z" * 14 + "y", "AKIA" + "A" * 13, "AKIAAKIA" + "Q2W3" * 4, "日本 " + "0123456789abcdef" * 3, "deadbeef" * 2, "deadbee" * 2 + "g",
    "01e7fa83-1c2b-4d5e-8f90-a1b2c3d4e5f6", "https://host.example/" + noise(1, B64, 40), "see " + noise(2, B64, 60) + " and " + noise(3, B64, 23), "a_long_name_of_plain_words/and-a-path.of.more",
    noise(4, "0123456789ABCDEF", 64), noise(5, "ABCDEFGHJKLMNPQR0123456789", 41), "x" * 500, "ab" * 300 + noise(6, B64, 80) + "cd" * 300 + noise(7, B64, 30), "sha256-" + noise(8, B64, 43),
    "w " * 20000 + "secret: " + noise(9, B64, 4000) + " tail " * 9000, "\U0001f600" * 5 + "token=" + noise(10, "abcdef0123456789", 40), "4242424242424242424242424242", "\n".join(f"key{i}={noise(i, B64, 30)}" for i in range(200)),
]


def scanned(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], DOCS)
    return sorted([tuple(r) for r in secrets.scan(df).collect()], key=str)


def test_against_brute_force(spark):
    rows = [*enumerate(TEXTS), (3, TEXTS[19]), (None, TEXTS[19]), (None, None), (3, TEXTS[19])]
    want = sorted([(i, *brute(t or "")) for i, t in rows], key=str)
    assert scanned(spark, rows) == want
    assert any("base64" in w[-1] for w in want) and any("capitals" in w[-1] for w in want)


def test_generated_texts(spark):
    alphabet = [*"aAfF09=: \"'-/", "password", "AKIA", "token", "é", noise(1, B64, 20), noise(2, "0123456789abcdef", 12)]
    rows = []
    for seed in range(300):
        r = random.Random(seed)
        rows.append((seed, "".join(r.choice(alphabet) for _ in range(r.randrange(60)))))
    assert scanned(spark, rows) == sorted([(i, *brute(t)) for i, t in rows], key=str)


def test_allow_list_leaves_base_spans(spark):
    [row] = scanned(spark, [(1, "token=EXAMPLE" + noise(3, B64, 40))])
    assert row[1] == 1 and row[4] == 0
    [row] = scanned(spark, [(1, "value=" + noise(3, B64, 40))])
    assert row[1] == 0 and row[4] == 1


def test_no_rows(spark):
    assert scanned(spark, []) == []


def test_whole_table_against_sql_and_plan(spark):
    got = secret_queries.op13_secrets(spark, SF)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(secret_queries.OP13_SQL)
    assert sorted(map(tuple, got.collect())) == sorted(want.project(", ".join(got.columns)).fetchall())


@pytest.mark.parametrize("kind", secrets.CLASSES, ids=lambda k: k.name)
def test_tables_of_the_classes(kind):
    assert len(set(kind.symbols)) == len(kind.symbols) and all(re.fullmatch(kind.pattern, s) for s in kind.symbols)
