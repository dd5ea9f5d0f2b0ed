import pytest

from skyfold.llm import chat

KIND = "conv_id long, turn long, role string, text string, n int, pos string"


def brute(rows):
    convs = {}
    for c, t, r, x in set(rows):
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    lists = {c: [(r, x) for _, _, r, x in sorted(set(v))] for c, v in convs.items()}
    out = []
    for c, turns in lists.items():
        same = [o for o, v in lists.items() if v == turns]
        longer = any(len(v) > len(turns) and v[: len(turns)] == turns for v in lists.values())
        if c == min(same) and not longer:
            out.append((c, len(turns), len(same), "".join(f"<|{r}|>\n{x}<|end|>\n" for r, x in turns)))
    return sorted(out)


def found(spark, rows):
    return sorted(tuple(r) for r in chat.collapse(spark.createDataFrame([(*r, 1, "x") for r in rows], KIND)).collect())


A, B, C = (0, "user", "hi"), (1, "assistant", "hello"), (2, "user", "bye")
CASES = {
    "snapshots": [(1, *A), (2, *A), (2, *B), (3, *A), (3, *B), (3, *C), (4, *A), (4, *B), (4, *C), (5, *B), (6, *A), (6, 1, "assistant", "other")],
    "odd rows": [(1, None, None, None), (1, 0, "user", ""), (2, *A), (2, *A), (2, 0, "user", "hi there"), (None, *A), (None, None, None, None), (3, 5, None, "x"), (4, 5, None, "x"), (4, 9, "user", None)],
    "order matters": [(1, *A), (1, *B), (2, 0, "assistant", "hello"), (2, 1, "user", "hi")],
    "empty": [],
    "long": [(1, i, "user", f"t{i % 5}") for i in range(3000)] + [(2, i, "user", f"t{i % 5}") for i in range(1500)],
}


@pytest.mark.parametrize("case", CASES)
def test_against_brute_force(spark, case):
    assert found(spark, CASES[case]) == brute(CASES[case])


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    assert sorted(tuple(r) for r in chat.collapse(table).collect()) == brute(rows)


def test_plan_has_no_python(spark):
    plan = chat.collapse(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
