"""Age limit of operands, by hand and against the last value of every minute."""

import pytest
from helpers import MIN, readings, results, rule, rules

from pointloom.plans.engine import derive

ROWS = [
    ("D0", "a", 1, 0), ("D0", "b", 10, 0), ("D1", "c", 100, 2 * MIN), ("D0", "a", 2, 18 * MIN), ("D0", "b", 20, 50 * MIN),
    ("D1", "c", 300, 51 * MIN), ("D0", "a", 3, 52 * MIN), ("D1", "c", 400, 200 * MIN), ("D0", "b", 30, 209 * MIN),
]


def brute(formula, operands, age):
    """{minute: value}: fires in the 15 minutes after a reading of an operand, on values at most `age` minutes old."""
    out = {}
    for tick in range(1, 230):
        slots = [[(ms // MIN, v) for d, p, v, ms in ROWS if (d, p) == o and ms // MIN < tick] for o in operands]
        if any(s and tick - s[-1][0] <= 15 for s in slots) and all(s and (age is None or tick - s[-1][0] <= age) for s in slots):
            out[tick] = formula(*[s[-1][1] for s in slots])
    return out


@pytest.mark.parametrize("age", [None, 3, 15, 20, 40])
def test_age_limit(spark, age):
    many = "+".join(f"v{i}" for i in range(17))
    table = rules(
        spark,
        rule("own", "a*b", [("a", "D0", "a"), ("b", "D0", "b")]),
        rule("across", "b-c", [("b", "D0", "b"), ("c", "D1", "c")]),
        rule("const", "a*k", [("a", "D0", "a"), ("k", "D0", "k")]),
        rule("k", "5", expr_type=2),
        rule("long", many, [(f"v{i}", "D0", "ab"[i % 2]) for i in range(17)]),
    )
    got = results(derive(readings(spark, ROWS), table, max_age=age))
    wants = {
        "own": (lambda a, b: a * b, [("D0", "a"), ("D0", "b")]), "across": (lambda b, c: b - c, [("D0", "b"), ("D1", "c")]),
        "const": (lambda a: a * 5, [("D0", "a")]), "long": (lambda a, b: 9 * a + 8 * b, [("D0", "a"), ("D0", "b")]),
    }
    for point, (formula, operands) in wants.items():
        assert {t: v for (t, _, p), v in got.items() if p == point} == brute(formula, operands, age), point


@pytest.mark.parametrize("age", [3, 20])
def test_age_limit_of_children(spark, age):
    from pointloom.schemas import MODEL, OBJECT

    objects = spark.createDataFrame([(1, None, 396, "P", 9, 1), (2, 1, 396, "D0", 7, 1), (3, 1, 396, "D1", 7, 1)], OBJECT)
    models = spark.createDataFrame([(9, 396, "PLANT"), (7, 396, "DEV")], MODEL)
    rows = [("D0", "c", v, ms) for d, p, v, ms in ROWS if p == "b"] + [("D1", "c", v, ms) for d, p, v, ms in ROWS if p == "c"]
    table = rules(spark, rule("sum", "CHILD_SUM", (), 1, [("model", "DEV"), ("point", "c")], device="P"))
    got = results(derive(readings(spark, rows), table, objects, models, max_age=age))
    assert {t: v for (t, _, p), v in got.items()} == brute(lambda b, c: b + c, [("D0", "b"), ("D1", "c")], age)
