"""Formula parsing and evaluation, against plain Python where possible."""

import ast
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pointloom.functions import arithmetic as ar
from pointloom.functions.bits import bit_at
from pointloom.functions.formula import compile_same_device, parse_call, parse_formula, variable_name


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_variable_names(spark):
    names = {i: one(spark, variable_name(F.lit(i))) for i in (0, 25, 26, 51, 52, 701, 702, 18277)}
    assert names == {0: "a", 25: "z", 26: "aa", 51: "az", 52: "ba", 701: "zz", 702: "aaa", 18277: "zzz"}


@pytest.mark.parametrize(
    "text, name, args",
    [
        ("f('a', \"b\")", "f", ["a", "b"]), ("f (‘a’,“b”)", "f", ["a", "b"]), ("f()", "f", []), ("f( )", "f", []),
        ("f(a,,b,,)", "f", ["a", "", "b"]), ("f(g(x),1)", "f", ["g(x)", "1"]), ("f('it''s')", "f", ["it''s"]),
    ],
)
def test_calls(spark, text, name, args):
    got = one(spark, parse_call(F.lit(text)))
    assert (got.name, got.args) == (name, args)


@pytest.mark.parametrize("text", ["a+b", " f(x)", "f(x) ", "f", "(x)", ""])
def test_no_calls(spark, text):
    assert one(spark, parse_call(F.lit(text))) is None


@pytest.mark.parametrize(
    "text, expr, expr_type, n",
    [
        (None, "", 0, 0), (" \t", "", 0, 0), ("f(x)", "f(x)", 1, 0), ("a+b", "a+b", 0, 0), ("{oops", "{oops", 0, 0),
        ('{"formula":"a","vars":[{"name":"a","data_code":"p","object_code":"D"}]}', "a", 0, 1),
        ('{"formula":"DAY_DIFF","vars":[{"data_code":"p"}]}', "DAY_DIFF", 1, 1), ('{"formula":"x"}', "x", 1, 0), ("{}", "", 1, 0),
    ],
)
def test_formula_forms(spark, text, expr, expr_type, n):
    got = one(spark, parse_formula(F.lit(text).cast("string"), F.lit(396)))
    assert (got.expr, got.expr_type, len(got.depends_on)) == (expr, expr_type, n)


def test_same_device_names(spark):
    got = one(spark, compile_same_device(F.lit("A*B + 2*A - TRUE and not x1"), F.lit(396), F.lit("D0")))
    assert got.expr == "a*b + 2*a - TRUE and not c"
    assert [(d.var, d.point_code, d.device_code) for d in got.depends_on] == [("a", "A", "D0"), ("b", "B", "D0"), ("c", "x1", "D0")]


def test_bits(spark):
    def bit(v, b):
        return one(spark, bit_at(F.lit(v).cast("double"), F.lit(b)))

    assert [bit(5, b) for b in (1, 2, 3, 0, -1)] == [1, 0, 1, None, None]
    assert [bit(-5, 2), bit(5.9, 1), bit(float("nan"), 1), bit(1e300, 1), bit(1, 65)] == [1, 1, None, None, 1]


def test_names_have_no_limit(spark):
    names = {i: one(spark, variable_name(F.lit(i))) for i in (18278, 18279, 475253, 475254)}
    assert names == {18278: "aaaa", 18279: "aaab", 475253: "zzzz", 475254: "aaaaa"}


leaf = st.sampled_from(["v_0", "v_1", "v_2", "2", "3", "0", "0.5", "10", ".5", "2e1"])
formulas = st.recursive(
    leaf,
    lambda e: st.one_of(
        st.tuples(e, st.sampled_from("+-*/%"), e).map(lambda t: f"({t[0]} {t[1]} {t[2]})"), e.map(lambda x: f"-{x}"),
        st.tuples(e, st.sampled_from("+-*/%"), e, st.sampled_from("+-*/%"), e).map(lambda t: "".join(t)),
    ),
    max_leaves=8,
)


def plain_value(text, values):
    """By Python's own grammar: whole numbers stay whole among themselves, dividing by zero gives None."""

    def walk(node):
        if isinstance(node, ast.Name):
            return values[int(node.id[2:])]
        if isinstance(node, ast.Constant):
            return node.value
        if isinstance(node, ast.UnaryOp):
            return -walk(node.operand) if isinstance(node.op, ast.USub) else walk(node.operand)
        a, b = walk(node.left), walk(node.right)
        if a is None or b is None:
            return None
        if isinstance(node.op, (ast.Div, ast.Mod)):
            if b == 0:
                raise ZeroDivisionError
            if isinstance(a, int) and isinstance(b, int):
                q = abs(a) // abs(b) * (1 if (a < 0) == (b < 0) else -1)
                return q if isinstance(node.op, ast.Div) else a - q * b
            return a / b if isinstance(node.op, ast.Div) else math.fmod(a, b)
        return {ast.Add: lambda: a + b, ast.Sub: lambda: a - b, ast.Mult: lambda: a * b}[type(node.op)]()

    try:
        return float(walk(ast.parse(text, mode="eval").body))
    except ZeroDivisionError:
        return None


def values_of(spark, rows):
    df = spark.createDataFrame(rows, "template STRING, v ARRAY<DOUBLE>")
    return [r.x for r in df.select(ar.evaluate(ar.translated("template")["program"], F.col("v")).alias("x")).collect()]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(formulas, min_size=20, max_size=20, unique=True))
def test_programs_agree_with_plain_evaluation(spark, texts):
    rows = [(t, [float(a), float(b), 1.5]) for t in texts for a in (0, 7) for b in (-2, 3)]
    for (t, v), got in zip(rows, values_of(spark, rows)):
        want = plain_value(t, v)
        assert (got is None) == (want is None), (t, v)
        assert got is None or got == pytest.approx(want, nan_ok=True), (t, v)


def test_right_operands_come_with_their_step():
    v = ar.VARIABLE
    assert ar.translate("(v_0+v_1)/2") == [(v, 0.0), (ar.ADD + ar.BY_VARIABLE, 1.0), (ar.DIVIDE + ar.BY_NUMBER, 2.0)]
    assert ar.translate("v_0-v_1*0.5") == [(v, 0.0), (v, 1.0), (ar.MULTIPLY + ar.BY_NUMBER, 0.5), (ar.SUBTRACT, 0.0)]


def test_programs_without_such_steps_still_run(spark):
    plain = "array(named_struct('op', 1, 'x', 0D), named_struct('op', 1, 'x', 1D), named_struct('op', {op}, 'x', 0D))"
    for op, want in ((ar.ADD, 9.0), (ar.SUBTRACT, 5.0), (ar.MULTIPLY, 14.0), (ar.DIVIDE, 3.5), (ar.REMAINDER, 1.0)):
        program = F.expr(plain.format(op=op))
        assert spark.range(1).select(ar.evaluate(program, F.array(F.lit(7.0), F.lit(2.0)))).first()[0] == want


def test_any_number_and_length_of_formulas(spark):
    n = 1500
    rows = [(f"v_0 + {i}", [1.0]) for i in range(n)]
    rows += [("+".join(f"v_{i}" for i in range(2000)), [1.0] * 2000), ("(" * 1200 + "v_0" + ")" * 1200, [3.0]), ("-" * 1201 + "v_0", [3.0])]
    rows += [("1+(" * 900 + "v_0" + ")" * 900, [2.0])]
    assert values_of(spark, rows) == [*[1.0 + i for i in range(n)], 2000.0, 3.0, -3.0, 902.0]


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        (None, "unbound name"), ("", "outside grammar"), ("v_0 v_1", "outside grammar"), ("v_0 ** 2", "outside grammar"), ("(v_0", "outside grammar"),
        ("v_0)", "outside grammar"), ("v_0 +", "outside grammar"), ("1_000", "outside grammar"), ("v_0 > 1", "outside grammar"), ("007", "outside grammar"),
        ("v_0 + 1" + "0" * 401, "number out of range"), ("v_0 + 1e999", "number out of range"), ("v_0 + 1/0", "divides by zero"), ("()", "outside grammar"),
    ],
)
def test_bad_formulas_have_a_reason(text, reason):
    assert ar._translated(text) == {"program": None, "reason": reason}
