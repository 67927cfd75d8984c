"""Arithmetic formulas over bound variables.

A formula is reduced to a template by renaming its variables to positions, and translated once, where rules are prepared,
into a postfix program: an array of steps that travels with the rule. Programs are evaluated by built-in functions with a
stack, so any number of formulas, of any length and depth, takes one expression of the plan. A text outside the grammar
gives no program but a reason; it never disturbs other rules.
"""

from __future__ import annotations

import math
import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointloom.functions.formula import IDENTIFIER, is_point_name

TEMPLATE_TOKEN = rf"({IDENTIFIER}|[0-9]+(?:\.[0-9]*)?(?:[eE][+-]?[0-9]+)?|[^a-zA-Z_0-9]+)"
PROGRAM = "array<struct<op:int,x:double>>"

# Steps of a program.
NUMBER, VARIABLE, NEGATE, ADD, SUBTRACT, MULTIPLY, DIVIDE, REMAINDER = range(8)
# Added to + - * / % whose right operand is a number or variable: it comes with the step, in x.
BY_NUMBER, BY_VARIABLE = 8, 16
_BINARY = {"+": (1, ADD), "-": (1, SUBTRACT), "*": (2, MULTIPLY), "/": (2, DIVIDE), "%": (2, REMAINDER)}
_SIGN = 3
_PIECE = re.compile(r"\s*(?:((?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)(?![0-9a-zA-Z_.])|v_([0-9]+)(?![0-9a-zA-Z_])|([-+*/%()]))\s*")

# Python workers get the functions below with their code, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def template_text(expr: Column, variables: Column) -> Column:
    """`expr` with the i-th name of the array `variables` written as v_i; null if it uses any other name."""
    tokens = F.transform(
        F.regexp_extract_all(F.translate(expr, "\r\n\t", "   "), F.lit(TEMPLATE_TOKEN), F.lit(1)),
        lambda t: F.when(
            is_point_name(t),
            F.when(
                F.array_contains(variables, t),
                F.concat(F.lit("v_"), (F.array_position(variables, t) - F.lit(1)).cast("string")),
            ),
        ).otherwise(t),
    )
    unbound = F.exists(tokens, lambda t: t.isNull() | t.contains("#"))
    return F.when(~unbound, F.trim(F.array_join(tokens, "")))


class Rejected(ValueError):
    """The formula can't run; the message says why."""


def _number(text: str):
    if text.isdigit():
        if len(text) > 1 and text[0] == "0" and text.strip("0"):
            raise Rejected("outside grammar")  # a whole number with leading zeros
        if len(text) > 400:
            raise Rejected("number out of range")
        return int(text)
    value = float(text)
    if not math.isfinite(value):
        raise Rejected("number out of range")
    return [(NUMBER, value)]


def _steps(operand) -> list:
    """A whole number stays one until it meets something else."""
    if isinstance(operand, list):
        return operand
    try:
        return [(NUMBER, float(operand))]
    except OverflowError as e:
        raise Rejected("number out of range") from e


def _whole(op: int, a: int, b: int) -> int:
    """Arithmetic on two whole-number literals stays whole, so 1/2 is 0."""
    if op in (DIVIDE, REMAINDER):
        if b == 0:
            raise Rejected("divides by zero")
        q = abs(a) // abs(b) * (1 if (a < 0) == (b < 0) else -1)
        return q if op == DIVIDE else a - q * b
    value = a + b if op == ADD else a - b if op == SUBTRACT else a * b
    if value.bit_length() > 1100:
        raise Rejected("number out of range")
    return value


def translate(template: str) -> list[tuple[int, float]]:
    """Postfix program of numbers, v_<i>, + - * / %, signs and parentheses; Rejected for any other text."""
    done: list = []  # whole numbers and programs
    waiting: list[tuple[int, int]] = []  # (rank, step) of operators; rank 0: an open parenthesis

    def settle(rank: int) -> None:
        while waiting and waiting[-1][0] >= rank > 0:
            level, op = waiting.pop()
            b = done.pop()
            if level == _SIGN:
                if op == NEGATE:
                    b = -b if isinstance(b, int) else [*b, (NEGATE, 0.0)] if len(b) < 8 else (b.append((NEGATE, 0.0)) or b)
                done.append(b)
                continue
            a = done.pop()
            if isinstance(a, int) and isinstance(b, int):
                done.append(_whole(op, a, b))
                continue
            a = _steps(a)
            a.extend(_steps(b))
            a.append((op, 0.0))
            done.append(a)

    at, operand = 0, False  # whether an operand has just ended
    while at < len(template):
        m = _PIECE.match(template, at)
        if not m:
            raise Rejected("outside grammar")
        at = m.end()
        number, variable, sign = m.groups()
        if sign == ")":
            if not operand:
                raise Rejected("outside grammar")
            settle(1)
            if not waiting:
                raise Rejected("outside grammar")
            waiting.pop()
        elif sign and operand and sign != "(":
            rank, op = _BINARY[sign]
            settle(rank)
            waiting.append((rank, op))
            operand = False
        elif operand:
            raise Rejected("outside grammar")
        elif sign == "(":
            waiting.append((0, 0))
        elif sign in ("-", "+"):
            waiting.append((_SIGN, NEGATE if sign == "-" else ADD))
        elif sign:
            raise Rejected("outside grammar")
        else:
            done.append([(VARIABLE, float(variable))] if variable else _number(number))
            operand = True
    if not operand:
        raise Rejected("outside grammar")
    settle(1)
    if waiting or len(done) != 1:
        raise Rejected("outside grammar")
    return _fused(_steps(done[0]))


def _fused(steps: list[tuple[int, float]]) -> list[tuple[int, float]]:
    """The steps, with a number or variable that is a right operand taken into the step that uses it."""
    out: list[tuple[int, float]] = []
    for op, x in steps:
        if ADD <= op <= REMAINDER and out[-1][0] in (NUMBER, VARIABLE):
            kind, x = out.pop()
            op += BY_NUMBER if kind == NUMBER else BY_VARIABLE
        out.append((op, x))
    return out


def _translated(template: str | None) -> dict:
    if template is None:
        return {"program": None, "reason": "unbound name"}
    try:
        return {"program": [{"op": op, "x": x} for op, x in translate(template)], "reason": None}
    except Rejected as e:
        return {"program": None, "reason": str(e)}


@F.pandas_udf(
    T.StructType([
        T.StructField("program", T.ArrayType(T.StructType([T.StructField("op", T.IntegerType()), T.StructField("x", T.DoubleType())]))),
        T.StructField("reason", T.StringType()),
    ])
)
def translated(template: pd.Series) -> pd.DataFrame:
    """Program of each template, or why there is none; each distinct template of a batch is translated once."""
    made = {t: _translated(t) for t in template.dropna().unique()}
    none = _translated(None)
    return pd.DataFrame([made[t] if isinstance(t, str) else none for t in template], columns=["program", "reason"])


def evaluate(program: Column, values: Column) -> Column:
    """Value of a program over the array `values`. Null where there is no program, or something is divided by zero.

    The top of the stack is kept apart from the rest, so most steps build no array; `values` is built once a row. A filter on the
    result would repeat all of it: see `with_once`.
    """

    def state(top: Column, rest: Column, held: Column) -> Column:
        return F.struct(top.alias("top"), rest.alias("rest"), held.alias("held"))

    def step(stack: Column, s: Column) -> Column:
        op, top, rest, held = s["op"], stack["top"], stack["rest"], stack["held"]
        alone = op > REMAINDER
        variable = F.get(held, s["x"].cast("int"))
        a = F.when(alone, top).otherwise(F.get(rest, F.size(rest) - 1))
        b = F.when(op >= BY_VARIABLE, variable).when(alone, s["x"]).otherwise(top)
        kind = F.pmod(op, F.lit(BY_NUMBER))
        made = (
            F.when(kind == ADD, a + b).when(kind == SUBTRACT, a - b).when(kind == MULTIPLY, a * b)
            .when(kind == DIVIDE, F.try_divide(a, b)).when(kind == REMAINDER, F.when(b != 0, a % b))
        )
        return state(
            F.when(op == NUMBER, s["x"]).when(op == VARIABLE, variable).when(op == NEGATE, -top).otherwise(made),
            F.when(alone | (op == NEGATE), rest).when(op <= VARIABLE, F.concat(rest, F.array(top)))
            .otherwise(F.slice(rest, F.lit(1), F.size(rest) - 1)),
            held,
        )

    none = state(F.lit(None).cast("double"), F.array().cast("array<double>"), values)
    return F.aggregate(program, none, step, lambda stack: stack["top"])
