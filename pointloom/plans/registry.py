"""Extension points: formula functions known to the compiler and calculations known to the engine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from pointloom.functions.bits import bit_at


@dataclass(frozen=True)
class CallContext:
    """What a formula function sees of its point: Columns, not rows."""

    args: Column
    company_id: Column
    device_code: Column

    def arg(self, i: int) -> Column:
        return F.get(self.args, F.lit(i))


@dataclass(frozen=True)
class Compiled:
    """What a formula function yields. `reason` says why the call is rejected; null when it is good."""

    expr: Column
    expr_type: Column
    depends_on: Column | None = None
    params: Column | None = None
    reason: Column = field(default_factory=lambda: F.lit(None).cast("string"))


FormulaFunction = Callable[[CallContext], Compiled]


@dataclass(frozen=True)
class FiredContext:
    """What a calculation sees of a firing. The period aggregates run from the start of the calculation's period
    to the present firing, per rule."""

    value: Column
    first: Column
    maximum: Column
    minimum: Column
    total: Column
    count: Column
    params: Column

    def param(self, name: str) -> Column:
        named = F.filter(self.params, lambda p: p["name"] == name)
        return F.get(named, F.lit(0))["value"]


@dataclass(frozen=True)
class Calculation:
    """`period` is hour, day, month, year, total or None (no period aggregates needed)."""

    value: Callable[[FiredContext], Column]
    period: str | None = None


def _difference(c: FiredContext) -> Column:
    return c.value - c.first


def _statistic(c: FiredContext) -> Column:
    kind = F.lower(F.coalesce(c.param("type"), F.lit("max")))  # named once: it is looked up in each firing
    known = F.array(F.lit("max"), F.lit("min"), F.lit("avg"))
    return F.get(F.array(c.maximum, c.minimum, c.total / c.count), (F.array_position(known, kind) - 1).cast("int"))


def _bit(c: FiredContext) -> Column:
    return bit_at(c.value, F.coalesce(c.param("bit").try_cast("int"), F.lit(0)))


# Fixed names of the built-in calculations.
CALCULATIONS: dict[str, Calculation] = {
    "HOUR_DIFF": Calculation(_difference, "hour"),
    "DAY_DIFF": Calculation(_difference, "day"),
    "MONTH_DIFF": Calculation(_difference, "month"),
    "YEAR_DIFF": Calculation(_difference, "year"),
    "TOTAL_DIFF": Calculation(_difference, "total"),
    "DAILY_STATS": Calculation(_statistic, "day"),
    "DEC_TO_BIN": Calculation(_bit),
}
ARITHMETIC = "ARITHMETIC"
ROLLUPS = ("CHILD_SUM", "CHILD_AVG")

FORMULA_FUNCTIONS: dict[str, FormulaFunction] = {}


def register_calculation(name: str, calculation: Calculation) -> None:
    """Make `name` usable as the expr of a function rule."""
    CALCULATIONS[name] = calculation


def register_function(name: str, function: FormulaFunction) -> None:
    """Make `name(...)` usable in point formulas."""
    FORMULA_FUNCTIONS[name] = function
