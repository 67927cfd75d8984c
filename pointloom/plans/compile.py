"""Rule compilation: point configuration + device tree -> rule rows, in one pass over the point table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointloom.functions.formula import compile_same_device, parse_call, parse_formula, strip_controls
from pointloom.functions.once import with_once
from pointloom.operators.snapshot import spread
from pointloom.operators.topology import expand_children, join_config, resolve_model
from pointloom.plans.registry import FORMULA_FUNCTIONS, ROLLUPS, CallContext, Compiled, register_function
from pointloom.schemas import RULE_KEY
from pointloom.sources.changes import COMPUTED_SOURCES

DEPS = "array<struct<var:string,company_id:int,device_code:string,point_code:string>>"
PARAMS = "array<struct<name:string,value:string>>"

# Granularity argument of energyUseCalcNew -> calculation.
GRANULARITIES = {
    "hour": "HOUR_DIFF", "day": "DAY_DIFF", "month": "MONTH_DIFF", "year": "YEAR_DIFF", "all": "TOTAL_DIFF",
}


def _param(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), value.alias("value"))


def _own_point(c: CallContext) -> Column:
    """The single dependency `a` on the point named by the first argument, same device."""
    return F.array(
        F.struct(
            F.lit("a").alias("var"), c.company_id.cast("int").alias("company_id"),
            c.device_code.alias("device_code"), c.arg(0).alias("point_code"),
        )
    )


def _needs(c: CallContext, n: int) -> Column:
    return F.when(F.size(c.args) < n, "too few arguments")


def _energy(c: CallContext) -> Compiled:
    unit = F.lower(c.arg(1))
    expr = F.lit(None).cast("string")
    for name, calculation in GRANULARITIES.items():
        expr = F.when(unit == name, calculation).otherwise(expr)
    reason = F.coalesce(_needs(c, 2), F.when(expr.isNull(), "unknown granularity"))
    return Compiled(expr, F.lit(1), _own_point(c), reason=reason)


def _bit(c: CallContext) -> Compiled:
    return Compiled(F.lit("DEC_TO_BIN"), F.lit(1), _own_point(c), F.array(_param("bit", c.arg(1))), _needs(c, 2))


def _stats(c: CallContext) -> Compiled:
    return Compiled(
        F.lit("DAILY_STATS"), F.lit(1), _own_point(c), F.array(_param("type", F.lower(c.arg(1)))), _needs(c, 2)
    )


def _same_device(c: CallContext) -> Compiled:
    made = compile_same_device(c.arg(0), c.company_id, c.device_code)
    return Compiled(made["expr"], F.lit(0), made["depends_on"], reason=_needs(c, 1))


def _rollup(name: str):
    def compiled(c: CallContext) -> Compiled:
        # children stay in the object table; `rollup_dependencies` joins them when the rule runs
        params = F.array(_param("model", c.arg(0)), _param("point", c.arg(1)))
        return Compiled(F.lit(name), F.lit(1), params=params, reason=_needs(c, 2))

    return compiled


register_function("energyUseCalcNew", _energy)
register_function("decToBin", _bit)
register_function("calcDailyStats", _stats)
register_function("calcConstant", _same_device)
register_function("calcSum", _rollup("CHILD_SUM"))
register_function("calcAvg", _rollup("CHILD_AVG"))


def _as_struct(c: Compiled) -> Column:
    none_deps, none_params = F.array().cast(DEPS), F.array().cast(PARAMS)
    return F.struct(
        c.expr.alias("expr"), c.expr_type.cast("int").alias("expr_type"),
        (none_deps if c.depends_on is None else c.depends_on.cast(DEPS)).alias("depends_on"),
        (none_params if c.params is None else c.params.cast(PARAMS)).alias("params"),
        c.reason.cast("string").alias("reason"),
    )


def compile_formula(formula: Column, data_source: Column, company_id: Column, device_code: Column, call: Column, parsed: Column) -> Column:
    """STRUCT(expr, expr_type, depends_on, params, reason) of one point formula.

    `parsed` and `call` are columns holding parse_formula(...) and parse_call(parsed.expr).
    """
    text = F.get_json_object(formula, "$.formula")
    constant = F.when(strip_controls(formula).startswith("{"), F.coalesce(text, formula)).otherwise(formula)
    context = CallContext(call["args"], company_id, device_code)
    is_call = (parsed["expr_type"] == 1) & call.isNotNull()
    out = F.when(data_source == 3, _as_struct(Compiled(constant, F.lit(2))))
    for name, function in FORMULA_FUNCTIONS.items():
        out = out.when(is_call & (call["name"] == name), _as_struct(function(context)))
    unknown = Compiled(parsed["expr"], F.lit(1), reason=F.lit("unknown function"))
    plain = Compiled(parsed["expr"], parsed["expr_type"], parsed["depends_on"])
    return out.when(is_call, _as_struct(unknown)).otherwise(_as_struct(plain))


def compile_points(points: DataFrame, objects: DataFrame) -> DataFrame:
    """Every computed or constant point with its object, compiled, including rejected ones (`reason` not null)."""
    live = points.where(F.col("data_source").isin(*COMPUTED_SOURCES)).select(
        "data_id", "company_id", "object_id", "data_code", "data_type", "data_source", "formula"
    )
    # parsing is CPU work on small rows: spread it evenly, whatever the files or the object a point belongs to
    rows = spread(join_config(live, objects), "data_id")
    rows = with_once(rows, "_parsed", parse_formula(F.col("formula"), F.col("company_id")))
    rows = with_once(rows, "_call", F.when(F.col("_parsed.expr_type") == 1, parse_call(F.col("_parsed.expr"))))
    rows = with_once(
        rows, "_c",
        compile_formula(
            F.col("formula"), F.col("data_source"), F.col("company_id"), F.col("object_code"),
            F.col("_call"), F.col("_parsed"),
        ),
    )
    compiled = rows.select(
        "data_id", "object_id",
        F.col("company_id").cast("string").alias("company_id"),
        F.col("object_code").alias("device_code"),
        F.col("data_code").alias("point_code"),
        F.lit(2).alias("point_type"),
        F.coalesce(F.col("data_type").try_cast("int"), F.lit(0)).alias("value_type"),
        F.col("_c.expr_type").alias("expr_type"),
        F.col("_c.expr").alias("expr"),
        F.col("_c.depends_on").alias("dependencies"),
        F.col("_c.params").alias("parameters"),
        F.coalesce("status", F.lit(0)).alias("enabled"),
        F.col("_c.reason").alias("reason"),
    )
    # the newest good row of a key is the rule, as in a table with that unique key
    w = Window.partitionBy(*RULE_KEY, F.col("reason").isNull()).orderBy(F.col("data_id").desc())
    older = F.col("reason").isNull() & (F.row_number().over(w) > 1)
    return compiled.withColumn("reason", F.when(older, "duplicate key").otherwise(F.col("reason")))


def rule_rows(compiled: DataFrame) -> DataFrame:
    """Good rules as RULE rows, dependencies and parameters as JSON text."""
    return compiled.where(F.col("reason").isNull()).select(
        *RULE_KEY, "point_type", "value_type", "expr_type", "expr",
        F.to_json("dependencies").alias("depends_on"), F.to_json("parameters").alias("params"), "enabled",
    )


def compile_rules(points: DataFrame, objects: DataFrame) -> DataFrame:
    """RULE rows of all live computed and constant points."""
    return rule_rows(compile_points(points, objects))


def rejected_rules(points: DataFrame, objects: DataFrame, models: DataFrame) -> DataFrame:
    """(RULE_KEY, reason) of formulas that cannot run."""
    compiled = compile_points(points, objects)
    failed = compiled.where(F.col("reason").isNotNull()).select(*RULE_KEY, "reason")
    rollups = rollup_watches(compiled)
    no_model = rollups.join(
        models.select("company_id", F.col("object_code").alias("model_code")), ["company_id", "model_code"], "left_anti"
    )
    return failed.unionByName(
        no_model.select(F.col("company_id").cast("string").alias("company_id"), "device_code", "point_code", F.lit("unknown model").alias("reason"))
    )


def rollup_watches(compiled: DataFrame) -> DataFrame:
    """Roll-up rules with what they watch: (object_id, model_code, RULE_KEY, point)."""
    def param(i: int) -> Column:
        return F.get("parameters", F.lit(i))["value"]

    return compiled.where(F.col("reason").isNull() & F.col("expr").isin(*ROLLUPS) & (F.col("expr_type") == 1)).select(
        F.col("company_id").cast("int").alias("company_id"), "object_id", "device_code", "point_code",
        param(0).alias("model_code"), param(1).alias("child_point"),
    )


def rollup_dependencies(rules: DataFrame, objects: DataFrame, models: DataFrame) -> DataFrame:
    """One row per roll-up rule and child: (RULE_KEY, dep_device_code, dep_point_code).

    `rules` are RULE rows whose expr is a roll-up. A parent is found by its code, the model by company and code.
    """
    params = F.from_json("params", PARAMS)

    def param(name: str) -> Column:
        return F.get(F.filter(params, lambda p: p["name"] == name), F.lit(0))["value"]

    wanted = rules.select(
        F.col("company_id").cast("int").alias("company_id"), "device_code", "point_code",
        param("model").alias("model_code"), param("point").alias("dep_point_code"),
    )
    parents = objects.select("company_id", F.col("object_code").alias("device_code"), "object_id")
    placed = resolve_model(wanted, models).join(parents, ["company_id", "device_code"])
    # an object that was replaced under a new id leaves its old row: its code still counts once
    return expand_children(placed, objects).select(
        F.col("company_id").cast("string").alias("company_id"), "device_code", "point_code",
        F.col("child_code").alias("dep_device_code"), "dep_point_code",
    ).distinct()
