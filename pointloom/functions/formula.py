"""Reading of rule formulas as Spark expressions: JSON form, call form, same-device form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pointloom.schemas import FORMULA_JSON

# Fixed values of the formula language.
CALL_PATTERN = r"^([a-zA-Z0-9_]+)\s*\((.*)\)$"
IDENTIFIER = r"[a-zA-Z_][a-zA-Z0-9_]*"
KEYWORDS = ["true", "false", "null", "and", "or", "not"]
QUOTES = "['\"‘’“”]"


def strip_controls(text: Column) -> Column:
    """Trim blanks and control characters (code points up to U+0020) at both ends."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def parse_formula(formula: Column, company_id: Column) -> Column:
    """STRUCT(expr, expr_type, depends_on ARRAY<STRUCT<var, company_id, device_code, point_code>>)."""
    dep_type = "array<struct<var:string,company_id:int,device_code:string,point_code:string>>"
    none = F.array().cast(dep_type)
    text = strip_controls(formula)
    doc = F.from_json(formula, FORMULA_JSON, {"columnNameOfCorruptRecord": "_bad"})
    variables = F.coalesce(doc["vars"], F.array().cast("array<struct<name:string,data_code:string,object_code:string>>"))
    deps = F.transform(
        variables,
        lambda v: F.struct(
            F.coalesce(v["name"], F.lit("")).alias("var"),
            company_id.cast("int").alias("company_id"),
            F.coalesce(v["object_code"], F.lit("")).alias("device_code"),
            F.coalesce(v["data_code"], F.lit("")).alias("point_code"),
        ),
    )
    named = F.exists(variables, lambda v: F.coalesce(v["name"], F.lit("")) != "")
    is_call = formula.contains("(") & formula.contains(")")

    def result(expr: Column, expr_type: Column, depends_on: Column) -> Column:
        return F.struct(
            expr.alias("expr"), expr_type.cast("int").alias("expr_type"), depends_on.cast(dep_type).alias("depends_on")
        )

    return (
        F.when(F.coalesce(text, F.lit("")) == "", result(F.lit(""), F.lit(0), none))
        .when(~text.startswith("{"), result(formula, F.when(is_call, 1).otherwise(0), none))
        .when(doc["_bad"].isNotNull(), result(formula, F.lit(0), none))
        .otherwise(result(F.coalesce(doc["formula"], F.lit("")), F.when(named, 0).otherwise(1), deps))
    )


def parse_call(expr: Column) -> Column:
    """STRUCT(name, args) of `name(arg, ...)`; null when the text is not a call."""
    name = F.regexp_extract(expr, CALL_PATTERN, 1)
    inner = F.regexp_extract(expr, CALL_PATTERN, 2)
    # trailing empty arguments do not count
    kept = F.regexp_replace(inner, r",+$", "")
    parts = F.when(strip_controls(kept) == "", F.array().cast("array<string>")).otherwise(F.split(kept, ","))
    args = F.transform(parts, lambda a: F.regexp_replace(strip_controls(a), f"^{QUOTES}|{QUOTES}$", ""))
    return F.when(expr.rlike(CALL_PATTERN), F.struct(name.alias("name"), args.alias("args")))


def variable_name(index: Column) -> Column:
    """0 -> a, 25 -> z, 26 -> aa, 702 -> aaa, and so on: seven letters, enough for any array."""
    digits = F.aggregate(
        F.sequence(F.lit(1), F.lit(7)),
        F.struct((index.cast("long") + 1).alias("n"), F.lit("").alias("s")),
        lambda a, _: F.struct(
            F.when(a["n"] > 0, F.floor((a["n"] - 1) / 26)).otherwise(F.lit(0)).cast("long").alias("n"),
            F.when(a["n"] > 0, F.concat(F.char(F.lit(97) + (a["n"] - 1) % 26), a["s"])).otherwise(a["s"]).alias("s"),
        ),
    )
    return digits["s"]


def formula_tokens(formula: Column) -> Column:
    """Text cut into identifiers and the pieces between them; joined again it gives the text."""
    return F.regexp_extract_all(formula, F.lit(f"({IDENTIFIER}|[^a-zA-Z_]+)"), F.lit(1))


def is_point_name(token: Column) -> Column:
    return token.rlike(f"^{IDENTIFIER}$") & ~F.lower(token).isin(KEYWORDS)


def compile_same_device(formula: Column, company_id: Column, device_code: Column) -> Column:
    """Each distinct point name becomes a, b, ... in order of first use and a dependency on the own device."""
    tokens = formula_tokens(formula)
    names = F.array_distinct(F.filter(tokens, is_point_name))
    deps = F.transform(
        names,
        lambda n, i: F.struct(
            variable_name(i).alias("var"),
            company_id.cast("int").alias("company_id"),
            device_code.alias("device_code"),
            n.alias("point_code"),
        ),
    )
    renamed = F.transform(
        tokens,
        lambda t: F.when(is_point_name(t), variable_name(F.array_position(names, t) - F.lit(1))).otherwise(t),
    )
    return F.struct(
        F.array_join(renamed, "").alias("expr"), F.lit(0).alias("expr_type"), deps.alias("depends_on")
    )


def constant_value(expr: Column) -> Column:
    """Number of a constant rule: a plain number, or the `formula` field of a JSON text."""
    text = F.get_json_object(expr, "$.formula")
    has_field = text.isNotNull()
    return F.when(expr.startswith("{"), F.when(has_field, F.coalesce(text.try_cast("double"), F.lit(0.0)))).otherwise(
        expr.try_cast("double")
    )
