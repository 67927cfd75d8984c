"""Derivation of points: readings + rule rows -> derived points."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointloom.functions.arithmetic import PROGRAM, evaluate, template_text, translated
from pointloom.functions.calendar import period_key
from pointloom.functions.formula import constant_value
from pointloom.functions.once import with_once
from pointloom.operators.binding import all_bound, bind_events, bound_runs, operand_events, operand_spans, rollup
from pointloom.operators.constants import active_constants
from pointloom.operators.snapshot import device_firings, slot_latest
from pointloom.plans.compile import DEPS, PARAMS, rollup_dependencies
from pointloom.plans.lineage import Rounds, materialize
from pointloom.plans.registry import ARITHMETIC, CALCULATIONS, ROLLUPS, FiredContext
from pointloom.schemas import MINUTE_MS, RULE_KEY, SERIES, TICK, WINDOW_SLOTS

WIDE_OPERANDS = 16  # operands bound as columns; longer formulas bind as one array, with the same results
MOST_LAYERS = 8  # refreshes that a rule set is read through before it is written as a whole
CYCLE = "cycle"  # reason of rules on a cycle or behind one
OPERAND = ["company_id", "dep_device_code", "dep_point_code"]


def active_rules(rules: DataFrame) -> DataFrame:
    """Enabled derived rules (a missing `enabled` counts as enabled)."""
    return rules.where((F.col("point_type") == 2) & (F.coalesce("enabled", F.lit(1)) != 0))


@dataclass
class RuleSet:
    """Rule rows taken apart: `rules` one row per rule that can fire, `deps` one row per operand, `constants` values by series.

    `arity`: most operands by route, as far as they are bound as columns. `groups`: which (level, route, long, periodic) there
    are. `rejected`: (RULE_KEY, reason) of rules that never fire. `layers`: refreshes since it was written as a whole.
    """

    rules: DataFrame
    deps: DataFrame
    constants: DataFrame
    arity: dict[str, int]
    max_level: int
    groups: frozenset[tuple[int, str, bool, bool]]
    rejected: DataFrame
    layers: int = 0

    def has(self, level: int, route: str, long: bool = False, periodic: bool | None = None) -> bool:
        return any((level, route, long, p) in self.groups for p in ((False, True) if periodic is None else (periodic,)))


def periodic_kinds() -> list[str]:
    return [name for name, c in CALCULATIONS.items() if c.period is not None]


def newest_rules(rules: DataFrame) -> DataFrame:
    """One row per RULE_KEY: that of the greatest `seq` where there is such a column, else the greatest row."""
    rest = [c for c in rules.columns if c not in RULE_KEY]
    order = [c for c in ("seq", "data_id") if c in rest]
    first = [*order, *[c for c in rest if c not in order]]
    return rules.groupBy(*RULE_KEY).agg(F.max(F.struct(*first)).alias("_r")).select(*RULE_KEY, "_r.*").select(*rules.columns)


def operands(rules: DataFrame) -> DataFrame:
    """Operand rows of rules with a dependency list: RULE_KEY, idx, var, dep_device_code, dep_point_code.

    A dependency without point code is no operand; one of an arithmetic rule also needs a variable name.
    """
    deps = F.from_json("depends_on", DEPS)
    usable = F.filter(
        deps,
        lambda d: d["point_code"].isNotNull() & ((F.col("expr_type") != 0) | d["var"].isNotNull()),
    )
    return rules.select(*RULE_KEY, F.posexplode(usable).alias("idx", "_d")).select(
        *RULE_KEY, "idx", F.col("_d.var").alias("var"), F.col("_d.device_code").alias("dep_device_code"),
        F.col("_d.point_code").alias("dep_point_code"),
    )


def rule_levels(rules: DataFrame, deps: DataFrame) -> tuple[DataFrame, int, DataFrame]:
    """(RULE_KEY, level) of rules that depend on derived points, the highest level, and the rules that never settle.

    Level n rules depend on rules up to level n-1, as many levels as the rules have. Those left when no rule settles any more
    are on a cycle or depend on one.
    """
    point = ["company_id", "dep_device_code", "dep_point_code"]

    def results(df: DataFrame) -> DataFrame:
        return df.select(
            "company_id", F.col("device_code").alias("dep_device_code"), F.col("point_code").alias("dep_point_code")
        ).distinct()

    left = deps.join(results(rules), point, "left_semi").select(*RULE_KEY, *point[1:])
    levels = left.select(*RULE_KEY, F.lit(0).alias("level")).limit(0)
    if left.isEmpty():
        return levels, 0, left.select(*RULE_KEY).limit(0)
    left = materialize(left.distinct())
    level = 0
    while not left.isEmpty():
        waiting = left.join(results(left), point, "left_semi").select(*RULE_KEY).distinct()
        ready = materialize(left.select(*RULE_KEY).distinct().join(waiting, RULE_KEY, "left_anti"))
        if ready.isEmpty():
            break
        level += 1
        levels = levels.unionByName(ready.withColumn("level", F.lit(level)))
        left = materialize(left.join(ready, RULE_KEY, "left_anti"))
    return levels, level, left.select(*RULE_KEY).distinct()


def _taken_apart(rules: DataFrame, objects: DataFrame | None, models: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Heads, with a reason where a rule never fires, and operands of RULE rows, one row a key."""
    live = active_rules(rules).where(F.col("expr_type") != 2)
    is_rollup = (F.col("expr_type") == 1) & F.coalesce(F.col("expr").isin(*ROLLUPS), F.lit(False))
    own = live.where(~is_rollup)
    variables = F.transform(
        F.filter(F.from_json("depends_on", DEPS), lambda d: d["point_code"].isNotNull() & d["var"].isNotNull()),
        lambda d: d["var"],
    )
    devices = F.array_distinct(F.transform(F.from_json("depends_on", DEPS), lambda d: d["device_code"]))
    is_formula = F.col("expr_type") == 0
    own = with_once(own, "_template", F.when(is_formula, template_text(F.col("expr"), variables)))
    own_heads = own.select(
        *RULE_KEY,
        F.when(is_formula, F.lit(ARITHMETIC)).otherwise(F.col("expr")).alias("kind"),
        F.when(is_formula, translated("_template")).alias("_t"),
        F.from_json("params", PARAMS).alias("parameters"),
        F.coalesce(F.when(is_formula, F.size(variables)).otherwise(F.lit(1)), F.lit(0)).alias("n_required"),
        F.coalesce(F.size(devices) > 1, F.lit(False)).alias("many_devices"),
        F.coalesce(F.size(F.filter(F.from_json("depends_on", DEPS), lambda d: d["point_code"].isNotNull())), F.lit(0)).alias("n_deps"),
    )
    heads = own_heads.select(
        *RULE_KEY, "kind", F.col("_t.program").alias("program"), "parameters", "n_required", "many_devices", "n_deps",
        F.when(F.col("kind") == ARITHMETIC, F.coalesce("_t.reason", F.when(F.col("n_required") == 0, "no operand")))
        .otherwise(F.when(~F.coalesce(F.col("kind").isin(*CALCULATIONS), F.lit(False)), "unknown calculation")).alias("reason"),
    )
    deps = operands(own)
    if objects is not None:
        wanted = live.where(is_rollup)
        children = rollup_dependencies(wanted, objects, models)
        counts = children.groupBy(*RULE_KEY).agg(F.count("*").cast("int").alias("n_required"))
        heads = heads.unionByName(
            wanted.join(counts, RULE_KEY, "left").select(
                *RULE_KEY, F.col("expr").alias("kind"), F.lit(None).cast(PROGRAM).alias("program"),
                F.from_json("params", PARAMS).alias("parameters"), F.coalesce("n_required", F.lit(0)).alias("n_required"),
                F.lit(True).alias("many_devices"), F.coalesce("n_required", F.lit(0)).alias("n_deps"), F.when(F.col("n_required").isNull(), "no child").alias("reason"),
            )
        )
        deps = deps.unionByName(
            children.select(*RULE_KEY, F.lit(0).alias("idx"), F.lit(None).cast("string").alias("var"), "dep_device_code", "dep_point_code")
        )
    else:
        heads = heads.unionByName(
            live.where(is_rollup).select(
                *RULE_KEY, F.col("expr").alias("kind"), F.lit(None).cast(PROGRAM).alias("program"), F.from_json("params", PARAMS).alias("parameters"),
                F.lit(0).alias("n_required"), F.lit(True).alias("many_devices"), F.lit(0).alias("n_deps"),
                F.lit("no child").alias("reason"),
            )
        )
    return heads, deps


def _rule_set(heads: DataFrame, deps: DataFrame, constants: DataFrame, rejected: DataFrame, layers: int = 0) -> RuleSet:
    """`heads` with their levels, and what is known of them all."""
    long = (F.col("route") != "rollup") & (F.col("n_required") > WIDE_OPERANDS)
    found = heads.groupBy("level", "route", long.alias("long"), F.col("kind").isin(*periodic_kinds()).alias("periodic")).agg(
        F.max("n_required").alias("n")
    ).collect()  # a few rows a level
    arity: dict[str, int] = {}
    for r in found:
        arity[r["route"]] = max(arity.get(r["route"], 0), min(r["n"], WIDE_OPERANDS))
    depth = max((r["level"] for r in found), default=0)
    groups = frozenset((r["level"], r["route"], r["long"], r["periodic"]) for r in found)
    return RuleSet(heads, deps, constants, arity, depth, groups, rejected, layers)


def _routed(heads: DataFrame) -> DataFrame:
    return heads.withColumn(
        "route",
        F.when(F.col("kind").isin(*ROLLUPS), "rollup")
        .when(F.col("many_devices") | (F.col("level") > 0), "spans")
        .otherwise("runs"),
    )


def prepare_rules(rules: DataFrame, objects: DataFrame | None = None, models: DataFrame | None = None) -> RuleSet:
    """Take RULE rows apart for the engine. Roll-up rules need the object and model tables.

    Rules that can't fire are set aside with a reason: unknown calculation, formula outside the grammar or with a name that
    is no operand, no operand at all, no child, and rules on a cycle.
    """
    rules = newest_rules(rules)
    heads, deps = _taken_apart(rules, objects, models)
    deps = materialize(deps)
    heads = materialize(heads.withColumn("rule_id", F.monotonically_increasing_id()))  # ids are fixed by writing
    rejected = heads.where(F.col("reason").isNotNull()).select(*RULE_KEY, "reason")
    heads = heads.where(F.col("reason").isNull()).drop("reason")
    levels, depth, cycles = rule_levels(heads, deps.join(heads.select(*RULE_KEY), RULE_KEY, "left_semi"))
    if not cycles.isEmpty():
        rejected = rejected.unionByName(cycles.withColumn("reason", F.lit(CYCLE)))
        heads = heads.join(cycles, RULE_KEY, "left_anti")
    if depth > 0:
        heads = heads.join(levels, RULE_KEY, "left").withColumn("level", F.coalesce("level", F.lit(0)))
        heads = materialize(heads)
    else:
        heads = heads.withColumn("level", F.lit(0))
    return _rule_set(_routed(heads), deps, active_constants(rules), rejected)


def _as_operands(rules: DataFrame, *extra: str) -> DataFrame:
    """Results of rules under the names that operands have."""
    return rules.select(
        "company_id", F.col("device_code").alias("dep_device_code"), F.col("point_code").alias("dep_point_code"), *extra
    )


def reached_rules(deps: DataFrame, changed: DataFrame) -> DataFrame:
    """Keys of `changed` and of all rules that depend on them, directly or through other rules.

    A round follows only what the round before found; there are as many as the longest chain has rules.
    """
    found = Rounds(deps.sparkSession)
    front = found.add(changed.select(*RULE_KEY).distinct())
    while not front.isEmpty():
        after = deps.join(_as_operands(front), OPERAND, "left_semi").select(*RULE_KEY).distinct()
        front = found.add(after.join(found.rows(), RULE_KEY, "left_anti"))
    return found.rows()


def levels_above(heads: DataFrame, deps: DataFrame, settled: DataFrame, stuck: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(RULE_KEY, level) of `heads`, and the keys of those on a cycle or behind one.

    They depend on measured points, on each other, on the rules of `settled`, whose levels are known, and on those of `stuck`,
    which are on or behind cycles themselves. A rule is one level above the highest of its operands.
    """
    above = (F.max("level") + 1).alias("level")
    floor = materialize(deps.join(_as_operands(settled, "level"), OPERAND).groupBy(*RULE_KEY).agg(above))
    stuck = _as_operands(stuck)
    left = deps.join(_as_operands(heads).unionByName(stuck), OPERAND, "left_semi")
    left = materialize(left.select(*RULE_KEY, *OPERAND[1:]).distinct())
    levels = Rounds(deps.sparkSession)
    first = heads.select(*RULE_KEY).join(left, RULE_KEY, "left_anti").join(floor, RULE_KEY, "left")
    ready = levels.add(first.select(*RULE_KEY, F.coalesce("level", F.lit(0)).alias("level")))
    while not (left.isEmpty() or ready.isEmpty()):
        waiting = left.join(_as_operands(left).unionByName(stuck), OPERAND, "left_semi").select(*RULE_KEY).distinct()
        free = left.join(waiting, RULE_KEY, "left_anti").join(_as_operands(levels.rows(), "level"), OPERAND)
        made = free.groupBy(*RULE_KEY).agg(above).unionByName(floor.join(free.select(*RULE_KEY), RULE_KEY, "left_semi"))
        ready = levels.add(made.groupBy(*RULE_KEY).agg(F.max("level").alias("level")))
        left = materialize(left.join(ready, RULE_KEY, "left_anti"))
    return levels.rows(), left.select(*RULE_KEY).distinct()


def refresh_rules(
    rs: RuleSet, rules: DataFrame, changed: DataFrame, objects: DataFrame | None = None, models: DataFrame | None = None
) -> RuleSet:
    """`rs` after changes: `rules` is the table as it is now, `changed` holds the RULE_KEYs of rows that came, went or differ.

    Only rules that these reach are taken apart and levelled anew, with new numbers; all others stay as they are. A roll-up
    whose children changed counts as changed. The result is that of `prepare_rules(rules)`.
    """
    reached = reached_rules(rs.deps, changed)
    rows = materialize(newest_rules(rules.join(reached, RULE_KEY, "left_semi")))
    kept = rs.rules.join(reached, RULE_KEY, "left_anti")
    start = kept.agg(F.max("rule_id")).first()[0]
    heads, deps = _taken_apart(rows, objects, models)
    deps = materialize(deps)
    numbered = F.monotonically_increasing_id() + F.lit(0 if start is None else start + 1)
    heads = materialize(heads.withColumn("rule_id", numbered))
    rejected = heads.where(F.col("reason").isNotNull()).select(*RULE_KEY, "reason")
    heads = heads.where(F.col("reason").isNull()).drop("reason")
    stuck = rs.rejected.where(F.col("reason") == CYCLE).join(reached, RULE_KEY, "left_anti")
    levels, cycles = levels_above(heads, deps.join(heads.select(*RULE_KEY), RULE_KEY, "left_semi"), kept, stuck)
    heads = materialize(_routed(heads.join(levels, RULE_KEY)))
    parts = [
        kept.unionByName(heads),
        rs.deps.join(reached, RULE_KEY, "left_anti").unionByName(deps),
        rs.constants.join(
            reached.toDF(*SERIES), SERIES, "left_anti"
        ).unionByName(active_constants(rows)),
        rs.rejected.join(reached, RULE_KEY, "left_anti").unionByName(rejected).unionByName(cycles.withColumn("reason", F.lit(CYCLE))),
    ]
    layers = rs.layers + 1
    if layers >= MOST_LAYERS:
        parts, layers = [materialize(p) for p in parts], 0
    return _rule_set(*parts, layers)


def _computed(arity: int):
    return evaluate(F.col("program"), F.array(*[F.col(f"v_{i}") for i in range(arity)]))


def _same_device(
    heads: DataFrame, slots: DataFrame, firings: DataFrame, rs: RuleSet, slide_ms: int, width: int, max_age: int | None = None
) -> DataFrame:
    arity = rs.arity["runs"]
    consts = (
        rs.deps.withColumnRenamed("dep_device_code", "device_id").withColumnRenamed("dep_point_code", "property_name")
        .join(rs.constants, ["company_id", "device_id", "property_name"])
        .groupBy(*RULE_KEY)
        .agg(F.array(*[F.max(F.when(F.col("idx") == i, F.col("const"))) for i in range(arity)]).alias("consts"))
    )
    deps = rs.deps.join(heads.select(*RULE_KEY, "rule_id"), RULE_KEY).join(consts, RULE_KEY, "left")
    deps = deps.withColumn("consts", F.coalesce("consts", F.array_repeat(F.lit(None).cast("double"), arity)))
    runs = bound_runs(slots, firings, deps.drop("var"), arity, (), width, max_age)
    runs = runs.join(heads.select("rule_id", "kind", "program", "parameters", "n_required"), "rule_id")
    runs = runs.where(all_bound(arity, F.col("n_required"))).withColumn("computed", _computed(arity))
    return runs.select(
        "rule_id", *RULE_KEY, "kind", "parameters", F.col("v_0").alias("value"), "computed", "slot",
        F.posexplode(F.slice("firings", F.lit(1), F.col("n"))).alias("_i", "_offset"),
    ).select(
        "rule_id", *RULE_KEY, "kind", "parameters", "value", "computed",
        ((F.col("slot") + 1 + F.col("_i")) * slide_ms).alias("tick_ms"),
        (F.col("slot") * slide_ms + F.col("_offset")).alias("snapshot_ms"),
    )


def _deps_of(heads: DataFrame, rs: RuleSet) -> DataFrame:
    return rs.deps.join(heads.select(*RULE_KEY, "rule_id"), RULE_KEY).drop("var", "device_code", "point_code")


def _many_devices(heads, slots, firings, rs: RuleSet, derived, slide_ms: int, width: int, max_age: int | None = None) -> DataFrame:
    arity = max(rs.arity.get("spans", 1), rs.arity.get("runs", 1) if slots is None else 1)
    events = operand_events(slots, firings, _deps_of(heads, rs), derived, rs.constants, slide_ms, width, max_age)
    attributes = heads.select("rule_id", *RULE_KEY, "kind", "program", "parameters", "n_required")
    bound = bind_events(events, attributes, arity, max_age)
    return bound.select(
        "rule_id", *RULE_KEY, "kind", "parameters", F.col("v_0").alias("value"), _computed(arity).alias("computed"),
        (F.col("tick") * slide_ms).alias("tick_ms"), "snapshot_ms",
    )


def _long_formulas(heads, slots, firings, rs: RuleSet, derived, slide_ms: int, width: int, max_age: int | None = None) -> DataFrame:
    """Formulas with more operands than are bound as columns: values gathered per firing, at most one per operand."""
    spans = operand_spans(slots, firings, _deps_of(heads, rs), derived, rs.constants, slide_ms, width, max_age)
    gathered = spans.groupBy("rule_id", "tick").agg(
        F.max("snapshot_ms").alias("snapshot_ms"),
        F.array_sort(F.collect_list(F.struct("idx", "value"))).alias("_v"),
    )
    rows = gathered.where(F.col("snapshot_ms").isNotNull()).join(
        heads.select("rule_id", *RULE_KEY, "kind", "program", "parameters", "n_required"), "rule_id"
    ).where(F.size("_v") == F.col("n_required"))
    values = F.transform("_v", lambda x: x["value"])
    return rows.select(
        "rule_id", *RULE_KEY, "kind", "parameters", F.get(values, F.lit(0)).alias("value"),
        evaluate(F.col("program"), values).alias("computed"),
        (F.col("tick") * slide_ms).alias("tick_ms"), "snapshot_ms",
    )


def _rollups(heads, slots, firings, rs: RuleSet, derived, slide_ms: int, width: int, max_age: int | None = None) -> DataFrame:
    deps = _deps_of(heads, rs)
    # each child is an operand of its own: its series stands for its number
    events = materialize(operand_events(slots, firings, deps, derived, rs.constants, slide_ms, width, max_age))
    sums = rollup(events, heads.select("rule_id", *RULE_KEY, "kind", F.col("n_required").alias("n_children")))
    value = F.when(F.col("kind") == "CHILD_AVG", F.col("total") / F.col("n_children")).otherwise(F.col("total"))
    return sums.select(
        (F.col("tick") * slide_ms).alias("tick_ms"), "snapshot_ms", "company_id",
        F.col("device_code").alias("device_id"), F.col("point_code").alias("property_name"), value.alias("value"),
    )


AGGREGATES = {"first": F.first, "max": F.max, "min": F.min, "sum": F.sum, "count": F.sum}


def rule_period(tz: str) -> Column:
    """Period of a firing by the calculation of its rule: a number, 0 where the calculation has none."""
    period = F.lit(0).cast("bigint")
    units: dict[str, list[str]] = {}
    for name, c in CALCULATIONS.items():
        if c.period not in (None, "total"):
            units.setdefault(c.period, []).append(name)
    for unit, names in units.items():
        period = F.when(F.col("kind").isin(*names), period_key(F.col("snapshot_ms"), unit, tz)).otherwise(period)
    return period


def with_period_aggregates(fired: DataFrame, tz: str = "UTC", carried: DataFrame | None = None) -> DataFrame:
    """Adds first, max, min, sum and count of `value` from the start of the rule's period to each firing.

    A rule has one period, so one window serves all calculations. `carried` holds what earlier batches left per
    rule and period (RULE_KEY, _period and the aggregates); it continues them.
    """
    own = {"first": "value", "max": "value", "min": "value", "sum": "value"}
    rows = fired.withColumn("_period", rule_period(tz)).withColumns(
        {**{f"_{a}": F.col(c) for a, c in own.items()}, "_count": F.lit(1.0)}
    )
    if carried is not None:
        rows = rows.unionByName(carried.withColumn("tick_ms", F.lit(0).cast("bigint")), allowMissingColumns=True)
    # rule ids are numbers of one rule set; what earlier batches left is known by the rule's key
    by = RULE_KEY if carried is not None else ["rule_id"]
    w = (
        Window.partitionBy(*by, "_period").orderBy("tick_ms")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = rows.withColumns({f"_{a}": fn(f"_{a}").over(w) for a, fn in AGGREGATES.items()})
    return rows.where(F.col("tick_ms") > 0) if carried is not None else rows


def calculate(rows: DataFrame) -> DataFrame:
    """Apply each firing's calculation to rows with period aggregates."""
    context = FiredContext(*[F.col(c) for c in ("value", *[f"_{a}" for a in AGGREGATES], "parameters")])
    result = F.when(F.col("kind") == ARITHMETIC, F.col("computed"))
    for name, c in CALCULATIONS.items():
        result = result.when(F.col("kind") == name, c.value(context))
    return with_once(rows, "_result", result).where(F.col("_result").isNotNull()).select(
        "tick_ms", "snapshot_ms", "company_id", F.col("device_code").alias("device_id"),
        F.col("point_code").alias("property_name"), F.col("_result").alias("value"),
    )


def without_period(fired: DataFrame) -> DataFrame:
    """Rows of calculations that need no period, as `calculate` takes them."""
    return fired.withColumns({f"_{a}": F.lit(None).cast("double") for a in AGGREGATES})


def derive(
    readings: DataFrame, rules: DataFrame | RuleSet, objects: DataFrame | None = None, models: DataFrame | None = None,
    tz: str = "UTC", slide_ms: int = MINUTE_MS, width: int = WINDOW_SLOTS, max_age: int | None = None,
) -> DataFrame:
    """All derived points of all firings: (tick_ms, snapshot_ms, company_id, device_id, property_name, value).

    With `max_age` an operand is bound up to so many slots after that of its last reading. Rules on derived points run after those they depend on, level by level; the results of a level are written once, but for the last.
    """
    rs = rules if isinstance(rules, RuleSet) else prepare_rules(rules, objects, models)
    slots = slot_latest(readings, slide_ms)
    firings = device_firings(readings, slide_ms, width)
    if rs.max_level > 0:
        slots, firings = materialize(slots), materialize(firings)
    periodic = F.col("kind").isin(*periodic_kinds())
    long = F.col("n_required") > WIDE_OPERANDS
    made: list[DataFrame] = []
    for level in range(rs.max_level + 1):
        here = rs.rules.where(F.col("level") == level)
        args = (slots, firings, rs, _union(made) if level > 0 else None, slide_ms, width, max_age)
        parts: list[DataFrame] = []
        for of_period in (False, True):
            aggregated = (lambda rows: with_period_aggregates(rows, tz)) if of_period else without_period
            some = here.where(periodic if of_period else ~periodic)
            if rs.has(level, "runs", False, of_period):
                parts.append(calculate(aggregated(_same_device(some.where((F.col("route") == "runs") & ~long), slots, firings, rs, slide_ms, width, max_age))))
            if rs.has(level, "spans", False, of_period):
                parts.append(calculate(aggregated(_many_devices(some.where((F.col("route") == "spans") & ~long), *args))))
            if rs.has(level, "runs", True, of_period) or rs.has(level, "spans", True, of_period):
                parts.append(calculate(aggregated(_long_formulas(some.where((F.col("route") != "rollup") & long), *args))))
        if rs.has(level, "rollup"):
            parts.append(_rollups(here.where(F.col("route") == "rollup"), *args))
        if parts:
            made.append(materialize(_union(parts)) if level < rs.max_level else _union(parts))  # the last is read once
    return _union(made) if made else readings.sparkSession.createDataFrame([], TICK)


def rejected_rule_rows(rules: DataFrame, objects: DataFrame | None = None, models: DataFrame | None = None) -> DataFrame:
    """(RULE_KEY, reason) of RULE rows that never fire: what `prepare_rules` sets aside, constants that are no numbers, and
    all but the newest row of a key.
    """
    kept = newest_rules(rules)
    constants = active_rules(kept).where((F.col("expr_type") == 2) & constant_value(F.col("expr")).isNull())
    twice = rules.groupBy(*RULE_KEY).count().where(F.col("count") > 1)
    return prepare_rules(rules, objects, models).rejected.unionByName(
        constants.select(*RULE_KEY, F.lit("unreadable constant").alias("reason"))
    ).unionByName(twice.select(*RULE_KEY, F.lit("duplicate key").alias("reason")))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
