"""Which rules fire at which window ends, and with which values of their operands.

A dependency table has one row per rule operand: RULE_KEY, `idx` (operand number), the operand's series
(`company_id`, `dep_device_code`, `dep_point_code`) and any attributes of the rule. Rules work on runs as the
snapshots do: a rule's run starts at a slot in which one of its operands has a reading, keeps its values up to the
next such slot, and fires for at most `width` window ends. Window ends are written out last.

Values are known for ever, or with `max_age` (a number of slots) at window ends up to so many after the slot of their
reading: then the operand is unbound until its next reading. Constants have no age.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointloom.operators.exact import limb_range, limbs, with_total
from pointloom.operators.snapshot import slot_latest, spread
from pointloom.schemas import DEVICE, MINUTE_MS, RULE_KEY, SERIES, WINDOW_SLOTS


def rule_key(df: DataFrame) -> list[str]:
    """How rows name their rule: by `rule_id` where they have it, else by RULE_KEY."""
    return ["rule_id"] if "rule_id" in df.columns else list(RULE_KEY)


def operand_slots(slots: DataFrame, deps: DataFrame, *extra: str) -> DataFrame:
    """Slot rows of the series some rule depends on, once per depending operand.

    The rule side is not forced to be broadcast: adaptive execution does so while it is small.
    """
    d = deps.withColumnRenamed("dep_device_code", "device_id").withColumnRenamed("dep_point_code", "property_name")
    return slots.where(F.col("value").isNotNull()).select(*SERIES, "slot", "value", *extra).join(d, SERIES)


def _run_length(w, width: int) -> Column:
    """0 for all but the last row of a slot, so several operands read in one slot give one run."""
    gap = F.lead("slot").over(w) - F.col("slot")
    return F.least(F.coalesce(gap, F.lit(width).cast("bigint")), F.lit(width)).cast("int")


def trigger_rules(readings: DataFrame, deps: DataFrame, slide_ms: int = MINUTE_MS, width: int = WINDOW_SLOTS) -> DataFrame:
    """(tick_ms, RULE_KEY) once for every window end whose snapshot holds an operand of the rule.

    The slots of a rule with any of its operands are bits of one number an hour of 60 slots, put together before the shuffle:
    a rule has one row an hour, however many operands. Slots and window ends are written out last.
    """
    fired = operand_slots(slot_latest(readings, slide_ms), deps.select(*RULE_KEY, "dep_device_code", "dep_point_code"))
    bits = F.bit_or(F.expr("shiftleft(1L, cast(pmod(slot, 60) AS int))"))
    hours = fired.groupBy(*RULE_KEY, F.expr("slot - pmod(slot, 60)").alias("_hour")).agg(bits.alias("_bits"))
    held = F.filter(F.sequence(F.lit(0), F.lit(59)), lambda bit: F.getbit("_bits", bit) == 1)
    hours = hours.select(*RULE_KEY, "_hour", F.transform(held, lambda bit: F.col("_hour") + bit).alias("_slots"))
    following = F.lead(F.get("_slots", F.lit(0))).over(Window.partitionBy(*RULE_KEY).orderBy("_hour"))
    hours = hours.withColumn("_after", following)

    def window_ends(slot: Column, i: Column) -> Column:
        until = F.coalesce(F.get("_slots", i + 1), F.col("_after"), slot + width)
        return F.sequence(slot + 1, F.least(until, slot + width))

    tick = F.explode(F.flatten(F.transform("_slots", window_ends)))
    return hours.select(*RULE_KEY, tick.alias("_tick")).select((F.col("_tick") * slide_ms).alias("tick_ms"), *RULE_KEY)


def bound_runs(
    slots: DataFrame, firings: DataFrame | None, deps: DataFrame, arity: int, attributes: Sequence[str] = (),
    width: int = WINDOW_SLOTS, max_age: int | None = None,
) -> DataFrame:
    """Runs of rules whose operands belong to one device: RULE_KEY, attributes, slot, n, v_0 .. v_{arity-1}.

    An operand has its last reading, however old, or its constant (`consts`, an array by operand) if it never had
    one. With `firings` the snapshot times of the operands' device are kept. A numeric `rule_id` among the columns of
    `deps` stands for the rule in shuffles and sorts.
    """
    rows = operand_slots(slots, deps)
    if firings is not None:
        rows = rows.join(firings, [*DEVICE, "slot"])
    by = rule_key(deps)
    kept = [*dict.fromkeys([*by, *RULE_KEY, *attributes]), *(["firings"] if firings is not None else [])]
    has_consts = "consts" in deps.columns
    rows = spread(rows.select(*kept, "idx", "slot", "value", *(["consts"] if has_consts else [])), *by)
    w = Window.partitionBy(*by).orderBy("slot")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def operand(i: int) -> Column:
        seen = F.last(F.when(F.col("idx") == i, F.col("value")), ignorenulls=True).over(upto)
        return F.coalesce(seen, F.get("consts", F.lit(i))) if has_consts else seen

    n = _run_length(w, width)
    if max_age is not None:
        # values only grow older along a run, so the oldest operand ends it
        read = [F.max(F.when(F.col("idx") == i, F.col("slot"))).over(upto) for i in range(arity)]
        n = F.least(n, F.array_min(F.array(*read)) + max_age - F.col("slot")).cast("int")
    bound = rows.withColumns({"n": n, **{f"v_{i}": operand(i) for i in range(arity)}})
    return bound.where(F.col("n") > 0).select(*kept, "slot", "n", *[f"v_{i}" for i in range(arity)])


def all_bound(arity: int, required: Column) -> Column:
    """Whether the first `required` of v_0 .. v_{arity-1} have a value."""
    ok = F.lit(True)
    for i in range(arity):
        ok = ok & ((required <= i) | F.col(f"v_{i}").isNotNull())
    return ok


def bind_variables(
    readings: DataFrame, deps: DataFrame, arity: int, slide_ms: int = MINUTE_MS, width: int = WINDOW_SLOTS,
    max_age: int | None = None,
) -> DataFrame:
    """(tick_ms, RULE_KEY, v_0 ..) at every firing at which all `n_required` operands have a value."""
    runs = bound_runs(slot_latest(readings, slide_ms), None, deps, arity, ["n_required"], width, max_age)
    runs = runs.where(all_bound(arity, F.col("n_required")))
    values = [f"v_{i}" for i in range(arity)]
    tick = F.explode(F.sequence(F.col("slot") + 1, F.col("slot") + F.col("n")))
    return runs.select(*RULE_KEY, *values, tick.alias("_tick")).select(
        (F.col("_tick") * slide_ms).alias("tick_ms"), *RULE_KEY, *values
    )


def operand_spans(
    slots: DataFrame | None, firings: DataFrame | None, deps: DataFrame, derived: DataFrame | None,
    constants: DataFrame | None, slide_ms: int, width: int, max_age: int | None = None,
) -> DataFrame:
    """Operands of rules over several devices or over derived points, per window end.

    Columns: the rule's key, idx, tick (minute number), value, `snapshot_ms` while the operand is in the snapshot, else
    null. Readings stay known up to the operand's next reading; derived values (tick rows) are present at their own
    tick only and known afterwards; constants are known until the first reading.
    """
    by = rule_key(deps)
    operand = [*by, "idx", "company_id", "device_id", "property_name"]
    operand = list(dict.fromkeys(operand))
    parts = []
    if slots is not None:
        parts.append(
            operand_slots(slots, deps).join(firings, [*DEVICE, "slot"]).select(
                *operand, "slot", "value", F.lit(width).alias("_present"), "firings"
            )
        )
    if derived is not None:
        d = derived.select(*SERIES, F.expr(f"tick_ms div {slide_ms} - 1").alias("slot"), "value", "snapshot_ms")
        parts.append(
            operand_slots(d, deps, "snapshot_ms").select(
                *operand, "slot", "value", F.lit(1).alias("_present"),
                F.array((F.col("snapshot_ms") - F.col("slot") * slide_ms).cast("int")).alias("firings"),
            )
        )
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    bounds = rows.groupBy(*by).agg(
        (F.min("slot") + 1).alias("_from"), F.max(F.col("slot") + F.col("_present")).alias("_to")
    )
    if constants is not None:
        d = deps.withColumnRenamed("dep_device_code", "device_id").withColumnRenamed("dep_point_code", "property_name")
        rows = rows.unionByName(
            d.join(constants, SERIES).select(
                *operand, F.lit(None).cast("bigint").alias("slot"), F.col("const").alias("value"),
                F.lit(0).alias("_present"), F.lit(None).cast("array<int>").alias("firings"),
            )
        )
    w = Window.partitionBy(*operand).orderBy(F.col("slot").asc_nulls_first())
    spans = rows.withColumn("_next", F.lead("slot").over(w)).join(bounds, by)
    first = F.coalesce(F.col("slot") + 1, F.col("_from"))
    last = F.least(F.coalesce("_next", "_to"), F.col("_to"))
    if max_age is not None:
        last = F.least(last, F.col("slot") + max_age)  # without slot: a constant
    ticks = spans.where(first <= last).select(
        *by, "idx", "slot", "value", "firings", F.explode(F.sequence(first, last)).alias("tick")
    )
    offset = F.get("firings", (F.col("tick") - F.col("slot") - 1).cast("int"))
    return ticks.select(*by, "idx", "tick", "value", (F.col("slot") * slide_ms + offset).alias("snapshot_ms"))


def operand_events(
    slots: DataFrame | None, firings: DataFrame | None, deps: DataFrame, derived: DataFrame | None,
    constants: DataFrame | None, slide_ms: int, width: int, max_age: int | None = None,
) -> DataFrame:
    """Operands of rules over several devices or over derived points, only at window ends that hold them.

    Columns: the rule's key, idx, tick (minute number), snapshot_ms; where the operand changes also its value and `before`,
    the value it replaces. A reading is in at most `width` snapshots, a derived value in that of its own tick, so
    rows follow the readings, however far apart they are. A constant is a change before all ticks. With `max_age` a value
    too old is replaced by null, in a row without snapshot_ms.
    """
    by = rule_key(deps)
    operand = list(dict.fromkeys([*by, "idx", "company_id", "device_id", "property_name"]))
    parts = []
    if slots is not None:
        parts.append(
            operand_slots(slots, deps).join(firings, [*DEVICE, "slot"]).select(*operand, "slot", "value", "firings")
        )
    if derived is not None:
        d = derived.select(*SERIES, F.expr(f"tick_ms div {slide_ms} - 1").alias("slot"), "value", "snapshot_ms")
        parts.append(
            operand_slots(d, deps, "snapshot_ms").select(
                *operand, "slot", "value", F.array((F.col("snapshot_ms") - F.col("slot") * slide_ms).cast("int")).alias("firings")
            )
        )
    if constants is not None:
        d = deps.withColumnRenamed("dep_device_code", "device_id").withColumnRenamed("dep_point_code", "property_name")
        parts.append(
            d.join(constants, SERIES).where(F.col("const").isNotNull()).select(
                *operand, F.lit(None).cast("bigint").alias("slot"), F.col("const").alias("value"),
                F.array(F.lit(None).cast("int")).alias("firings"),
            )
        )
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    w = Window.partitionBy(*operand).orderBy(F.col("slot").asc_nulls_first())
    rows = rows.withColumns({"_next": F.lead("slot").over(w), "before": F.lag("value").over(w)})
    outdated = None
    if max_age is not None:
        rests = F.coalesce(F.col("_next") > F.col("slot") + max_age, F.col("slot").isNotNull())
        outdated = rows.where(rests).select(
            *by, "idx", (F.col("slot") + max_age + 1).alias("tick"), F.lit(None).cast("bigint").alias("snapshot_ms"),
            F.lit(None).cast("double").alias("value"), F.col("value").alias("before"),
        )
        renewed = F.lag("slot").over(w) + max_age < F.col("slot")
        rows = rows.withColumn("before", F.when(~F.coalesce(renewed, F.lit(False)), F.col("before")))
    # in the snapshots up to the one that holds the operand's next reading
    count = F.coalesce(F.least(F.size("firings"), (F.col("_next") - F.col("slot")).cast("int")), F.size("firings"))
    held = F.when(count > 0, F.slice("firings", F.lit(1), count)).otherwise(F.slice("firings", 1, 1))
    events = rows.select(*by, "idx", "slot", "value", "before", count.alias("_n"), F.posexplode(held).alias("_i", "_offset"))
    first = F.col("_i") == 0
    events = events.select(
        *by, "idx", F.coalesce(F.col("slot") + 1 + F.col("_i"), F.lit(-(2**62))).alias("tick"),
        F.when(F.col("_n") > 0, F.col("slot") * slide_ms + F.col("_offset")).alias("snapshot_ms"),
        F.when(first, F.col("value")).alias("value"), F.when(first, F.col("before")).alias("before"),
    )
    return events if outdated is None else events.unionByName(outdated)


def _upto(by: Sequence[str]):
    return Window.partitionBy(*by).orderBy("tick").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def bind_events(events: DataFrame, attributes: DataFrame, arity: int, max_age: int | None = None) -> DataFrame:
    """Rules over several devices: `attributes`, tick, snapshot_ms, v_0 .. v_{arity-1}, all bound.

    An operand keeps its last value, for `max_age` slots if that is given. A rule has one row per tick before its values are
    carried on.
    """
    by = rule_key(events)
    wide = events.groupBy(*by, "tick").agg(
        F.max("snapshot_ms").alias("snapshot_ms"),
        *[F.max(F.when(F.col("idx") == i, F.col("value"))).alias(f"v_{i}") for i in range(arity)],
    )
    kept = wide.withColumns({f"v_{i}": F.last(f"v_{i}", ignorenulls=True).over(_upto(by)) for i in range(arity)})
    if max_age is not None:
        first = [f"_at_{i}" for i in range(arity)]
        changed = [F.when(F.col(f"v_{i}").isNotNull() & (F.col("tick") > -(2**62)), F.col("tick")) for i in range(arity)]
        at = wide.withColumns(dict(zip(first, changed, strict=True)))
        kept = at.withColumns({
            **{f"v_{i}": F.last(f"v_{i}", ignorenulls=True).over(_upto(by)) for i in range(arity)},
            **{a: F.last(a, ignorenulls=True).over(_upto(by)) for a in first},
        })
        oldest = F.array_min(F.array(*first))  # a value read in slot s came at window end s + 1
        kept = kept.where(F.coalesce(F.col("tick") - oldest < max_age, F.lit(True))).drop(*first)
    rows = kept.where(F.col("snapshot_ms").isNotNull()).join(attributes, by)
    return rows.where(all_bound(arity, F.col("n_required")))


def rollup(events: DataFrame, children: DataFrame) -> DataFrame:
    """Sum over the children of roll-up rules at every firing at which all children have a value.

    `children` holds the rule's key and `n_children`; `events` is read twice, so it should be a written table. Changes are
    combined per rule and tick before and after the shuffle, then summed up along the ticks. Sums are exact (see `exact`):
    a value leaves no trace once it is replaced, however large it was. Values that are no finite numbers are counted aside.
    """
    by = rule_key(events)
    is_change = F.col("value").isNotNull() | F.col("before").isNotNull()
    kinds = {
        "_nan": lambda c: F.isnan(c), "_up": lambda c: c == float("inf"), "_down": lambda c: c == float("-inf"),
    }
    of = limb_range(events, "value", "before")
    finite = lambda c: F.when(~F.isnan(c) & (F.abs(c) < float("inf")), F.col(c))
    parts = [f"_limb_{i}" for i in range(len(of))]
    changes = {
        **{n: new - old for n, new, old in zip(parts, limbs(finite("value"), of), limbs(finite("before"), of), strict=True)},
        "_known": F.col("value").isNotNull().cast("int") - F.col("before").isNotNull().cast("int"),
        **{n: F.coalesce(is_kind(F.col("value")).cast("int"), F.lit(0)) - F.coalesce(is_kind(F.col("before")).cast("int"), F.lit(0)) for n, is_kind in kinds.items()},
    }
    sums = events.groupBy(*by, "tick").agg(
        F.max("snapshot_ms").alias("snapshot_ms"), *[F.sum(F.when(is_change, c)).alias(n) for n, c in changes.items()]
    )
    sums = sums.withColumns({n: F.sum(n).over(_upto(by)) for n in changes})
    whole = sums.where(F.col("snapshot_ms").isNotNull()).join(children, by).where(F.col("_known") == F.col("n_children"))
    whole = with_total(whole, parts, of, "total")
    total = (
        F.when((F.col("_nan") > 0) | ((F.col("_up") > 0) & (F.col("_down") > 0)), float("nan"))
        .when(F.col("_up") > 0, float("inf")).when(F.col("_down") > 0, float("-inf")).otherwise(F.col("total"))
    )
    return whole.withColumn("total", total).drop("_known", *kinds)
