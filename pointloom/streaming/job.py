"""The live job: telemetry stream -> snapshots -> state -> rules, once per micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from pointloom.functions.calendar import PERIODS
from pointloom.operators.binding import operand_slots
from pointloom.plans import engine
from pointloom.plans.engine import RuleSet, calculate, with_period_aggregates
from pointloom.plans.lineage import materialize
from pointloom.plans.registry import ARITHMETIC, CALCULATIONS
from pointloom.schemas import DEVICE, MINUTE_MS, ORIGIN, RULE_KEY, SERIES, TICK, WINDOW_SLOTS, struct
from pointloom.sinks.encode import derived_points, encode_envelope, rule_origin
from pointloom.sinks.tables import LogTable, write_derived
from pointloom.sources.telemetry import decode, to_readings
from pointloom.streaming.ruleset import LiveRules
from pointloom.streaming.snapshots import stream_snapshots, stream_ticks
from pointloom.streaming.state import stream_device_state

Loader = Callable[[SparkSession], DataFrame]
LAST_VALUES = struct("company_id STRING, device_id STRING, property_name STRING, value DOUBLE, tick_ms BIGINT")
CARRIED = struct(
    "company_id STRING, device_code STRING, point_code STRING, _period BIGINT, _first DOUBLE, _max DOUBLE, _min DOUBLE, _sum DOUBLE, _count DOUBLE"
)
ORIGINS = struct("company_id STRING, device_id STRING, project_id STRING, gateway_code STRING, tick_ms BIGINT")
_CORE = TICK.fieldNames()


def _function_rules(ticks: DataFrame, rs: RuleSet) -> DataFrame:
    """Function rules on one measured point: their aggregates come with the ticks."""
    heads = rs.rules.where((F.col("level") == 0) & (F.col("n_deps") == 1) & F.col("kind").isin(*CALCULATIONS))
    deps = rs.deps.where(F.col("idx") == 0).join(heads.select(*RULE_KEY, "kind", "parameters"), RULE_KEY)

    def of_period(aggregate: str) -> Column:
        col = F.col(f"total_{aggregate}")
        for name, c in CALCULATIONS.items():
            if c.period not in (None, "total"):
                col = F.when(F.col("kind") == name, F.col(f"{c.period}_{aggregate}")).otherwise(col)
        return col

    extra = ["tick_ms", "snapshot_ms", *[f"{u}_{a}" for u in PERIODS for a in engine.AGGREGATES]]
    rows = operand_slots(ticks.withColumn("slot", F.lit(0)), deps.drop("var"), *extra)
    rows = rows.withColumns({f"_{a}": of_period(a) for a in engine.AGGREGATES})
    return calculate(rows.withColumn("computed", F.lit(None).cast("double")))


def derive_batch(
    ticks: DataFrame, rs: RuleSet, last_values: DataFrame, carried: DataFrame, tz: str = "UTC",
    slide_ms: int = MINUTE_MS, width: int = WINDOW_SLOTS,
) -> tuple[DataFrame, DataFrame]:
    """Derived points of one micro-batch, and the aggregates that its rules on derived points carry to the next.

    `ticks` comes from `stream_device_state`; `last_values` holds the operands seen in earlier batches.
    """
    known = last_values.select(*SERIES, F.col("value").alias("const"))
    known = known.unionByName(rs.constants.join(known.select(*SERIES), SERIES, "left_anti"))
    state = replace(rs, constants=known)
    present = ticks.select(*_CORE)
    made = [_function_rules(ticks, rs)]
    left, written = [], 0
    for level in range(rs.max_level + 1):
        if level > 0:
            made = [*made[:written], materialize(engine._union(made[written:]))]  # each level's results once
            written = len(made)
            present = engine._union([ticks.select(*_CORE), *[m.select(*_CORE) for m in made]])
        here = rs.rules.where(F.col("level") == level)
        args = (None, None, state, present, slide_ms, width)
        short = here.where((F.col("route") != "rollup") & (F.col("n_required") <= engine.WIDE_OPERANDS))
        # a function rule of several points fires with any of them, on the value of the first
        short = short.where((F.col("kind") == ARITHMETIC) | (F.col("level") > 0) | (F.col("n_deps") > 1))
        fired = materialize(with_period_aggregates(engine._many_devices(short, *args), tz, carried))
        newest = F.max_by(F.struct("_period", *[f"_{a}" for a in engine.AGGREGATES]), "tick_ms")
        left.append(fired.where(F.col("kind") != ARITHMETIC).groupBy(*RULE_KEY).agg(newest.alias("_n")).select(*RULE_KEY, "_n.*"))
        made.append(calculate(fired))
        if rs.has(level, "rollup"):
            made.append(engine._rollups(here.where(F.col("route") == "rollup"), *args))
        if rs.has(level, "spans", True) or rs.has(level, "runs", True):
            long = here.where((F.col("route") != "rollup") & (F.col("n_required") > engine.WIDE_OPERANDS))
            made.append(calculate(with_period_aggregates(engine._long_formulas(long, *args), tz)))
    return engine._union(made), engine._union(left)


def batch_function(
    spark: SparkSession, rules: Loader, out_path: str, state_path: str, objects: Loader | None = None,
    models: Loader | None = None, tz: str = "UTC", slide_ms: int = MINUTE_MS, width: int = WINDOW_SLOTS,
    write: Callable[[DataFrame, int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """The foreachBatch function. Rules are loaded anew each time, so a changed rule counts from the next batch on; what it
    reaches is prepared anew. A batch that runs again has the rules of its first run.

    Points are stored as full records: project and gateway are those of the device's snapshot, else the last known of the
    device, else the last known of its rules' operands. `write` gets each batch's points once they are stored, for a sink
    of its own (`sinks.tables.kafka_writer`).

    All it keeps is in tables versioned by batch, to which a batch adds the rows it changed: a batch that runs again starts
    from the same state and replaces what it wrote.
    """
    root = state_path.rstrip("/")
    last = LogTable(spark, f"{root}/last_values", LAST_VALUES, SERIES)
    carry = LogTable(spark, f"{root}/carried", CARRIED, RULE_KEY)
    origins = LogTable(spark, f"{root}/origins", ORIGINS, DEVICE)
    live = LiveRules(spark, f"{root}/configuration", rules, objects, models)

    def run(batch: DataFrame, batch_id: int) -> None:
        path = f"{root}/ticks/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(path)  # the batch is used several times below
        ticks = spark.read.schema(batch.schema).parquet(path)
        rs = live.at(batch_id)
        before = last.read(before=batch_id)
        derived, carried = derive_batch(ticks, rs, before, carry.read(before=batch_id), tz, slide_ms, width)
        fired = ticks.where(F.col("project_id").isNotNull()).groupBy("tick_ms", *DEVICE).agg(F.max(F.struct(*ORIGIN)).alias("_o"))
        fired = fired.select("tick_ms", *DEVICE, "_o.*")
        newest = fired.groupBy(*DEVICE).agg(F.max(F.struct("tick_ms", *ORIGIN)).alias("_o")).select(*DEVICE, "_o.*")
        newest = materialize(newest.select(*ORIGINS.fieldNames()))
        old = origins.read(before=batch_id).select(*ORIGINS.fieldNames())
        own = old.join(newest, DEVICE, "left_anti").unionByName(newest).select(*DEVICE, *ORIGIN)
        moved = newest.join(old.select(*DEVICE, *ORIGIN), [*DEVICE, *ORIGIN], "left_anti")  # only these are written
        derived = derived_points(derived, fired, own, rule_origin(rs.deps, own))
        write_derived(derived, out_path, batch_id)
        results = spark.read.schema(derived.schema).parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")
        if write:
            write(results, batch_id)
        # only series that are operands of formulas or roll-ups need to be remembered
        remembered = rs.deps.join(rs.rules.where((F.col("kind") == ARITHMETIC) | (F.col("route") == "rollup") | (F.col("level") > 0) | (F.col("n_deps") > 1)), RULE_KEY, "left_semi").select(
            "company_id", F.col("dep_device_code").alias("device_id"), F.col("dep_point_code").alias("property_name")
        ).distinct()
        seen = ticks.select(*LAST_VALUES.fieldNames()).unionByName(results.select(*LAST_VALUES.fieldNames()))
        seen = seen.where(F.col("value").isNotNull()).join(remembered, SERIES, "left_semi")
        touched = before.join(seen.select(*SERIES).distinct(), SERIES, "left_semi").select(*LAST_VALUES.fieldNames())
        latest = touched.unionByName(seen).groupBy(*SERIES).agg(F.max_by("value", "tick_ms").alias("value"), F.max("tick_ms").alias("tick_ms"))
        last.write(latest, batch_id)
        origins.write(moved, batch_id)
        carry.write(carried, batch_id)

    return run


def derive_stream(
    readings: DataFrame, rules: Loader, out_path: str, state_path: str, checkpoint: str, objects: Loader | None = None,
    models: Loader | None = None, tz: str = "UTC", delay: str = "30 seconds", write: Callable[[DataFrame, int], None] | None = None,
) -> DataStreamWriter:
    """The whole job over a stream of readings; call `.trigger(...).start()` on the result.

    Needs the RocksDB state store: spark.sql.streaming.stateStore.providerClass.
    """
    ticks = stream_device_state(stream_ticks(stream_snapshots(readings, delay)), tz)
    run = batch_function(readings.sparkSession, rules, out_path, state_path, objects, models, tz, write=write)
    return ticks.writeStream.outputMode("append").foreachBatch(run).option("checkpointLocation", checkpoint)


def telemetry_stream(
    raw: DataFrame, rules: Loader, out_path: str, state_path: str, checkpoint: str, write: Callable[[DataFrame, int], None], **options
) -> DataStreamWriter:
    """From raw messages (`sources.telemetry.read_telemetry`) to result messages: `write` gets each batch's messages."""

    def encoded(derived: DataFrame, batch_id: int) -> None:
        write(encode_envelope(derived), batch_id)

    return derive_stream(to_readings(decode(raw)), rules, out_path, state_path, checkpoint, write=encoded, **options)
