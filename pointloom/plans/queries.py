"""Catalogue of queries: one per operator, each over whole tables. Keys match those in `oracle.py`."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pointloom.functions.arithmetic import evaluate, template_text, translated
from pointloom.functions.bits import bit_at
from pointloom.functions.formula import compile_same_device, parse_call, parse_formula
from pointloom.functions.once import with_once
from pointloom.operators import asof, binding, constants, series, snapshot, topology
from pointloom.plans import compile as compiler
from pointloom.plans import engine, sample
from pointloom.plans.lineage import checkpoint_folder, materialize
from pointloom.schemas import DEVICE, OBJECT, ORIGIN, POINT_CONF, RULE, RULE_KEY, SERIES
from pointloom.sinks.encode import derived_points, encode_envelope, rule_origin
from pointloom.sinks.tables import upsert_rules
from pointloom.sources import changes, telemetry
from pointloom.streaming import snapshots as live
from pointloom.streaming.state import stream_device_state as stream_state

Query = Callable[[SparkSession, str], DataFrame]
ALL: dict[str, Query] = {}
TZ = "Asia/Shanghai"


def query(fn: Query) -> Query:
    ALL[fn.__name__] = fn
    return fn


def rounded(col: str | Column) -> Column:
    """Six digits. The nudge keeps means that lie on half a last digit on one side whatever the order of summing."""
    return F.round((F.col(col) if isinstance(col, str) else col) + F.lit(1e-9), 6)


def listed(deps: Column) -> Column:
    """Dependency list as text: var=device.point;..."""
    return F.array_join(
        F.transform(deps, lambda d: F.concat(F.coalesce(d["var"], F.lit("")), F.lit("="), d["device_code"], F.lit("."), d["point_code"])), ";"
    )


# ---- messages -------------------------------------------------------------------------------------------------
@query
def topic_fields(spark, d):
    msg = F.from_json("value", "topic STRING")
    rows = sample.messages(spark, d).select("msg_id", telemetry.topic_fields(msg["topic"]).alias("t"))
    return rows.select("msg_id", "t.gateway_code", "t.company_id", "t.project_id")


@query
def decode_envelope(spark, d):
    return telemetry.decode_envelope(sample.messages(spark, d)).select(
        "msg_id", "company_id", "device_id", "project_id", "gateway_code", "property_name",
        F.col("property_num_value").alias("value"), "data_type", "ts_ms",
    )


@query
def decode_flat(spark, d):
    return telemetry.decode_flat(sample.messages(spark, d)).select(
        "msg_id", "company_id", "device_id", "property_name", F.col("property_num_value").alias("value"), "ts_ms"
    )


@query
def decode_messages(spark, d):
    """Both message forms in one pass."""
    return telemetry.decode(sample.messages(spark, d)).select(
        "msg_id", "company_id", "device_id", "property_name", F.col("property_num_value").alias("value"), "ts_ms"
    )


@query
def decode_rejects(spark, d):
    return telemetry.rejects(sample.messages(spark, d)).select("msg_id", "reason")


@query
def encode_envelope_roundtrip(spark, d):
    """Differences of the day written as messages, then decoded again."""
    readings = sample.telemetry(spark, d)
    diffs = series.period_diffs(snapshot.snapshot_ticks(readings), ["day"]).withColumn("value", rounded("day_diff"))
    sent = encode_envelope(diffs, snapshot.device_origin(readings))
    got = telemetry.decode_envelope(sent.select("tick_ms", "value"))
    return got.select(
        "tick_ms", "company_id", "device_id", "project_id", "gateway_code", "property_name",
        rounded("property_num_value").alias("value"), "ts_ms",
    )


# ---- snapshots ------------------------------------------------------------------------------------------------
@query
def latest_snapshot(spark, d):
    return snapshot.latest_snapshot(sample.telemetry(spark, d))


@query
def snapshot_time(spark, d):
    return snapshot.snapshot_time(sample.telemetry(spark, d))


@query
def snapshot_ticks(spark, d):
    return snapshot.snapshot_ticks(sample.telemetry(spark, d))


# ---- period differences and statistics ------------------------------------------------------------------------
def _diff(unit: str, dense: bool = True, tz: str = "UTC") -> Query:
    def run(spark, d):
        ticks = snapshot.snapshot_ticks(sample.telemetry(spark, d, dense))
        return series.period_diffs(ticks, [unit], tz).select(
            "tick_ms", "snapshot_ms", *SERIES, rounded(f"{unit}_diff").alias("diff")
        )

    return run


for _unit in ("hour", "day", "month", "year", "total"):
    ALL[f"{_unit}_diff"] = _diff(_unit)
ALL["day_diff_local"] = _diff("day", dense=False, tz=TZ)


@query
def all_diffs(spark, d):
    """All five differences in one pass."""
    units = ["hour", "day", "month", "year", "total"]
    out = series.period_diffs(snapshot.snapshot_ticks(sample.telemetry(spark, d)), units)
    return out.select("tick_ms", *SERIES, *[rounded(f"{u}_diff").alias(f"{u}_diff") for u in units])


def _stat(kind: str) -> Query:
    def run(spark, d):
        out = series.daily_stats(snapshot.snapshot_ticks(sample.telemetry(spark, d)), [kind])
        return out.select("tick_ms", *SERIES, rounded(f"daily_{kind}").alias("stat"))

    return run


for _kind in series.STATS:
    ALL[f"daily_{_kind}"] = _stat(_kind)


@query
def daily_reading_stats(spark, d):
    out = series.daily_reading_stats(sample.telemetry(spark, d))
    return out.select("tick_ms", *SERIES, *[rounded(f"daily_{k}").alias(f"daily_{k}") for k in series.STATS])


# ---- configuration and change records -------------------------------------------------------------------------
@query
def row_image(spark, d):
    rows = changes.row_image(sample.point_changes(spark, d))
    return rows.select(
        "op", "seq", F.get_json_object("image", "$.data_id").cast("bigint").alias("data_id"),
        F.get_json_object("image", "$.data_source").cast("int").alias("data_source"),
    )


@query
def route_config(spark, d):
    both = sample.point_changes(spark, d).unionByName(sample.object_changes(spark, d))
    rows = changes.route_config(both, "point")
    key = F.coalesce(F.get_json_object("image", "$.data_id"), F.get_json_object("image", "$.object_id"))
    return rows.select("table", "op", "seq", key.cast("bigint").alias("row_id"))


@query
def apply_changes(spark, d):
    return changes.apply_changes(sample.point_changes(spark, d), POINT_CONF, ["data_id"])


@query
def join_config(spark, d):
    points = sample.point_conf(spark, d)
    return topology.join_config(points, sample.objects(spark, d)).select(
        "data_id", "data_code", "object_code", "status", F.col("company_id")
    )


@query
def tombstones(spark, d):
    """Keys of deleted points; those of devices in debt count as objects that are gone, so their device is unknown."""
    gone = changes.row_image(sample.point_changes(spark, d)).where(F.col("op") == "d")
    rows = gone.select(F.from_json("image", POINT_CONF).alias("r")).select("r.*")
    live = sample.objects(spark, d).where(F.col("status") != 0)
    return topology.tombstones(rows, live)


@query
def resolve_model(spark, d):
    wanted = sample.objects(spark, d).where(F.col("model_id").isNotNull()).select("object_id", "company_id", F.col("model_id").alias("own_model"))
    coded = wanted.join(sample.models(spark, d).select(F.col("model_id").alias("own_model"), F.col("object_code").alias("model_code")), "own_model")
    return topology.resolve_model(coded, sample.models(spark, d)).select("object_id", "company_id", "model_code", "model_id")


@query
def expand_children(spark, d):
    plants = sample.objects(spark, d).where(F.col("parent_id").isNull()).select("object_id", "company_id")
    parents = plants.join(sample.models(spark, d).select("company_id", "model_id"), "company_id")
    return topology.expand_children(parents, sample.objects(spark, d)).select("object_id", "model_id", "child_id", "child_code")


# ---- formulas and rule compilation ----------------------------------------------------------------------------
@query
def parse_formula_query(spark, d):
    rows = sample.point_conf(spark, d).where(F.col("data_source") == 2)
    rows = rows.withColumn("p", parse_formula(F.col("formula"), F.col("company_id")))
    return rows.select("data_id", "p.expr", "p.expr_type", listed(F.col("p.depends_on")).alias("depends_on"))


@query
def parse_call_query(spark, d):
    rows = sample.point_conf(spark, d).withColumn("c", parse_call(F.col("formula"))).where(F.col("c").isNotNull())
    return rows.select(
        "data_id", F.col("c.name").alias("function"), F.size("c.args").alias("n_args"),
        F.get("c.args", F.lit(0)).alias("arg0"), F.get("c.args", F.lit(1)).alias("arg1"),
    )


@query
def compile_same_device_query(spark, d):
    """The text of every point with a formula (first argument, formula field, or all of it) as a same-device formula."""
    rows = sample.point_conf(spark, d).where(F.col("formula").isNotNull())
    text = F.coalesce(
        F.get(parse_call(F.col("formula"))["args"], F.lit(0)), F.get_json_object("formula", "$.formula"), F.col("formula")
    )
    rows = rows.withColumn("c", compile_same_device(text, F.col("company_id"), F.col("object_id").cast("string")))
    return rows.select("data_id", "c.expr", listed(F.col("c.depends_on")).alias("depends_on"))


@query
def compile_functions(spark, d):
    rows = compiler.compile_points(sample.point_conf(spark, d), sample.objects(spark, d))
    names = ["HOUR_DIFF", "DAY_DIFF", "MONTH_DIFF", "YEAR_DIFF", "TOTAL_DIFF", "DEC_TO_BIN", "DAILY_STATS"]
    rows = rows.where(F.col("reason").isNull() & F.col("expr").isin(names) & (F.size("parameters") + F.size("dependencies") > 0))
    first = F.get("parameters", F.lit(0))
    return rows.select(
        "data_id", "expr", "expr_type", listed(F.col("dependencies")).alias("depends_on"),
        F.concat_ws("=", first["name"], first["value"]).alias("param"),
    )


def _rules(spark, d) -> DataFrame:
    return compiler.compile_rules(sample.point_conf(spark, d), sample.objects(spark, d))


@query
def compile_rules(spark, d):
    return _rules(spark, d)


@query
def rejected_rules(spark, d):
    return compiler.rejected_rules(sample.point_conf(spark, d), sample.objects(spark, d), sample.models(spark, d))


@query
def active_rules(spark, d):
    return engine.active_rules(_rules(spark, d)).select(*RULE_KEY, "expr_type", "expr")


@query
def upsert_rules_query(spark, d):
    """All rules as the stored table; as updates the rules after the point changes, each with the newest change."""
    current = _rules(spark, d)
    changed = changes.apply_changes(sample.point_changes(spark, d).where(F.col("op") != "d"), POINT_CONF, ["data_id"])
    updates = compiler.compile_points(changed, sample.objects(spark, d)).where("data_id % 3 = 0")
    updates = compiler.rule_rows(updates).withColumn("seq", F.lit(1))
    older = current.where(F.col("expr_type") == 0).withColumn("expr", F.lit("stale")).withColumn("seq", F.lit(0))
    return upsert_rules(current, updates.unionByName(older)).select(*RULE_KEY, "expr_type", "expr", "enabled")


@query
def affected_rules(spark, d):
    records = sample.object_changes(spark, d)
    images = records.select(F.explode(F.array("before", "after")).alias("image")).where(F.col("image").isNotNull())
    images = images.select(F.from_json("image", OBJECT).alias("o")).select("o.parent_id", "o.model_id")
    compiled = compiler.compile_points(sample.point_conf(spark, d), sample.objects(spark, d))
    return topology.affected_rules(images, sample.models(spark, d), compiler.rollup_watches(compiled)).select(
        F.col("company_id").cast("string").alias("company_id"), "device_code", "point_code", "model_code"
    )


# ---- rules on telemetry ---------------------------------------------------------------------------------------
def _formula_deps(spark, d) -> DataFrame:
    """Operands of all rules that list any."""
    deps = engine.operands(engine.active_rules(_rules(spark, d)))
    return deps.join(deps.groupBy(*RULE_KEY).agg(F.count("*").cast("int").alias("n_required")), RULE_KEY)


@query
def trigger_rules(spark, d):
    return binding.trigger_rules(sample.telemetry(spark, d), _formula_deps(spark, d))


@query
def bind_variables(spark, d):
    return binding.bind_variables(sample.telemetry(spark, d), _formula_deps(spark, d), 2)


@query
def constant_points(spark, d):
    known = constants.active_constants(_rules(spark, d))
    return constants.constant_points(sample.telemetry(spark, d), known)


@query
def arithmetic_formulas(spark, d):
    """Formulas of the rule table over pairs of quantities: every event's value and its successor number."""
    rules = _rules(spark, d).where(F.col("expr_type") == 0)
    variables = F.transform(F.from_json("depends_on", compiler.DEPS), lambda v: v["var"])
    texts = rules.select(
        F.col("company_id"), F.col("device_code").alias("device_id"), "point_code",
        translated(template_text(F.col("expr"), variables))["program"].alias("program"),
    )
    readings = sample.telemetry(spark, d).join(texts, ["company_id", "device_id"])
    values = F.array("value", (F.col("seq") % 3).cast("double"))
    out = with_once(readings.select("seq", "point_code", "program", "value"), "result", rounded(evaluate(F.col("program"), values)))
    return out.where(F.col("result").isNotNull()).select("seq", "point_code", "result")


@query
def bit_at_query(spark, d):
    bits = sample.telemetry(spark, d).select("seq", "value", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("bit"))
    signed = F.when(F.col("seq") % 2 == 0, -F.col("value")).otherwise(F.col("value"))
    out = bits.select("seq", "bit", bit_at(signed, F.col("bit")).alias("bit_value"))
    return out.where(F.col("bit_value").isNotNull())


def _derived(spark, d, codes: list[str] | None = None, support: tuple[str, ...] = ()) -> DataFrame:
    """Derived points of the given rule codes (all if None); `support` names rules they depend on."""
    objects = sample.objects(spark, d)
    rules = _rules(spark, d)
    if codes is not None:
        rules = rules.where((F.col("expr_type") == 2) | F.col("point_code").isin(*codes, *support))
    out = engine.derive(sample.telemetry(spark, d), materialize(rules), objects, sample.models(spark, d))
    if support:
        out = out.where(F.col("property_name").isin(*codes))
    return out.select("tick_ms", "snapshot_ms", *SERIES, rounded("value").alias("value"))


def _derive(*codes: str, support: tuple[str, ...] = ()) -> Query:
    return lambda spark, d: _derived(spark, d, list(codes), support)


ALL["rollup_sum"] = _derive("plantSum")
ALL["rollup_avg"] = _derive("plantAvg")


@query
def rollup_spikes(spark, d):
    """Roll-ups over readings of which some are very large, so that sums of changes would lose the rest."""
    readings = sample.telemetry(spark, d).withColumn("value", F.expr(sample.SPIKED))
    rules = materialize(_rules(spark, d).where(F.col("point_code").isin("plantSum", "plantAvg")))
    out = engine.derive(readings, rules, sample.objects(spark, d), sample.models(spark, d))
    value = F.when(F.abs("value") < 1e15, rounded("value")).otherwise(F.round(F.col("value") / 1e9, 0))
    return out.select("tick_ms", "snapshot_ms", *SERIES, value.alias("value"))


@query
def derive_aged(spark, d):
    """Formulas on one and on two devices and roll-ups whose operands count for three hours after their reading."""
    codes = ["mix", "cross", "plantSum", "plantAvg"]
    rules = materialize(_rules(spark, d).where(F.col("point_code").isin(codes)))
    out = engine.derive(sample.telemetry(spark, d), rules, sample.objects(spark, d), sample.models(spark, d), max_age=180)
    return out.select("tick_ms", "snapshot_ms", *SERIES, rounded("value").alias("value"))


@query
def encode_results(spark, d):
    """Results of formulas on one and two devices and of roll-ups as full records, sent as messages, then decoded again."""
    readings = sample.telemetry(spark, d)
    rules = materialize(_rules(spark, d).where(F.col("point_code").isin("mix", "cross", "plantSum")))
    rs = engine.prepare_rules(rules, sample.objects(spark, d), sample.models(spark, d))
    fired = snapshot.device_origin(readings)
    own = fired.groupBy(*DEVICE).agg(F.max_by(F.struct(*ORIGIN), "tick_ms").alias("o")).select(*DEVICE, "o.*")
    points = derived_points(engine.derive(readings, rs), fired, own, rule_origin(rs.deps, own))
    got = telemetry.decode_envelope(encode_envelope(points.withColumn("value", rounded("value"))).select("tick_ms", "value"))
    return got.select(
        "tick_ms", "company_id", "device_id", "project_id", "gateway_code", "property_name",
        rounded("property_num_value").alias("value"), "ts_ms",
    )


ALL["arithmetic"] = _derive("mix", "ratio", "revenue", "weighted")
ALL["cross_device"] = _derive("cross")
ALL["bit_rules"] = _derive("errBit")
ALL["diff_rules"] = _derive("clickDay", "viewHour", "viewAll", "clickMonth", "clickYear")
ALL["stats_rules"] = _derive("purStat")
ALL["chained_rules"] = _derive("chain", "chainDay", support=("revenue", "mix"))


@query
def derive_points(spark, d):
    """Flagship: every rule of the table over the whole telemetry."""
    return _derived(spark, d)


# ---- streaming ------------------------------------------------------------------------------------------------
def _streamed(spark, d, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a stream over the events files to its end and return what it wrote."""
    schema = sample.table(spark, d, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*")  # a glob may be a file or a folder
    readings = events.selectExpr(*sample.telemetry_columns(sample.SPARK_MS, True))
    root = f"{checkpoint_folder(spark).rstrip('/')}/pointloom-{uuid.uuid4().hex}"
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # the number of state partitions is fixed by a query's first start: one per core of this cluster
        "spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism),
    }
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        out = build(readings)
        run = (
            out.writeStream.format("parquet").outputMode("append").option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        )
        run.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema(out.schema).parquet(f"{root}/out")


@query
def stream_snapshots(spark, d):
    """Windows the watermark has passed at the end of the data."""
    out = _streamed(spark, d, live.stream_snapshots)
    return out.select(F.unix_millis("window.end").alias("tick_ms"), *SERIES, "value", "ts_ms")


@query
def stream_device_state(spark, d):
    """Day difference and running day mean from the per-series state; only they are written by the stream, not all aggregates."""
    return _streamed(spark, d, lambda r: stream_state(live.stream_ticks(live.stream_snapshots(r))).select(
        "tick_ms", "snapshot_ms", *SERIES, rounded(F.col("value") - F.col("day_first")).alias("day_diff"),
        rounded(F.col("day_sum") / F.col("day_count")).alias("day_avg"),
    ))


# ---- history --------------------------------------------------------------------------------------------------
@query
def asof_history(spark, d):
    return asof.asof_history(sample.probes(spark, d), sample.history(spark, d)).select(
        "probe_id", *SERIES, "ts_ms", "property_num_value"
    )


@query
def asof_history_full(spark, d):
    out = asof.asof_history_full(sample.probes(spark, d), sample.history(spark, d))
    return out.select(
        "probe_id", "data_id", F.unix_millis("data_date").alias("data_date"), "data_type", "project_id", "gateway_code",
        "protocol_code", "product_id", "property_value", "property_num_value", "message_id", "timestamp",
        F.unix_millis("create_date").alias("create_date"), "year", "month", "day", "hour",
    )


RENAMED = {
    "encode_envelope_roundtrip": "encode_envelope", "parse_formula_query": "parse_formula", "parse_call_query": "parse_call",
    "compile_same_device_query": "compile_same_device", "upsert_rules_query": "upsert_rules", "bit_at_query": "bit_at",
}
for _old, _new in RENAMED.items():
    ALL[_new] = ALL.pop(_old)

__all__ = ["ALL", "RULE"]
