"""Result messages: all results of one firing of a device in one JSON envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointloom.schemas import DEVICE, ORIGIN, RULE_KEY

TOPIC_PREFIX = "/data/derived/calc/tcp"


def rule_origin(deps: DataFrame, origin: DataFrame) -> DataFrame:
    """(DEVICE, ORIGIN) of devices with rules: that of the operands' devices in `origin` (DEVICE, ORIGIN), the greatest of several.

    `deps` has a row per operand: RULE_KEY, dep_device_code. For devices that send nothing themselves, such as parents.
    """
    devices = deps.select("company_id", "device_code", F.col("dep_device_code").alias("device_id")).distinct()
    found = devices.join(origin.select(*DEVICE, *ORIGIN), DEVICE).groupBy("company_id", "device_code").agg(F.max(F.struct(*ORIGIN)).alias("_o"))
    return found.select("company_id", F.col("device_code").alias("device_id"), *[F.col(f"_o.{c}").alias(c) for c in ORIGIN])


def derived_points(derived: DataFrame, *origins: DataFrame) -> DataFrame:
    """Derived points as full records: ORIGIN, data_type `calc`, property_value (text), data_date (ms) added.

    Each of `origins` names project and gateway by device, and by window end too if it has tick_ms; the first that knows a
    device's project counts. Where none does they are null.
    """
    rows = derived
    for i, o in enumerate(origins):
        keys = [c for c in ("tick_ms", *DEVICE) if c in o.columns]
        rows = rows.join(o.select(*keys, F.struct(*ORIGIN).alias(f"_o{i}")), keys, "left")
    known = F.coalesce(*[F.when(F.col(f"_o{i}.project_id").isNotNull(), F.col(f"_o{i}")) for i in range(len(origins))]) if origins else None
    of = {c: known[c] if origins else F.lit(None).cast("string") for c in ORIGIN}
    return rows.select(
        *derived.columns, *[v.alias(c) for c, v in of.items()], F.lit("calc").alias("data_type"),
        F.col("value").cast("string").alias("property_value"), F.col("snapshot_ms").alias("data_date"),
    )


def encode_envelope(derived: DataFrame, origin: DataFrame | None = None, topic_prefix: str = TOPIC_PREFIX) -> DataFrame:
    """One message (`value`, with tick_ms, company_id, device_id) per window end and device.

    `origin` (tick_ms, company_id, device_id, project_id) names the project, else a column `project_id` of the points (see
    `derived_points`); where neither does it is `unknown`. The message id is made of the window end, so equal input gives
    equal output.
    """
    firing = ["tick_ms", "company_id", "device_id"]
    point = F.struct(
        F.col("property_name").alias("nm"),
        F.col("value").alias("v"),
        F.coalesce(F.expr("snapshot_ms div 1000"), F.lit(0)).alias("ts"),
    )
    project = F.max("project_id") if origin is None and "project_id" in derived.columns else F.lit(None).cast("string")
    messages = derived.groupBy(*firing).agg(F.array_sort(F.collect_list(point)).alias("datas"), project.alias("project_id"))
    if origin is not None:
        messages = messages.drop("project_id")
        messages = messages.join(origin.select(*firing, "project_id"), firing, "left")
    payload = F.to_json(
        F.struct(
            "datas",
            F.coalesce("device_id", F.lit("unknown")).alias("meter"),
            F.concat(F.lit("CALC-"), F.col("tick_ms").cast("string")).alias("mid"),
        )
    )
    topic = F.format_string(
        f"{topic_prefix}/%s/%s", F.coalesce("company_id", F.lit("unknown")), F.coalesce("project_id", F.lit("unknown"))
    )
    body = F.to_json(F.struct(F.lit("calc").alias("parseType"), payload.alias("payload"), topic.alias("topic")))
    return messages.select(*firing, body.alias("value"))
