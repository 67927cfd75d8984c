"""Constant points: values of constant rules, overridden by readings of the same point."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pointloom.functions.formula import constant_value
from pointloom.operators.snapshot import device_slots, slot_latest
from pointloom.schemas import DEVICE, MINUTE_MS, SERIES, WINDOW_SLOTS


def active_constants(rules: DataFrame) -> DataFrame:
    """(SERIES, const) of enabled constant rules with a readable number."""
    return rules.where((F.col("expr_type") == 2) & (F.coalesce("enabled", F.lit(1)) != 0)).select(
        "company_id", F.col("device_code").alias("device_id"), F.col("point_code").alias("property_name"),
        constant_value(F.col("expr")).alias("const"),
    ).where(F.col("const").isNotNull())


def constant_points(readings: DataFrame, constants: DataFrame, slide_ms: int = MINUTE_MS, width: int = WINDOW_SLOTS) -> DataFrame:
    """Value of every constant point at every firing of its device: the last reading if any, else the constant.

    A constant never fires a device by itself.
    """
    w = Window.partitionBy(*DEVICE).orderBy("slot")
    gap = F.coalesce(F.lead("slot").over(w) - F.col("slot"), F.lit(width))
    fired = device_slots(readings, slide_ms).withColumn("_n", F.least(gap, F.lit(width))).drop("newest_ms")
    known = Window.partitionBy(*SERIES).orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_slot = (
        fired.join(constants, DEVICE)
        .join(slot_latest(readings, slide_ms).select(*SERIES, "slot", "value"), [*SERIES, "slot"], "left")
        .withColumn("value", F.coalesce(F.last("value", ignorenulls=True).over(known), F.col("const")))
    )
    tick = F.explode(F.sequence(F.col("slot") + 1, F.col("slot") + F.col("_n")))
    return per_slot.select(tick.alias("_tick"), *SERIES, "value").select(
        (F.col("_tick") * slide_ms).alias("tick_ms"), *SERIES, "value"
    )
