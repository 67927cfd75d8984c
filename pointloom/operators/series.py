"""Per-series derivations over ticks: period differences and running daily statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pointloom.functions.calendar import period_key
from pointloom.schemas import MINUTE_MS, SERIES

STATS = ("max", "min", "avg")


def period_diffs(ticks: DataFrame, units: Sequence[str], tz: str = "UTC") -> DataFrame:
    """Adds `<unit>_diff` per unit: value minus the first value seen in the period of the snapshot time.

    All units share the partitioning by series, so they cost one sort each and no shuffle. The unit `total`
    has no period. A meter reset is not corrected; a difference can be negative.
    """
    out = ticks.where(F.col("value").isNotNull())
    for unit in units:
        out = out.withColumn("_p", period_key(F.col("snapshot_ms"), unit, tz))
        w = (
            Window.partitionBy(*SERIES, *([] if unit == "total" else ["_p"]))
            .orderBy("tick_ms").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        out = out.withColumn(f"{unit}_diff", F.col("value") - F.first("value").over(w))
    return out.drop("_p")


def daily_stats(ticks: DataFrame, kinds: Sequence[str] = STATS, tz: str = "UTC") -> DataFrame:
    """Adds `daily_<kind>`: statistic over the firings since local midnight, up to and with the present one.

    A reading counts once per minute for as long as it stays in the snapshot; see `daily_reading_stats` for the
    statistic over readings.
    """
    w = (
        Window.partitionBy(*SERIES, "_day").orderBy("tick_ms")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    made = {
        "max": F.max("value").over(w),
        "min": F.min("value").over(w),
        "avg": F.sum("value").over(w) / F.count("value").over(w),
    }
    out = ticks.where(F.col("value").isNotNull()).withColumn("_day", period_key(F.col("snapshot_ms"), "day", tz))
    return out.withColumns({f"daily_{k}": made[k] for k in kinds}).drop("_day")


def daily_reading_stats(readings: DataFrame, kinds: Sequence[str] = STATS, tz: str = "UTC", slide_ms: int = MINUTE_MS) -> DataFrame:
    """Statistics over the readings themselves since local midnight, one row per series and minute with readings.

    Readings are combined per minute and local day before the running window, which then has at most 1440 rows.
    """
    named = readings.where(F.col("property_name").isNotNull() & F.col("value").isNotNull())
    per_slot = named.groupBy(
        *SERIES,
        period_key(F.col("ts_ms"), "day", tz).alias("_day"),
        F.expr(f"(ts_ms - pmod(ts_ms, {slide_ms})) div {slide_ms}").alias("slot"),
    ).agg(
        F.max("value").alias("_max"), F.min("value").alias("_min"), F.sum("value").alias("_sum"),
        F.count("value").alias("_count"),
    )
    w = (
        Window.partitionBy(*SERIES, "_day").orderBy("slot")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    made = {
        "max": F.max("_max").over(w),
        "min": F.min("_min").over(w),
        "avg": F.sum("_sum").over(w) / F.sum("_count").over(w),
    }
    return per_slot.select(
        ((F.col("slot") + 1) * slide_ms).alias("tick_ms"), *SERIES, *[made[k].alias(f"daily_{k}") for k in kinds]
    )



