"""Sliding device snapshots: the latest reading of every point in a 15-minute window, each minute.

A reading of slot M (minute number) can be the latest one for window ends M+1 .. M+15 only, and stops being so at
the next slot of its series that has a reading. So the rows of all windows follow from one row per (series, slot)
and the slot of its successor; nothing is multiplied by 15 before a shuffle. Reduced to slots, a series holds at
most one row per minute, however many readings arrived, so a partition by series stays bounded by the time range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointloom.schemas import DEVICE, MINUTE_MS, SERIES, WINDOW_SLOTS


def arrival() -> Column:
    """Order of readings: by time, then by arrival number, whatever its values; a missing one comes first."""
    return F.struct("ts_ms", F.coalesce(F.col("seq"), F.lit(-(2**63))).alias("seq"))


def slot_latest(readings: DataFrame, slide_ms: int = MINUTE_MS) -> DataFrame:
    """Latest reading per (series, slot): columns SERIES, slot, value, ts_ms. Unnamed points are dropped.

    Two hash aggregations with plain numbers as keys and buffers: one row per (series, slot, time) of the latest arrival,
    then the latest time. Readings are never sorted.
    """
    named = readings.where(F.col("property_name").isNotNull()).select(
        *SERIES, F.expr(f"(ts_ms - pmod(ts_ms, {slide_ms})) div {slide_ms}").alias("slot"), "value", "ts_ms", "seq"
    )
    arrived = F.coalesce(F.col("seq"), F.lit(-(2**63)))
    by_time = named.groupBy(*SERIES, "slot", "ts_ms").agg(F.max_by("value", arrived).alias("value"))
    time = F.coalesce(F.col("ts_ms"), F.lit(-(2**63)))
    return by_time.groupBy(*SERIES, "slot").agg(F.max_by("value", time).alias("value"), F.max("ts_ms").alias("ts_ms"))


def successor_slots(slots: DataFrame, width: int = WINDOW_SLOTS, by: Sequence[str] = tuple(SERIES)) -> DataFrame:
    """Adds `n`: the number of window ends, from slot+1 on, at which the row is the latest of its series."""
    w = Window.partitionBy(*by).orderBy("slot")
    gap = F.lead("slot").over(w) - F.col("slot")
    return slots.withColumn("n", F.least(F.coalesce(gap, F.lit(width).cast("bigint")), F.lit(width)).cast("int"))


def latest_snapshot(readings: DataFrame, slide_ms: int = MINUTE_MS, width: int = WINDOW_SLOTS) -> DataFrame:
    """One row per window end and point: (tick_ms, SERIES, value, ts_ms)."""
    runs = successor_slots(slot_latest(readings, slide_ms), width)
    return _at_window_ends(runs, slide_ms, *SERIES, "value", "ts_ms")


def _at_window_ends(runs: DataFrame, slide_ms: int, *cols: str | Column) -> DataFrame:
    """One row per window end slot+1 .. slot+n: tick_ms and `cols`."""
    ticks = runs.select("*", F.explode(F.sequence(F.col("slot") + 1, F.col("slot") + F.col("n"))).alias("_tick"))
    return ticks.select((F.col("_tick") * slide_ms).alias("tick_ms"), *cols)


def device_slots(readings: DataFrame, slide_ms: int = MINUTE_MS) -> DataFrame:
    """Newest reading time per (device, slot). Reads three columns and is combined before its shuffle."""
    named = readings.where(F.col("property_name").isNotNull()).select(
        *DEVICE, F.expr(f"(ts_ms - pmod(ts_ms, {slide_ms})) div {slide_ms}").alias("slot"), "ts_ms"
    )
    return named.groupBy(*DEVICE, "slot").agg(F.max("ts_ms").alias("newest_ms"))


def device_firings(readings: DataFrame, slide_ms: int = MINUTE_MS, width: int = WINDOW_SLOTS) -> DataFrame:
    """Per device and slot with a reading: `firings`, the snapshot times at window ends slot+1 .. slot+width.

    Each is an offset in ms from the start of the slot, so that a row carries 4 bytes per window end.
    """
    w = Window.partitionBy(*DEVICE).orderBy("slot").rangeBetween(0, width - 1)
    ahead = spread(device_slots(readings, slide_ms), *DEVICE).withColumn(
        "_ahead", F.collect_list(F.struct("slot", "newest_ms")).over(w)
    )
    start = F.col("slot") * slide_ms
    end = F.col("slot") + width
    firings = F.flatten(
        F.transform(
            F.col("_ahead"),
            lambda x, i: F.array_repeat(
                (x["newest_ms"] - start).cast("int"),
                (F.coalesce(F.get(F.col("_ahead"), i + 1)["slot"], end) - x["slot"]).cast("int"),
            ),
        )
    )
    return ahead.select(*DEVICE, "slot", firings.alias("firings"))


def snapshot_runs(readings: DataFrame, slide_ms: int = MINUTE_MS, width: int = WINDOW_SLOTS) -> DataFrame:
    """Slot rows with the snapshot times of their device: (SERIES, slot, value, ts_ms, firings)."""
    slots = slot_latest(readings, slide_ms)
    return slots.join(device_firings(readings, slide_ms, width), [*DEVICE, "slot"])


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Partition by `keys` ahead of an explode, with the session's full number of shuffle partitions.

    Adaptive execution sizes partitions by what is shuffled and would merge those that grow manyfold afterwards.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def snapshot_ticks(readings: DataFrame, slide_ms: int = MINUTE_MS, width: int = WINDOW_SLOTS) -> DataFrame:
    """TICK rows: every point of every window with the snapshot time of its device.

    The result is partitioned by series, so windows by series and period follow without another shuffle.
    """
    runs = successor_slots(spread(snapshot_runs(readings, slide_ms, width), *SERIES), width)
    return runs.select(
        *SERIES, "slot", "value", F.posexplode(F.slice("firings", F.lit(1), F.col("n"))).alias("_i", "_offset")
    ).select(
        ((F.col("slot") + 1 + F.col("_i")) * slide_ms).alias("tick_ms"),
        (F.col("slot") * slide_ms + F.col("_offset")).alias("snapshot_ms"),
        *SERIES,
        "value",
    )


def snapshot_time(readings: DataFrame, slide_ms: int = MINUTE_MS, width: int = WINDOW_SLOTS) -> DataFrame:
    """One row per device and window end: (tick_ms, DEVICE, snapshot_ms)."""
    runs = successor_slots(device_slots(readings, slide_ms), width, DEVICE)
    return _at_window_ends(runs, slide_ms, *DEVICE, F.col("newest_ms").alias("snapshot_ms"))


def device_origin(readings: DataFrame, slide_ms: int = MINUTE_MS, width: int = WINDOW_SLOTS) -> DataFrame:
    """Per device and window end the project and gateway of the newest reading in the window."""
    slot = F.expr(f"(ts_ms - pmod(ts_ms, {slide_ms})) div {slide_ms}")
    newest = readings.where(F.col("property_name").isNotNull()).groupBy(*DEVICE, slot.alias("slot")).agg(
        F.max_by(F.struct("project_id", "gateway_code"), F.struct("ts_ms", "seq")).alias("_o")
    )
    runs = successor_slots(newest, width, DEVICE)
    return _at_window_ends(
        runs, slide_ms, *DEVICE, F.col("_o.project_id").alias("project_id"), F.col("_o.gateway_code").alias("gateway_code")
    )
