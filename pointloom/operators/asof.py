"""As-of lookup: the newest history row at or before a time, for many keys at once.

Work is split by (series, time bucket). Per bucket only its last row travels forward to later buckets, so neither a
series with a long history nor one with very many probes has to fit one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pointloom.schemas import HISTORY, SERIES

HOUR_MS = 3_600_000


def asof_join(
    keys: DataFrame, history: DataFrame, values: Sequence[str], on: Sequence[str] = tuple(SERIES), key_ts: str = "ts_ms",
    history_ts: str = "timestamp", tie: str = "data_id", bucket_ms: int = HOUR_MS,
) -> DataFrame:
    """`keys` with the `values` of the newest history row of the same series whose time is <= `key_ts`.

    Values are null where there is none. Of several rows of one millisecond the one with the largest `tie` counts.
    """
    on = list(on)

    def bucket(ts: str):
        return F.expr(f"({ts} - pmod({ts}, {bucket_ms})) div {bucket_ms}").alias("_bucket")

    # one row per series and millisecond on both sides, combined before the shuffle
    rows = history.groupBy(*on, bucket(history_ts), F.col(history_ts).alias("_ts")).agg(
        F.max_by(F.struct(*values), tie).alias("_row")
    )
    probes = keys.groupBy(*on, bucket(key_ts), F.col(key_ts).alias("_ts")).agg(F.lit(True).alias("_probe"))

    # newest row of all earlier buckets, for the buckets with probes
    last = rows.groupBy(*on, "_bucket").agg(F.max_by("_row", "_ts").alias("_row"))
    asked = probes.select(*on, "_bucket").distinct()
    marks = last.select(*on, "_bucket", "_row", F.lit(False).alias("_asked")).unionByName(
        asked.select(*on, "_bucket", F.lit(None).cast(last.schema["_row"].dataType).alias("_row"), F.lit(True).alias("_asked"))
    )
    earlier = Window.partitionBy(*on).orderBy("_bucket").rangeBetween(Window.unboundedPreceding, -1)
    carried = (
        marks.withColumn("_row", F.when(F.col("_asked"), F.last("_row", ignorenulls=True).over(earlier)))
        .where(F.col("_asked") & F.col("_row").isNotNull())
        .select(*on, "_bucket", (F.col("_bucket") * bucket_ms - 1).alias("_ts"), "_row", F.lit(False).alias("_probe"))
    )
    line = (
        rows.select(*on, "_bucket", "_ts", "_row", F.lit(False).alias("_probe"))
        .unionByName(carried)
        .unionByName(
            probes.select(*on, "_bucket", "_ts", F.lit(None).cast(last.schema["_row"].dataType).alias("_row"), "_probe")
        )
    )
    upto = (
        Window.partitionBy(*on, "_bucket").orderBy("_ts", "_probe")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = (
        line.withColumn("_row", F.last("_row", ignorenulls=True).over(upto))
        .where(F.col("_probe"))
        .select(*on, F.col("_ts").alias(key_ts), "_row")
    )
    return keys.join(found, [*on, key_ts], "left").select(
        *keys.columns, *[F.col(f"_row.{v}").alias(v) for v in values]
    )


def asof_history(keys: DataFrame, history: DataFrame) -> DataFrame:
    """Keys (SERIES, ts_ms) with the numeric value at or before the time; reads six history columns."""
    return asof_join(keys, history, ["property_num_value"])


def asof_history_full(keys: DataFrame, history: DataFrame) -> DataFrame:
    """Keys (SERIES, ts_ms) with every other column of the history row at or before the time."""
    return asof_join(keys, history, [c for c in HISTORY.fieldNames() if c not in SERIES])
