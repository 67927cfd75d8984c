"""Minute history table, partitioned by calendar columns."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointloom.schemas import HISTORY


def read_history(
    spark: SparkSession, path: str | None = None, from_ms: int | None = None, to_ms: int | None = None,
    fmt: str = "parquet", **options: str,
) -> DataFrame:
    """HISTORY rows with from_ms <= timestamp <= to_ms.

    The bounds also go to the year and month columns (UTC), so a table partitioned by them is pruned to the
    months in question, and to the row-group statistics of `timestamp`.
    """
    if fmt == "jdbc":
        df = spark.read.format("jdbc").options(**options).load()
        df = df.select(*[F.col(c).alias(c.lower()) for c in df.columns])
    else:
        df = spark.read.schema(HISTORY).format(fmt).options(**options).load(path)
    month = F.col("year") * 100 + F.col("month")
    for bound, is_low in ((from_ms, True), (to_ms, False)):
        if bound is None:
            continue
        at = datetime.fromtimestamp(bound / 1000, tz=timezone.utc)
        key = at.year * 100 + at.month
        if is_low:
            df = df.where((F.col("year") >= at.year) & (month >= key) & (F.col("timestamp") >= bound))
        else:
            df = df.where((F.col("year") <= at.year) & (month <= key) & (F.col("timestamp") <= bound))
    return df


def write_history(history: DataFrame, path: str, mode: str = "append") -> None:
    """Write HISTORY rows partitioned by year, month and day; the rebalance hint lets Spark split large days."""
    (
        history.hint("rebalance", "year", "month", "day")
        .write.mode(mode).partitionBy("year", "month", "day").parquet(path)
    )
