"""Calendar period of an epoch-millisecond column in an explicit time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# period name -> digits kept of yyyyMMddHH
PERIODS = {"hour": 10, "day": 8, "month": 6, "year": 4, "total": 0}


def local_time(ms: Column, tz: str = "UTC") -> Column:
    """Wall-clock TIMESTAMP_NTZ in `tz`; does not depend on the session time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = F.timestamp_add("MILLISECOND", ms, epoch)
    return utc if tz.upper() == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def period_key(ms: Column, unit: str, tz: str = "UTC") -> Column:
    """Period as a number: 2024013123 (hour), 20240131 (day), 202401, 2024, or 0 for the whole life."""
    if unit not in PERIODS:
        raise ValueError(f"unknown period {unit!r}; expected one of {sorted(PERIODS)}")
    if unit == "total":
        return F.lit(0).cast("bigint")
    t = local_time(ms, tz)
    key = F.year(t).cast("bigint")
    for unit_fn, name in ((F.month, "month"), (F.day, "day"), (F.hour, "hour")):
        if PERIODS[name] > PERIODS[unit]:
            break
        key = key * 100 + unit_fn(t)
    return key
