"""Exact sums of doubles: order-free, and free of what is taken away again.

A finite double is written as whole numbers below 2^32 ("limbs"), limb k counting 2^(32 k). Sums of limbs are sums of longs,
so adding a value and taking it away leaves nothing, however large it was and whatever was summed meanwhile. Only the limbs
between the largest and the least value are needed: three or four for values of like size, 66 at most.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 32
BASE = float(1 << BITS)


def _scaled(v: Column, limbs: int) -> Column:
    """v / 2^(32 limbs), in two steps whose factors are doubles; exact but for bits below 1."""
    half = 2.0 ** (-BITS * limbs // 2)
    return v * F.lit(half) * F.lit(half)


def limb_range(df: DataFrame, *cols: str) -> range:
    """The limbs of the finite values in these columns; one row comes to the driver."""
    sizes = [F.abs(F.when(~F.isnan(c) & (F.abs(c) < float("inf")) & (F.col(c) != 0), F.col(c))) for c in cols]
    found = df.agg(F.min(F.least(*sizes) if len(sizes) > 1 else sizes[0]).alias("low"), F.max(F.greatest(*sizes) if len(sizes) > 1 else sizes[0]).alias("high")).first()
    if found["low"] is None:
        return range(0)
    low = max(-1074, math.frexp(found["low"])[1] - 53)  # the place of the last bit
    return range(low // BITS, (math.frexp(found["high"])[1] - 1) // BITS + 1)


def limbs(v: Column, of: range) -> list[Column]:
    """The limbs of a finite double, with its sign; null counts as 0."""
    v = F.coalesce(v, F.lit(0.0))
    # a value from 2^(32 (k + 1) + 53) on has no bits in limb k, and might not be scaled to it
    return [
        F.when(F.abs(v) < (2.0 ** (BITS * (k + 1) + 53) if BITS * (k + 1) + 53 < 1024 else float("inf")), (_scaled(v, k) % BASE).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        for k in of
    ]


def _once(value: Column, fn: Callable[[Column], Column]) -> Column:
    """fn(value), with the value computed once, however often fn names it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _carried(limbs_: Column) -> Column:
    """Limbs of 0 to 2^32 - 1 with the same sum, and one more on top with the rest and its sign."""
    none = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("carry"))

    def step(acc: Column, limb: Column) -> Column:
        whole = limb + acc["carry"]
        return F.struct(
            F.concat(acc["out"], F.array(whole.bitwiseAND(F.lit((1 << BITS) - 1)))).alias("out"), F.shiftright(whole, BITS).alias("carry")
        )

    return F.aggregate(limbs_, none, step, lambda acc: F.concat(acc["out"], F.array(acc["carry"])))


def with_total(df: DataFrame, parts: Sequence[str], of: range, name: str) -> DataFrame:
    """Replaces summed limbs by their sum as a double, within one unit in its last place."""
    rest = [c for c in df.columns if c not in parts]
    if not parts:
        return df.withColumn(name, F.lit(0.0))
    # the place of a limb as a product of two doubles, from the least limb on, carries on top included
    halves = F.array(*[F.lit(2.0 ** (BITS * k // 2)) for k in (*of, of[-1] + 1, of[-1] + 2)])

    def value(limbs_: Column) -> Column:
        terms = F.transform(limbs_, lambda x, i: x.cast("double") * F.get(halves, i) * F.get(halves, i))
        return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)

    def signed(limbs_: Column) -> Column:  # limbs of one sign cancel nothing
        minus = F.get(limbs_, F.lit(len(parts))) < 0
        return F.when(minus, -value(_carried(F.transform(limbs_, lambda x: -x)))).otherwise(value(limbs_))

    return df.select(*rest, _once(_carried(F.array(*parts)), signed).alias(name))
