"""Single-bit extraction from a numeric point value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bit_at(value: Column, bit: Column) -> Column:
    """Bit `bit` (1 = lowest) of `value` truncated to 64 bits; null when the bit is not positive or
    the value has no 64-bit integer form."""
    whole = value.try_cast("bigint")
    # a shift count is taken modulo 64, as on the JVM
    shifted = F.call_function("shiftright", whole, bit.cast("int") - F.lit(1))
    return F.when(bit > 0, shifted.bitwiseAND(F.lit(1).cast("bigint")).cast("double"))
