"""Evaluate a costly expression exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, col: Column) -> DataFrame:
    """`df` with column `name`, computed once however often it is used later.

    A later filter on a plain projected column is pushed below the projection and repeats its whole expression;
    for formula parsing, where each step uses the one before many times, that multiplies. A one-element explode is
    a step the optimizer does not move filters through.
    """
    return df.select("*", F.explode(F.array(col)).alias(name))
