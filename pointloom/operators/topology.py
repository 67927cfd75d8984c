"""Joins over the configuration: objects, models, children, and the rules a topology change touches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_config(points: DataFrame, objects: DataFrame, keep_unmatched: bool = False) -> DataFrame:
    """Point configuration with its object's code, status and parent.

    Live points without object give nothing. With `keep_unmatched` (deleted points) their device is `unknown`.
    """
    o = objects.select("object_id", "object_code", "status", "parent_id")
    joined = points.join(o, "object_id", "left" if keep_unmatched else "inner")
    if not keep_unmatched:
        return joined
    return joined.withColumn("object_code", F.coalesce("object_code", F.lit("unknown")))


def tombstones(deleted_points: DataFrame, objects: DataFrame) -> DataFrame:
    """Rule keys switched off because their point was deleted: enabled 0."""
    return join_config(deleted_points, objects, keep_unmatched=True).select(
        F.col("company_id").cast("string").alias("company_id"),
        F.col("object_code").alias("device_code"),
        F.col("data_code").alias("point_code"),
        F.lit(0).alias("enabled"),
    )


def resolve_model(wanted: DataFrame, models: DataFrame) -> DataFrame:
    """Adds `model_id` for (company_id, model_code); the smallest id where a code occurs twice."""
    first = models.groupBy("company_id", F.col("object_code").alias("model_code")).agg(
        F.min("model_id").alias("model_id")
    )
    return wanted.join(first, ["company_id", "model_code"])


def expand_children(parents: DataFrame, objects: DataFrame) -> DataFrame:
    """One row per child: rows of `parents` (object_id, model_id) with the code of every child of that model."""
    children = objects.where(F.col("parent_id").isNotNull() & F.col("model_id").isNotNull()).select(
        F.col("parent_id").alias("object_id"), "model_id", F.col("object_code").alias("child_code"),
        F.col("object_id").alias("child_id"),
    )
    return parents.join(children, ["object_id", "model_id"])


def affected_rules(object_images: DataFrame, models: DataFrame, watches: DataFrame) -> DataFrame:
    """Roll-up rules to refresh after object changes.

    `object_images` holds the old and new rows (parent_id, model_id) of changed objects, `watches` the roll-ups
    (object_id, model_code, further columns). A watch is hit when a child of its model came, went or changed.
    """
    touched = (
        object_images.where(F.col("parent_id").isNotNull())
        .join(models.select("model_id", F.col("object_code").alias("model_code")), "model_id")
        .select(F.col("parent_id").alias("object_id"), "model_code")
        .distinct()
    )
    return watches.join(touched, ["object_id", "model_code"], "left_semi")
