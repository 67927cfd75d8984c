"""Change records of the rule and configuration tables, and their reduction to the current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointloom.schemas import CDC_ENVELOPE, RULE_IMAGE

COMPUTED_SOURCES = (2, 3)  # data_source of computed and constant points


def parse_change_records(raw: DataFrame, seq: Column | None = None) -> DataFrame:
    """Debezium JSON in `value` -> (table, op, before, after, seq). Lines that are not JSON are dropped."""
    doc = F.from_json("value", CDC_ENVELOPE)
    order = F.coalesce(F.col("_c.ts_ms"), F.lit(0).cast("bigint")) if seq is None else seq.cast("bigint")
    return (
        raw.withColumn("_c", doc)
        .select(
            F.col("_c.source.table").alias("table"), F.col("_c.op").alias("op"),
            F.col("_c.before").alias("before"), F.col("_c.after").alias("after"), order.alias("seq"),
        )
        .where(F.col("op").isNotNull())
    )


def read_rule_changes(spark: SparkSession, fmt: str, path: str | None = None, stream: bool = True, **options: str) -> DataFrame:
    """Change records of the rule table: first the snapshot (op r), then changes.

    `kafka` and file formats carry Debezium JSON; `jdbc` (batch) reads the present table as snapshot records.
    """
    if fmt == "jdbc":
        table = spark.read.format("jdbc").options(**options).load()
        image = F.to_json(F.struct(*[F.col(c).alias(c.lower()) for c in table.columns]))
        return table.select(
            F.lit(options["dbtable"]).alias("table"), F.lit("r").alias("op"),
            F.lit(None).cast("string").alias("before"), image.alias("after"), F.lit(0).cast("bigint").alias("seq"),
        )
    reader = spark.readStream if stream else spark.read
    if fmt == "kafka":
        df = reader.format("kafka").options(**{"startingOffsets": "earliest", **options}).load()
        return parse_change_records(df.select(F.col("value").cast("string").alias("value"), "offset"), F.col("offset"))
    reader = reader.format(fmt).options(**options)
    if fmt != "text":
        reader = reader.schema("value STRING, seq BIGINT")
    df = reader.load(path)
    return parse_change_records(df, F.col("seq") if "seq" in df.columns else None)


def read_config_changes(
    spark: SparkSession, fmt: str, tables: Sequence[str], path: str | None = None, stream: bool = True, **options: str
) -> dict[str, DataFrame]:
    """One change stream split into one frame per configuration table."""
    changes = read_rule_changes(spark, fmt, path, stream, **options)
    return {t: changes.where(F.col("table") == t) for t in tables}


def row_image(changes: DataFrame) -> DataFrame:
    """Adds `image`: `before` of a delete, `after` of any other record. Records without image are dropped."""
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return changes.withColumn("image", image).where(F.col("image").isNotNull())


def route_config(changes: DataFrame, point_table: str) -> DataFrame:
    """Point records pass only when computed or constant; records of all other tables pass."""
    source = F.coalesce(F.get_json_object("image", "$.data_source").try_cast("int"), F.lit(0))
    return row_image(changes).where((F.col("table") != point_table) | source.isin(*COMPUTED_SOURCES))


def apply_changes(changes: DataFrame, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Current rows of one table: the newest image per key, without the deleted ones.

    One partial + final aggregation; a key with a long change history is combined before the shuffle.
    """
    imaged = row_image(changes).withColumn("_row", F.from_json("image", schema))
    newest = imaged.groupBy(*[F.col(f"_row.{k}").alias(k) for k in keys]).agg(
        F.max_by(F.struct("op", "_row"), F.col("seq")).alias("_last")
    )
    return newest.where(F.col("_last.op") != "d").select("_last._row.*")


def rule_images(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current rule rows from rule-table changes; numbers given as text are read leniently."""
    rows = apply_changes(changes, RULE_IMAGE, keys)

    def number(name: str, default: int) -> Column:
        return F.coalesce(F.col(name).try_cast("int"), F.lit(default)).alias(name)

    return rows.select(
        "company_id", "device_code", "point_code", number("point_type", 0), number("value_type", 0),
        number("expr_type", 0), F.coalesce("expr", F.lit("")).alias("expr"),
        F.coalesce("depends_on", F.lit("")).alias("depends_on"), F.coalesce("params", F.lit("")).alias("params"),
        number("enabled", 1),
    )
