"""Telemetry messages: reading, decoding into points, rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pointloom.functions.once import with_once
from pointloom.schemas import ENVELOPE, FLAT_POINT, PAYLOAD, POINT

_CORRUPT = {"columnNameOfCorruptRecord": "_bad"}


def read_telemetry(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """Stream of raw messages with the column `value`; from Kafka also `partition` and `offset`, the order of arrival.

    Kafka: pass `kafka_bootstrap_servers`, `subscribe` and any other source option; a new query starts at the
    latest offsets. Other formats (text, parquet) stream the files below `path`.
    """
    if fmt == "kafka":
        defaults = {"startingOffsets": "latest"}
        renamed = {("kafka.bootstrap.servers" if k == "kafka_bootstrap_servers" else k): v for k, v in options.items()}
        df = spark.readStream.format("kafka").options(**{**defaults, **renamed}).load()
        return df.select(F.col("value").cast("string").alias("value"), "partition", "offset")
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "text":
        reader = reader.schema("value STRING")
    return reader.load(path).select("value")


def topic_fields(topic: Column) -> Column:
    """STRUCT(gateway_code, company_id, project_id) from parts 4, 5 and 6 of the topic; `unknown` where absent."""
    parts = F.split(F.coalesce(topic, F.lit("")), "/")

    def part(i: int) -> Column:
        return F.coalesce(F.nullif(F.get(parts, F.lit(i)), F.lit("")), F.lit("unknown"))

    return F.struct(part(4).alias("gateway_code"), part(5).alias("company_id"), part(6).alias("project_id"))


def lenient_double(text: Column) -> Column:
    """Number of a JSON scalar: numeric text counts, true is 1, anything else is 0."""
    return F.coalesce(text.try_cast("double"), F.when(text == "true", 1.0).otherwise(0.0))


def lenient_long(text: Column) -> Column:
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def _parsed(raw: DataFrame, value_col: str, once: bool = True) -> DataFrame:
    """Adds the parsed forms and `route`: envelope, flat, or the reason for a reject.

    `once`: for uses that filter by route, which would otherwise repeat the parsing for each mention of it.
    """
    add = with_once if once else DataFrame.withColumn
    value = F.col(value_col)
    nested = value.rlike(r'"payload"\s*:\s*[\{\[]')
    df = add(raw, "_msg", F.from_json(value, ENVELOPE, _CORRUPT))
    has_payload = F.coalesce(F.col("_msg.payload"), F.lit("")) != ""
    df = add(df, "_body", F.when(has_payload & ~nested, F.from_json("_msg.payload", PAYLOAD, _CORRUPT)))
    df = add(df, "_flat", F.when(~has_payload, F.from_json(value, FLAT_POINT, _CORRUPT)))
    flat_number_bad = F.lit(False)
    for name, typ in (
        ("property_num_value", "double"), ("timestamp", "bigint"), ("create_date", "bigint"), ("data_date", "bigint"),
    ):
        text = F.nullif(F.col(f"_flat.{name}"), F.lit(""))
        flat_number_bad = flat_number_bad | (text.isNotNull() & text.try_cast(typ).isNull())
    route = (
        F.when(value.isNull() | F.col("_msg._bad").isNotNull(), "malformed message")
        .when(nested, "nested payload")
        .when(has_payload & F.col("_body._bad").isNotNull() & F.col("_body.datas").isNull(), "malformed payload")
        .when(has_payload, "envelope")
        .when(flat_number_bad, "malformed point")
        .otherwise("flat")
    )
    return df.withColumn("_route", route)


def _keep(raw: DataFrame, value_col: str) -> list[str]:
    return [c for c in raw.columns if c != value_col]


def _envelope_points(parsed: DataFrame, keep: list[str]) -> DataFrame:
    rows = parsed.where(F.col("_route") == "envelope").select(
        *keep,
        topic_fields(F.col("_msg.topic")).alias("_t"),
        F.coalesce(F.col("_body.meter"), F.lit("")).alias("device_id"),
        F.explode("_body.datas").alias("_d"),
    )
    return rows.select(
        *keep,
        F.col("_t.company_id").alias("company_id"),
        "device_id",
        F.col("_t.project_id").alias("project_id"),
        lenient_double(F.col("_d.v")).alias("property_num_value"),
        F.lit("source").alias("data_type"),
        F.lit(None).cast("string").alias("property_value"),
        F.lit(None).cast("bigint").alias("create_date"),
        F.lit(None).cast("bigint").alias("data_date"),
        F.col("_t.gateway_code").alias("gateway_code"),
        F.coalesce(F.col("_d.nm"), F.lit("")).alias("property_name"),
        (lenient_long(F.col("_d.ts")) * 1000).alias("ts_ms"),
    )


def _flat_points(parsed: DataFrame, keep: list[str]) -> DataFrame:
    def field(name: str) -> Column:
        source = "timestamp" if name == "ts_ms" else name
        typ = POINT[name].dataType
        col = F.col(f"_flat.{source}")
        return (col if typ.simpleString() == "string" else F.nullif(col, F.lit("")).try_cast(typ)).alias(name)

    rows = parsed.where(F.col("_route") == "flat").select(*keep, *[field(n) for n in POINT.fieldNames()])
    return rows.where(F.col("ts_ms").isNotNull())


def decode_envelope(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """One POINT row per element of `datas`. Further columns of `raw` are kept."""
    return _envelope_points(_parsed(raw, value_col), _keep(raw, value_col))


def decode_flat(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Messages without payload are points themselves; those without timestamp are dropped."""
    return _flat_points(_parsed(raw, value_col), _keep(raw, value_col))


def decode(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """All points of a mixed message table, each message parsed once."""
    keep = _keep(raw, value_col)
    parsed = _parsed(raw, value_col, once=False)  # its explode already keeps parsing in one place
    t = topic_fields(F.col("_msg.topic"))
    empty = F.array().cast("array<struct<nm:string,v:string,ts:string>>")
    flat = F.col("_route") == "flat"
    one = F.array(
        F.struct(
            F.col("_flat.property_name").alias("nm"),
            F.col("_flat.property_num_value").alias("v"),
            F.col("_flat.timestamp").alias("ts"),
        )
    )
    items = F.when(F.col("_route") == "envelope", F.coalesce(F.col("_body.datas"), empty)).when(flat, one)
    rows = parsed.select(*keep, "_flat", flat.alias("_is_flat"), t.alias("_t"), "_body.meter", F.explode(items).alias("_d"))

    def pick(flat_name: str, envelope: Column, typ: str = "string") -> Column:
        col = F.col(f"_flat.{flat_name}")
        flat_col = col if typ == "string" else F.nullif(col, F.lit("")).try_cast(typ)
        return F.when(F.col("_is_flat"), flat_col).otherwise(envelope)

    null = F.lit(None)
    out = rows.select(
        *keep,
        pick("company_id", F.col("_t.company_id")).alias("company_id"),
        pick("device_id", F.coalesce(F.col("meter"), F.lit(""))).alias("device_id"),
        pick("project_id", F.col("_t.project_id")).alias("project_id"),
        pick("property_num_value", lenient_double(F.col("_d.v")), "double").alias("property_num_value"),
        pick("data_type", F.lit("source")).alias("data_type"),
        pick("property_value", null).alias("property_value"),
        pick("create_date", null.cast("bigint"), "bigint").alias("create_date"),
        pick("data_date", null.cast("bigint"), "bigint").alias("data_date"),
        pick("gateway_code", F.col("_t.gateway_code")).alias("gateway_code"),
        pick("property_name", F.coalesce(F.col("_d.nm"), F.lit(""))).alias("property_name"),
        pick("timestamp", lenient_long(F.col("_d.ts")) * 1000, "bigint").alias("ts_ms"),
    )
    return out.where(F.col("ts_ms").isNotNull())


def rejects(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Messages that decode to nothing because they are malformed, with the reason."""
    parsed = _parsed(raw, value_col)
    return parsed.where(~F.col("_route").isin("envelope", "flat")).select(
        *raw.columns, F.col("_route").alias("reason")
    )


def to_readings(points: DataFrame, seq: Column | None = None) -> DataFrame:
    """POINT rows as READING rows. `seq` numbers the arrivals; readings of one millisecond are ordered by it.

    Without `seq` it is the message's `offset` where there is one: messages of a device are keyed alike, so they come in
    one partition, in which offsets tell their order.
    """
    if seq is None:
        seq = F.col("offset") if "offset" in points.columns else F.lit(0)
    return points.select(
        seq.cast("bigint").alias("seq"),
        "company_id", "device_id", "project_id", "gateway_code", "property_name",
        F.col("property_num_value").alias("value"), "ts_ms",
    )
