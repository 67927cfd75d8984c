"""Fixed schemas and column groups shared by all modules."""

from __future__ import annotations

from pyspark.sql import types as T

MINUTE_MS = 60_000
WINDOW_SLOTS = 15  # 15-minute window sliding by one minute

DEVICE = ["company_id", "device_id"]
SERIES = ["company_id", "device_id", "property_name"]
RULE_KEY = ["company_id", "device_code", "point_code"]
ORIGIN = ["project_id", "gateway_code"]  # where a reading came from


_TYPES = {
    "STRING": T.StringType(), "BIGINT": T.LongType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
}


def struct(text: str, **nested: T.DataType) -> T.StructType:
    """Schema from "name TYPE, ..." without needing a session; `nested` adds columns of other types at the end."""
    fields = [c.split() for c in text.split(",")]
    return T.StructType(
        [T.StructField(n, _TYPES[t]) for n, t in fields] + [T.StructField(n, t) for n, t in nested.items()]
    )


# Wire message. Numbers stay text so that "7.5" and 7.5 are read alike.
ENVELOPE = struct("topic STRING, payload STRING, _bad STRING")
PAYLOAD = struct("meter STRING, _bad STRING", datas=T.ArrayType(struct("nm STRING, v STRING, ts STRING")))
FLAT_POINT = struct(
    "company_id STRING, device_id STRING, project_id STRING, property_num_value STRING, data_type STRING,"
    "property_value STRING, create_date STRING, data_date STRING, gateway_code STRING, property_name STRING,"
    "timestamp STRING, _bad STRING"
)

# What decoding yields; `ts_ms` is the wire field `timestamp`.
POINT = struct(
    "company_id STRING, device_id STRING, project_id STRING, property_num_value DOUBLE, data_type STRING,"
    "property_value STRING, create_date BIGINT, data_date BIGINT, gateway_code STRING, property_name STRING,"
    "ts_ms BIGINT"
)
# What the snapshot operators read: one named measurement with its arrival number.
READING = struct(
    "seq BIGINT, company_id STRING, device_id STRING, project_id STRING, gateway_code STRING,"
    "property_name STRING, value DOUBLE, ts_ms BIGINT"
)
TICK = struct(
    "tick_ms BIGINT, snapshot_ms BIGINT, company_id STRING, device_id STRING, property_name STRING, value DOUBLE"
)

DEPENDENCY = struct("var STRING, company_id INT, device_code STRING, point_code STRING")
PARAM = struct("name STRING, value STRING")
RULE = struct(
    "company_id STRING, device_code STRING, point_code STRING, point_type INT, value_type INT, expr_type INT,"
    "expr STRING, depends_on STRING, params STRING, enabled INT"
)
# Text image of a rule row inside a change record.
RULE_IMAGE = struct(
    "company_id STRING, device_code STRING, point_code STRING, point_type STRING, value_type STRING,"
    "expr_type STRING, expr STRING, depends_on STRING, params STRING, enabled STRING"
)
OBJECT = struct(
    "object_id INT, parent_id INT, company_id INT, object_code STRING, model_id INT, status INT"
)
MODEL = struct("model_id INT, company_id INT, object_code STRING")
POINT_CONF = struct(
    "data_id BIGINT, company_id INT, object_id INT, data_code STRING, data_type STRING, data_source INT,"
    "formula STRING"
)
FORMULA_JSON = struct(
    "formula STRING, _bad STRING", vars=T.ArrayType(struct("name STRING, data_code STRING, object_code STRING"))
)
CDC = struct("table STRING, op STRING, before STRING, after STRING, seq BIGINT")
CDC_ENVELOPE = struct("op STRING, before STRING, after STRING, ts_ms BIGINT", source=struct("table STRING"))
HISTORY = struct(
    "data_id BIGINT, data_date TIMESTAMP, data_type STRING, company_id STRING, project_id STRING,"
    "gateway_code STRING, protocol_code STRING, product_id STRING, device_id STRING, property_name STRING,"
    "property_value STRING, property_num_value DOUBLE, message_id STRING, timestamp BIGINT,"
    "create_date TIMESTAMP, year INT, month INT, day INT, hour INT"
)
