"""Sample inputs made from the given tables: telemetry, messages, device tree, point configuration, changes, history.

Columns are written as SQL expressions that Spark and the checking engine read alike; only the millisecond clock
differs. So both sides start from the same rows and the checking SQL stays independent of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
DAY0 = 1704067200000  # 2024-01-01T00:00Z, first day of the events
DENSE0 = 1704060720000  # 2023-12-31T22:12Z, so that the dense series crosses an hour, a day, a month and a year
DENSE_FACTOR = 200

SPARK_MS = "unix_millis(cast(ts as timestamp))"
DUCK_MS = "epoch_us(ts) // 1000"  # epoch_ms rounds

_SERIES = [
    "event_id AS seq",
    "cast(396 + user_id % 2 AS string) AS company_id",
    "concat('D', cast(user_id AS string)) AS device_id",
    "concat('p', cast(event_id % 3 AS string)) AS project_id",
    "concat('gw', cast(user_id % 4 AS string)) AS gateway_code",
    "event_type AS property_name",
    "value",
]


def telemetry_columns(ms: str, dense: bool) -> list[str]:
    clock = f"cast({DENSE0} + floor((({ms}) - {DAY0}) / {DENSE_FACTOR}.0) AS bigint)" if dense else f"cast({ms} AS bigint)"
    return [*_SERIES, f"{clock} AS ts_ms"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Every 29th reading made very large, with either sign.
SPIKED = "CASE WHEN seq % 29 = 3 THEN 100000000000000000.0D WHEN seq % 29 = 17 THEN -100000000000000000.0D ELSE value END"


def telemetry(spark: SparkSession, sf_dir: str, dense: bool = True) -> DataFrame:
    """READING rows from `events`: one series per user and event type."""
    return table(spark, sf_dir, "events").selectExpr(*telemetry_columns(SPARK_MS, dense))


# --- messages: one per event, most of them regular, some odd in the ways the decoder has to cope with ---
_TOPIC = (
    "case when event_id % 11 = 4 then '\"topic\":\"x\",' when event_id % 11 = 5 then '' else "
    "concat('\"topic\":\"/data/a/b/gw', cast(user_id % 4 AS string), '/', cast(396 + user_id % 2 AS string), '/161\",') end"
)


def message_columns(ms: str, backslash: str) -> list[str]:
    """(msg_id, value). `backslash` is how the engine writes one backslash inside a string literal."""
    s = f"cast(floor(({ms}) / 1000.0) AS bigint)"
    q = f"'{backslash}\"'"  # a quote escaped inside the payload text
    number = (
        f"case when event_id % 13 = 1 then concat({q}, cast(value AS string), {q}) "
        f"when event_id % 13 = 2 then concat({q}, 'abc', {q}) when event_id % 13 = 3 then 'true' "
        "else cast(value AS string) end"
    )

    def field(name: str) -> str:
        return f"{q}, '{name}', {q}, ':'"

    item = f"'{{', {field('nm')}, {q}, event_type, {q}, ',', {field('v')}, {number}, ',', {field('ts')}, cast({s} AS string), '}}'"
    second = f"'{{', {field('nm')}, {q}, 'k', {q}, ',', {field('v')}, cast(event_id % 97 AS string), ',', {field('ts')}, cast({s} AS string), '}}'"
    head = f"'{{', {field('meter')}, {q}, 'D', cast(user_id AS string), {q}, ',', {field('datas')}"
    body = (
        f"case when event_id % 17 = 5 then concat({head}, '5}}') "
        f"when event_id % 17 = 6 then concat({head}, '[') "
        f"else concat({head}, '[', {item}, ',', {second}, ']}}') end"
    )
    flat = (
        "concat('{\"company_id\":\"', cast(396 + user_id % 2 AS string), '\",\"device_id\":\"D', cast(user_id AS string), "
        "'\",\"property_name\":\"', event_type, '\",\"extra\":1,\"property_num_value\":', cast(value AS string), "
        f"case when event_id % 2 = 0 then '' else concat(',\"timestamp\":', cast({s} * 1000 AS string)) end, '}}')"
    )
    value = (
        f"case when event_id % 19 = 3 then {flat} when event_id % 19 = 4 then concat('not json ', cast(event_id AS string)) "
        "when event_id % 19 = 5 then concat('{\"topic\":\"x\",\"payload\":{\"meter\":\"D', cast(user_id AS string), '\"}}') "
        f"else concat('{{', {_TOPIC}, '\"payload\":\"', {body}, '\"}}') end"
    )
    return ["event_id AS msg_id", f"{value} AS value"]


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*message_columns(SPARK_MS, "\\\\"))


# --- device tree: plants from regions, devices from the customers that have events ---
PLANT_COLUMNS = [
    "cast(n_regionkey * 2 + par + 1 AS int) AS object_id", "cast(null AS int) AS parent_id",
    "cast(396 + par AS int) AS company_id", "concat('P', cast(n_regionkey * 2 + par + 1 AS string)) AS object_code",
    "cast(null AS int) AS model_id", "1 AS status",
]
DEVICE_COLUMNS = [
    "cast(c_custkey + 1000 AS int) AS object_id",
    "cast(n_regionkey * 2 + c_custkey % 2 + 1 AS int) AS parent_id",
    "cast(396 + c_custkey % 2 AS int) AS company_id",
    "concat('D', cast(c_custkey AS string)) AS object_code",
    "cast(ascii(c_mktsegment) * 10 + c_custkey % 2 AS int) AS model_id",
    "cast(case when c_acctbal < -900 then 0 else 1 end AS int) AS status",
]


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with events, with their region."""
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey")).distinct()
    return (
        table(spark, sf_dir, "customer").join(users, "c_custkey", "left_semi")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    plants = table(spark, sf_dir, "nation").select("n_regionkey").distinct().selectExpr(
        "n_regionkey", "explode(array(0, 1)) AS par"
    )
    return plants.selectExpr(*PLANT_COLUMNS).unionByName(devices(spark, sf_dir).selectExpr(*DEVICE_COLUMNS))


MODEL_COLUMNS = [
    "cast(ascii(c_mktsegment) * 10 + par + dup AS int) AS model_id", "cast(396 + par AS int) AS company_id",
    "c_mktsegment AS object_code",
]


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models per segment and company; the second repeats the code under a larger id."""
    return table(spark, sf_dir, "customer").select("c_mktsegment").distinct().selectExpr(
        "c_mktsegment", "explode(array(0, 1)) AS par"
    ).selectExpr("*", "explode(array(0, 5000)) AS dup").selectExpr(*MODEL_COLUMNS)


# --- point configuration: (number, data_code, data_type, data_source, formula), formulas built from the device ---
_Q = "chr(39)"
_OWN = "cast(c_custkey AS string)"


def _call(name: str, *args: str) -> str:
    return f"concat('{name}(', " + ", ',', ".join(args) + ", ')')"


def _quoted(text: str) -> str:
    return f"{_Q}, '{text}', {_Q}"


def _json(formula: str, *variables: tuple[str, str, str]) -> str:
    parts = ", ',', ".join(
        f"'{{\"name\":\"{n}\",\"data_code\":\"{p}\",\"object_code\":\"D', {d}, '\"}}'" for n, p, d in variables
    )
    return f"concat('{{\"formula\":\"{formula}\",\"vars\":[', {parts}, ']}}')"


DEVICE_POINTS: list[tuple[int, str, str, int, str]] = [
    (1, "clickDay", "0", 2, _call("energyUseCalcNew", _quoted("click"), _quoted("day"))),
    (2, "viewHour", "0", 2, _call("energyUseCalcNew", _quoted("view"), f"' ', {_quoted('hour')}")),
    (3, "purStat", "0", 2, "concat('calcDailyStats(‘purchase’,“', case c_custkey % 3 when 0 then 'avg' when 1 then 'max' else 'MIN' end, '”)')"),
    (4, "errBit", "1", 2, _call("decToBin", _quoted("error"), "cast(c_custkey % 8 + 1 AS string)")),
    (5, "price", "0", 3, f"case when c_custkey % 2 = 0 then concat('{{\"formula\":\"', cast(c_custkey % 5 + 1 AS string), '.5\"}}') else concat(cast(c_custkey % 3 + 2 AS string), '.25') end"),
    (6, "signup", "0", 3, "'12'"),
    (7, "revenue", "0", 2, _call("calcConstant", _quoted("purchase*price + purchase/2"))),
    (8, "mix", "x", 2, _json("(a+b)/2", ("a", "click", _OWN), ("b", "view", _OWN))),
    (9, "cross", "0", 2, _json("a-b*0.5", ("a", "click", _OWN), ("b", "view", "cast(c_custkey + 2 AS string)"))),
    (10, "chain", "0", 2, _json("r*2 - p", ("r", "revenue", _OWN), ("p", "purchase", _OWN))),
    (11, "chainDay", "0", 2, _json("DAY_DIFF", ("", "mix", _OWN))),
    (12, "bad", "0", 2, _call("noSuchFunction", _quoted("x"))),
    (13, "week", "0", 2, _call("energyUseCalcNew", _quoted("click"), _quoted("week"))),
    (14, "short", "0", 2, _call("decToBin", _quoted("error"))),
    (15, "click", "0", 1, "cast(null AS string)"),
    (16, "viewAll", "0", 2, _call("energyUseCalcNew", _quoted("view"), _quoted("all"))),
    (17, "clickMonth", "0", 2, _call("energyUseCalcNew", _quoted("click"), _quoted("MONTH"))),
    (18, "clickYear", "0", 2, _call("energyUseCalcNew", _quoted("click"), _quoted("year"))),
    (19, "weighted", "0", 2, _json("s*c/100", ("s", "signup", _OWN), ("c", "click", _OWN))),
    (20, "ratio", "0", 2, _json("e/(bit-1)", ("e", "error", _OWN), ("bit", "error", _OWN))),
    (21, "blank", "0", 2, "' '"),
    (22, "broken", "0", 2, "'{\"formula\":'"),
    (23, "plain", "0", 2, "'price'"),
]
PLANT_POINTS: list[tuple[int, str, str, int, str]] = [
    (1, "plantSum", "0", 2, _call("calcSum", _quoted("BUILDING"), _quoted("purchase"))),
    (2, "plantAvg", "0", 2, _call("calcAvg", _quoted("BUILDING"), _quoted("purchase"))),
    (3, "noModel", "0", 2, _call("calcSum", _quoted("NOPE"), _quoted("purchase"))),
]
POINT_FIELDS = ("data_id", "company_id", "object_id", "data_code", "data_type", "data_source", "formula")


def point_values(kind: tuple, plant: bool) -> list[str]:
    """SQL expressions of one configured point, in the order of POINT_FIELDS."""
    i, code, typ, source, formula = kind
    if plant:
        return [
            f"cast(1000000000 + (n_regionkey * 2 + par + 1) * 4 + {i} AS bigint)", "cast(396 + par AS int)",
            "cast(n_regionkey * 2 + par + 1 AS int)", f"'{code}'", f"'{typ}'", f"{source}", formula,
        ]
    return [
        f"cast(c_custkey * 32 + {i} AS bigint)", "cast(396 + c_custkey % 2 AS int)", "cast(c_custkey + 1000 AS int)",
        f"'{code}'", f"'{typ}'", f"{source}", formula,
    ]


def _points(base: DataFrame, kinds: list[tuple], plant: bool) -> DataFrame:
    rows = ", ".join(
        "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in zip(POINT_FIELDS, point_values(k, plant))) + ")" for k in kinds
    )
    return base.selectExpr(f"inline(array({rows}))")


def point_conf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """POINT_CONF rows: every device has the DEVICE_POINTS, every plant the PLANT_POINTS."""
    plants = table(spark, sf_dir, "nation").select("n_regionkey").distinct().selectExpr(
        "n_regionkey", "explode(array(0, 1)) AS par"
    )
    return _points(devices(spark, sf_dir), DEVICE_POINTS, False).unionByName(_points(plants, PLANT_POINTS, True))


# --- change records of the point table: (number, condition, op, has before, has after, data_source, formula) ---
CHANGES: list[tuple[int, str, str, bool, bool, str, str]] = [
    (0, "true", "c", False, True, "data_source", "formula"),
    (1, "data_id % 3 = 0", "u", True, True, "data_source", f"concat('calcDailyStats(', {_quoted('view')}, ',', {_quoted('min')}, ')')"),
    (2, "data_id % 6 = 0", "u", True, True, "1", "formula"),
    (3, "data_id % 7 = 0", "d", True, False, "data_source", "formula"),
]


def point_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC rows of the point table: inserts, two updates in one batch, deletes, a point turned into a measured one."""
    rows = []
    for k, condition, op, before, after, source, formula in CHANGES:
        image = (
            "to_json(named_struct('data_id', data_id, 'company_id', company_id, 'object_id', object_id, 'data_code', "
            "data_code, 'data_type', data_type, 'data_source', {s}, 'formula', {f}))"
        )
        b = image.format(s="data_source", f="formula") if before else "cast(null AS string)"
        a = image.format(s=source, f=formula) if after else "cast(null AS string)"
        rows.append(
            f"if({condition}, named_struct('table', 'point', 'op', '{op}', 'before', {b}, 'after', {a}, "
            f"'seq', cast(data_id * 10 + {k} AS bigint)), null)"
        )
    return point_conf(spark, sf_dir).selectExpr(f"inline(filter(array({', '.join(rows)}), x -> x is not null))")


def object_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC rows of the object table: snapshot records, then every fifth device moves to another plant of its company."""
    image = "to_json(named_struct('object_id', object_id, 'parent_id', {p}, 'company_id', company_id, 'object_code', object_code, 'model_id', model_id, 'status', status))"
    now, moved = image.format(p="parent_id"), image.format(p="(parent_id + 1) % 10 + 1")
    rows = (
        f"named_struct('table', 'object', 'op', 'r', 'before', cast(null AS string), 'after', {now}, 'seq', cast(object_id * 10 AS bigint))",
        f"if(parent_id is not null and object_id % 5 = 0, named_struct('table', 'object', 'op', 'u', 'before', {now}, 'after', {moved}, 'seq', cast(object_id * 10 + 1 AS bigint)), null)",
    )
    return objects(spark, sf_dir).selectExpr(f"inline(filter(array({', '.join(rows)}), x -> x is not null))")


# --- history and probes ---
def history_columns(ms: str, stamp: str) -> list[str]:
    return [
        "event_id AS data_id", f"{stamp} AS data_date", "'source' AS data_type",
        "cast(396 + user_id % 2 AS string) AS company_id", "'161' AS project_id",
        "concat('gw', cast(user_id % 4 AS string)) AS gateway_code", "'tcp' AS protocol_code",
        "concat('m', cast(user_id % 7 AS string)) AS product_id", "concat('D', cast(user_id AS string)) AS device_id",
        "event_type AS property_name", "cast(value AS string) AS property_value", "value AS property_num_value",
        "concat('msg', cast(event_id AS string)) AS message_id", f"cast({ms} AS bigint) AS timestamp",
        f"{stamp} AS create_date", "cast(year(ts) AS int) AS year", "cast(month(ts) AS int) AS month",
        "cast(day(ts) AS int) AS day", "cast(hour(ts) AS int) AS hour",
    ]


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*history_columns(SPARK_MS, "cast(ts AS timestamp)"))


_TYPE_OF_ORDER = "case o_orderkey % 5 " + " ".join(f"when {i} then '{t}'" for i, t in enumerate(EVENT_TYPES)) + " end"
PROBE_COLUMNS = [
    "o_orderkey AS probe_id",
    "cast(396 + cast(floor(o_custkey / 10.0) AS bigint) % 2 AS string) AS company_id",
    "concat('D', cast(cast(floor(o_custkey / 10.0) AS bigint) AS string)) AS device_id",
    f"{_TYPE_OF_ORDER} AS property_name",
    f"cast({DAY0} + (o_orderkey * 7919 % 2592000) * 1000 AS bigint) AS ts_ms",
]


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One as-of key per order."""
    return table(spark, sf_dir, "orders").selectExpr(*PROBE_COLUMNS)
