"""Decoding, encoding, change records and table sinks."""

import json

import pytest
from helpers import MIN, T0, readings, rule, rules
from pyspark.sql import functions as F

from pointloom.operators.snapshot import device_origin, latest_snapshot
from pointloom.schemas import MODEL, RULE, RULE_KEY
from pointloom.sinks.encode import encode_envelope
from pointloom.sinks.tables import LogTable, preview, upsert_rule_table, write_derived
from pointloom.sources import changes, telemetry
from pointloom.sources.history import read_history, write_history


def envelope(datas, topic="/data/a/b/gw/396/161", meter="D1"):
    return json.dumps({"topic": topic, "payload": json.dumps({"meter": meter, "datas": datas})})


def raw(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value STRING")


def test_number_coercion(spark):
    values = ["7.5", "abc", 3, True, False, None, "NaN"]
    msg = envelope([{"nm": f"p{i}", "v": v, "ts": 1704067200} for i, v in enumerate(values)])
    got = {r.property_name: r.property_num_value for r in telemetry.decode_envelope(raw(spark, msg)).collect()}
    assert [got[f"p{i}"] for i in range(6)] == [7.5, 0.0, 3.0, 1.0, 0.0, 0.0] and got["p6"] != got["p6"]


def test_missing_fields_and_times(spark):
    msg = envelope([{"v": 1, "ts": "1704067200"}, {"nm": "q", "ts": 5.9}, {"nm": "r", "v": 2}])
    got = [(r.property_name, r.property_num_value, r.ts_ms) for r in telemetry.decode_envelope(raw(spark, msg)).collect()]
    assert got == [("", 1.0, 1704067200000), ("q", 0.0, 5000), ("r", 2.0, 0)]


@pytest.mark.parametrize(
    "topic, want",
    [
        ("/data/a/b/gw/396/161", ("gw", "396", "161")), ("x", ("unknown",) * 3), ("", ("unknown",) * 3),
        ("/data/a/b/gw/396/", ("gw", "396", "unknown")), ("/data/a/b/gw", ("gw", "unknown", "unknown")),
    ],
)
def test_topic(spark, topic, want):
    t = spark.range(1).select(telemetry.topic_fields(F.lit(topic)).alias("t")).select("t.*").first()
    assert (t.gateway_code, t.company_id, t.project_id) == want


def test_flat_points_and_rejects(spark):
    flat = {"company_id": "396", "device_id": "D1", "property_name": "p", "property_num_value": "2.5", "timestamp": T0, "more": [1]}
    df = raw(
        spark, json.dumps(flat), json.dumps({**flat, "timestamp": None}), json.dumps({**flat, "property_num_value": "x"}),
        "nonsense", '{"payload":{"meter":"D1"}}', '{"payload":"{broken"}', envelope(5), envelope([]),
    )
    assert [(r.device_id, r.property_num_value, r.ts_ms) for r in telemetry.decode_flat(df).collect()] == [("D1", 2.5, T0)]
    assert telemetry.decode(df).count() == 1
    reasons = sorted(r.reason for r in telemetry.rejects(df).collect())
    assert reasons == ["malformed message", "malformed payload", "malformed payload", "malformed point", "nested payload"]


def test_encode_then_decode(spark):
    r = readings(spark, [("D0", "a", 1.5, 0), ("D0", "b", -2, 10_000)])
    derived = latest_snapshot(r).withColumn("snapshot_ms", F.lit(T0 + 10_000))
    sent = encode_envelope(derived, device_origin(r), "/data/x/calc/tcp")
    body = json.loads(sent.orderBy("tick_ms").first().value)
    assert body["parseType"] == "calc" and body["topic"] == "/data/x/calc/tcp/396/161"
    inner = json.loads(body["payload"])
    assert inner["meter"] == "D0" and inner["mid"] == f"CALC-{T0 + MIN}"
    assert inner["datas"] == [{"nm": "a", "v": 1.5, "ts": (T0 + 10_000) // 1000}, {"nm": "b", "v": -2.0, "ts": (T0 + 10_000) // 1000}]
    back = telemetry.decode_envelope(sent.select("value"))
    assert back.count() == 30 and {x.project_id for x in back.collect()} == {"161"}
    unknown = json.loads(encode_envelope(derived).first().value)
    assert unknown["topic"].endswith("/396/unknown")


def debezium(op, table, before, after, ms):
    return json.dumps({"op": op, "before": before, "after": after, "source": {"table": table}, "ts_ms": ms})


def test_change_records_reduce_to_the_current_state(spark, tmp_path):
    m = lambda i, code: {"model_id": i, "company_id": 396, "object_code": code}
    lines = [
        debezium("r", "model", None, m(1, "A"), 1), debezium("u", "model", m(1, "A"), m(1, "B"), 2),
        debezium("c", "model", None, m(2, "C"), 3), debezium("d", "model", m(2, "C"), None, 4),
        debezium("c", "other", None, m(3, "X"), 5), debezium("c", "model", None, None, 6), "no json",
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    tables = changes.read_config_changes(spark, "text", ["model", "other"], str(tmp_path / "in"), stream=False)
    now = changes.apply_changes(tables["model"], MODEL, ["model_id"]).collect()
    assert [(r.model_id, r.object_code) for r in now] == [(1, "B")]
    assert tables["other"].count() == 1
    stream = changes.read_rule_changes(spark, "text", str(tmp_path / "in"))
    assert stream.isStreaming and stream.columns == ["table", "op", "before", "after", "seq"]


def test_rule_images_are_read_leniently(spark):
    row = {"company_id": "1", "device_code": "D", "point_code": "p", "point_type": "2", "expr_type": 0, "expr": "a", "depends_on": "[]", "params": None}
    cdc = spark.createDataFrame([("rules", "c", None, json.dumps(row), 1)], "table STRING, op STRING, before STRING, after STRING, seq BIGINT")
    got = changes.rule_images(cdc, RULE_KEY).first()
    assert (got.point_type, got.value_type, got.enabled, got.params) == (2, 0, 1, "")


def test_upsert_table_is_idempotent_per_batch(spark, tmp_path):
    apply = upsert_rule_table(spark, str(tmp_path / "rules"))
    table = LogTable(spark, str(tmp_path / "rules"), RULE, RULE_KEY)

    def batch(*rows):
        return rules(spark, *[r for r, _ in rows]).withColumn("_n", F.monotonically_increasing_id()).join(
            spark.createDataFrame([(r[2], r[6], s) for r, s in rows], "point_code STRING, expr STRING, seq INT"), ["point_code", "expr"]
        )

    apply(batch((rule("a", "1"), 1), (rule("b", "1"), 1)), 0)
    second = batch((rule("a", "2"), 5), (rule("a", "3"), 6), (rule("c", "1"), 5))
    apply(second, 1)
    apply(second, 1)
    assert sorted((r.point_code, r.expr) for r in table.read().collect()) == [("a", "3"), ("b", "1"), ("c", "1")]
    assert table.versions() == [0, 1] and table.read(before=1).count() == 2 and table.read(before=0).count() == 0


def test_written_batch_replaces_itself(spark, tmp_path):
    df = spark.range(5)
    for _ in range(2):
        write_derived(df, str(tmp_path / "out"), 7)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    assert preview(df, 2) is None


def test_history_is_pruned_by_partition_and_time(spark, sf_dir, tmp_path):
    from pointloom.plans import sample

    h = sample.history(spark, sf_dir)
    write_history(h, str(tmp_path / "h"))
    got = read_history(spark, str(tmp_path / "h"), T0 + 86_400_000, T0 + 2 * 86_400_000)
    want = h.where(F.col("timestamp").between(T0 + 86_400_000, T0 + 2 * 86_400_000))
    assert got.count() == want.count() > 0
    plan = got.select("timestamp")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "PushedFilters: [IsNotNull(timestamp)" in plan


def test_kafka_reader_only_needs_its_jar(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        telemetry.read_telemetry(spark, kafka_bootstrap_servers="localhost:1", subscribe="t")


def test_merge_statement_names_every_column_once():
    from pointloom.sinks.tables import merge_statement

    assert merge_statement("rule", "stage") == (
        "INSERT INTO rule (company_id, device_code, point_code, point_type, value_type, expr_type, expr, depends_on, params, enabled) "
        "SELECT company_id, device_code, point_code, point_type, value_type, expr_type, expr, depends_on, params, enabled FROM stage "
        "ON DUPLICATE KEY UPDATE point_type = VALUES(point_type), value_type = VALUES(value_type), expr_type = VALUES(expr_type), "
        "expr = VALUES(expr), depends_on = VALUES(depends_on), params = VALUES(params), enabled = VALUES(enabled)"
    )
