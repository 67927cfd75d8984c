"""The rule-sync job over several micro-batches against compiling the final configuration."""

import json

from pointloom.plans.compile import compile_rules
from pointloom.schemas import CDC, OBJECT, POINT_CONF, RULE, RULE_KEY
from pointloom.sinks.tables import LogTable
from pointloom.streaming.rules import sync_stream


def record(table, op, before, after, seq):
    return (table, op, before and json.dumps(before), after and json.dumps(after), seq)


def obj(i, parent, code, model=5, status=1):
    return {"object_id": i, "parent_id": parent, "company_id": 396, "object_code": code, "model_id": model, "status": status}


def point(i, o, code, formula, source=2):
    return {"data_id": i, "company_id": 396, "object_id": o, "data_code": code, "data_type": "0", "data_source": source, "formula": formula}


def test_several_batches_and_a_restart(spark, tmp_path):
    model = {"model_id": 5, "company_id": 396, "object_code": "M"}
    hour, day = "energyUseCalcNew('p','hour')", "energyUseCalcNew('p','day')"
    batches = [
        [
            record("object", "r", None, obj(1, None, "P", None), 1), record("object", "r", None, obj(10, 1, "C0"), 1), record("model", "r", None, model, 1),
            record("point", "r", None, point(1, 10, "a", hour), 1), record("point", "r", None, point(2, 10, "b", "calcConstant('p*2')"), 1),
            record("point", "r", None, point(3, 1, "sum", "calcSum('M','p')"), 1), record("point", "r", None, point(4, 10, "gone", hour), 1),
            record("point", "r", None, point(5, 10, "measured", hour), 1), record("point", "r", None, point(6, 77, "early", day), 1),
        ],
        [
            record("point", "u", point(1, 10, "a", hour), point(1, 10, "a", day), 5), record("point", "u", point(1, 10, "a", hour), point(1, 10, "a", "noSuch('x')"), 4),
            record("point", "d", point(4, 10, "gone", hour), None, 3), record("point", "u", None, point(5, 10, "measured", hour, 1), 3),
        ],
        [
            record("object", "u", obj(10, 1, "C0"), obj(10, 1, "C9"), 6), record("object", "c", None, obj(77, 1, "LATE", status=0), 6),
            record("point", "u", None, point(1, 10, "a", hour), 2),  # older than what is known
        ],
    ]
    seen = []

    def job():
        stream = spark.readStream.schema(CDC).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        return sync_stream(stream, str(tmp_path / "state"), str(tmp_path / "cp"), write=lambda u, i: seen.append((i, u.count())))

    for i, b in enumerate(batches):
        spark.createDataFrame(b, CDC).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        run = job().trigger(availableNow=True).start()  # a new query each time: it goes on where the last one stopped
        run.awaitTermination()
    got = {(r.device_code, r.point_code): (r.expr, r.enabled) for r in LogTable(spark, str(tmp_path / "state/rules"), RULE, RULE_KEY).read().collect()}
    points = spark.createDataFrame(
        [tuple(p.values()) for p in (point(1, 10, "a", day), point(2, 10, "b", "calcConstant('p*2')"), point(3, 1, "sum", "calcSum('M','p')"), point(5, 10, "measured", hour, 1), point(6, 77, "early", day))],
        POINT_CONF,
    )
    objects = spark.createDataFrame([tuple(o.values()) for o in (obj(1, None, "P", None), obj(10, 1, "C9"), obj(77, 1, "LATE", status=0))], OBJECT)
    want = {(r.device_code, r.point_code): (r.expr, r.enabled) for r in compile_rules(points, objects).collect()}
    assert {k: v for k, v in got.items() if k in want} == want and want[("LATE", "early")][1] == 0
    assert {k for k in got if k not in want} == {("C0", "a"), ("C0", "b"), ("C0", "gone"), ("C0", "measured")}
    assert all(got[k][1] == 0 for k in got if k not in want)
    assert [i for i, _ in seen] == [0, 1, 2]
